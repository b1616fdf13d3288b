"""What several operators need: cutting lineage, tie-free row keys, distributed running sums and numbering."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut, folder, mark, shared_dir, sweep, written

__all__ = ["arrow_batches", "buckets_for", "cut", "fit_columns", "folder", "mark", "running_sum", "shared_dir", "sized", "slices", "small", "sweep", "written"]

#: Rows that one bucket of a distributed running sum holds on average.
BUCKET_ROWS = 4096
#: Rows, of a few numbers each, that are sent to every executor at most; a larger table is shuffled instead.
BROADCAST_ROWS = 1 << 19
#: Rows and bytes an Arrow batch holds at most, so that a batch of long texts stays small.
BATCH_ROWS, BATCH_BYTES = 1000, 32 << 20


def arrow_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches sent to Python workers, for the session, since plans are made when a result is read. All operators share these bounds; one
    that wants fewer rows at a time takes slices(), one that wants more sized()."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of `rows` rows at most."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def sized(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of `rows` rows, but for the last one."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            whole = pa.concat_batches(held)
            for i in range(0, n - n % rows, rows):
                yield whole.slice(i, rows)
            held, n = [whole.slice(n - n % rows)], n % rows
    if n:
        yield pa.concat_batches(held)


def small(table: DataFrame) -> DataFrame:
    """A written table of narrow rows, marked for broadcast if it has BROADCAST_ROWS at most: counted, not guessed."""
    return F.broadcast(table) if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else table


def fit_columns(df: DataFrame, needed: dict[str, str]) -> DataFrame:
    """Only the columns an operator works on, cast to its types; a missing one is null. Extra columns never clash."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(f"`{have[n.lower()]}`") if n.lower() in have else F.lit(None)).cast(t).alias(n) for n, t in needed.items()])


def buckets_for(rows: int) -> int:
    return max(1, -(-rows // BUCKET_ROWS))


def running_sum(df: DataFrame, group: list[str], bucket: str, order: list, value: Column, out: str) -> DataFrame:
    """Adds `out`, the sum of value over rows of the group up to and with the row, in (bucket, order) order.

    No task holds a whole group: sums of buckets are pre-aggregated, running totals are taken over the small table of
    buckets, and rows are only sorted within their bucket. Group columns must be non-null; bucket is a long."""
    keys = [*group, bucket]
    df = df.withColumn("_v", value)
    sums = df.groupBy(*keys).agg(F.sum("_v").alias("_bucket"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, F.coalesce(F.sum("_bucket").over(before), F.lit(0)).cast("long").alias("_before"))
    inner = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("_in", F.sum("_v").over(inner)).join(offsets, keys).withColumn(out, F.col("_before") + F.col("_in")).drop("_v", "_in", "_before")
