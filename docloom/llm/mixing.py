"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: A word.
WORD = r"[^\x20\x09-\x0D]+"
#: Weights by rank of the source, repeating.
WEIGHTS = (5, 2, 1)
#: A target is at most so many times its source's size.
MOST_REPEATS = 3


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], repeats: int, share: float) -> DataFrame:
    """(source, source_size, target) of a table (source, source_size): one row a source.

    The budget, share x all sizes, is split by weight; a target above repeats x source_size stops there and its excess is
    reshared by weight until none is above. Sorted by the level at which they stop, the sources that stop are a prefix, so
    running sums give the level at which the others settle."""
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    t = sizes.withColumn("weight", weight).withColumn("most", (F.col("source_size") * repeats).cast("double"))
    t = t.withColumn("stops_at", F.col("most") / F.col("weight")).withColumn("budget", F.sum("source_size").over(everything) * float(share))
    order = [F.col("stops_at"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    t = t.withColumn("level", (F.col("budget") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
    # the first source that does not stop at the level its predecessors leave settles the level; later ones would find a lower one
    t = t.withColumn("level", F.max(F.when(F.col("level") <= F.col("stops_at"), F.col("level"))).over(everything))
    target = F.when(F.col("level").isNull(), F.col("most")).otherwise(F.least(F.col("most"), F.col("weight") * F.col("level")))
    return t.select("source", "source_size", target.alias("target"))


def _within(turn: Column) -> Column:
    """Whether half of a document's copy, in the given pass over its source, lies within the target."""
    return F.col("cum") + turn * F.col("source_size") - F.col("size") / 2.0 <= F.col("target")


def row_hash(id_col: str, source_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(f"`{id_col}`").cast("long"), F.col(f"`{source_col}`").cast("string"), F.col(f"`{text_col}`").cast("string"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix itself: the rows of docs that it takes, each as often as it takes it, with all their columns."""
    taken = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **how)
    taken = taken.groupBy("doc_id", "row_hash").agg(F.sum("copies").cast("int").alias("copies")).filter("copies > 0")
    taken = taken.select(F.coalesce("doc_id", F.lit(0)).alias("_docloom_id"), F.col("row_hash").alias("_docloom_hash"), F.col("copies").alias("_docloom_copies"))
    keyed = docs.withColumns({"_docloom_id": F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(0)), "_docloom_hash": row_hash(id_col, source_col, text_col)})
    # repeated rows are one here; their copies are added up
    found = keyed.join(taken, ["_docloom_id", "_docloom_hash"]).dropDuplicates(["_docloom_id", "_docloom_hash"])
    return found.withColumn("_docloom_copy", F.explode(F.sequence(F.lit(1), F.col("_docloom_copies")))).drop("_docloom_id", "_docloom_hash", "_docloom_copies", "_docloom_copy")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, repeats: int = MOST_REPEATS, share: float = 1.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Mixes all documents; returns doc_id, source, row_hash (of both and the text), size (words), source_size, target, taken (words, repeats
    counted), copies.

    Every source's documents are shuffled by a hash of doc_id and text and queue up, up to `repeats` times over. A copy's virtual
    finish time is its source's cumulative words, this copy with them, over the source's target. All copies are put in order of
    finish time, and taken while their cumulative words stay within the budget. A copy of which more than half lies beyond its source's target stays
    out, so that others' words never fill a gap that a long document leaves. Documents aren't cut: a source's taken words differ from its target by
    less than its longest document.

    A null source is a source of its own, ranked last; null or blank text has size 0 and nothing is taken of it; repeated rows
    queue each on their own (identical ones are interchangeable); an empty table gives an empty result. No task sorts a whole
    source or the whole queue: both orders are cut into buckets, whose sums are added up first."""
    rows = common.fit_columns(docs, {id_col: "long", text_col: "string", source_col: "string"})
    rows = common.cut(rows.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), row_hash(id_col, source_col, text_col).alias("row_hash"), words(F.col(text_col)).alias("size"), F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("/"), F.coalesce(F.col(text_col), F.lit(""))).cast("binary")), 1, 15), 16, 10).cast("long").alias("turn")))
    wide = common.buckets_for(rows.count())
    aims = common.cut(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, repeats, share).withColumn("queue", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long")))

    queued = rows.join(aims.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    queued = queued.withColumn("bucket", F.floor(F.col("turn") / float(1 << 60) * wide))
    queued = common.running_sum(queued, ["queue"], "bucket", ["turn", F.col("doc_id").asc_nulls_first(), "size"], F.col("size"), "cum")
    finish = (F.col("cum") + F.col("pass") * F.col("source_size")) / F.col("target")
    queued = common.cut(queued.filter((F.col("size") > 0) & (F.col("target") > 0)))

    # at most `repeats` copies a document; only their finish times are needed to find the last one taken
    copies = queued.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))).filter(_within(F.col("pass"))).withColumn("finish", finish)
    copies = copies.withColumn("slice", F.floor(F.least(F.col("finish"), F.lit(float(2 * repeats))) * wide)).select("queue", "doc_id", "turn", "pass", "size", "finish", "slice")
    total = aims.agg(F.sum("source_size")).first()[0] or 0
    budget = float(total) * float(share)
    slices = copies.groupBy("slice").agg(F.sum("size").alias("words"))
    slices = slices.withColumn("upto", F.sum("words").over(Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)))
    first_over = slices.filter(F.col("upto") > budget).orderBy("slice").limit(1).collect()
    if not first_over:
        end = (float("inf"), 0, 0, 0)
    else:  # the slice in which the budget ends: one bucket of copies is range-sorted for the exact place
        left = budget - (first_over[0]["upto"] - first_over[0]["words"])
        edge = copies.filter(F.col("slice") == first_over[0]["slice"])
        order = ["finish", "queue", "turn", "pass"]
        edge = edge.withColumn("upto", F.sum("size").over(Window.orderBy(*order, F.col("doc_id").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)))
        stop = edge.filter(F.col("upto") > left).orderBy(*order).limit(1).collect()[0]
        end = tuple(stop[c] for c in order)
    # copies before the first one that would exceed the budget are in
    taken = F.lit(0)
    for k in range(repeats):
        f = (F.col("cum") + k * F.col("source_size")) / F.col("target")
        here = F.struct(f.alias("a"), F.col("queue").alias("b"), F.col("turn").alias("c"), F.lit(k).alias("d"))
        there = F.struct(F.lit(float(end[0])).alias("a"), F.lit(int(end[1])).cast("long").alias("b"), F.lit(int(end[2])).cast("long").alias("c"), F.lit(int(end[3])).alias("d"))
        taken = taken + (_within(F.lit(k)) & (here < there)).cast("int")
    done = queued.withColumn("copies", taken).select("doc_id", "source", "row_hash", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies")
    idle = rows.join(aims.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).filter((F.col("size") == 0) | (F.col("target") <= 0))
    return done.unionByName(idle.select("doc_id", "source", "row_hash", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"), F.lit(0).alias("copies")))
