"""Names that stay taken from run to run: contents that were seen and titles that were given, in the state of a streaming query."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.numbering import number
from ..session import written

#: Names share so many keys of the state by their hash. A registry keeps the number it began with.
BUCKETS = 64
FEED = "name string, first string, n long"
ANSWER = "batch long, name string, first string, before long"
# the worker that Spark starts on the driver to look at a state's schema knows no files that were sent to the executors
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Taken(StatefulProcessor):
    """Of each name the first holder and how often it was taken, in a map per key: a batch reads and writes only the names that it has."""

    def __init__(self, batch: int) -> None:
        self.batch = batch

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getMapState("held", "name string", "first string, n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for part in rows:
            found = []
            for name, first, n in zip(part["name"], part["first"], part["n"].tolist()):
                holder, before = self.held.getValue((name,)) or (first, 0)
                self.held.updateValue((name,), (holder, before + n))
                found.append((self.batch, name, holder, before))
            yield pd.DataFrame(found, columns=["batch", "name", "first", "before"])


def _session(spark: SparkSession) -> SparkSession:
    s = spark.newSession()
    for k, v in {
        "spark.sql.shuffle.partitions": spark.conf.get("spark.sql.shuffle.partitions"), "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true", "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false", "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    }.items():
        s.conf.set(k, v)
    return s


def take(names: DataFrame, where: str, batch: int, buckets: int = BUCKETS) -> DataFrame:
    """(name, first, before) of a batch's names (name, first, n), each there once: the first holder of each, in this batch or an earlier one, and how often it was
    taken before. The registry lies in folder `where`, and its batches are numbered upwards.

    A batch is written beside the feed and moved into it whole, and a streaming query, started anew on the registry's checkpoint, takes it up once. So a batch that
    stopped anywhere can be run again, and one that ended gives its answers again, whatever names it is then called with. Null names are left out."""
    spark = names.sparkSession
    s = _session(spark)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fed, staged = path(f"{where}/feed/{batch:09d}"), path(f"{where}/staged/{batch:09d}")
    fs = fed.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(fed):
        names.filter("name IS NOT NULL").select("name", "first", F.col("n").cast("long").alias("n")).write.mode("overwrite").parquet(str(staged))
        fs.mkdirs(fed.getParent())
        if not fs.rename(staged, fed):
            raise OSError(f"{staged} can't be moved to {fed}")
    stream = s.readStream.schema(FEED).parquet(f"{where}/feed/*")
    bucket = F.pmod(F.xxhash64("name"), F.lit(buckets))
    found = stream.select(bucket.alias("bucket"), "name", "first", "n").groupBy("bucket").transformWithStateInPandas(Taken(batch), ANSWER, "append", "none")
    found.writeStream.format("parquet").option("path", f"{where}/answers").option("checkpointLocation", f"{where}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(ANSWER).parquet(f"{where}/answers").filter(F.col("batch") == batch).drop("batch")


def run(files: DataFrame, where: str, batch: int, buckets: int = BUCKETS) -> DataFrame:
    """path, unique_title of those of a batch's files (path, title, n_bytes, sha256) whose content no file had before, in this batch or an earlier one. A title's first
    file has it as it is, and the next ones, in later batches too, get _1, _2 and so on; within a batch files go by path.

    Contents and titles meet as one row each, so a title or content that a third of all files have is no large group. Paths are unique; null content is no
    content and equals nothing; a null title stays null."""
    files = written(files.withColumn("_content", F.concat_ws(":", F.col("n_bytes").cast("string"), F.when(F.col("n_bytes").isNotNull(), F.col("sha256")))))
    has = F.col("sha256").isNotNull() & F.col("n_bytes").isNotNull()
    contents = take(files.filter(has).groupBy(F.col("_content").alias("name")).agg(F.min("path").alias("first"), F.count("*").alias("n")), f"{where}/contents", batch, buckets)
    # a survivor's path is its content's first one; contents without a file here that came first are earlier batches'
    own = files.filter(has).join(contents.filter("before = 0").select(F.col("first").alias("path")), "path", "left_semi")
    kept = written(number(own.unionByName(files.filter(~has)).select("path", "title"), ["title"], [F.col("path")], "_turn"))
    titles = take(kept.groupBy(F.col("title").alias("name")).agg(F.min("path").alias("first"), F.max("_turn").alias("n")), f"{where}/titles", batch, buckets)
    given = kept.join(titles.select(F.col("name").alias("title"), "before"), "title", "left")
    place = F.col("before") + F.col("_turn") - 1
    return given.select("path", F.when(place > 0, F.concat_ws("_", "title", place.cast("string"))).otherwise(F.col("title")).alias("unique_title"))
