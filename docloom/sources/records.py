"""A table of records by identifier that grows: an upsert rewrites the parts it touches only, and a lookup reads one bucket's files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PART = "_part"


class Records:
    """Records in Parquet in folder `where`, in parts and in each part in buckets by the key's hash, sorted by it and with its Bloom filter. The table is opened anew by the
    same call with the same key, parts and buckets.

    Parts are what an upsert writes anew, buckets the tasks that join it; choose them so that a bucket of a part is some 100 MB. Null keys are left out. There is one
    record per key as long as those of each upsert have each key once. One writer at a time: a run that stops while Spark moves its new parts into
    place may leave one of them in the table's staging folder."""

    def __init__(self, spark: SparkSession, name: str, where: str, schema: str, key: str = "unique_id", parts: int = 16, buckets: int = 16) -> None:
        self.spark, self.name, self.key, self.parts, self.buckets = spark, name, key, parts, buckets
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{name}` ({schema}, {PART} int) USING parquet OPTIONS ('parquet.bloom.filter.enabled#{key}' 'true') "
            f"PARTITIONED BY ({PART}) CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{where}'"
        )
        spark.sql(f"ALTER TABLE `{name}` RECOVER PARTITIONS")

    def _part(self, key: Column) -> Column:
        # another hash than the one that deals keys to buckets, so each part has keys of all buckets
        return F.pmod(F.xxhash64(key), F.lit(self.parts)).cast("int")

    def rows(self) -> DataFrame:
        return self.spark.table(f"`{self.name}`").drop(PART)

    def merged(self, new: DataFrame) -> DataFrame:
        """What an upsert of these rows writes: the parts they touch, whole. The records that are there are read from these parts only, and aren't shuffled."""
        table = self.spark.table(f"`{self.name}`")
        new = new.filter(F.col(self.key).isNotNull()).withColumn(PART, self._part(F.col(self.key))).select(*table.columns)
        touched = [r[0] for r in new.select(PART).distinct().collect()]  # as many as there are parts, at most
        old = table.filter(F.col(PART).isin(touched))
        return old.join(new.select(self.key), self.key, "left_anti").select(*table.columns).unionByName(new.repartition(self.buckets, F.col(self.key)))

    def upsert(self, new: DataFrame) -> None:
        """Puts records in place of those of equal key, and adds the others. `new` is read twice; it must not be made from this table."""
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")
        try:
            self.merged(new).write.mode("overwrite").insertInto(f"`{self.name}`")
        finally:
            self.spark.conf.set(mode, before)

    def lookup(self, key: str) -> DataFrame:
        """The record of one key: one part's one bucket is read, of which row groups without the key are skipped."""
        return self.spark.table(f"`{self.name}`").filter((F.col(PART) == self._part(F.lit(key))) & (F.col(self.key) == key)).drop(PART)
