"""The table of records that grows: what an upsert touches, and what a lookup reads."""

import os
import re
import uuid

from pyspark.sql import functions as F

from docloom.session import folder
from docloom.sources.records import Records


def _plan(df) -> str:
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def _table(spark, where, parts=8, buckets=4):
    return Records(spark, f"records_{uuid.uuid4().hex}", where, "unique_id string, title string", parts=parts, buckets=buckets)


def _files(where):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(where.removeprefix("file:")) for f in fs if f.endswith(".parquet")}


def test_upsert_rewrites_touched_parts_only(spark):
    where = folder(spark, "records")
    t = _table(spark, where)
    old = spark.range(2000).select(F.col("id").cast("string").alias("unique_id"), F.lit("old").alias("title"))
    t.upsert(old)
    before = _files(where)
    assert len(before) <= 8 * 4
    new = spark.createDataFrame([("7", "new"), ("x", "added"), (None, "nobody's")], "unique_id string, title string")
    t.upsert(new)
    after = _files(where)
    touched = {re.search(r"_part=(\d+)", p)[1] for p in before.keys() ^ after.keys()}
    assert 1 <= len(touched) <= 2 and all(before[p] == after[p] for p in before.keys() & after.keys())
    got = {r.unique_id: r.title for r in t.rows().collect()}
    assert t.rows().count() == 2001 and got["7"] == "new" and got["x"] == "added" and got["8"] == "old"
    t.upsert(new.limit(0))
    assert {r.unique_id: r.title for r in t.rows().collect()} == got
    # opened anew from its folder
    assert {r.unique_id: r.title for r in _table(spark, where).rows().collect()} == got


def test_old_records_are_not_shuffled(spark):
    where = folder(spark, "records")
    t = _table(spark, where, 2, 4)
    t.upsert(spark.range(1000).select(F.col("id").cast("string").alias("unique_id"), F.lit("old").alias("title")))
    new = spark.range(500, 1500).select(F.col("id").cast("string").alias("unique_id"), F.lit("new").alias("title"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(t.merged(new))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the join's sides: the old one is sorted as it is scanned, the new one's keys are dealt to its buckets
    left, right = plan.split("LeftAnti")[1].split("Union")[0].split("SortMergeJoin")[-1].split("FileScan parquet", 1)
    assert "Exchange" not in left and "Bucketed: true" in right.split("\n")[0] and "Exchange hashpartitioning(unique_id" in right
    t.upsert(new)
    assert sorted((r.title, r["count"]) for r in t.rows().groupBy("title").count().collect()) == [("new", 1000), ("old", 500)]


def test_lookup_reads_one_bucket(spark):
    where = folder(spark, "records")
    t = _table(spark, where)
    t.upsert(spark.range(3000).select(F.col("id").cast("string").alias("unique_id"), F.concat(F.lit("t"), "id").alias("title")))
    one = t.lookup("1234")
    assert [tuple(r) for r in one.collect()] == [("1234", "t1234")] and t.lookup("none").count() == 0
    # without all other files it is still found: none of them is opened
    own = t.rows().filter("unique_id = '1234'").select(F.input_file_name()).first()[0].removeprefix("file://")
    everything = _files(where)
    assert own in everything and len(everything) > 16
    for path in everything.keys() - {own}:
        os.remove(path)
    assert [tuple(r) for r in one.collect()] == [("1234", "t1234")]
