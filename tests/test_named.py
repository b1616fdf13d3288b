"""Files with their own names, moves that are run again, and a taxonomy as a table."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from docloom.operators.taxonomy import Taxonomy, keyword_hits, table_hits
from docloom.operators import taxonomy
from docloom.sources import named

ROWS = [(f"doc [{i}]_chunk_{i}.txt", f"tëxt {i}") for i in range(30)]


def test_a_failed_task_leaves_no_file(spark, tmp_path):
    rows = spark.createDataFrame(ROWS, "name string, content string").repartition(3)
    bad = rows.withColumn("content", F.when(F.col("name") == ROWS[17][0], F.raise_error(F.lit("stop"))).otherwise(F.col("content")))
    with pytest.raises(Exception, match="stop"):
        named.write_named(bad, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists() or list((tmp_path / "out").iterdir()) == []
    named.write_named(rows, f"file:{tmp_path}/out")
    assert {p.name: p.read_text() for p in (tmp_path / "out").iterdir()} == dict(ROWS)


def test_names_that_are_there(spark, tmp_path):
    rows = spark.createDataFrame(ROWS[:2], "name string, content string")
    named.write_named(rows, str(tmp_path))
    (tmp_path / "other").write_text("stays")
    with pytest.raises(Exception, match="there already"):
        named.write_named(rows, str(tmp_path))
    named.write_named(rows.withColumn("content", F.lit(None).cast("string")), str(tmp_path), overwrite=True)
    assert sorted((p.name, p.read_text()) for p in tmp_path.iterdir()) == sorted([(n, "") for n, _ in ROWS[:2]] + [("other", "stays")])
    for name in ("a/b", "", "..", None, "x" * 256):
        with pytest.raises(Exception, match="no file's name"):
            named.write_named(spark.createDataFrame([(name, "x")], "name string, content string"), str(tmp_path))


def test_moves_go_on_after_a_crash(spark, tmp_path):
    for i in range(6):
        (tmp_path / f"{i}").write_text(f"file {i}")
    pairs = [(str(tmp_path / f"{i}"), str(tmp_path / "new" / f"{i}")) for i in range(4)] + [(str(tmp_path / "4"), None), (str(tmp_path / "9"), str(tmp_path / "new" / "9"))]
    manifest = spark.createDataFrame(pairs, "source string, target string")
    named.carried_out(spark.createDataFrame(pairs[:2], manifest.schema)).collect()  # a run that stopped half-way: two are moved, and of a third the copy is made but the source still there
    (tmp_path / "new" / "2").write_text("file 2")
    (tmp_path / "new" / "3").write_text("another file")
    assert [r.status for r in named.carried_out(manifest).sort("source").collect()] == ["done", "done", "moved", "taken", "deleted", "lost"]
    assert [r.status for r in named.carried_out(manifest).sort("source").collect()] == ["done", "done", "done", "taken", "done", "lost"]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["3", "5", "new"]
    chain = spark.createDataFrame([("a", "b"), ("b", "c")], "source string, target string")
    with pytest.raises(ValueError, match="twice"):
        named.carried_out(chain)


def test_hashes_of_files_a_piece_at_a_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(named, "PIECE", 7)
    (tmp_path / "f").write_bytes(b"x" * 100)
    rows = named.hashed_files(spark.createDataFrame([(str(tmp_path / "f"),), (str(tmp_path / "none"),)], "path string")).collect()
    assert rows[0][1:] == (100, hashlib.sha256(b"x" * 100).hexdigest()) and rows[1][1:] == (None, None)


def test_a_taxonomy_as_a_table(spark, monkeypatch):
    monkeypatch.setattr(taxonomy, "SHARD", 3)
    words = {"categories": {"A": ["oak", "oak", "Oaks", ""], "B": ["ak tr", "é"]}, "tags": {"t": ["tree"], "u": []}}
    made = Taxonomy.parse(json.dumps({k: words.get(n, {}) for n, k in zip(("categories", "tags"), list(taxonomy.DIMENSIONS.values())[:2])}))
    docs = spark.createDataFrame([(1, "oaks and oak tree"), (2, ""), (3, None), (4, "é"), (5, "none")], "id long, t string")
    want = sorted(tuple(r) for r in keyword_hits(docs, made, "id", "t").collect())
    assert sorted(tuple(r) for r in table_hits(docs, made.table(spark), "id", "t").collect()) == want and want
    assert table_hits(docs, made.table(spark).limit(0), "id", "t").collect() == []


def test_a_hundred_thousand_keywords(spark):
    keywords = spark.range(100_000).select(F.lit("d").alias("dim"), (F.col("id") % 50).cast("int").alias("label_ord"), (F.col("id") % 50).cast("string").alias("label"), F.lit(0).alias("kw_ord"), F.concat(F.lit("w"), F.col("id").cast("string"), F.lit("x")).alias("keyword"))
    docs = spark.range(2000).select("id", F.concat_ws(" ", *[F.concat(F.lit("w"), (F.col("id") * k % 100_000).cast("string"), F.lit("x")) for k in (1, 7, 31)]).alias("t"))
    got = table_hits(docs, keywords, "id", "t").agg(F.sum("hits")).first()[0]
    assert got == sum(len({i * k % 100_000 for k in (1, 7, 31)}) for i in range(2000))
