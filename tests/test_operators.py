"""Operators on small tables: invariants of the chunker, identifiers, taxonomy, sinks, extraction and streaming."""

import json
import math
import os
import random
import sqlite3

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docloom import session
from docloom.operators import chunk, dedup, enrich, identity, image
from docloom.operators.numbering import number
from docloom.operators.taxonomy import Taxonomy
from docloom.plans import catalog, workflow
from docloom.sources import extract, files
from docloom.streaming import ingest

from .conftest import SF

W = chunk.Words()
TEXT = st.lists(st.sampled_from(["One two. ", "Three! ", "four five six ", "```code here``` ", "\n", "é? ", "open ``` ", ". . "]), max_size=25).map("".join)


# --- chunks -------------------------------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(1, 12), st.integers(0, 5))
def test_pack(text, most, overlap):
    got = chunk.pack(text, W, most, overlap)
    assert all(t == t.strip() for t, _ in got)
    pieces = [len(W.encode(p)) for k, s in chunk.segments(text) for p in ([s] if k == "code" else chunk.sentences(s))]
    assert all(n <= most + (overlap if overlap else 0) or n <= max(pieces) + overlap for _, n in got)
    everything = chunk.pack(text, W, 10**9, overlap)
    assert len(everything) == (1 if text.strip() else 0)
    if overlap == 0:
        assert "".join("".join(t.split()) for t, _ in got) == "".join(text.split())


def test_pack_cases():
    assert chunk.pack("", W) == [] and chunk.pack(" \n ", W) == []
    assert chunk.pack("a b. c d.", W, 4, 0) == [("a b. c d.", 4)]  # an exact fit stays
    assert chunk.pack("a b. c d.", W, 3, 0) == [("a b.", 2), ("c d.", 2)]
    assert chunk.pack("a b c d e. f.", W, 3, 1) == [("a b c d e.", 5), ("e. f.", 2)]  # an oversized first sentence is whole
    assert chunk.pack("a b. ```x y``` c.", W, 2, 1) == [("a b.", 2), ("```x y```", 2), ("y``` c.", 2)]  # no overlap before a fence
    assert chunk.segments("a ```b``` c ```d") == [("text", "a "), ("code", "```b```"), ("text", " c ```d")]


def test_sentence_windows():
    assert list(chunk.sentences("x" * 25 + " y", window=10)) == ["x" * 10, "x" * 10, "xxxxx y"]
    assert " ".join(chunk.sentences("aa bb cc dd ee", window=6)).split() == "aa bb cc dd ee".split()
    assert list(chunk.sentences('He said "no." Then 3.14 e.g. x')) == ['He said "no."', "Then 3.14 e.g.", "x"]


def test_overlap_cuts_characters(spark):
    p = pytest.importorskip("public_tokenizers")
    t = chunk.RankFile(p.path("byte_bpe_50k.tiktoken"), p.PATTERN)
    got = chunk.pack("日本語 " * 5 + ". " + "x y z. " * 3, t, 20, 3)
    assert len(got) > 1 and t.encode("<|endoftext|>")
    docs = spark.createDataFrame([("1", "a b. c d. " * 50, "k"), ("2", None, "k"), ("3", "", "k")], "unique_id string, text string, extra string")
    out = chunk.chunk_documents(docs, chunk.RankFile, (p.path("byte_bpe_50k.tiktoken"), p.PATTERN), 30, 5).collect()
    assert {r.unique_id for r in out} == {"1"} and [r.chunk_no for r in out] == list(range(1, len(out) + 1)) and out[0].extra == "k"


def test_chunk_names(spark):
    df = chunk.chunk_names(spark.createDataFrame([("a [123456].txt", 2)], "file_name string, chunk_no int"))
    assert df.first().file_name == "a [123456]_chunk_2.txt"


# --- duplicates, numbers, identifiers -----------------------------------------------------------


def test_dedup(spark):
    rows = [("b", b"x"), ("a", b"x"), ("c", b"y"), ("d", None), ("e", None), ("f", b"")]
    df = spark.createDataFrame(rows, "path string, content binary")
    assert sorted(r.path for r in dedup.exact_dedup(df).collect()) == ["a", "c", "d", "e", "f"]
    assert [tuple(r) for r in dedup.removed(df).collect()] == [("b", "a")]
    assert dedup.exact_dedup(df.limit(0)).count() == 0
    again = [("a", b"x"), ("a", b"x"), ("b", b"x"), ("b", b"z"), ("b", b"z"), (None, b"x"), (None, b"q"), (None, b"q"), ("d", None), ("d", None), ("e", b"y")]
    df = spark.createDataFrame(again, "path string, content binary").withColumn("sha256", F.lit("clash"))
    got = dedup.exact_dedup(df)
    assert got.columns == df.columns
    key = lambda r: (r[0] or "", r[1] or b"")
    assert sorted(((r.path, r.content and bytes(r.content)) for r in got.collect()), key=key) == sorted([("a", b"x"), ("b", b"z"), (None, b"q"), ("d", None), ("d", None), ("e", b"y")], key=key)
    assert sorted(map(tuple, dedup.removed(df).collect()), key=str) == sorted([("b", "a"), (None, "a")], key=str)


def test_numbers(spark):
    rows = [(i % 3 if i % 7 else None, -i) for i in range(500)]
    got = number(spark.createDataFrame(rows, "g int, v int"), ["g"], [F.col("v")], "n").collect()
    for g in (0, 1, 2, None):
        own = sorted((r.v, r.n) for r in got if r.g == g)
        assert [n for _, n in own] == list(range(1, len(own) + 1))
    assert sorted((r.v, r.n) for r in number(spark.createDataFrame(rows, "g int, v int"), [], [F.col("v")], "n").collect())[0] == (-499, 1)


def test_unique_titles(spark):
    rows = [(f"p{i:03}", t) for i, t in enumerate(["x", "y", "x", "unknown_title", "x", "unknown_title"])]
    got = {r.path: r.unique_title for r in dedup.unique_titles(spark.createDataFrame(rows, "path string, title string")).collect()}
    assert got == {"p000": "x", "p001": "y", "p002": "x_1", "p003": "unknown_title", "p004": "x_2", "p005": "unknown_title_1"}


def test_ids(spark):
    used = spark.createDataFrame([("100000",), ("junk",), ("100002",)], "unique_id string")
    got = identity.assign_ids(spark.createDataFrame([("b",), ("a",), ("c",)], "k string"), used, [F.col("k")])
    assert {r.k: r.unique_id for r in got.collect()} == {"a": "100001", "b": "100003", "c": "100004"}
    full = spark.range(100000, 1000000).select(F.col("id").cast("string").alias("unique_id"))
    with pytest.raises(ValueError, match="free"):
        identity.assign_ids(spark.range(1), full, [F.col("id")])


@pytest.fixture(scope="module")
def ranks():
    make, args = catalog._tokenizer()
    return make(*args)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["one", "Two's", " ", "  ", "\n", "\t", "\x1c", "\u00a0", "\u3000", "\x85", ".", "!?", "12", "é", "\u0301", "'s", "_", "```", "🙂"]), max_size=60).map("".join))
def test_tail(ranks, text):
    assert all(ranks.tail(text, n) == ranks.encode(text)[-n:] for n in (1, 2, 3, 5))


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(1, 40), st.integers(0, 8))
def test_pack_uncounted(ranks, text, most, overlap):
    assert all(chunk.pack_uncounted(text, t, most, overlap) == [c for c, _ in chunk.pack(text, t, most, overlap)] for t in (W, ranks))


def test_short_texts_are_not_encoded():
    """To be packed; and of a long chunk not all is, to find its last tokens."""
    make, args = catalog._tokenizer()
    t, encode, seen = make(*args), make(*args).encode, []
    t.encode = lambda text: seen.append(len(text)) or encode(text)
    assert chunk.pack_uncounted("The same words. " * 180, t) == [("The same words. " * 180).strip()] and not seen
    assert t.tail("The same words. " * 9000, 200) == encode("The same words. " * 9000)[-200:] and sum(seen) < 4000


# --- taxonomy and metadata ----------------------------------------------------------------------

TAX = Taxonomy.parse('{"CATEGORY_KEYWORDS": {"A": ["Xx", "yy", ""], "B": ["zz", "yy", "zz"], "C": ["q-q"]}, "TAG_KEYWORDS": {"T1": ["aa"], "T2": ["aa", "b"], "T3": ["aa"], "T4": ["aa"], "T5": ["aa"], "T6": ["aa"]}, "RESEARCH_TYPE_KEYWORDS": {}, "SENTIMENT_TYPE": {"S": ["s"]}}')


def test_labels(spark):
    rows = ["xx yy", "yy", "zz", "nothing", "q-q qq", "xxyyzz", ""]
    df = spark.createDataFrame([(t,) for t in rows], "t string").select("t", TAX.top1(F.col("t"), "category").alias("c"), TAX.top1(F.col("t"), "research_type").alias("r"))
    assert {r.t: r.c for r in df.collect()} == {"xx yy": "A", "yy": "A", "zz": "B", "nothing": "Uncategorized", "q-q qq": "C", "xxyyzz": "B", "": "Uncategorized"}
    assert {r.r for r in df.collect()} == {"Unclassified"}
    tags = spark.createDataFrame([("aa b",)], "t string").select(TAX.tags(F.col("t")).alias("x")).first().x
    assert tags == ["T1", "T2", "T3", "T4", "T5"]


def test_relevance(spark):
    texts = ["aa " * 99, "aa " * 100, "w " * 100, "aaa " + "w " * 199, "b" + " w" * 999]
    got = [r.x for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", TAX.relevance(F.col("t")).alias("x")).orderBy("i").collect()]

    def want(t):
        n = len(t.split())
        m = sum(t.count(k.lower()) for _, ks in TAX.labels["tag"] for k in ks)
        return 1 if n < 100 or not m else min(100, max(1, round(math.log10(1 + m / n * 1000) * 77)))

    assert got == [want(t) for t in texts]


def test_texts_go_to_python_once(spark):
    """Repair, normal form, words to skip, labels and relevance are one pass over a text, and none of Java's patterns goes through it."""
    plan = catalog.queries()["pipeline_summary"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 2  # the documents, and the special rows
    assert "regexp_replace" not in plan and "split(" not in plan


def test_taxonomy_file(spark):
    t = Taxonomy.load(spark, catalog.TAXONOMY)
    assert t.table(spark).groupBy("dim").count().count() == 4 and t.table(spark).filter("keyword = 'quest'").count() == 2


def test_last_chunk_wins_and_upsert(spark):
    rows = [("c [100001]_chunk_9.txt", "nine 1999"), ("c [100001]_chunk_10.txt", "ten"), ("c.txt", "no id")]
    records = enrich.metadata(spark.createDataFrame(rows, "file_name string, text string"), TAX)
    last = enrich.last_chunk_wins(records)
    assert [(r.unique_id, r.title, r.year) for r in last.collect()] == [("100001", "nine 1999", "1999")]
    old = enrich.stored(last).withColumn("title", F.lit("old"))
    assert [r.title for r in enrich.upsert(old, enrich.stored(last)).collect()] == ["nine 1999"]
    assert enrich.upsert(old, enrich.stored(last).limit(0)).first().title == "old"


def test_workflow_and_sinks(spark, tmp_path):
    docs = spark.createDataFrame([("100001", "a [100001].txt", "Title line. " + "aa xx. " * 200), ("100002", "b [100002].txt", "Title line. " + "aa xx. " * 200), ("100003", "c [100003].txt", "Other.")], "unique_id string, file_name string, text string")
    out = workflow.run(docs, TAX, chunk.Words, (), 100, 10)
    assert out["unique"].count() == 2
    final = out["final"].collect()
    assert len(final) > 4 and all(r.chunk.token_count == len(W.encode(r.chunk.text)) for r in final)
    assert {r.metadata.category for r in final if r.metadata.unique_id == "100001"} == {"A"} and final[0].file_name.endswith(".pdf")
    files.write_metadata(out["records"], str(tmp_path / "m"))
    again = files.metadata_json(spark, str(tmp_path / "m"))
    assert sorted(map(tuple, again.select("unique_id", "title").collect())) == sorted(map(tuple, out["records"].select("unique_id", "title").collect()))
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "1.json").write_text('{\n "unique_id": "1",\n "tags": ["x"]\n}')
    (tmp_path / "one" / "2.json").write_text("broken")
    assert [(r.unique_id, r.tags) for r in files.metadata_json(spark, str(tmp_path / "one"), True).collect()] == [("1", ["x"])]
    files.write_documents(out["final"], str(tmp_path / "f"))
    assert spark.read.json(str(tmp_path / "f")).select("metadata.unique_id", "chunk.token_count").count() == len(final)
    for _ in range(2):
        files.sqlite_rows(enrich.stored(out["records"]), str(tmp_path / "db"))
    with sqlite3.connect(tmp_path / "db") as db:
        assert db.execute("SELECT count(*) FROM metadata").fetchone() == (2,)


def test_files(spark, tmp_path):
    (tmp_path / "a [123456].TXT").write_bytes("é\r\nx\ry".encode())
    (tmp_path / "b+c%.txt").write_text("z")
    (tmp_path / "x.pdf").write_bytes(b"%PDF" + b"0" * 2000)
    got = {r.file_name: r.text for r in files.text_files(spark, str(tmp_path)).collect()}
    assert got["a [123456].TXT"] == "é\nx\ny" and "b+c%.txt" in got
    found = files.initial_bytes(files.binary_files(spark, str(tmp_path))).collect()
    assert len(found) == 1 and len(found[0].prefix) == 1024
    files.append_ids(spark.createDataFrame([("100001",), ("",)], "unique_id string"), str(tmp_path / "ids"))
    assert [r.unique_id for r in files.used_ids(spark, str(tmp_path / "ids")).collect()] == ["100001"]


# --- images -------------------------------------------------------------------------------------


def test_pixels(spark):
    data = bytes([1, 2, 3, 4, 5, 6])
    schema = "image_id string, image struct<height:int,width:int,nChannels:int,data:binary>"
    df = spark.createDataFrame([("c", (1, 2, 3, bytearray(data))), ("g", (1, 1, 1, bytearray(b"\x07"))), ("e", (0, 0, 3, bytearray()))], schema)
    got = sorted(tuple(r) for r in image.pixels(df).collect())
    assert got == [("c", 1, 2, 3), ("c", 4, 5, 6), ("g", 7, 7, 7)]
    rows, whole = ({r.image_id: r.colorfulness for r in x.collect()} for x in (image.colorfulness(image.pixels(df)), image.image_colorfulness(df)))
    assert rows["g"] == 0 and whole["e"] == 0 and whole["c"] == pytest.approx(rows["c"]) and whole["g"] == 0


# --- extraction ---------------------------------------------------------------------------------


def test_extraction_ladder(spark, tmp_path):
    def first(content):
        if content == b"broken":
            raise ValueError("no")
        return {b"good": ["p1", "p2"], b"scan": [" ", ""]}.get(content, [])

    made = extract.Extractor(pages=[first, lambda c: ["", "backup"] if c != b"empty" else []], ocr=lambda c: ["seen"] if c == b"scan" else [], images=lambda c: [(1, "png", b"i"), (1, "png", b"skip"), (2, "jpg", b"bad")] if c == b"good" else 1 / 0, tables=lambda c: [[{"a": "1"}]], keep_image=lambda i: {b"i": True, b"skip": False}[i])
    found = extract.extract(spark.createDataFrame([(x.decode(), x) for x in (b"good", b"scan", b"broken", b"empty")], "path string, content binary"), made)
    rows = found.collect()
    assert extract.texts(found).count() == 4 and [(r.page_no, r.image_no, bytes(r.content)) for r in extract.images(found).collect()] == [(1, 1, b"i")]
    assert {(r.path, r.table_no, r.row_no, r.cells["a"]) for r in extract.table_rows(found).collect()} == {(p, 1, 1, "1") for p in ("good", "scan", "broken", "empty")}
    assert extract.problems(found).count() == 4
    files.write_images(extract.images(found), str(tmp_path / "i"))
    files.write_tables(extract.table_rows(found).withColumnRenamed("path", "unique_id"), str(tmp_path / "t"))
    read = spark.read.option("header", True).csv(str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "i")).count() == 1 and read.count() == 4 and {r.a for r in read.collect()} == {"1"}
    files.write_text(extract.texts(found).withColumnRenamed("path", "unique_id"), str(tmp_path / "x"))
    assert {r.unique_id: r.text for r in spark.read.json(str(tmp_path / "x")).collect()}["good"] == "p1\np2"
    text = {r.path: (r.text, r.status) for r in rows if r.kind == "text"}
    assert text["good"] == ("p1\np2", "ok") and text["scan"] == (" \nseen\n", "ok") and text["broken"] == ("backup", "ok") and text["empty"][1] == "blank"
    pictures = [(r.page_no, r.item_no, r.status == "ok") for r in rows if r.kind == "image" and r.path == "good"]
    assert pictures == [(1, 1, True), (2, 1, False)]
    assert sum(r.kind == "table" for r in rows) == 4 and sum(r.kind == "problem" for r in rows) == 3


def test_table_csv(spark):
    rows = [("1", 1, 1, {"a": "x", "b": 'say "hi"'}), ("1", 1, 2, {"b": "2,5", "c": "line\nend"}), ("1", 2, 1, {"z": ""})]
    got = {(r.unique_id, r.table_no): r.csv for r in files.table_csv(spark.createDataFrame(rows, "unique_id string, table_no int, row_no int, cells map<string,string>")).collect()}
    import csv
    import io

    assert list(csv.reader(io.StringIO(got["1", 1]))) == [["a", "b", "c"], ["x", 'say "hi"', ""], ["", "2,5", "line\nend"]] and list(csv.reader(io.StringIO(got["1", 2]))) == [["z"], [""]]


def test_relevant_images():
    grey, red = np.full((50, 3), 90, np.uint8), np.tile(np.array([[0, 0, 255], [0, 255, 0]], np.uint8), (25, 1))
    pictures = {b"grey": grey, b"red": red}
    words = {b"grey": "w " * 11, b"red": "w " * 99}
    rule = image.relevant(pictures.__getitem__, words.__getitem__)
    assert not rule(b"grey") and rule(b"red")
    words[b"grey"] = " one two "
    assert rule(b"grey") and image.colourful(np.empty((0, 3))) == 0


def split_at_bars(text):
    return [part.strip() for part in text.split("|")]


def test_sentence_model_is_passed_on(spark):
    docs = spark.createDataFrame([("1", "a [100001].txt", "one two | three. four | five")], "unique_id string, file_name string, text string")
    out = workflow.run(docs, TAX, chunk.Words, (), 2, 0, split=split_at_bars)
    assert [r.text for r in out["chunks"].orderBy("chunk_no").collect()] == ["one two", "three. four", "five"]


def test_files_to_json(spark, tmp_path):
    """From a folder of files to nested JSON: copies go, titles come from the metadata, the biggest font, the first line or the first title, and every back-end is used."""
    home = tmp_path / "in"
    home.mkdir()
    parts = {"b.pdf": "title=Deep Sea Report 2020\fFirst page aa xx. More aa.\fSecond page.", "a.PDF": "\fsmall big|BIGGEST WORDS\f", "copy.pdf": "title=Deep Sea Report 2020\fFirst page aa xx. More aa.\fSecond page.", "c.pdf": "\fA long first line\nrest of it", "d.pdf": "\f\n", "x.txt": "no"}
    for name, text in parts.items():
        (home / name).write_text(text)

    def pages(content):
        return content.decode().split("\f")[1:]

    def spans(content):
        if b"BIGGEST" not in content:
            return []
        return [(1, 8.0, "small big"), (1, 20.0, "BIGGEST WORDS"), (6, 99.0, "too late")]

    def title(content):
        head = content.decode().split("\f")[0]
        return head[6:] if head else None

    made = extract.Extractor(pages=[pages], ocr=lambda c: ["read aloud"] if c == b"\f\n" else [], images=lambda c: [(1, "png", b"keep"), (1, "png", b"drop")], tables=lambda c: [[{"k": "v"}]] if c.startswith(b"title") else 1 / 0, keep_image=lambda i: i == b"keep", title=title, spans=spans)
    used = spark.createDataFrame([("100000",)], "unique_id string")
    out = workflow.run_files(files.binary_files(spark, str(home)), made, used, TAX, chunk.Words, (), 6, 1)
    name = lambda path: path.rsplit("/", 1)[1]
    assert [(name(r.duplicate), name(r.survivor)) for r in out["removed"].collect()] == [("copy.pdf", "b.pdf")]
    names = {name(r.path): (r.first_title, r.title, r.unique_id, r.file_name) for r in out["names"].collect()}
    assert names == {
        "a.PDF": ("small_bigbiggest_words", "BIGGEST WORDS", "100001", "biggest_words [100001].pdf"),
        "b.pdf": ("deep_sea_report", "Deep Sea Report 2020", "100002", "deep_sea_report_2020 [100002].pdf"),
        "c.pdf": ("a_long_first_line", "A long first line", "100003", "a_long_first_line [100003].pdf"),
        "d.pdf": ("unknown_title", "unknown_title", "100004", "unknowntitle [100004].pdf"),
    }
    final = out["final"].collect()
    assert {r.metadata.unique_id for r in final} == {"100001", "100002", "100003", "100004"}
    assert {r.chunk_file for r in final if r.metadata.unique_id == "100002"} == {"deep_sea_report_2020 [100002]_chunk_1.txt", "deep_sea_report_2020 [100002]_chunk_2.txt"}
    assert {r.chunk.text for r in final if r.metadata.unique_id == "100004"} == {"read aloud"}
    assert {(r.unique_id, bytes(r.content)) for r in out["images"].collect()} == {(f"10000{k}", b"keep") for k in range(1, 5)}
    assert [(r.unique_id, r.cells) for r in out["tables"].collect()] == [("100002", {"k": "v"})] and out["problems"].count() == 3
    assert out["records"].count() == 4


def test_large_taxonomy(spark):
    """612 keywords in 72 labels, all dimensions in one projection, against plain counting."""
    import itertools

    words = ["".join(w) for w in itertools.product("aeiou", "lmnrst", "aeiou")] + ["".join(w) for w in itertools.product("bcdfgh", "aeiou", "lmnrst")]
    rng = random.Random(4)
    sizes = {"CATEGORY_KEYWORDS": (11, 119), "TAG_KEYWORDS": (51, 327), "RESEARCH_TYPE_KEYWORDS": (7, 102), "SENTIMENT_TYPE": (3, 64)}
    raw = {dim: {f"{dim[:2]}{i}": [rng.choice(words) for _ in range(n // labels + (i < n % labels))] for i in range(labels)} for dim, (labels, n) in sizes.items()}
    tax = Taxonomy.parse(json.dumps(raw))
    assert tax.table(spark).count() == 612
    texts = [" ".join(rng.choice(words) + rng.choice(words) for _ in range(rng.randint(1, 300))) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", tax.top1(F.col("t"), "category").alias("c"), tax.top1(F.col("t"), "research_type").alias("r"), tax.top1(F.col("t"), "sentiment_type").alias("s"), tax.tags(F.col("t")).alias("g"), tax.relevance(F.col("t")).alias("v"))

    def best(t, key, n):
        hits = [(-sum(k in t for k in ks), i, label) for i, (label, ks) in enumerate(raw[key].items())]
        return [label for h, _, label in sorted(hits)[:n] if h < 0]

    for r in df.collect():
        t = texts[r.i]
        assert (r.c, r.r, r.s) == tuple((best(t, k, 1) or [None])[0] for k in ("CATEGORY_KEYWORDS", "RESEARCH_TYPE_KEYWORDS", "SENTIMENT_TYPE")) and r.g == sorted(best(t, "TAG_KEYWORDS", 5))
        m, n = sum(t.count(k) for ks in raw["TAG_KEYWORDS"].values() for k in ks), len(t.split())
        assert r.v == (1 if n < 100 or not m else min(100, max(1, round(math.log10(1 + m / n * 1000) * 77))))


# --- session ------------------------------------------------------------------------------------


def test_sweep(spark):
    since = session.mark()
    one, two = session.written(spark.range(3)), session.written(spark.range(4))
    paths = session._made[since:]
    session.sweep(spark, since, paths[1])
    assert two.count() == 4 and not os.path.exists(paths[0].removeprefix("file:")) and one is not two
    session.sweep(spark, since)
    assert not os.path.exists(paths[1].removeprefix("file:")) and session.mark() == since


def test_shared_dir_must_be_named_on_a_cluster():
    class Context:
        master = "spark://x"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context
        conf = {}

    with pytest.raises(RuntimeError, match="checkpoint"):
        session.shared_dir(Session)


# --- streaming ----------------------------------------------------------------------------------


def test_ingest(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a [100001].pdf").write_bytes(b"One. Two. Three.")
    chunks = lambda b: chunk.chunk_documents(b.select(F.regexp_extract("path", r"(\d{6})", 1).alias("unique_id"), F.col("content").cast("string").alias("text")), chunk.Words, (), 2, 0)

    def run():
        q = ingest.ingest(ingest.file_stream(spark, str(tmp_path / "in")), chunks, str(tmp_path / "t"), str(tmp_path / "c"))
        q.awaitTermination(120)
        return spark.read.parquet(str(tmp_path / "t")).count()

    assert run() == 2
    (tmp_path / "in" / "b [100002].pdf").write_bytes(b"One.")
    assert run() == 3 and run() == 3
    files.append_new(spark.read.parquet(str(tmp_path / "t")), str(tmp_path / "t"), ["unique_id", "chunk_no"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3


def test_files_share_batches(spark):
    """F1, F7, F8: every file was a batch of its own; and names were made from what was extracted three times."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    made = extract.Extractor(pages=[lambda content: content.decode().split("\f")])
    types = to_arrow_schema(StructType.fromDDL(extract.SCHEMA))
    small = pa.RecordBatch.from_pydict({"path": [f"p{i}" for i in range(5000)], "content": [b"text"] * 5000})
    assert [b.num_rows for b in extract._batches(iter([small]), made.rows, types)] == [2000, 2000, 1000]
    large = pa.RecordBatch.from_pydict({"path": ["a", "b", "c"], "content": [b"x" * (5 << 20)] * 3})
    assert [b.num_rows for b in extract._batches(iter([large]), made.rows, types)] == [1, 1, 1]
    assert not list(extract._batches(iter([]), made.rows, types))


def test_names_extract_once(spark, tmp_path, monkeypatch):
    """each of the title ladder's three readings extracted all files anew."""
    seen = str(tmp_path / "seen")

    def title(content: bytes) -> None:
        with open(seen, "a") as f:
            f.write("x")

    files = spark.createDataFrame([(f"d{i}.pdf", f"text {i}\nof a file".encode()) for i in range(9)], "path string, content binary")
    monkeypatch.setattr(catalog, "_files", lambda spark, d: files)
    monkeypatch.setattr(catalog, "_stand_ins", lambda: extract.Extractor(pages=[lambda content: content.decode().split("\f")], title=title))
    assert catalog.queries()["files_named"](spark, "").count() == 9
    assert os.path.getsize(seen) == 9


def test_texts_are_chunked_in_parts(monkeypatch):
    """a worker held what it made of a whole batch of 10,000 texts at a time."""
    import pyarrow as pa

    texts = [f"One sentence {i}. Another. " * 30 if i % 7 else None for i in range(1000)]
    batch = pa.RecordBatch.from_pydict({"id": list(range(1000)), "text": texts})
    assert [len(b) for b in chunk.few(batch)] == [chunk.TEXTS] * 10 and sum(len(a) for a in chunk.few(batch.column(1))) == 1000
    found = [r for b in chunk.few(batch) for c in chunk._packed(b, chunk.Words(), 50, 5, chunk.sentences, ["id", "chunk_no", "text", "token_count"]) for r in c.to_pylist()]
    expected = [{"id": i, "chunk_no": n, "text": c, "token_count": k} for i, t in enumerate(texts) if t for n, (c, k) in enumerate(chunk.pack(t, chunk.Words(), 50, 5), 1)]
    assert found == expected


def test_chunks_keep_other_columns(spark):
    docs = spark.createDataFrame([(1, None, ["a"], "x. y."), (2, "n", None, None), (3, "m", [], "")], "id int, `a b` string, l array<string>, text string")
    rows = chunk.chunk_documents(docs, chunk.Words).collect()
    assert [tuple(r) for r in rows] == [(1, None, ["a"], 1, "x. y.", 4 - 2)]
    assert rows[0].__fields__ == ["id", "a b", "l", "chunk_no", "text", "token_count"]
    assert [r[0] for r in docs.select(chunk.token_count(F.col("text"), chunk.Words)).collect()] == [2, 0, 0]
