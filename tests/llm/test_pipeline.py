"""The pipeline's stages, and the queries without SQL, against brute force."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from docloom.llm import langid, quality, queries, simhash

from ..conftest import SF
from .test_ops import brute_fingerprint, brute_owner, brute_suffixes, brute_targets, special_docs, tokenizer  # noqa: F401


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with the special rows, extra columns that clash with what stages compute, and labels."""
    d = tmp_path_factory.mktemp("sf")
    rows = [(*r, len(r[1] or "")) for r in special_docs()]
    junk = [(700 + i, " ".join(f"{w.upper()}!! $$" for w in f"aa bb{i} cc dd{i} ee ff{i}".split()), "en", "s1", 9) for i in range(25)]
    docs = spark.createDataFrame(rows + junk, "doc_id long, text string, lang string, source string, n_chars long")
    docs.withColumns({"score": F.lit("s"), "w": F.lit(1), "carried": F.lit(2), "copies": F.lit(None).cast("string"), "node": F.lit(3.5)}).write.parquet(f"{d}/documents.parquet")
    labels = [(i, 1, 0) for i in (*range(40), 500, 301)] + [(700 + i, 0, 0) for i in range(25)] + [(None, 1, 0), (3, None, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return str(d)


def read(rows):
    return Counter(map(repr, rows.collect()))


def test_stages(spark, folder, tokenizer):  # noqa: F811
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    step = dict(pipeline.STAGES)

    def write(df, k):
        assert df.columns == names
        df.write.parquet(f"{folder}/stage{k}")
        return spark.read.parquet(f"{folder}/stage{k}")

    # quality: the rows that the fitted space scores 0.3 or more
    good = write(step["quality"](spark, docs, folder), 0)
    space = quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    everything = docs.collect()
    scores = space.scores(np.array([quality.terms((r.text or "").encode()) for r in everything], np.float32))
    assert read(good) == Counter(repr(r) for r, s in zip(everything, scores) if s >= 0.3)
    assert not any((r.doc_id or 0) >= 700 for r in good.collect()) and good.count() > 50

    # near copies: one row of each group, the smallest id
    unlike = write(step["near_copies"](spark, good, folder), 1)
    rows = good.collect()
    hashes = [simhash.shingle_hashes(r.text, 5) for r in rows]
    fps = [brute_fingerprint(r.text, 5) for r in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4:
                root = [root[j] if r == root[i] else r for r in root]
    place = {(r.doc_id, r.text): r.h for r in good.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()}
    sets = [set(h.tolist()) for h in hashes]
    order = sorted(range(len(rows)), key=lambda i: (rows[i].doc_id is None, rows[i].doc_id or 0, place[rows[i].doc_id, rows[i].text]))
    like = lambda i, k: len(sets[i] & sets[k]) >= 0.8 * len(sets[i] | sets[k])

    def staying(some, group):
        stay = []
        for i in some:
            if not any(group(i, k) and like(i, k) for k in stay):
                stay.append(i)
        return stay

    # first within SimHash groups, and of equal texts; then among all that stay
    stay = staying(staying(order, lambda i, k: root[i] == root[k] or rows[i].text == rows[k].text), lambda i, k: True)
    kept = unlike.collect()
    assert Counter(map(repr, kept)) == Counter(repr(rows[i]) for i in stay)

    # repeats: bytes that brute force removes, less broken characters
    left = write(step["repeats"](spark, unlike, folder), 2)
    order = {(r.doc_id, r.text): r.h for r in unlike.select("doc_id", "text", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("h")).collect()}
    ranked = sorted(((x.doc_id, x.text) for x in kept), key=lambda r: (r[0] is not None, r[0] or 0, order[r]))
    want = Counter((i, None if t is None else k.decode(errors="ignore")) for (i, t), (_, _, _, k) in zip(ranked, brute_suffixes(ranked, 100)))
    got = left.collect()
    assert Counter((x.doc_id, x.text) for x in got) == want
    assert all(x.n_chars == (len(x.text) if x.text is not None else None) for x in got) and all(x.carried == 2 and x.score == "s" for x in got)

    # mix: whole copies, near each source's target
    mixed = write(step["mix"](spark, left, folder), 3)
    size = lambda x: len((x.text or "").encode().split())
    sizes, took, largest = Counter({x.source: 0 for x in got}), Counter(), Counter()
    for x in got:
        sizes[x.source] += size(x)
        largest[x.source] = max(largest[x.source], size(x))
    out = mixed.collect()
    for x in out:
        took[x.source] += size(x)
    aims = brute_targets(sizes)
    assert out and max(Counter(map(repr, out)).values()) <= 3 and all(abs(took[s] - aims[s]) <= largest[s] for s in sizes)
    assert set(map(repr, out)) <= set(map(repr, got))

    # tokens
    tokens = step["tokens"](spark, mixed, folder).collect()
    assert Counter((x.doc_id, x.source, tuple(x.ids), x.n_tokens, x.exact) for x in tokens) == Counter((x.doc_id, x.source, ids := tuple(tokenizer[2].encode_ordinary(x.text or "")), len(ids), True) for x in out)


def test_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.count() == 0 and (name == "tokens" or out.columns == docs.columns)


def test_run(spark):
    out = pipeline.run(spark, SF)
    assert out.count() > 50 and out.filter("NOT exact").count() == 0


# --- the registered queries over whole tables ---------------------------------------------------


@pytest.fixture(scope="module")
def table():
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    return {i: (t["text"][k], t["lang"][k]) for k, i in enumerate(t["doc_id"])}


def run(spark, name):
    return {r.doc_id: r for r in queries.queries()[name](spark, SF).collect()}


def test_op1(spark, table):
    got = run(spark, "op1_suffixes")
    for i, n, gone, kept in brute_suffixes(sorted((i, t) for i, (t, _) in table.items()), 100):
        assert (got[i].n_bytes, got[i].n_removed, got[i].kept_sha256) == (n, gone, hashlib.sha256(kept).hexdigest())


def test_op3(spark, table):
    got = run(spark, "op3_langid")
    held = [i for i in table if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (i in set(held)) for i in table)
    assert sum(got[i].lang_pred == table[i][1] for i in held) >= 0.9 * len(held)
    assert langid.WINDOW


def test_op6(spark, table):
    got = run(spark, "op6_simhash")
    ids = sorted(table)
    fps = [brute_fingerprint(table[i][0], 4) for i in ids]
    root = list(range(len(ids)))
    for a in range(len(ids)):
        for b in range(a):
            if bin(fps[a] ^ fps[b]).count("1") <= 4 and root[a] != root[b]:
                root = [root[b] if r == root[a] else r for r in root]
    least = {}
    for i, r in zip(ids, root):
        least.setdefault(r, i)
    assert {i: (got[i].fingerprint, got[i].component_id) for i in ids} == {i: (f"{f:016x}", least[r]) for i, f, r in zip(ids, fps, root)}


def test_op7(spark, table, tokenizer):  # noqa: F811
    for i, r in run(spark, "op7_bpe").items():
        ids = tokenizer[2].encode_ordinary(table[i][0])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(table[i][0].encode()).hexdigest())


def test_op8(spark, table):
    got = run(spark, "op8_quality")
    labels = pq.read_table(f"{SF}/labels.parquet").to_pydict()
    held = [(i, y) for i, y in zip(labels["doc_id"], labels["quality"]) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert set(got) == set(table) and sum(got[i].predicted == y for i, y in held) >= 0.85 * len(held)


def test_op10(spark, table):
    got = run(spark, "op10_sharding")
    assert {i: (r.shard, r.grown_shard) for i, r in got.items()} == {i: (brute_owner(i, [1.0] * 24), brute_owner(i, [1.0] * 25)) for i in table}
