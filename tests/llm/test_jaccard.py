"""Exact near copies against all pairs."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from docloom.llm import jaccard, similar, simhash

from .test_ops import DOCS, sentence, special_docs


def near_copies(seed=3):
    """Texts and copies of them with more and more words replaced: similarities on both sides of the bound."""
    rng = random.Random(seed)
    rows = []
    for i in range(12):
        words = sentence(rng.randint(60, 400), rng).split()
        words = [f"{w}{rng.randint(0, 9999)}" for w in words]
        for j in range(7):
            rows.append((1000 * j + i, " ".join(words), "en", "s"))
            for _ in range(rng.randint(1, max(1, len(words) // 60))):
                words[rng.randrange(len(words))] = f"new{rng.random()}"
    return rows


def brute(rows, size, least):
    """Places that stay, by all pairs."""
    sets = [set(simhash.shingle_hashes(t, size).tolist()) for t in rows]
    kept = []
    for i, a in enumerate(sets):
        if not any(not a | sets[k] or len(a & sets[k]) >= least * len(a | sets[k]) for k in kept):
            kept.append(i)
    return kept


@pytest.mark.parametrize(("size", "least", "cells"), [(5, 0.8, 1 << 21), (2, 0.6, 1 << 21), (5, 0.8, 500)])
def test_keep_unlike(spark, size, least, cells, monkeypatch):
    monkeypatch.setattr(similar, "CELLS", cells)
    docs = spark.createDataFrame(special_docs() + near_copies(), DOCS).withColumns({"node": F.lit("clash"), "text_hash": F.lit(1), "n": F.lit(2)})
    rows = sorted(docs.withColumn("h", F.xxhash64("text")).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.h))
    got = jaccard.keep_unlike(docs, size, least)
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter((rows[k].doc_id, rows[k].text) for k in brute([r.text for r in rows], size, least))


def all_similar(rows):
    sets = [set(simhash.shingle_hashes(t, 5).tolist()) for t in rows]
    return {(i, j) for j in range(len(rows)) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}


def test_stage_loses_no_pair(spark):
    """SimHash first, then the exact filter on what stays: of all pairs at 0.8 or more none is left, and nothing goes that has no such partner."""
    rows = sorted(near_copies())
    pairs = all_similar([t for _, t, _, _ in rows])
    got = {r.doc_id for r in dict(pipeline.STAGES)["near_copies"](spark, spark.createDataFrame(rows, DOCS), "").collect()}
    stay = {k for k, r in enumerate(rows) if r[0] in got}
    assert len(pairs) > 30 and not any(i in stay and j in stay for i, j in pairs)
    linked = {k for p in pairs for k in p}
    assert all(k in stay for k in range(len(rows)) if k not in linked) and min(linked) in stay
    # SimHash alone finds most of them, and what it drops is similar to something that stays
    alone = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows, DOCS)).collect()}
    assert got <= alone and all(any((min(k, i), max(k, i)) in pairs for i in range(len(rows)) if rows[i][0] in alone) for k, r in enumerate(rows) if r[0] not in alone)


def test_prefix_filter_misses_no_pair():
    rng = random.Random(6)
    for least in (0.5, 0.8, 0.95):
        sets = []
        for _ in range(40):
            base = rng.sample(range(10_000), rng.randint(1, 60))
            sets += [np.unique(np.array([x if rng.random() < 0.93 else rng.randint(0, 10_000) for x in base], np.uint64)) for _ in range(5)]
        kept, gone = [], []
        for i, x in enumerate(sets):
            (gone if any(similar.similarity(x, sets[k]) >= least for k in kept) else kept).append(i)
        assert similar.repeated(sets, least) == gone and gone
    assert similar.repeated([np.empty(0, np.uint64)] * 3, 0.8) == [1, 2] and similar.similarity(np.empty(0), np.empty(0)) == 1


def test_texts_of_one_name_are_told_apart(spark, monkeypatch):
    """Different texts whose 64-bit names agree are no copies of each other."""
    from docloom.llm import simhash

    rows = [(i, f"text number {i} has words of its own like w{i * 7} and v{i * 13} and u{i * 17} and t{i * 23}") for i in range(20)]
    rows += [(100 + i, rows[i][1]) for i in range(5)] + [(200, ""), (201, None), (202, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(simhash, "node_name", lambda text: F.length(text).cast("long") % 3)
    want = [*range(20), 200]
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == want
    assert sorted(r.doc_id for r in jaccard.keep_unlike(docs).collect()) == want
