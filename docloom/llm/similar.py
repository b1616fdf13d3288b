"""Which of some candidates are near copies: exact Jaccard similarity of shingle sets, within components of candidates."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Shingles of a component that one task goes through at most.
CELLS = 1 << 21

PLACE = ["doc_id", "text_hash"]
SETS = T.StructType([*[T.StructField(c, T.LongType()) for c in ("root", *PLACE, "n")], T.StructField("shingles", T.ArrayType(T.LongType(), False))])
GONE = T.StructType([T.StructField(c, T.LongType()) for c in PLACE])
_ROUND = ["root", "part", "kind", *PLACE, "shingles"]


def enough(n: int, least: float) -> int:
    """Shingles that a set of n shares at least with any set that has a similarity of `least` or more with it."""
    return max(1, math.ceil(least * n - 1e-9))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets, given as arrays of distinct numbers; 1 for two empty ones."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


class Kept:
    """Sets that stay, found again by a prefix filter: similar sets, in one order, share one of the first n - enough(n) + 1 shingles of either."""

    def __init__(self, least: float):
        self.least, self.sets, self.empty, self.by = least, [], False, defaultdict(list)

    def _prefix(self, x: np.ndarray) -> list[int]:
        return x[: len(x) - enough(len(x), self.least) + 1].tolist() if len(x) else []

    def has_similar(self, x: np.ndarray) -> bool:
        if not len(x):
            return self.empty
        seen = set()
        for s in self._prefix(x):
            for k in self.by.get(s, ()):
                if k not in seen:
                    seen.add(k)
                    if self.least * len(x) <= len(self.sets[k]) <= len(x) / self.least and similarity(x, self.sets[k]) >= self.least:
                        return True
        return False

    def add(self, x: np.ndarray) -> None:
        self.empty |= not len(x)
        for s in self._prefix(x):
            self.by[s].append(len(self.sets))
        self.sets.append(x)


def repeated(sets: list[np.ndarray], least: float) -> list[int]:
    """Places of the sets, each in ascending order, that are similar to an earlier one which isn't repeated itself."""
    kept, gone = Kept(least), []
    for i, x in enumerate(sets):
        if kept.has_similar(x):
            gone.append(i)
        else:
            kept.add(x)
    return gone


def with_sets(rows: DataFrame, shingle_set) -> DataFrame:
    """(root, doc_id, text_hash, n, shingles) of rows (root, doc_id, text_hash, text): shingle_set(text) in ascending order, and its size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, 250):
            sets = [shingle_set(t).view(np.int64) for t in b.column(3).cast(pa.string()).to_pylist()]
            n = np.array([len(x) for x in sets], np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(np.concatenate([*sets, np.empty(0, np.int64)]), pa.int64()))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(n), lists], names=SETS.names)

    common.arrow_batches(rows.sparkSession)
    return rows.select("root", *PLACE, "text").mapInArrow(run, SETS)


def _batch(gone: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*gone)], names=GONE.names)


def _settled(sets: DataFrame, least: float) -> DataFrame:
    """(doc_id, text_hash) of what goes, a component at a time, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, last = Kept(least), None
        for b in batches:
            gone = []
            for root, i, h, x in zip(*(b.column(c).to_pylist() for c in range(3)), b.column(3)):
                if root != last:
                    kept, last = Kept(least), root
                x = x.values.to_numpy().view(np.uint64)
                if kept.has_similar(x):
                    gone.append((i, h))
                else:
                    kept.add(x)
            if gone:
                yield _batch(gone)

    return sets.select("root", *PLACE, "shingles").repartition("root").sortWithinPartitions("root", *PLACE).mapInArrow(run, GONE)


def _against(heads: DataFrame, rest: DataFrame, least: float) -> DataFrame:
    """(doc_id, text_hash) of rest that are similar to one of their component's heads; the rest of a component is dealt to parts, and its heads go to each."""
    parts = rest.groupBy("root").agg(F.ceil(F.sum("n") / F.lit(CELLS)).cast("int").alias("parts"))
    both = heads.join(parts, "root").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("kind", F.lit(0)).select(*_ROUND)
    both = both.unionByName(rest.join(parts, "root").withColumn("part", F.pmod(F.xxhash64(*PLACE), F.col("parts")).cast("int")).withColumn("kind", F.lit(1)).select(*_ROUND))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, last = Kept(least), None
        for b in batches:
            gone = []
            for root, part, kind, i, h, x in zip(*(b.column(c).to_pylist() for c in range(5)), b.column(5)):
                if (root, part) != last:
                    kept, last = Kept(least), (root, part)
                x = x.values.to_numpy().view(np.uint64)
                if kind == 0:
                    kept.add(x)
                elif kept.has_similar(x):
                    gone.append((i, h))
            if gone:
                yield _batch(gone)

    return both.repartition("root", "part").sortWithinPartitions("root", "part", "kind", *PLACE).mapInArrow(run, GONE)


def later_copies(sets: DataFrame, least: float) -> DataFrame:
    """(doc_id, text_hash) of the documents (root, doc_id, text_hash, n, shingles) that are similar to an earlier one of their component which stays.

    A component that fits in a task is gone through there, in order. Of a larger one the first documents that fill half a task are; those that stay are
    then held against all the others, part by part in parallel, and what is similar goes. So it goes on with the rest until that fits: rounds
    follow the shingles of unlike documents, half a task's a round, and a group of near copies is gone after one. No pairs are ever made."""
    found, todo = [], sets
    fractions = [2.0**-k for k in range(1, 31)]
    while True:
        large = todo.groupBy("root").agg(F.sum("n").alias("cells"), F.percentile_approx("doc_id", fractions, 10_000).alias("at")).filter(F.col("cells") > CELLS)
        half = F.ceil(F.log2(F.col("cells") / F.lit(CELLS / 2))).cast("int")
        large = common.written(large.select("root", F.get("at", F.least(half, F.lit(len(fractions))) - 1).alias("upto")))
        found.append(common.written(_settled(todo.join(large, "root", "left_anti"), least)))
        if large.isEmpty():
            break
        rest = todo.join(large, "root")
        heads = common.written(rest.filter("doc_id <= upto").drop("upto"))
        gone = common.written(_settled(heads, least))
        heads = heads.join(gone, PLACE, "left_anti")
        rest = rest.filter("doc_id > upto").drop("upto")
        alike = common.written(_against(heads, rest, least))
        found += [gone, alike]
        todo = common.written(rest.join(alike, PLACE, "left_anti"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out
