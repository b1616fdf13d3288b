"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors are put in the order of the grid cells of their leading principal dimensions and cut into leaves. Leaves are joined by cells that are the same or
neighbours, and by the distance of their boxes; only leaves with a partner travel, in intervals of the sequence, and an interval is joined with another one
by recursion over both that leaves out whatever boxes lie apart.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .components import components, stars
from .vectors import matrix, widened

#: Vectors of a leaf, and bytes of the vectors of an interval that is joined as one task.
LEAF, INTERVAL_BYTES = 512, 8 << 20
#: Leading principal dimensions whose cells give the order, whose cells join leaves, and whose boxes give distances.
ORDERED, JOINED, BOXED = 16, 2, 24
#: Vectors the principal dimensions are fitted on at most, in the order of a hash. They decide how much is skipped, never what is linked.
SAMPLE = 4096
#: What rounding may add to a distance.
LOOSE = 1e-7

_log = logging.getLogger(__name__)


def units(m: np.ndarray) -> np.ndarray:
    """Rows of length one, safe from overflow; the rows are finite and not zero."""
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def apart(low_a: np.ndarray, high_a: np.ndarray, low_b: np.ndarray, high_b: np.ndarray) -> float:
    """Least distance of two boxes."""
    return float(np.sqrt((np.maximum(0, np.maximum(low_a - high_b, low_b - high_a)) ** 2).sum()))


def join_intervals(one: list[tuple[np.ndarray, np.ndarray]], two: list[tuple[np.ndarray, np.ndarray]] | None, eps: float) -> Iterator[tuple[int, int]]:
    """Pairs (place in one, place in two) of two sequences of boxes that lie within eps; with None for two, pairs i <= j of the one. Intervals of the sequences are
    joined recursively, and left at once if their own boxes lie apart."""
    same = two is None
    boxes = {0: one, 1: one if same else two}
    known: dict = {}

    def box(side: int, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        key = (0 if same else side, a, b)
        if key not in known:
            if b - a == 1:
                known[key] = boxes[side][a]
            else:
                (l1, h1), (l2, h2) = box(side, a, (a + b) // 2), box(side, (a + b) // 2, b)
                known[key] = np.minimum(l1, l2), np.maximum(h1, h2)
        return known[key]

    todo = [(0, len(boxes[0]), 0, len(boxes[1]))] if boxes[0] and boxes[1] else []
    while todo:
        a, b, c, d = todo.pop()
        itself = same and (a, b) == (c, d)
        if not itself and apart(*box(0, a, b), *box(1, c, d)) > eps:
            continue
        if b - a == 1 and d - c == 1:
            yield a, c
        elif itself:
            m = (a + b) // 2
            todo += [(a, m, a, m), (a, m, m, b), (m, b, m, b)]
        elif b - a >= d - c:
            m = (a + b) // 2
            todo += [(a, m, c, d), (m, b, c, d)]
        else:
            m = (c + d) // 2
            todo += [(a, b, c, m), (a, b, m, d)]


def links(a: np.ndarray, b: np.ndarray, weight_a: np.ndarray, weight_b: np.ndarray, same: bool, cosine: float, project: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of two intervals of unit vectors, in order: how many vectors each of a and of b links to, and the components' roots (places in a, then in b)."""
    eps = math.sqrt(2 - 2 * cosine) + LOOSE
    cuts = [[(i, min(i + LEAF, len(m))) for i in range(0, len(m), LEAF)] for m in (a, b)]
    boxes = [[((p := m[i:j] @ project).min(axis=0), p.max(axis=0)) for i, j in c] for m, c in zip((a, b), cuts)]
    n_a, n_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    us, vs = [], []
    for x, y in join_intervals(boxes[0], None if same else boxes[1], eps):
        (i, j), (k, m) = cuts[0][x], cuts[1][y]
        itself = same and x == y
        hit = a[i:j] @ b[k:m].T >= cosine
        if itself:
            np.fill_diagonal(hit, False)
        u, v = np.nonzero(hit)
        if not len(u):
            continue
        n_a[i:j] += hit @ weight_b[k:m]
        if not itself:
            n_b[k:m] += weight_a[i:j] @ hit
        root = stars(u, v, j - i) if itself else stars(u, v + (j - i), (j - i) + (m - k))
        place = np.arange(i, j) if itself else np.concatenate([np.arange(i, j), np.arange(k, m) + (0 if same else len(a))])
        tied = np.flatnonzero(root != np.arange(len(root)))
        us.append(place[tied]), vs.append(place[root[tied]])
    n = len(a) + (0 if same else len(b))
    if same:
        n_a, n_b = n_a + n_b, n_b[:0]
    root = stars(np.concatenate(us), np.concatenate(vs), n) if us else np.arange(n)
    return n_a, n_b, root


def group(vectors: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row: how many other vectors have a cosine of `cosine` at least, the smallest vec_id
    reachable over such links, and whether it is the row's own.

    A vector that is null, empty, zero or holds a null or non-finite component links with nothing. Equal vectors are one node with a weight from
    the start, so copies never make pairs. A null vec_id takes part; a component without any id has a null component_id, and kept is then
    false. Vectors of other lengths count as padded with zeros; an empty table gives an empty result. What leaves a pair of intervals is a count and
    one link per vector, never the pairs, and pairs of leaves are rows of a table; the driver sees counts only, and the bounded sample."""
    if not 0 < cosine <= 1:
        raise ValueError("cosine must lie above 0, and be 1 at most")
    spark = vectors.sparkSession
    common.arrow_batches(spark)
    rows = common.fit_columns(vectors, {id_col: "long", vec_col: "array<double>"}).toDF("vec_id", "vector")
    usable = F.coalesce(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("vector", F.when(usable, F.transform("vector", lambda x: x + F.lit(0.0))))
    nodes = rows.filter("vector IS NOT NULL").groupBy("vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
    nodes = common.written(nodes.withColumn("node", F.monotonically_increasing_id()))
    count, width = nodes.agg(F.count("*"), F.max(F.size("vector"))).first()
    if count:
        sample = np.array([r[0] + [0.0] * (width - len(r[0])) for r in nodes.select("vector").orderBy(F.xxhash64("node")).limit(SAMPLE).collect()])
        sample = units(sample)
        _, _, axes = np.linalg.svd(sample - sample.mean(axis=0), full_matrices=False)
        project = np.ascontiguousarray(axes[:BOXED].T)
        tied = common.written(_join(nodes, count, width, cosine, project))
        roots = components(tied.filter("root IS NOT NULL").select(F.col("node").alias("u"), F.col("root").alias("v")))
        counts = tied.filter("n > 0").groupBy("node").agg(F.sum("n").alias("others"))
        found = nodes.join(counts, "node", "left").join(roots, "node", "left").select("vector", "first", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "node").alias("root"))
    else:
        found = nodes.select("vector", "first", F.col("n").alias("n_links"), F.col("node").alias("root"))
    ids = found.groupBy("root").agg(F.min("first").alias("component"))
    found = rows.join(found.join(ids, "root").drop("first", "root"), "vector", "left")
    component = F.when(F.col("vector").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return found.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def leaf_cuts(points: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Cuts a sequence into leaves of `most` points at most, each where two neighbours lie farthest apart, so that few leaves span a gap."""
    jump = np.concatenate([np.sqrt(((points[1:] - points[:-1]) ** 2).sum(axis=1)), [np.inf]])
    least, i = max(1, most // 8), 0
    while i < len(points):
        j = len(points) if len(points) - i <= least else i + least + int(jump[i + least - 1 : i + most].argmax())
        yield i, j
        i = j


def _leaves(nodes: DataFrame, count: int, width: int, eps: float, project: np.ndarray) -> DataFrame:
    """Leaves in grid order, with their interval, their boxes' ends and their cells in the leading dimensions."""
    joined = min(JOINED, project.shape[1])
    keyed = T.StructType([T.StructField("cells", T.BinaryType()), T.StructField("y", T.DoubleType()), *nodes.select("node", "n", "vector").schema.fields])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = units(widened(matrix(b.column(2))[0], width)) @ project
            grid = np.clip(np.floor(m[:, :ORDERED] / eps) + (1 << 31), 0, (1 << 32) - 1).astype(">u4")  # bytes in the order of the numbers
            yield pa.RecordBatch.from_arrays([pa.array([g.tobytes() for g in grid], pa.binary()), pa.array(m[:, 0]), *b.columns], names=keyed.names)

    order = ["cells", "y", "node"]
    per = max(LEAF, INTERVAL_BYTES // (8 * width) // LEAF * LEAF)
    dealt = nodes.select("node", "n", "vector").mapInArrow(place, keyed).repartitionByRange(max(1, -(-count // per)), *order).sortWithinPartitions(*order)
    box = T.ArrayType(T.DoubleType())
    packed = T.StructType([T.StructField("leaf", T.LongType()), T.StructField("interval", T.LongType()), T.StructField("low", box), T.StructField("high", box), T.StructField("cells", T.ArrayType(T.LongType())), *[T.StructField(c, T.BinaryType()) for c in ("nodes", "weights", "data")]])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, at = TaskContext.get().partitionId(), 0, 0
        for b in common.sized(batches, 16 * LEAF):
            nodes_, weights = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            whole = units(widened(matrix(b.column(2))[0], width))
            projected = whole @ project
            for i, j in leaf_cuts(projected, LEAF):
                m, p = whole[i:j], projected[i:j]
                grid = np.unique(np.floor(p[:, :joined] / eps).astype(np.int64), axis=0)  # every cell that the leaf has a vector in
                mine = [int(_cell(c)) for c in grid]
                lists = [pa.array([x], t) for x, t in ((p.min(axis=0), pa.list_(pa.float64())), (p.max(axis=0), pa.list_(pa.float64())), (mine, pa.list_(pa.int64())))]
                yield pa.RecordBatch.from_arrays([pa.array([part << 32 | k]), pa.array([part << 32 | at // per]), *lists, *[pa.array([x.tobytes()], pa.binary()) for x in (nodes_[i:j], weights[i:j], m)]], names=packed.names)
                k, at = k + 1, at + j - i

    return common.written(dealt.select("node", "n", "vector").mapInArrow(pack, packed))


def _cell(place) -> int:
    """One number for a cell of the joined dimensions; there are few cells along a side, for unit vectors end at 1."""
    out = 0
    for c in place:
        out = out * (1 << 20) + int(c) + (1 << 19)
    return out


def leaf_pairs(leaves: DataFrame, eps: float, joined: int = JOINED) -> DataFrame:
    """(a, b, a_interval, b_interval): pairs a <= b of leaves (leaf, interval, low, high, cells) whose boxes lie within eps. A link's ends are in the same cell or in
    neighbouring ones, so an equality join of cells finds every such pair; distances decide."""
    steps = [sum(s * (1 << 20) ** (joined - 1 - i) for i, s in enumerate(step)) for step in product((-1, 0, 1), repeat=joined)]
    boxes = leaves.select("leaf", "interval", "low", "high", "cells")
    near = F.explode(F.array_distinct(F.flatten(F.transform("cells", lambda c: F.array(*[c + F.lit(s) for s in steps])))))
    one = boxes.select(F.col("leaf").alias("a"), F.col("interval").alias("a_interval"), F.col("low").alias("a_low"), F.col("high").alias("a_high"), near.alias("cell"))
    two = boxes.select(F.col("leaf").alias("b"), F.col("interval").alias("b_interval"), F.col("low").alias("b_low"), F.col("high").alias("b_high"), F.explode("cells").alias("cell"))
    gap = F.zip_with(F.zip_with("a_low", "b_high", lambda x, y: x - y), F.zip_with("b_low", "a_high", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    within = F.aggregate(gap, F.lit(0.0), lambda n, x: n + x * x) <= float(eps) ** 2
    return one.join(two, "cell").filter("a <= b").filter(within).select("a", "b", "a_interval", "b_interval").distinct()


def _join(nodes: DataFrame, count: int, width: int, cosine: float, project: np.ndarray) -> DataFrame:
    """(node, root, n): the join's counts and links. How many pairs of leaves are skipped is logged."""
    spark, eps = nodes.sparkSession, math.sqrt(2 - 2 * cosine) + LOOSE
    leaves = _leaves(nodes, count, width, eps, project)
    pairs = common.written(leaf_pairs(leaves, eps, min(JOINED, project.shape[1])))
    n, kept = leaves.count(), pairs.count()
    _log.info("%d of %d pairs of leaves are skipped", n * (n + 1) // 2 - kept, n * (n + 1) // 2)
    # a task joins two intervals, and gets the leaves of either that have a partner in the other
    sides = F.explode(F.array(F.struct(F.col("a").alias("leaf"), F.lit(0).alias("side")), F.struct(F.col("b").alias("leaf"), F.lit(1).alias("side"))))
    same = F.col("a_interval") == F.col("b_interval")
    wanted = pairs.select("a_interval", "b_interval", sides.alias("x")).select("a_interval", "b_interval", F.col("x.leaf").alias("leaf"), F.when(same, F.lit(0)).otherwise(F.col("x.side")).alias("side")).distinct()
    sent = wanted.join(leaves.select("leaf", "nodes", "weights", "data"), "leaf")
    tasks = wanted.select("a_interval", "b_interval").distinct().count()
    parallel = max(1, min(tasks, 8 * spark.sparkContext.defaultParallelism))
    sent = sent.repartition(parallel, "a_interval", "b_interval").sortWithinPartitions("a_interval", "b_interval", "side", "leaf")
    out = T.StructType([T.StructField("node", T.LongType()), T.StructField("root", T.LongType()), T.StructField("n", T.LongType())])

    def joined(held: list[tuple]) -> pa.RecordBatch:
        column = lambda side, i, t: np.concatenate([np.frombuffer(h[i], t) for h in held if h[0] == side] or [np.empty(0, t)])
        (na, wa, ma), (nb, wb, mb) = ([column(side, 1, np.int64), column(side, 2, np.int64), column(side, 3, np.float64).reshape(-1, width)] for side in (0, 1))
        itself = not len(nb)
        c_a, c_b, root = links(ma, ma if itself else mb, wa, wa if itself else wb, itself, cosine, project)
        node, n = (na, c_a) if itself else (np.concatenate([na, nb]), np.concatenate([c_a, c_b]))
        some = (n > 0) | (root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(node[root][some]), pa.array(n[some])], names=out.names)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            for a, b, *row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if (a, b) != last and held:
                    yield joined(held)
                    held = []
                held.append(row)
                last = a, b
        if held:
            yield joined(held)

    result = sent.select("a_interval", "b_interval", "side", "nodes", "weights", "data").mapInArrow(join, out)
    return result.withColumn("root", F.when(F.col("node") != F.col("root"), F.col("root")))
