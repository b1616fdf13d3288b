"""Exact top-k inner products by vector-approximation files.

Every vector is approximated by one byte a component, the number of a cell whose edges are quantiles of a sample. The approximations are scanned in blocks for
bounds of each query's products; what may still be among the k best is read exactly, in the order of its bound, until the k-th result is certain. A block
that no bound of its box lets reach the k-th best of the sample of any query of a block is left out before it travels.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .vectors import matrix, widened

#: Rows of a block of approximations, and of a block of queries, at most.
BLOCK, QUERIES = 4096, 4096
#: Boxes of blocks that travel together.
PACK = 512
#: Rows that the cells' edges, the order of the blocks and the first bounds are taken from at most. They decide how much is read, never what is found.
SAMPLE = 4096
#: Cells a dimension is quantised into.
CELLS = 256
#: Dimensions of the sample's principal axes whose signs give the order of rows in blocks.
ORDERED = 12
#: Products of a scan that are held at a time.
HELD = 1 << 21

_log = logging.getLogger(__name__)


def scaled(vectors: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale x component) in double precision, where every result is an integer."""
    return np.floor(scale * vectors)


def products(data: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact integer inner products of rows of integers (held as doubles) with a query; Python numbers where 64 bits might not do."""
    most = float(np.abs(data).max(initial=0)) * float(np.abs(query).max(initial=0)) * max(1, data.shape[1])
    if most < 2**53:
        return (data @ query).astype(np.int64)
    if most < 2**62:
        return data.astype(np.int64) @ query.astype(np.int64)
    q = [int(x) for x in query]
    return np.array([sum(int(a) * b for a, b in zip(row, q)) for row in data], object)


def pack(vector: np.ndarray) -> bytes:
    """Integers, held as doubles, in the fewest bytes of 1, 2, 4 or 8 each that hold them all, after that number."""
    most = np.abs(vector).max(initial=0)
    size, kind = next((s, k) for s, k, bound in ((1, np.int8, 2**7), (2, np.int16, 2**15), (4, np.int32, 2**31), (8, np.float64, np.inf)) if most < bound or s == 8)
    return bytes([size]) + vector.astype(kind).tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, {1: np.int8, 2: np.int16, 4: np.int32, 8: np.float64}[data[0]], offset=1).astype(np.float64)


class Cells:
    """Edges of each dimension's cells: quantiles of a sample between the least and the greatest of all components."""

    def __init__(self, sample: np.ndarray, low: np.ndarray, high: np.ndarray):
        inner = np.quantile(sample, np.linspace(0, 1, CELLS + 1)[1:-1], axis=0, method="closest_observation") if len(sample) else np.zeros((CELLS - 1, len(low)))
        # an edge that repeats opens no cell; a component's cell is the last one whose lower edge it reaches
        self.edges = np.clip(np.concatenate([low[None, :], inner]), low, high)
        self.low, self.high = np.zeros((len(low), CELLS)), np.zeros((len(low), CELLS))
        for d in range(len(low)):
            e = self.edges[:, d]
            self.low[d] = e
            self.high[d] = np.concatenate([np.maximum(e[:-1], e[1:] - 1), high[d : d + 1]])  # components are integers

    def of(self, data: np.ndarray) -> np.ndarray:
        out = np.empty(data.shape, np.uint8)
        for d in range(data.shape[1]):
            out[:, d] = np.searchsorted(self.edges[:, d], data[:, d], side="right") - 1
        return out

    def bounds(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = np.arange(cells.shape[1])
        return self.low[d, cells], self.high[d, cells]


def limits(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(queries, rows) of products that rows between low and high have at least, and at most; rounding is allowed for."""
    centre, half = (low + high) / 2, (high - low) / 2
    about, spread = queries @ centre.T, np.abs(queries) @ half.T
    if len(low):
        spread += (1e-12 * (np.abs(queries) @ (np.abs(centre) + half).max(axis=0)) + 1e-9)[:, None]
    return about - spread, about + spread


def highest(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """(queries, boxes) of products that no row of a box exceeds; rounding is allowed for."""
    return limits(queries, low, high)[1]


class Scan:
    """What a block of queries has found in the approximations it has seen."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, first: np.ndarray, k: int):
        self.ids, self.queries, self.k = ids, queries, k
        self.best = np.repeat(first[:, None], k, axis=1)  # the k greatest lower bounds; first is a bound from elsewhere, which all may share
        self.held: list[tuple[np.ndarray, ...]] = []

    def see(self, ids: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        step = max(1, HELD // max(1, len(ids)))
        for i in range(0, len(self.queries), step):
            s = slice(i, i + step)
            least, most = limits(self.queries[s], low, high)
            least, most = np.ceil(least), np.floor(most)  # products are integers: in cells of one integer the bounds meet
            own = self.ids[s, None] == ids[None, :]
            least[own], most[own] = -np.inf, -np.inf
            both = np.concatenate([self.best[s], least], axis=1)
            self.best[s] = np.partition(both, both.shape[1] - self.k, axis=1)[:, -self.k :]
            bound = self.best[s].min(axis=1)
            q, r = np.nonzero((most >= bound[:, None]) & (most > -np.inf))
            self.held.append((q + i, ids[r], most[q, r], least[q, r]))
        if sum(len(h[0]) for h in self.held) > HELD // 4:
            self._drop()

    def _drop(self) -> None:
        q, ids, most, least = (np.concatenate(x) for x in zip(*self.held))
        bound = self.best.min(axis=1)[q]
        ok = most >= bound
        # what is known to tie with the k-th place matters by its id only: the k smallest
        tied = np.flatnonzero(ok & (most == bound) & (least == most))
        tied = tied[np.lexsort((ids[tied], q[tied]))]
        if len(tied):
            starts = np.flatnonzero(np.concatenate([[True], q[tied][1:] != q[tied][:-1]]))
            place = np.arange(len(tied)) - np.repeat(starts, np.diff(np.append(starts, len(tied))))
            ok[tied[place >= self.k]] = False
        self.held = [(q[ok], ids[ok], most[ok], least[ok])]

    def found(self) -> tuple[np.ndarray, ...]:
        """(query's place, id, upper bound, lower bound) of what may be among the k best."""
        if not self.held:
            return tuple(np.empty(0, t) for t in (np.int64, np.int64, float, float))
        self._drop()
        return self.held[0]


def certain(query: np.ndarray, ids: np.ndarray, data: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(ids, scores) of the k largest products, ties to the smaller id, and how many vectors were read: in order of their bounds, greatest first, until
    the k-th score exceeds the next bound."""
    order, read, step = np.argsort(-bounds, kind="stable"), 0, 2 * k
    scores = np.empty(0, object)
    while read < len(order):
        scores = np.concatenate([scores, products(data[order[read : read + step]], query)])
        read = min(read + step, len(order))
        if len(scores) >= k and read < len(order) and sorted(scores, reverse=True)[k - 1] > bounds[order[read]]:
            break
    best = sorted(range(read), key=lambda i: (-int(scores[i]), int(ids[order[i]])))[:k]
    return ids[order[best]], scores[best], read


def _long(scores: np.ndarray) -> list[int]:
    out = [int(s) for s in scores]
    if any(not -(1 << 63) <= s < 1 << 63 for s in out):
        raise OverflowError("an inner product leaves 64 bits")
    return out


def topk(vectors: DataFrame, is_query: Column, k: int, scale: float, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k largest integer inner products of each query with all other rows.

    Components count as floor(scale x component) in double precision, whatever their size; a score among the k best that leaves 64 bits is an
    OverflowError. Ties go to the smaller vec_id. A vector that is null, empty or holds a null or non-finite component takes no part, nor does a row
    without an id; rows with the query's id are its own; a repeated row is found once for each copy; a shorter vector counts as padded with zeros;
    an empty table gives an empty result. Of the approximations a byte a component travels, a block of them once per block of queries that it can
    matter to; exact vectors travel only for what the bounds leave."""
    spark = vectors.sparkSession
    common.arrow_batches(spark)
    empty = "query_id long, rank int, vec_id long, score long"
    rows = common.fit_columns(vectors.withColumn("_query", F.coalesce(is_query, F.lit(False))), {id_col: "long", vec_col: "array<double>", "_query": "boolean"})
    rows = rows.toDF("id", "vector", "query").filter("id IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0")
    rows = rows.filter(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    packed = T.StructType([T.StructField("id", T.LongType()), T.StructField("query", T.BooleanType()), T.StructField("data", T.BinaryType())])

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths = b.column(1).value_lengths().to_numpy()
            with np.errstate(over="ignore"):
                m = scaled(matrix(b.column(1))[0], scale)
            if not np.isfinite(m).all():
                raise OverflowError("a scaled component leaves double precision")
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([pack(v[:n]) for v, n in zip(m, lengths)], pa.binary())], names=packed.names)

    exact = common.written(rows.select("id", "vector", "query").mapInArrow(shrink, packed))
    width, low, high = _range(exact)
    if not width:
        return spark.createDataFrame([], empty)
    taken = exact.select("id", "data").orderBy(F.xxhash64("id", "data"), "id").limit(SAMPLE).collect()
    sample, sample_ids = np.array([widened(unpack(r[1])[None, :], width)[0] for r in taken]), np.array([r[0] for r in taken], np.int64)
    cells = Cells(sample, low, high)
    middle = sample.mean(axis=0)
    axes = np.linalg.svd(sample - middle, full_matrices=False)[2][:ORDERED]
    model = spark.sparkContext.broadcast((cells, sample, sample_ids, middle, axes))  # SAMPLE rows and CELLS edges a dimension at most
    total, queries = exact.agg(F.count("*"), F.count(F.when(F.col("query"), 1))).first()
    if not queries:
        return spark.createDataFrame([], empty)
    data, asked = _blocks(exact, total, model, width, k, False), _blocks(exact.filter("query"), queries, model, width, k, True)
    n = asked.count()
    pairs, strips = _pairs(data, asked, n, width)
    found = common.written(_scan(pairs, data, asked, n, strips, model, width, k))

    # the k-th greatest lower bound of all of a query's blocks; what can't reach it goes
    bound = found.groupBy("query_id").agg(F.min("first").alias("first"), F.slice(F.sort_array(F.flatten(F.collect_list("best")), False), 1, k).alias("best"))
    bound = bound.select("query_id", F.when(F.size("best") < k, F.col("first")).otherwise(F.greatest("first", F.element_at("best", -1))).alias("bound"))
    left = found.select("query_id", "asked", F.explode(F.arrays_zip("ids", "most")).alias("x")).select("query_id", "asked", F.col("x.ids").alias("id"), F.col("x.most").alias("most"))
    left = left.join(bound, "query_id").filter("most >= bound").drop("bound")
    left = common.written(left.groupBy("query_id", "asked", "id").agg(F.max("most").alias("most")))  # a repeated row is one here, and comes back below
    read = left.join(exact.select("id", "data"), "id").select("query_id", "asked", F.col("id"), "most", "data")
    want = exact.filter("query").select(F.col("id").alias("query_id"), F.xxhash64("data").alias("asked"), F.lit(None).cast("long").alias("id"), F.lit(float("inf")).alias("most"), "data")
    out = T.StructType([T.StructField(c, T.LongType()) for c in ("query_id", "vec_id", "score")])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last = None

        def done() -> pa.RecordBatch | None:
            times = sum(r[2] is None for r in held)  # the query's own rows come first
            rest = held[times:]
            if not times or not rest:
                return None
            m = np.array([widened(unpack(r[4])[None, :], width)[0] for r in rest])
            ids, scores, _ = certain(widened(unpack(held[0][4])[None, :], width)[0], np.array([r[2] for r in rest], np.int64), m, np.array([r[3] for r in rest]), k)
            n = len(ids) * times
            return pa.RecordBatch.from_arrays([pa.array([last[0]] * n, pa.int64()), pa.array(np.tile(ids, times), pa.int64()), pa.array(_long(scores) * times, pa.int64())], names=out.names)

        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if r[:2] != last and held:
                    if (x := done()) is not None:
                        yield x
                    held = []
                held.append(r)
                last = r[:2]
        if held and (x := done()) is not None:
            yield x

    answers = read.unionByName(want).repartition("query_id").sortWithinPartitions("query_id", "asked", F.desc("most"), "id").mapInArrow(answer, out)
    # all of a query's answers are in one task already: k for each of its rows
    ranked = answers.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score").cast("decimal(20,0)")).alias("less"), "vec_id", "score"))), 1, k).alias("x"))
    return ranked.select("query_id", F.posexplode("x").alias("i", "x")).select("query_id", (F.col("i") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def _range(exact: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """The width of the widest vector, and each dimension's least and greatest component: one row per task and dimension, combined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = np.empty(0)
        least = 0
        for b in batches:
            for v in map(unpack, b.column(0).to_pylist()):
                n, least = max(len(v), len(low)), min(least or len(v), len(v))
                pad = lambda x, to: np.concatenate([x, np.full(n - len(x), to)])  # noqa: B023,E731
                low, high = np.minimum(pad(low, np.inf), pad(v, np.inf)), np.maximum(pad(high, -np.inf), pad(v, -np.inf))
        n = len(low)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n), pa.int64()), pa.array(low), pa.array(high), pa.array(np.full(n, least), pa.int64())], names=["d", "low", "high", "least"])

    found = exact.select("data").mapInArrow(run, "d long, low double, high double, least long").groupBy("d").agg(F.min("low"), F.max("high"), F.min("least")).orderBy("d").collect()
    low, high = (np.array([r[i] for r in found], float) for i in (1, 2))
    if found:  # a shorter vector is zero there
        short = np.arange(len(found)) >= min(r[3] for r in found)
        low[short], high[short] = np.minimum(low[short], 0), np.maximum(high[short], 0)
    return len(found), low, high


_BOX = [T.StructField("low", T.ArrayType(T.DoubleType())), T.StructField("high", T.ArrayType(T.DoubleType()))]


def _blocks(exact: DataFrame, count: int, model, width: int, k: int, queries: bool) -> DataFrame:
    """Blocks of rows that lie together, with their box: the ids and, packed, the approximations; of queries the vectors themselves, and the k-th best
    product in the sample, which nothing among a query's k best falls short of."""
    most = QUERIES if queries else BLOCK
    keyed = T.StructType([T.StructField("code", T.LongType()), T.StructField("id", T.LongType()), T.StructField("data", T.BinaryType())])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, _, middle, axes = model.value
        for b in batches:
            m = np.array([widened(unpack(x)[None, :], width)[0] for x in b.column(1).to_pylist()]).reshape(-1, width)
            side = ((m - middle) @ axes.T > 0) @ (1 << np.arange(len(axes))[::-1])
            yield pa.RecordBatch.from_arrays([pa.array(side, pa.int64()), b.column(0), b.column(1)], names=keyed.names)

    rest = [T.StructField("first", T.DoubleType()), *[T.StructField(c, T.BinaryType()) for c in ("ids", "asked", "firsts", "data")]]
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("rows", T.LongType()), *_BOX, *rest])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, sample, sample_ids, _, _ = model.value
        part, n = TaskContext.get().partitionId(), 0
        for b in common.sized(batches, most):
            ids, raw = b.column(1).to_numpy().astype(np.int64), b.column(2).to_pylist()
            m = np.array([widened(unpack(x)[None, :], width)[0] for x in raw]).reshape(-1, width)
            asked = firsts = b""
            first = None
            if queries:
                firsts = np.full(len(m), -np.inf)
                for i in range(0, len(m), 256):
                    least = limits(m[i : i + 256], sample, sample)[0]
                    least[ids[i : i + 256, None] == sample_ids[None, :]] = -np.inf
                    if len(sample) >= k:
                        firsts[i : i + 256] = np.partition(least, len(sample) - k, axis=1)[:, -k]
                first, firsts, data = float(firsts.min()), firsts.tobytes(), m.tobytes()
                low, high = m.min(axis=0), m.max(axis=0)
                asked = np.array(b.column(3).to_numpy(), np.int64).tobytes()
            else:
                c = cells.of(m)
                low, high = (x for x in cells.bounds(c))
                low, high, data = low.min(axis=0), high.max(axis=0), c.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([part << 32 | n]), pa.array([len(m)], pa.int64()), *[pa.array([x], pa.list_(pa.float64())) for x in (low, high)], pa.array([first], pa.float64()), *[pa.array([x], pa.binary()) for x in (ids.tobytes(), asked, firsts, data)]], names=schema.names)
            n += 1

    dealt = exact.select("id", "data").mapInArrow(code, keyed).repartitionByRange(max(1, -(-count // most)), "code", "id").sortWithinPartitions("code", "id")
    return common.written(dealt.withColumn("asked", F.xxhash64("data")).mapInArrow(make, schema))


def _pairs(data: DataFrame, asked: DataFrame, n: int, width: int) -> tuple[DataFrame, int]:
    """(q, block): blocks whose box lets one of a block of queries, of which there are n, reach its first bound; and in how many strips a block of queries goes
    over them. Boxes travel in packs, PACK blocks to one, and meet each block of queries once. How many pairs are left out is logged."""
    packs = T.StructType([T.StructField(c, T.BinaryType()) for c in ("blocks", "low", "high")])
    found = T.StructType([T.StructField("q", T.LongType()), T.StructField("block", T.LongType())])

    def pack_boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.sized(batches, PACK):
            low, high = (np.ascontiguousarray(c.flatten().to_numpy()).tobytes() for c in b.columns[1:])
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (b.column(0).to_numpy().tobytes(), low, high)], names=packs.names)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for q, raw, firsts, blocks, low, high in zip(*(c.to_pylist() for c in b.columns)):
                queries, firsts, blocks = np.frombuffer(raw).reshape(-1, width), np.frombuffer(firsts), np.frombuffer(blocks, np.int64)
                low, high = (np.frombuffer(x).reshape(-1, width) for x in (low, high))
                hit = np.zeros(len(blocks), bool)
                for i in range(0, len(queries), 256):
                    hit |= (highest(queries[i : i + 256], low, high) >= firsts[i : i + 256, None]).any(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(hit.sum(), q), pa.int64()), pa.array(blocks[hit])], names=found.names)

    numbered = asked.select(F.col("block").alias("q"), "data", "firsts", F.row_number().over(Window.orderBy("block")).alias("number"))  # a row per QUERIES queries
    boxes = data.select("block", "low", "high").mapInArrow(pack_boxes, packs).withColumn("number", F.explode(F.sequence(F.lit(1), F.lit(n))))
    pairs = common.written(boxes.join(numbered, "number").select("q", "data", "firsts", "blocks", "low", "high").mapInArrow(meet, found))
    blocks, kept = data.count(), pairs.count()
    everything = blocks * n
    _log.info("%d of %d pairs of blocks are skipped", everything - kept, everything)
    return pairs, max(1, min(blocks, -(-2 * data.sparkSession.sparkContext.defaultParallelism // n)))


def _scan(pairs: DataFrame, data: DataFrame, asked: DataFrame, n: int, strips: int, model, width: int, k: int) -> DataFrame:
    """(query_id, asked, first, ids, most, best) per query and group of blocks: what its bounds leave, and its k greatest lower bounds."""
    spark = pairs.sparkSession
    strip = F.pmod(F.xxhash64("block"), F.lit(strips))
    blocks = pairs.withColumn("strip", strip).join(data.select("block", "ids", "data"), "block").select("q", "strip", F.lit(1).alias("kind"), "block", "ids", F.lit(None).cast("binary").alias("asked"), F.lit(None).cast("binary").alias("firsts"), "data")
    mine = pairs.select("q", strip.alias("strip")).distinct().join(asked.select(F.col("block").alias("q"), "ids", "asked", "firsts", "data"), "q").select("q", "strip", F.lit(0).alias("kind"), F.col("q").alias("block"), "ids", "asked", "firsts", "data")
    fields = [T.StructField(c, T.LongType()) for c in ("query_id", "asked")]
    doubles = T.ArrayType(T.DoubleType())
    out = T.StructType([*fields, T.StructField("first", T.DoubleType()), T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("most", doubles), T.StructField("best", doubles)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, scan, hashes, firsts = model.value[0], None, None, None

        def result() -> Iterator[pa.RecordBatch]:
            q, ids, most, _ = scan.found()
            o = np.argsort(q, kind="stable")
            at = np.searchsorted(q[o], np.arange(len(scan.ids) + 1)).astype(np.int32)
            best = [[x for x in row if x > first] for row, first in zip(scan.best.tolist(), firsts.tolist())]
            lists = [pa.ListArray.from_arrays(pa.array(at), pa.array(v[o], t)) for v, t in ((ids, pa.int64()), (most, pa.float64()))]
            yield pa.RecordBatch.from_arrays([pa.array(scan.ids), pa.array(hashes), pa.array(firsts), *lists, pa.array(best, pa.list_(pa.float64()))], names=out.names)

        for b in batches:
            for kind, ids, asked_, first, raw in zip(*(b.column(i) for i in range(5))):
                ids = np.frombuffer(ids.as_py(), np.int64)
                if kind.as_py() == 0:
                    if scan is not None:
                        yield from result()
                    hashes, firsts = np.frombuffer(asked_.as_py(), np.int64), np.frombuffer(first.as_py())
                    scan = Scan(ids, np.frombuffer(raw.as_py()).reshape(-1, width), firsts, k)
                else:
                    scan.see(ids, *cells.bounds(np.frombuffer(raw.as_py(), np.uint8).reshape(-1, width)))
        if scan is not None:
            yield from result()

    both = blocks.unionByName(mine)
    dealt = both.repartition(max(1, min(n * strips, 8 * spark.sparkContext.defaultParallelism)), "q", "strip").sortWithinPartitions("q", "strip", "kind", "block")
    return dealt.select("kind", "ids", "asked", "firsts", "data").mapInArrow(run, out)
