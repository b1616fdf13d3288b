"""Near copies by exact Jaccard similarity of shingle sets: a prefix filter that misses no pair, then exact counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, similar, simhash
from .components import components

#: Bytes of text whose shingles one part of the count holds on average.
PART_BYTES = 12 << 20
#: Rows of an Arrow batch of shingles.
OUT_ROWS = 1 << 17

PARTS = T.StructType([T.StructField("part", T.LongType()), *[T.StructField(c, T.BinaryType()) for c in ("key", "node", "n", "rows")]])
#: Buckets, or a multiple of them where there are more parts, that nodes are in while what a part found of them travels.
NODE_BUCKETS = 64
SHARED = T.StructType([T.StructField("bucket", T.LongType()), *[T.StructField(c, T.BinaryType()) for c in ("node", "n", "shared")]])
ENOUGH = T.StructType([T.StructField("node", T.LongType())])
COMMON = T.StructType([T.StructField(c, T.LongType()) for c in ("node", "n", "key", "df")])


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The distinct shingle hashes of a text, in order."""
    return np.unique(simhash.shingle_hashes(text, size))


def _enough(n: Column, least: float) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.lit(least) * n - F.lit(1e-9)))


def counted(texts: DataFrame, size: int, parts: int, which: bool) -> DataFrame:
    """Of texts (node, text), the shingles that more than one node has: (node, n, key, df) of each, n the size of the node's set and df how many nodes have it; or,
    if `which` isn't asked for, their numbers, packed by buckets of nodes, to be added up by enough_shared(). There are as many
    buckets as parts, at least, so that a task adds up few nodes.

    Shingles are dealt to parts by their hash, packed by the batch, and counted there. A key is 32 bits of the rest of the hash: keys that agree by chance make more
    candidates, which are compared exactly, and never fewer."""
    common.arrow_batches(texts.sparkSession)
    buckets = NODE_BUCKETS * max(1, -(-parts // NODE_BUCKETS))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t, size) for t in b.column(1).cast(pa.string()).to_pylist()]
            lengths = np.array([len(x) for x in sets], np.int64)
            whole = np.concatenate([*sets, np.empty(0, np.uint64)])
            at = (whole % np.uint64(parts)).astype(np.int64)
            key = (whole // np.uint64(parts)).astype(np.uint32)
            row = np.repeat(np.arange(len(sets)), lengths)
            order = np.argsort(at, kind="stable")  # by part, then by row
            key, row, at = key[order], row[order], at[order]
            opens = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (row[1:] != row[:-1])])) if len(at) else np.zeros(0, np.int64)
            rows = np.diff(np.append(opens, len(at))).astype(np.int32)  # keys of a row in a part
            used, first = np.unique(at[opens], return_index=True)
            ends = np.append(first[1:], len(opens))
            starts = np.append(opens, len(at))
            nodes, n = b.column(0).to_numpy()[row[opens]], lengths[row[opens]].astype(np.int32)
            cuts = [(key, starts[first], starts[ends]), (nodes, first, ends), (n, first, ends), (rows, first, ends)]
            blobs = [pa.array([c[i:j].tobytes() for i, j in zip(a, z)], pa.binary()) for c, a, z in cuts]
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), *blobs], names=PARTS.names)

    def shared(part: int, held: list[tuple[bytes, ...]]) -> Iterator[pa.RecordBatch]:
        key, node, n, rows = (np.frombuffer(b"".join(x), kind) for x, kind in zip(zip(*held), (np.uint32, np.int64, np.int32, np.int32)))
        place = np.repeat(np.arange(len(rows)), rows)
        order = np.argsort(key)
        starts = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
        df = np.diff(np.append(starts, len(key)))
        df = np.repeat(df, df)
        order, df = order[df > 1], df[df > 1]
        place = place[order]
        if not which:
            of = np.bincount(place, minlength=len(rows)).astype(np.int32)
            some = np.flatnonzero(of)
            bucket = (node[some].view(np.uint64) % np.uint64(buckets)).astype(np.int64)
            some = some[np.argsort(bucket, kind="stable")]
            rows_in = np.bincount(bucket, minlength=buckets)
            used, ends = np.flatnonzero(rows_in), np.cumsum(rows_in)
            cuts = [some[z - c : z] for z, c in zip(ends[used].tolist(), rows_in[used].tolist())]
            if cuts:
                yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), *[pa.array([c[o].tobytes() for o in cuts], pa.binary()) for c in (node, n, of)]], names=SHARED.names)
            return
        for i in range(0, len(order), OUT_ROWS):
            o, p = order[i : i + OUT_ROWS], place[i : i + OUT_ROWS]
            names = key[o].astype(np.int64) * parts + part
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (node[p], n[p].astype(np.int64), names, df[i : i + OUT_ROWS])], names=COMMON.names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for b in batches:
            for part, *blobs in zip(*(c.to_pylist() for c in b.columns)):
                if part != last and held:
                    yield from shared(last, held)
                    held = []
                held.append(blobs)
                last = part
        if held:
            yield from shared(last, held)

    return texts.select("node", "text").mapInArrow(spread, PARTS).repartition("part").sortWithinPartitions("part").mapInArrow(count, COMMON if which else SHARED)


def enough_shared(found: DataFrame, least: float) -> DataFrame:
    """(node) of the nodes that share enough of their shingles with others, given what counted() found."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None

        def done() -> pa.RecordBatch:
            node, n, of = (np.frombuffer(b"".join(x), t) for x, t in zip(zip(*held), (np.int64, np.int32, np.int32)))
            names, first, place = np.unique(node, return_index=True, return_inverse=True)
            n = n[first]
            need = np.maximum(1, np.ceil(least * n - 1e-9))
            return pa.RecordBatch.from_arrays([pa.array(names[np.bincount(place, of, len(names)) >= need])], names=ENOUGH.names)

        for b in batches:
            for key, *blobs in zip(*(c.to_pylist() for c in b.columns)):
                if key != last and held:
                    yield done()
                    held = []
                held.append(blobs)
                last = key
        if held:
            yield done()

    return found.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(add, ENOUGH)


def candidates(shared: DataFrame, least: float) -> DataFrame:
    """(node, key): the keys of which two sets that are similar have one in common.

    Similar sets share at least enough(n) shingles, so both have a common one among all but enough(n) - 1 of theirs, in whatever order: here the rarest ones
    first. A set with fewer shingles than that in common with all others is similar to none. Keys that only one node is left with go."""
    each = shared.groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("df", "key"))).alias("had"))
    each = each.filter(F.size("had") >= _enough(F.col("n"), least))
    first = F.slice("had", F.lit(1), (F.size("had") - _enough(F.col("n"), least) + 1).cast("int"))
    return common.written(each.select("node", F.explode(first).alias("x")).select("node", F.col("x.key").alias("key")))


def links(keys: DataFrame) -> DataFrame:
    """Links (u, v) that tie together all nodes of a key."""
    low = keys.groupBy("key").agg(F.min("node").alias("v"), F.count("*").alias("rows")).filter("rows > 1").select("key", "v")
    return keys.join(low, "key").filter("node <> v").select(F.col("node").alias("u"), "v").distinct()


def keep_unlike(docs: DataFrame, size: int = 5, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that are no copies and no near copies of an earlier row that stays: in order of doc_id (nulls last), then of a hash of the text.

    A document goes if its set of shingles has a Jaccard similarity of `least` or more with that of an earlier document that stays; every such pair is
    found. Equal texts are copies, and the first of them stands for all. All columns are kept; of repeated rows one stays. Wordless texts are copies
    of each other. An empty table gives an empty result."""
    spark = docs.sparkSession
    keyed, spots, firsts, again = simhash.places(simhash.placed(docs, id_col, text_col), text_col)
    texts = keyed.select(F.col("_docloom_id").alias("doc_id"), F.col("_docloom_text").alias("text_hash"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def parts(some: DataFrame) -> int:
        return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(some.agg(F.sum("bytes")).first()[0] or 0) // PART_BYTES))

    # where every row is a node of its own, as after a pass that leaves no copies, no row need be looked up
    alone = not again and spots.count() == firsts.count()
    nodes = keyed.select(F.col("_docloom_node").alias("node"), F.col(f"`{text_col}`").cast("string").alias("text")) if alone else texts.join(common.small(firsts.select(*similar.PLACE, "node")), similar.PLACE).select("node", "text")

    # first how many shingles each set shares with any other; only a set that shares enough of them may be similar to one, and takes further part
    n = parts(firsts)
    some = common.written(firsts.join(enough_shared(counted(nodes, size, n, False), least), "node", "left_semi"))
    left = texts.join(common.small(some.select(*similar.PLACE, "node")), similar.PLACE).select("node", "text")
    found = counted(left, size, parts(some), True)
    keys = candidates(found.distinct() if again else found, least)
    roots = components(links(keys))
    linked = common.written(roots.join(some.select("node", "doc_id", "text_hash"), "node"))
    sets = simhash.once(similar.with_sets(texts.join(common.small(linked), similar.PLACE), lambda t: shingle_set(t, size)), again)
    return simhash.kept_rows(keyed, spots, firsts, similar.later_copies(common.written(sets), least), again)
