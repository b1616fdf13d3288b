"""SimHash near-duplicates by deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, similar
from .components import components, stars

SEED = 42
BITS = 64
#: Shingles whose bits are counted at a time.
BLOCK = 1 << 16
#: Links that a task holds before it reduces them to one per node.
PAIRS = 1 << 20
#: Rows of keys that a task goes through at a time.
ROWS = 20_000


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of every shingle of the text's lower-cased (A-Z) words, repeats included; one of all words where there are fewer."""
    words = (text or "").encode().lower().split()  # bytes: lower() and split() know ASCII only
    if not words:
        return np.empty(0, np.uint64)
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    n = max(1, len(words) - size + 1)
    h = xxhash.xxh64_intdigest
    last = ends[size - 1 :] - 1 if len(words) >= size else ends[-1:] - 1
    return np.array([h(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist())], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes."""
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), BLOCK):
        part = hashes[i : i + BLOCK].astype(">u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int, tables: int = 1, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """(doc_id, fps), and long columns to carry: fingerprints as signed longs, the first one of the hashes themselves and the others, if more tables are
    asked for, of hashes mixed from them. Null and wordless texts have fingerprint 0 in each."""
    common.arrow_batches(docs.sparkSession)
    carry = carry or []
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fps", T.ArrayType(T.LongType(), False), False), *[T.StructField(c, T.LongType()) for c in carry]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes = (shingle_hashes(t, size) for t in b.column(1).cast(pa.string()).to_pylist())
            fps = np.array([[fingerprint(mixed(h, t)) for t in range(tables)] for h in hashes], np.uint64).reshape(-1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(fps) + 1, tables), pa.int32()), pa.array(fps.view(np.int64), pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), lists, *b.columns[2:]], names=schema.names)

    return common.fit_columns(docs, {id_col: "long", text_col: "string"} | dict.fromkeys(carry, "long")).mapInArrow(run, schema)


def mixed(hashes: np.ndarray, table: int) -> np.ndarray:
    """Hashes of another table from those of the first: independent bits, table 0 as they are."""
    if table == 0:
        return hashes
    h = (hashes ^ np.uint64(0x9E3779B97F4A7C15 * table % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def segments(differ: int) -> list[tuple[int, int]]:
    """(first bit, number of bits) of the fewest segments, two at least, of which one differs by at most one bit: were all to differ by two, more than `differ` bits would."""
    n = max(2, differ // 2 + 1)
    at = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(at, at[1:])]


def variants(fp: np.ndarray, differ: int, table: int) -> np.ndarray:
    """(n, BITS) keys of fingerprints: every segment less one bit, for each of its bits, marked with the table and the bit. Segments that differ by at most
    one bit share a key."""
    fp = fp.view(np.uint64)
    out = np.empty((len(fp), BITS), np.uint64)
    for first, width in segments(differ):
        part = fp >> np.uint64(first) & np.uint64((1 << width) - 1)
        for b in range(width):
            out[:, first + b] = part & np.uint64(~(1 << b) & (1 << 64) - 1) | np.uint64((table * BITS + first + b) << 40)
    return out.view(np.int64)


def near_in_buckets(key: np.ndarray, fp: np.ndarray, node: np.ndarray, differ: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (u, v) that tie together all nodes of equal keys whose fingerprints differ in `differ` bits at most; rows are in order of the key.

    Rows are compared with the next one, the next but one and so on, while the key lasts. Only one link per node is kept, never the pairs, and a bucket
    whose nodes are all tied is left: a large group of near copies takes a few steps, not as many as it has members."""
    names, place = np.unique(node, return_inverse=True)
    fp = np.ascontiguousarray(fp).view(np.uint64)
    root = np.arange(len(names))
    new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
    runs, run = np.flatnonzero(new), np.cumsum(new) - 1
    at, step, held = np.flatnonzero(key[1:] == key[:-1]), 1, []
    while len(at):
        a, b = place[at], place[at + step]
        hit = (np.bitwise_count(fp[at] ^ fp[at + step]) <= differ) & (a != b)
        held.append((a[hit], b[hit]))
        step += 1
        at = at[at + step < len(key)]
        at = at[key[at + step] == key[at]]
        if not len(at) or sum(len(h[0]) for h in held) > PAIRS:
            u, v = (np.concatenate(x) for x in zip(*held))
            tied = np.flatnonzero(root != np.arange(len(root)))
            root, held = stars(np.concatenate([u, tied]), np.concatenate([v, root[tied]]), len(names)), []
            of = root[place]
            done = np.minimum.reduceat(of, runs) == np.maximum.reduceat(of, runs)
            at = at[~done[run[at]]]
    tied = np.flatnonzero(root != np.arange(len(root)))
    return names[tied], names[root[tied]]


def near(nodes: DataFrame, differ: int, tables: int = 1) -> DataFrame:
    """Links (u, v) of nodes (node, fps) that differ by at most `differ` bits in one of the tables: not each pair, but ones that reach the same nodes."""
    keyed = T.StructType([T.StructField(c, T.LongType()) for c in ("key", "fp", "node")])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node, fps = b.column(0).to_numpy(), b.column(1).flatten().to_numpy().reshape(-1, tables)
            for t in range(tables):
                cols = variants(np.ascontiguousarray(fps[:, t]), differ, t).ravel(), np.repeat(fps[:, t], BITS), np.repeat(node, BITS)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=keyed.names)

    rows = nodes.select("node", "fps").repartition("node").mapInArrow(spread, keyed)
    out = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.empty(0, np.int64)] * 3
        for b in _then_none(common.sized(batches, ROWS)):
            new = [c.to_numpy(zero_copy_only=False) for c in b.columns] if b is not None else [np.empty(0, np.int64)] * 3
            key, fp, node = (np.concatenate(x) for x in zip(rest, new))
            whole = len(key) if b is None else int(np.searchsorted(key, key[-1])) if len(key) else 0  # the last key may go on
            rest = [key[whole:], fp[whole:], node[whole:]]
            u, v = near_in_buckets(key[:whole], fp[:whole], node[:whole], differ)
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=out.names)

    common.arrow_batches(nodes.sparkSession)
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, out)


def _then_none(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def _roots(rows: DataFrame, differ: int, tables: int) -> DataFrame:
    """(node, root) of the distinct fingerprints of rows."""
    nodes = common.written(rows.select("node", "fps").distinct())
    roots = components(near(nodes, differ, tables)).withColumnRenamed("node", "_node")
    return nodes.join(roots, F.col("node") == F.col("_node"), "left").select("node", F.coalesce("root", "node").alias("root"))


def _node(tables: int) -> Column:
    return F.get("fps", F.lit(0)) if tables == 1 else F.xxhash64("fps")


def group(docs: DataFrame, size: int = 5, differ: int = 7, tables: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) per row: component_id is the smallest doc_id reachable by links of fingerprints that differ in `differ` bits at most, in
    one table at least; fp is the first table's.

    Rows of equal fingerprints (exact copies, all wordless texts) are one node from the start, so a group of copies never makes
    pairs; only different nodes are compared. A null doc_id takes part; component_id is null where no member has an id.
    An empty table gives an empty result."""
    rows = common.written(fingerprints(docs, size, tables, id_col, text_col).withColumn("node", _node(tables)))
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("first")).join(_roots(rows, differ, tables), "node")
    ids = nodes.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(nodes.join(ids, "root").select("node", "component_id"), "node").select("doc_id", F.get("fps", F.lit(0)).alias("fp"), "component_id")


def node_name(text: Column) -> Column:
    """The 64-bit name under which equal texts meet; places() tells different ones apart that share it."""
    return F.xxhash64(text)


def placed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs with a row's place, (_docloom_id, _docloom_text), and _docloom_node, equal for equal texts and for all wordless ones."""
    text = F.col(f"`{text_col}`").cast("string")
    place = {"_docloom_id": F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit((1 << 63) - 1)), "_docloom_text": F.xxhash64(text)}
    return docs.withColumns(place | {"_docloom_node": F.when(_wordless(text), F.lit(0).cast("long")).otherwise(node_name(text))})


def _wordless(text: Column) -> Column:
    return ~F.coalesce(text, F.lit("")).rlike(r"[^ \t\n\x0B\f\r]")


def places(keyed: DataFrame, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame, bool]:
    """Of rows with their place: the rows, whose nodes now are equal for equal texts only; the places, (node, doc_id, text_hash, bytes); the first place of each node;
    and whether a place is there more than once. Texts aren't shuffled for it.

    Texts are equal if 128 bits of another hash are, too. Of different texts of one name all but one get a name of those bits; they are few, and looked up."""
    text = F.col(f"`{text_col}`").cast("string")
    digest = F.when(_wordless(text), F.lit("")).otherwise(F.md5(text.cast("binary")))
    size = F.octet_length(text)

    def narrow(rows: DataFrame) -> DataFrame:
        return common.written(rows.select(F.col("_docloom_node").alias("node"), F.col("_docloom_id").alias("doc_id"), F.col("_docloom_text").alias("text_hash"), size.alias("bytes"), F.unhex(digest).alias("digest")))

    def first_of(rows: DataFrame) -> DataFrame:
        return common.written(rows.groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.max("bytes").alias("bytes"), F.min("digest").alias("least"), F.max("digest").alias("most")))

    rows = narrow(keyed)
    firsts = first_of(rows)
    shared = firsts.filter("least <> most")
    if not shared.isEmpty():
        others = common.written(rows.join(common.small(common.written(shared.select("node", "least"))), "node").filter("digest <> least").select(F.col("node").alias("_docloom_node"), F.hex("digest").alias("_docloom_digest")).distinct())
        renamed = common.small(others).withColumn("_docloom_new", F.xxhash64("_docloom_node", "_docloom_digest"))
        keyed = keyed.withColumn("_docloom_digest", F.upper(digest)).join(renamed, ["_docloom_node", "_docloom_digest"], "left")
        keyed = keyed.withColumn("_docloom_node", F.coalesce("_docloom_new", "_docloom_node")).drop("_docloom_digest", "_docloom_new")
        rows = narrow(keyed)
        firsts = first_of(rows)
    again = not rows.groupBy("doc_id", "text_hash").count().filter("count > 1").isEmpty()
    return keyed, rows, firsts.select("node", "first.doc_id", "first.text_hash", "bytes"), again


def keep_one(docs: DataFrame, size: int = 5, differ: int = 4, tables: int = 1, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that are no copies and no near copies of an earlier row that stays: in order of doc_id (nulls last), then of a hash of the text.

    Fingerprints find components of candidates. Within one a document goes if its set of shingles has a Jaccard similarity of `least` or more with that of an
    earlier document that stays. Rows of equal texts are copies, and the first of them stands for all; different texts of equal fingerprints are compared
    like all others. All columns are kept; of repeated rows one stays. Wordless texts are copies of each other. An empty table gives an empty result."""
    keyed, spots, firsts, again = places(placed(docs, id_col, text_col), text_col)
    own = ["_docloom_id", "_docloom_text", "_docloom_node"]
    rows = common.written(fingerprints(keyed, size, tables, "_docloom_id", text_col, own[1:]).withColumn("node", _node(tables)))
    points = rows.groupBy("_docloom_node").agg(F.min("node").alias("point"))
    roots = components(near(common.written(rows.select("node", "fps").distinct()), differ, tables))
    rooted = firsts.join(points, F.col("node") == F.col("_docloom_node")).join(roots.toDF("point", "root"), "point", "left").select("doc_id", "text_hash", F.coalesce("root", "point").alias("root"))
    linked = common.written(rooted.join(rooted.groupBy("root").count().filter("count > 1").select("root"), "root"))
    texts = keyed.select(F.col("_docloom_id").alias("doc_id"), F.col("_docloom_text").alias("text_hash"), F.col(f"`{text_col}`").alias("text"))
    sets = once(similar.with_sets(texts.join(common.small(linked), similar.PLACE), lambda t: np.unique(shingle_hashes(t, size))), again)
    return kept_rows(keyed, spots, firsts, similar.later_copies(common.written(sets), least), again)


def once(sets: DataFrame, again: bool) -> DataFrame:
    """One row of each place."""
    return sets.dropDuplicates(similar.PLACE) if again else sets


def kept_rows(keyed: DataFrame, spots: DataFrame, firsts: DataFrame, gone: DataFrame, again: bool) -> DataFrame:
    """The rows of keyed that are the first of their node and not among those gone; of repeated rows one. What goes is named, not what stays: where that is little, texts stay where they are."""
    kept = common.written(firsts.join(gone, similar.PLACE, "left_anti").select(*similar.PLACE))
    out = common.written(spots.select(*similar.PLACE).distinct().join(kept, similar.PLACE, "left_anti").toDF("_docloom_id", "_docloom_text"))
    found = keyed.join(common.small(out), ["_docloom_id", "_docloom_text"], "left_anti")
    return (found.dropDuplicates(["_docloom_id", "_docloom_text"]) if again else found).drop("_docloom_id", "_docloom_text", "_docloom_node")


def hex16(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
