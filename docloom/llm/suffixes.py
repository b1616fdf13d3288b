"""Suffix-array dedup with difference-cover blockwise construction.

A suffix here is what follows a byte of a document, and only its first `length` bytes matter. Suffixes are dealt into buckets, and one
bucket is sorted at a time. A suffix's bucket is the least-hashed 32-byte gram among its first `length` bytes together with the place of
that gram, which follows from those bytes alone: equal suffixes meet in one bucket, wherever they start. Neighbouring suffixes of a document
that share the gram travel as one snippet. A task lays a block of buckets' snippets out with their grams at multiples of the cover period, sorts the sample of a
difference cover once by doubling, and then sorts each bucket by at most eight leading bytes and the rank of the sample suffix that follows them.

Of snippets whose bytes are the same only the first is laid out, for the others repeat it; bytes are compared, never hashes alone. A bucket of too many snippets for a
task is dealt anew, to parts by chance, each of which drops what repeats within it, and then to buckets by one more gram of a suffix's bytes, as often as it takes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Bytes of a gram that names a bucket; a power of two.
GRAM = 32
#: Suffixes of one document looked at together.
PIECE = (1 << 20) - 256
#: Period of the difference cover, and residues of which every difference mod the period is one: fixed values.
PERIOD = 32
COVER = (0, 1, 2, 3, 7, 11, 15, 19, 25)
#: Bytes of snippets that a task lays out at a time, if a bucket isn't larger.
BLOCK_BYTES = 1 << 20
#: Snippets of a bucket that is sorted in one place; a larger one is split first, into parts of so many.
HOT = 40_000
#: Rows of a batch of snippets that leaves a task's function.
OUT_ROWS = 5000
#: What a null doc_id counts as: it comes before all others.
NO_ID = -(1 << 63)

_TABLE = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 63, 256, dtype=np.int64).astype(np.uint64)
_LOW = np.uint64((1 << 20) - 1)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    h, m, width = _TABLE[data], 0x9E3779B97F4A7C15, 1
    while width < GRAM:  # the hash of two halves, each time twice as long
        h = h[:-width] * np.uint64(m) + h[width:]
        m, width = (m * m + 2) % (1 << 64) | 1, width * 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _leftmost_least(h: np.ndarray, window: int) -> np.ndarray:
    """For each window of the hashes, the place of the least one; of equals the leftmost."""
    v = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
    n, step = len(h) - window + 1, 1
    while step * 2 <= window:
        v, step = np.minimum(v[:-step], v[step:]), step * 2
    if step < window:
        v = np.minimum(v[:n], v[window - step : window - step + n])
    return (v & _LOW).astype(np.int64)


def snippets(data: bytes, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of suffixes in one bucket: arrays of gram hash, first suffix, number of suffixes, and place of the gram behind the first."""
    window = length - GRAM + 1
    view = memoryview(data)
    for at in range(0, len(data) - length + 1, PIECE):
        part = np.frombuffer(view[at : at + PIECE + length - 1], np.uint8)
        h = _gram_hashes(part)
        least = _leftmost_least(h, window)
        first = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        count = np.diff(np.concatenate([first, [len(least)]]))
        gram = least[first]
        yield h[gram].view(np.int64), first + at, count, gram - first


def split(text: bytes, near: int, count: int, level: int, length: int) -> Iterator[tuple[int, int, int]]:
    """(gram, first suffix, number of suffixes) of the runs of a snippet's suffixes that share one more gram, at the same distance: the least-hashed of those that the
    `level` grams already used leave over. The number names both the gram and its distance. Grams that a suffix has used follow from its bytes, as the first one does."""
    window = length - GRAM + 1
    h = _gram_hashes(np.frombuffer(text, np.uint8))
    used = [near]
    for _ in range(level - 1):  # all suffixes of the snippet share these
        rest = h.copy()
        rest[used] = ~np.uint64(0)
        used.append(int(_leftmost_least(rest, window)[0]))
    h[used] = ~np.uint64(0)
    least = _leftmost_least(h, window)[:count]
    first = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
    for a, n in zip(first.tolist(), np.diff(np.concatenate([first, [count]])).tolist()):
        g = int(least[a])
        yield (int(h[g]) * 0x9E3779B97F4A7C15 + (g - near) * 0xBF58476D1CE4E5B9) & (1 << 64) - 1, a, n


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, big end first."""
    w = np.zeros(len(text) - 8, np.uint64)
    for k in range(8):
        w <<= np.uint64(8)
        w |= text[k : len(text) - 8 + k]
    return w


def _dense(key: np.ndarray) -> np.ndarray:
    """Dense ranks of numbers."""
    order = np.argsort(key)
    new = np.zeros(len(key), np.int64)
    new[1:] = key[order[1:]] != key[order[:-1]]
    out = np.empty(len(key), np.int64)
    out[order] = np.cumsum(new)
    return out


def _ranks(keys: list[np.ndarray]) -> np.ndarray:
    """Dense ranks of rows by the keys, the first one the most significant: two at a time, as one number of their own dense ranks."""
    ranks = [_dense(k) for k in keys]
    while len(ranks) > 1:
        ranks = [_dense(a * (int(b.max(initial=0)) + 1) + b) for a, b in zip(ranks[::2], ranks[1::2])] + (ranks[-1:] if len(ranks) % 2 else [])
    return ranks[0]


def repeated_suffixes(bucket: np.ndarray, doc: np.ndarray, low: np.ndarray, near: np.ndarray, count: np.ndarray, texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(snippet, suffix in it) of the suffixes that an equal one in a smaller (doc, place) precedes.

    bucket and doc are ranks; low is each snippet's place in its document; near is where its gram starts; count is its number of suffixes."""
    # layout: grams stand at multiples of the period, so suffixes of one bucket agree mod the period
    pad = (-near) % PERIOD
    sizes = np.array([len(t) for t in texts], np.int64)
    room = -(-(pad + sizes + 8 + PERIOD) // PERIOD) * PERIOD
    base = np.concatenate([[0], np.cumsum(room)])
    text = np.zeros(base[-1] + 256, np.uint8)
    start = base[:-1] + pad
    at = np.arange(int(sizes.sum())) + np.repeat(start - (np.cumsum(sizes) - sizes), sizes)
    text[at] = np.frombuffer(b"".join(texts), np.uint8)
    # ranks of the cover's sample, sorted once: PERIOD bytes, then pairs of ranks a period, two, four ... apart; places between snippets have rank 0
    blocks = base[-1] // PERIOD
    inside = np.zeros(len(text), bool)
    inside[at] = True
    sample = (np.arange(blocks)[:, None] * PERIOD + np.array(COVER)).ravel()
    live = np.flatnonzero(inside[sample])
    word = _words(text)
    rank, step, per = np.zeros(len(sample), np.int64), 1, len(COVER)
    rank[live] = _ranks([word[sample[live] + k] for k in range(0, PERIOD, 8)]) + 1
    while step * PERIOD < length:
        far = np.concatenate([rank, np.zeros(step * per, np.int64)])[live + step * per]
        rank[live] = _ranks([rank[live], far]) + 1
        step *= 2
    residue_rank = np.full(PERIOD, -1)
    residue_rank[list(COVER)] = np.arange(per)
    to_sample = np.array([next(d for d in range(PERIOD) if (r + d) % PERIOD in COVER) for r in range(PERIOD)])
    # the suffixes, in buckets
    snippet = np.repeat(np.arange(len(texts)), count)
    place = np.arange(len(snippet)) - np.repeat(np.cumsum(count) - count, count)
    pos = start[snippet] + place
    gap = to_sample[pos % PERIOD]
    lead = word[pos] & ~((~np.uint64(0)) >> (8 * gap).astype(np.uint64))
    s = pos + gap
    tail = rank[(s // PERIOD) * per + residue_rank[s % PERIOD]]
    offset = near[snippet] - place
    key = bucket[snippet] * 4096 + offset
    order = np.argsort(_ranks([key, lead, tail]))
    # neighbours with the same first bytes: leading words differ mostly in the first ones
    same = key[order][1:] == key[order][:-1]
    for k in range(0, length, 8):
        live = np.flatnonzero(same)
        k = min(k, length - 8)
        same[live] = word[pos[order[live]] + k] == word[pos[order[live + 1]] + k]
    # of each class of equal suffixes, all but the first in (doc, place)
    alike = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    members, cls = order[alike], np.concatenate([[0], np.cumsum(~same)])[alike]
    o = np.lexsort((low[snippet[members]] + place[members], doc[snippet[members]], cls))
    later = members[o][1:][cls[o][1:] == cls[o][:-1]]
    return snippet[later], place[later]


def _runs(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs that the intervals cover."""
    o = np.argsort(starts, kind="stable")
    starts, ends = starts[o], np.maximum.accumulate(ends[o]) if len(ends) else ends
    first = np.concatenate([[True], starts[1:] > ends[:-1]]) if len(starts) else np.zeros(0, bool)
    return starts[first], ends[np.concatenate([first[1:], [True]])] if len(starts) else ends


_KEYS = [T.StructField("dk", T.LongType()), T.StructField("th", T.LongType())]


def _base(docs: DataFrame, id_col: str, text_col: str, carry: list[str]) -> tuple[DataFrame, str]:
    """Rows with dk, the id, and th, which tells rows of one id apart (0 where ids are unique); and which of the two names a row. Columns to carry are one struct."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"), F.struct(*[F.col(f"`{c}`") for c in carry] or [F.lit(0).alias("none")]).alias("carried"))
    rows = rows.withColumn("dk", F.coalesce("doc_id", F.lit(NO_ID).cast("long")))
    repeated = not rows.groupBy("dk").count().filter("count > 1").isEmpty()
    return rows.withColumn("th", F.xxhash64("doc_id", "text") if repeated else F.lit(0).cast("long")), "th" if repeated else "dk"


_SPANS = T.StructType([*_KEYS, T.StructField("low", T.LongType()), T.StructField("high", T.LongType())])
_SENT = T.StructType([*_KEYS, *[T.StructField(n, T.LongType()) for n in ("bucket", "place")], T.StructField("bytes", T.BinaryType())])


def _span(place: int, length: int) -> tuple[int, int]:
    """Where a snippet's bytes start and end in its document."""
    low = place >> 16
    return low, low + (place >> 8 & 255) + length - 1


def _firsts(rows: list[tuple], length: int) -> tuple[list[tuple], list[tuple]]:
    """Snippets (dk, th, bucket, place, bytes) of one or more buckets, in the order of these: the first of those with equal bytes and gram place in each bucket, and the
    spans (dk, th, low, high) of the others, whose every suffix the first one has, too. A row that is there twice is a copy of the document's, and counts once."""
    seen: dict[tuple, tuple] = {}
    spans = []
    for row in rows:
        key = row[2], row[3] & 255, row[4]
        first = seen.setdefault(key, row)
        if first is not row and first[:4] != row[:4]:
            spans.append((row[0], row[1], *_span(row[3], length)))
    return list(seen.values()), spans


def _in_buckets(batches: Iterator[pa.RecordBatch], done, enough: int) -> Iterator[list[tuple]]:
    """Rows of sorted batches, whole buckets at a time: `done` is called with lists whose bytes exceed `enough`, if one bucket's don't."""
    block: list[tuple] = []
    held, last = 0, None
    for b in batches:
        for row in zip(*(b.column(i).to_pylist() for i in range(5))):
            if held > enough and row[2] != last:
                yield from done(block)
                block, held = [], 0
            block.append(row)
            held += len(row[4])
            last = row[2]
    if block:
        yield from done(block)


def _as_batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = [pa.binary() if isinstance(f.dataType, T.BinaryType) else pa.int64() for f in schema.fields]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=schema.names)


def _cooled(hot: DataFrame, length: int) -> tuple[DataFrame, list[DataFrame]]:
    """Snippets of buckets that are too large, in buckets that aren't, and the spans found on the way.

    Each round deals a hot bucket's snippets to parts of HOT by a hash of their place; a part drops those that repeat another one of it, and cuts the others at one more
    gram. Copies of one snippet are a HOTth of what they were after a round, and snippets that differ have other grams, so rounds are few. What is as hot after a
    round as before it goes on as it is: it has one bucket, whatever its size."""
    done, spans, level = [], [], 1
    # a part's firsts, and, with a null bucket, the spans it found; a span's place is its start and its end is the bucket's column below
    both = T.StructType([*_SENT.fields, T.StructField("high", T.LongType())])
    before = None
    while True:
        size = hot.groupBy("bucket").agg(F.count("*").alias("n"))
        parts = F.ceil(F.col("n") / HOT)
        dealt = hot.join(size, "bucket").withColumn("part", F.pmod(F.xxhash64("dk", "th", "place"), parts)).select("dk", "th", F.xxhash64("bucket", "part").alias("deal"), "bucket", "place", "bytes")

        def collapse(batches: Iterator[pa.RecordBatch], level: int = level) -> Iterator[pa.RecordBatch]:
            def settle(block: list[tuple]) -> Iterator[pa.RecordBatch]:
                kept, found = _firsts(sorted(block, key=lambda r: r[:2] + (r[3] >> 16,)), length)
                rows = [(d, h, None, low, None, high) for d, h, low, high in found]
                for d, h, bucket, place, text in kept:
                    low, count, near = place >> 16, place >> 8 & 255, place & 255
                    for gram, a, n in split(text, near, count, level, length):
                        key = (bucket * 0x9E3779B97F4A7C15 + gram) & (1 << 64) - 1
                        rows.append((d, h, key - (1 << 64) if key >> 63 else key, (low + a) << 16 | n << 8 | near - a, text[a : a + n + length - 1], None))
                for i in range(0, len(rows), OUT_ROWS):
                    yield _as_batch(rows[i : i + OUT_ROWS], both)

            block: list[tuple] = []
            last = None
            for b in batches:
                for d, h, deal, *row in zip(*(b.column(i).to_pylist() for i in range(6))):
                    if deal != last and block:
                        yield from settle(block)
                        block = []
                    block.append((d, h, *row))
                    last = deal
            if block:
                yield from settle(block)

        found = common.written(dealt.repartition("deal").sortWithinPartitions("deal").mapInArrow(collapse, both))
        spans.append(found.filter("bucket IS NULL").select("dk", "th", F.col("place").alias("low"), "high"))
        rows = found.filter("bucket IS NOT NULL").drop("high")
        size = rows.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
        large = common.written(size.filter(F.col("n") > HOT))
        # what is alone in its bucket repeats nothing
        done.append(rows.join(size.filter(F.col("n") <= HOT).select("bucket"), "bucket", "left_semi"))
        now = large.agg(F.sum("n")).first()[0] or 0
        if not now:
            break
        hot = rows.join(large.select("bucket"), "bucket", "left_semi")
        if before is not None and now >= before:
            done.append(hot)
            break
        before, level = now, level + 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select(*_SENT.names), spans


def dedup(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, as_text: bool = False) -> DataFrame:
    """Removes each byte that a `length`-byte string covers which also starts earlier: in a smaller id, or before in the same document.

    Returns doc_id, n_bytes, spans (maximal removed runs [start, end) of the UTF-8 text, in order), kept (the other bytes) and carried (a struct of
    the columns named in carry). as_text: kept is a string, without characters that lost a byte.
    Texts are judged as given, whole; matches never cross documents. A null text is empty, a null id comes before all others, rows of one
    id are ordered by a hash of their text, and each further copy of a row repeats the first in whole. An empty table gives an
    empty result. length must lie between 40 and 224."""
    if not GRAM + 8 <= length <= 224:
        raise ValueError("length must lie between 40 and 224")
    common.arrow_batches(docs.sparkSession)
    base, key = _base(docs, id_col, text_col, carry or [])

    # 1. a row per snippet, dealt by bucket; place = first suffix << 16 | suffixes << 8 | gram behind the first. Of snippets of a batch with equal bytes only
    # the first is dealt; the others repeat it, and go as (low, high) to buckets of their own.
    out = T.StructType([*_KEYS, *[T.StructField(n, T.LongType()) for n in ("bucket", "place", "high")]])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dk, th = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            texts = b.column(2).cast(pa.binary()).to_pylist()
            found = []
            for i, t in enumerate(texts):
                if len(t) >= length:
                    found += [(np.full(len(g), dk[i]), np.full(len(g), th[i]), g, (first << 16) | (count << 8) | near, np.full(len(g), i)) for g, first, count, near in snippets(t, length)]
            if not found:
                continue
            rows = np.array([np.concatenate(c) for c in zip(*found)])
            # in order of bucket and form, then of document and place: neighbours of one form may be equal
            rows = rows[:, np.lexsort((rows[3], rows[1], rows[0], rows[3] & 0xFFFF, rows[2]))]
            alike = np.flatnonzero((rows[2, 1:] == rows[2, :-1]) & (rows[3, 1:] & 0xFFFF == rows[3, :-1] & 0xFFFF)) + 1
            # each is held against the first of its run; one that differs from that is dealt like any other
            firsts = np.arange(rows.shape[1])
            same = np.zeros(rows.shape[1], bool)
            new = np.ones(rows.shape[1], bool)
            new[alike] = False
            start = np.maximum.accumulate(np.where(new, firsts, 0))
            copy = np.zeros(rows.shape[1], bool)  # of the document
            copy[1:] = (rows[:2, 1:] == rows[:2, :-1]).all(axis=0) & (rows[2:4, 1:] == rows[2:4, :-1]).all(axis=0)
            at, place = rows[4].tolist(), rows[3].tolist()
            for k, f in zip(alike.tolist(), start[alike].tolist()):
                (a, z), (c, y) = _span(place[k], length), _span(place[f], length)
                same[k] = texts[at[k]][a:z] == texts[at[f]][c:y]
            d, h, _, spot, _ = rows[:, same & ~copy]
            o = np.lexsort((spot, h, d))
            d, h, low = d[o], h[o], spot[o] >> 16
            high = low + (spot[o] >> 8 & 255) + length - 1
            new = np.concatenate([[True], (d[1:] != d[:-1]) | (h[1:] != h[:-1]) | (low[1:] > high[:-1])]) if len(d) else np.zeros(0, bool)
            k = np.flatnonzero(new)
            known = [d[k], h[k], low[k], np.maximum.reduceat(high, k) if len(k) else high]
            rows = rows[:, ~same & ~copy]
            n = rows.shape[1]
            alone = known[0] * 0x9E3779B1 + known[2]
            cols = [np.concatenate(c) for c in ((rows[0], known[0]), (rows[1], known[1]), (rows[2], alone), (rows[3], known[2]), (np.zeros(n, np.int64), known[3]))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=out.names)

    rows = base.select("dk", "th", "text").mapInArrow(cut, out)
    known = F.col("high") > 0
    rows = rows.withColumn("n", F.count("*").over(Window.partitionBy("bucket"))).filter(known | (F.col("n") > 1))
    rows = common.written(rows.select("dk", "th", "place", F.when(~known, F.col("bucket")).alias("bucket"), (F.col("n") > HOT).alias("hot"), "high"))

    # 2. snippets that share a bucket get their bytes and meet there to be sorted
    text = base.select("dk", "th", "text", "doc_id", "carried")

    def joined(some: DataFrame) -> DataFrame:
        """Texts with the snippets wanted of them; all columns of `text`, so that its exchange serves the last step, too."""
        return text.join(some, F.col(key) == F.col("_key")).select("dk", "th", "text", "w", "doc_id", "carried")

    def wanted(some: DataFrame) -> DataFrame:
        return some.groupBy(F.col(key).alias("_key")).agg(F.collect_list(F.struct("th", "place", "bucket")).alias("w"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = b.column(3)
            flat, ends = w.values, w.offsets.to_numpy()
            of, place, bucket = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            for i, (d, h, t) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist())):
                at = slice(ends[i], ends[i + 1])
                own = of[at] == h
                places = place[at][own]
                texts = [t[a:z] for a, z in (_span(p, length) for p in places.tolist())]
                n = len(texts)
                for k in range(0, n, OUT_ROWS):
                    m = min(OUT_ROWS, n - k)
                    cols = np.full(m, d), np.full(m, h), bucket[at][own][k : k + m], places[k : k + m]
                    yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols], pa.array(texts[k : k + m], pa.binary())], names=_SENT.names)

    def sort_block(block: list[tuple]) -> Iterator[pa.RecordBatch]:
        block, spans = _firsts(block, length)
        if spans:
            yield _as_batch(spans, _SPANS)
        counts: dict[int, int] = {}
        for r in block:
            counts[r[2]] = counts.get(r[2], 0) + 1
        block = [r for r in block if counts[r[2]] > 1]
        if not block:
            return
        dk, th, bucket, place, texts = (list(c) for c in zip(*block))
        place = np.array(place, np.int64)
        low, count, near = place >> 16, place >> 8 & 255, place & 255
        docs_ = _ranks([np.array(dk, np.int64), np.array(th, np.int64)])
        k, j = repeated_suffixes(_ranks([np.array(bucket, np.int64)]), docs_, low, near, count, texts, length)
        if not len(k):
            return
        o = np.lexsort((j, k))
        k, j = k[o], j[o]
        first = np.concatenate([[True], (k[1:] != k[:-1]) | (j[1:] != j[:-1] + 1)])
        last = np.concatenate([first[1:], [True]])
        k1 = k[first]
        cols = [np.array(dk, np.int64)[k1], np.array(th, np.int64)[k1], low[k1] + j[first], low[k1] + j[last] + length]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=_SPANS.names)

    def sort_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _in_buckets(batches, sort_block, BLOCK_BYTES)

    held = joined(wanted(rows.filter("bucket IS NOT NULL AND NOT hot"))).mapInArrow(fetch, _SENT)
    repeats = rows.filter("bucket IS NULL").select("dk", "th", F.col("place").alias("low"), "high")
    hot = rows.filter("bucket IS NOT NULL AND hot")
    if (n_hot := hot.count()) > 0:
        # where they are few, the places go to the texts
        some = common.written(wanted(hot))
        cooled, found = _cooled(common.written(joined(F.broadcast(some) if n_hot <= common.BROADCAST_ROWS else some).mapInArrow(fetch, _SENT)), length)
        held = held.unionByName(cooled)
        for f in found:
            repeats = repeats.unionByName(f)
    # buckets are dealt and put in order by their gram
    sorted_spans = held.repartition("bucket").sortWithinPartitions("bucket", "dk", "th", "place").mapInArrow(sort_buckets, _SPANS)

    # 3. each document's spans meet its text
    gone = repeats.unionByName(sorted_spans).groupBy(F.col(key).alias("_key")).agg(F.collect_list(F.struct("th", "low", "high")).alias("w"))
    result = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType(), False), T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))), T.StructField("kept", T.StringType() if as_text else T.BinaryType()), base.schema["carried"]])
    arrow = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, spans_, kept, sizes = b.column(0), [], [], []
            rank = b.column(4).to_pylist()
            hashes = b.column(1).to_pylist()
            w = b.column(3)
            flat, ends, some = w.values, w.offsets.to_numpy(), w.is_valid().to_pylist()
            th, lo, hi = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            for i, t in enumerate(b.column(2).cast(pa.binary()).to_pylist()):
                if rank[i] > 1 and len(t) >= length:
                    starts, stops = np.array([0]), np.array([len(t)])
                else:
                    part = slice(ends[i], ends[i + 1]) if some[i] else slice(0, 0)
                    own = th[part] == hashes[i]
                    starts, stops = _runs(lo[part][own], hi[part][own])
                spans_.append([{"start": int(a), "end": int(z)} for a, z in zip(starts, stops)])
                edges = [0, *[x for s in spans_[-1] for x in (s["start"], s["end"])], len(t)]
                kept.append(b"".join(t[a:z] for a, z in zip(edges[::2], edges[1::2])))
                sizes.append(len(t))
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(spans_, pa.list_(arrow)), pa.array([k.decode(errors="ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary()), b.column(5)], names=result.names)

    whole_rows = text.join(gone, F.col(key) == F.col("_key"), "left").withColumn("rank", F.row_number().over(Window.partitionBy("dk", "th").orderBy(F.lit(1))))
    return whole_rows.select("doc_id", "th", "text", "w", "rank", "carried").mapInArrow(remove, result)
