"""Byte-level BPE encoding and decoding in length-bucketed numpy matrices."""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: White space of the Unicode property White_Space, which the rank files' pattern means by \s.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: No merge.
NONE = np.int32(2**31 - 1)
#: Matrices are as wide as a power of two, in blocks of so many places; one of these, too.
BLOCK = 256
#: Cells of a matrix at most, if one row doesn't have more.
CELLS = 1 << 18
#: Pieces whose ids a worker remembers; it forgets all of them beyond.
REMEMBERED = 100_000
#: Rows encoded at a time: few, since all their pieces are held.
ROWS = 250

_worker: dict = {}


def pieces_pattern(pattern: str) -> regex.Pattern:
    """The pattern with \\s and \\S spelled out."""
    return regex.compile(pattern.replace("[^\\s", f"[^{SPACE}").replace("\\s", f"[{SPACE}]").replace("\\S", f"[^{SPACE}]"))


class Vocabulary:
    """Ranks of a rank file (base64 token, rank a line) as a hashed table from pairs of ids to the merged id, which is its rank."""

    def __init__(self, raw: bytes):
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in raw.splitlines() if line.strip())}
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(rank)
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(left)) * 2.5))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.merged = np.full(1 << self.bits, NONE, np.int32)
        todo, value = (np.array(left, np.int64) << 32) | np.array(right, np.int64), np.array(merged, np.int32)
        slot = self._slot(todo)
        while len(todo):  # linear probing, all pairs a step
            free = self.keys[slot] < 0
            _, first = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            won = np.zeros(len(todo), bool)
            won[first] = True
            won &= free
            self.keys[slot[won]], self.merged[slot[won]] = todo[won], value[won]
            todo, value, slot = todo[~won], value[~won], (slot[~won] + 1) & ((1 << self.bits) - 1)
        lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        self.blob = np.frombuffer(b"".join(self.tokens), np.uint8)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged id of each pair of ids; NONE where there is none or an id is negative."""
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        out = np.full(key.shape, NONE, np.int32)
        live = np.flatnonzero((left >= 0) & (right >= 0))
        slot = self._slot(key.ravel()[live])
        flat, wanted = out.ravel(), key.ravel()[live]
        while len(live):
            there = self.keys[slot]
            hit = there == wanted
            flat[live[hit]] = self.merged[slot[hit]]
            on = ~hit & (there >= 0)
            live, wanted, slot = live[on], wanted[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return flat.reshape(key.shape)

    def _matrix(self, rows: list[bytes], width: int) -> list[np.ndarray]:
        """Ids of rows of at most `width` bytes. A round merges each row's leftmost pair of minimum rank. A row lies in blocks of BLOCK places with the least rank of each, so a
        round looks at a row's blocks, then into one, and moves up what stands right of the merged pair in its block only; emptied blocks are skipped by links."""
        n, wide = len(rows), min(width, BLOCK)
        blocks = width // wide
        size = np.array([len(r) for r in rows])
        ids = np.full((n, width), -1, np.int32)
        ids[np.arange(width) < size[:, None]] = self.byte[np.frombuffer(b"".join(rows), np.uint8)]
        rank = np.full((n, width), NONE, np.int32)
        rank[:, :-1] = self.pair(ids[:, :-1], ids[:, 1:])
        ids, rank = ids.reshape(-1, wide), rank.reshape(-1, wide)  # a line is a block
        least = rank.min(axis=1).reshape(n, blocks)
        lengths = np.clip(size[:, None] - np.arange(blocks) * wide, 0, wide)
        before, after = (np.tile(np.arange(blocks) + k, (n, 1)) for k in (-1, 1))
        out: list = [None] * n
        at = np.arange(n)
        while True:
            r = np.arange(len(at))
            block = least.argmin(axis=1)
            over = least[r, block] == NONE
            if over.any():  # finished rows leave the matrix
                inside = np.arange(ids.shape[1]) < lengths[:, :, None]
                whole = ids.reshape(inside.shape)
                for k in np.flatnonzero(over):
                    out[at[k]] = whole[k][inside[k]]
                on = ~over
                if not on.any():
                    return out
                lines = np.repeat(on, blocks)
                ids, rank, least, lengths, before, after, at, block = ids[lines], rank[lines], least[on], lengths[on], before[on], after[on], at[on], block[on]
                r = np.arange(len(at))
            if (most := max(1, int(lengths.max()))) * 2 <= ids.shape[1]:  # compaction of all blocks
                ids, rank = ids[:, :most].copy(), rank[:, :most].copy()
            line = r * blocks + block
            j = rank[line].argmin(axis=1)  # leftmost minimum
            ids[line, j] = least[r, block]
            # the right half leaves: the next place, or the first one of the next block
            across = j + 1 >= lengths[r, block]
            other, gone = np.where(across, after[r, block], block), np.where(across, 0, j + 1)
            where, right = r * blocks + other, np.arange(ids.shape[1] - 1) >= gone[:, None]
            for m, none in ((ids, -1), (rank, NONE)):
                old = m[where]
                m[where, :-1] = np.where(right, old[:, 1:], old[:, :-1])
                m[where, -1] = np.where(gone < old.shape[1], none, old[:, -1])
            lengths[r, other] -= 1
            if (empty := np.flatnonzero(lengths[r, other] == 0)).size:
                x, y = before[empty, other[empty]], after[empty, other[empty]]
                after[empty, x] = y
                inner = y < blocks
                before[empty[inner], y[inner]] = x[inner]
            # ranks of the pairs of the merged place with its neighbours
            follows = self._first(ids, lengths, after, r, block, j + 1)
            rank[line, j] = self.pair(ids[line, j], follows)
            ahead = np.where(j > 0, block, before[r, block])
            left = np.flatnonzero(ahead >= 0)
            b = ahead[left]
            k = np.where(j[left] > 0, j[left] - 1, lengths[left, b] - 1)
            to = left * blocks + b
            rank[to, k] = self.pair(ids[to, k], ids[line[left], j[left]])
            least[r, block] = rank[line].min(axis=1)
            for some, of in ((np.flatnonzero(across), other), (np.flatnonzero((ahead != block) & (ahead >= 0)), ahead)):
                if some.size:
                    least[some, of[some]] = rank[some * blocks + of[some]].min(axis=1)

    @staticmethod
    def _first(ids: np.ndarray, lengths: np.ndarray, after: np.ndarray, r: np.ndarray, block: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The id at place j of each row's block, or the first one of the block after it; -1 at the row's end."""
        blocks = lengths.shape[1]
        within = j < lengths[r, block]
        b = np.where(within, block, after[r, block])
        there = b < blocks
        return np.where(there, ids[r * blocks + np.where(there, b, 0), np.where(within, j, 0)], -1)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece."""
        out: list = [None] * len(pieces)
        by: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if not p:
                out[i] = np.empty(0, np.int32)
            else:
                by.setdefault(1 << (len(p) - 1).bit_length(), []).append(i)
        for width, members in by.items():
            step = max(1, CELLS // width)
            for k in range(0, len(members), step):
                part = members[k : k + step]
                for i, ids in zip(part, self._matrix([pieces[i] for i in part], width)):
                    out[i] = ids
        return out

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the rows' ids, and where each row's end."""
        lengths = (self.starts[1:] - self.starts[:-1])[ids]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return gather(self.blob, self.starts[:-1][ids], lengths), ends[offsets]


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """values[start : start + length] of all pairs, one after another."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return values[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)]


class Encoder:
    """Encodes texts with a vocabulary; remembers the ids of a bounded number of pieces."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.find = vocabulary, pieces_pattern(pattern).findall
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.starts = np.empty(0, np.int32), np.zeros(1, np.int64)

    def encode(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the offsets of each text's."""
        found = [self.find(t) if t else [] for t in texts]
        if len(self.place) > REMEMBERED:
            self._forget()
        new = [p for p in set().union(*found) if p not in self.place]
        if new:
            got = self.vocabulary.encode_pieces([p.encode() for p in new])
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            self.ids = np.concatenate([self.ids, *got])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum([len(g) for g in got])])
        at = np.fromiter((self.place[p] for f in found for p in f), np.int64)
        lengths = self.starts[at + 1] - self.starts[at]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return gather(self.ids, self.starts[at], lengths), ends[np.concatenate([[0], np.cumsum([len(f) for f in found])])]


def _encoder(raw, pattern: str) -> Encoder:
    key = (hash(raw.value), pattern)
    if key not in _worker:
        _worker.clear()
        _worker[key] = Encoder(Vocabulary(raw.value), pattern)
    return _worker[key]


def read_ranks(path: str) -> bytes:
    """The rank file's bytes; its size is that of the vocabulary, whatever the corpus, so it may be broadcast."""
    with open(path, "rb") as f:
        return f.read()


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


def _binaries(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """Adds the ids of each whole text, split by the pattern, without special tokens: array<int>, empty for null or empty text.

    Every row is encoded on its own: repeated rows give the same ids, an empty table an empty result, and all other columns are
    kept (one named like `out` is replaced). Memory follows the batch, and a text of any length is encoded whole."""
    spark = docs.sparkSession
    common.arrow_batches(spark)
    raw = spark.sparkContext.broadcast(read_ranks(path))
    base = docs.drop(out)
    schema = T.StructType([*base.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType(), False))])
    at = [f.name for f in base.schema.fields].index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(raw, pattern)
        for b in common.slices(batches, ROWS):
            ids, offsets = encoder.encode(b.column(at).cast(pa.string()).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, _lists(ids, offsets)], names=[*b.schema.names, out])

    return base.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, pattern: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the bytes that the ids stand for; null or empty ids are no bytes. All columns are kept, but one named like `out` is replaced. Repeated rows give the
    same bytes, and an empty table an empty result. ids must be ones of the rank file."""
    spark = encoded.sparkSession
    common.arrow_batches(spark)
    raw = spark.sparkContext.broadcast(read_ranks(path))
    encoded = encoded.drop(out)
    schema = T.StructType([*encoded.schema.fields, T.StructField(out, T.BinaryType())])
    at = [f.name for f in encoded.schema.fields].index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _encoder(raw, pattern).vocabulary
        for b in batches:
            ids = b.column(at)
            lengths = np.nan_to_num(ids.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            data, ends = vocabulary.decode(ids.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lengths)]))
            yield pa.RecordBatch.from_arrays([*b.columns, _binaries(data, ends)], names=[*b.schema.names, out])

    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """encode() and decode() of the ids in one pass: one Python worker a task instead of two. The text column is dropped, and ones named like ids or out are replaced; the
    others are kept. A null or empty text has no ids and no bytes; repeated rows give the same, and an empty table an empty result."""
    spark = docs.sparkSession
    common.arrow_batches(spark)
    raw = spark.sparkContext.broadcast(read_ranks(path))
    base = docs.drop(ids, out)
    kept = [f for f in base.schema.fields if f.name != text_col]
    schema = T.StructType([*kept, T.StructField(ids, T.ArrayType(T.IntegerType(), False)), T.StructField(out, T.BinaryType())])
    at = [f.name for f in base.schema.fields].index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(raw, pattern)
        for b in common.slices(batches, ROWS):
            flat, offsets = encoder.encode(b.column(at).cast(pa.string()).to_pylist())
            data, ends = encoder.vocabulary.decode(flat, offsets)
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in kept], _lists(flat, offsets), _binaries(data, ends)], names=schema.names)

    return base.mapInArrow(run, schema)


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of rows with ids and decoded, neither of them null; empty ones have the digest of nothing. Rows are kept as often as they
    are there; a null doc_id stays null."""
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
