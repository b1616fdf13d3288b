"""Quality classifier: similarity-weighted votes of the nearest labelled documents in a latent-semantic space."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Hashed terms of shapes, and of words and pairs of them; latent dimensions, neighbours that vote, and the power of the similarity that weighs a vote.
SHAPES, WORDS, DIMENSIONS, NEIGHBOURS, SHARPNESS = 1024, 2048, 32, 15, 8
TERMS = SHAPES + WORDS
#: What the words' half of a text's vector weighs beside the shapes' half.
WORD_WEIGHT = 1.0
#: Rounds of the iteration that finds the latent axes.
ROUNDS = 12
#: Documents whose terms are counted at a time.
ROWS = 250
#: Labelled documents of each label that the classifier is fitted on at most; the broadcast vectors are bounded by it.
PER_LABEL = 3000
#: Documents whose products with all labelled vectors are taken at a time.
BLOCK = 512

#: Class of each byte: 0 white space, 1 lower case and bytes beyond ASCII, 2 upper case, 3 digits, then one for each other byte.
_CLASS = np.arange(256, dtype=np.uint64) + np.uint64(4)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[97:123] = _CLASS[128:] = 1
_CLASS[65:91], _CLASS[48:58] = 2, 3
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


#: What a byte at a place in its word, the last of them for all later ones, adds to the word's hash.
_LETTER = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 63, (32, 256), dtype=np.int64).astype(np.uint64)
_LETTER[:, 65:91] = _LETTER[:, 97:123]
_LETTER[:, [9, 10, 11, 12, 13, 32]] = 0


def _share(distinct: int, n: int) -> int:
    """Eighths of n that are distinct, rounded up."""
    return -(-8 * distinct // n)


def terms(data: bytes) -> np.ndarray:
    """Counts of a text's hashed terms. Shapes: of its words (runs of one byte class as one), pairs of neighbouring shapes, the lengths of words and text, and which share
    of the words, and of the lines, is distinct. Words: each one, A-Z as a-z, and pairs of neighbours."""
    b = np.frombuffer(data, np.uint8)
    c = _CLASS[b]
    out = np.zeros(TERMS, np.float32)
    run = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]])) if len(c) else np.zeros(0, np.int64)
    r = c[run]
    inside = r != 0
    first = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1]])) if len(r) else run
    if not len(first):
        return out
    # a word's shape: the sum of its runs' hashes, each turned by its place in the word
    place = np.arange(len(r)) - np.maximum.accumulate(np.where(inside & np.concatenate([[True], ~inside[:-1]]), np.arange(len(r)), 0))
    h = np.where(inside, _mixed(r * _MIX + np.minimum(place, 7).astype(np.uint64)), np.uint64(0))
    shape = np.add.reduceat(h, first)
    end = np.concatenate([run, [len(c)]])[1:]
    last = np.concatenate([first[1:], [len(r)]]) - 1
    starts = run[first]
    length = end[np.where(inside[last], last, last - 1)] - starts
    # a word's hash: the sum of its bytes', by their place
    at = np.zeros(len(b), np.int64)
    at[starts] = np.diff(np.concatenate([[0], starts]))
    at = np.arange(len(b)) - np.cumsum(at)
    word = _mixed(np.add.reduceat(_LETTER[np.clip(at, 0, 31), b], starts))
    # a line's hash: the sum of its words', by their place; blank lines are none
    of = np.searchsorted(np.flatnonzero(b == 10), starts)
    opens = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    behind = np.arange(len(of)) - np.repeat(opens, np.diff(np.concatenate([opens, [len(of)]])))
    lines = np.add.reduceat(_mixed(word + _MIX * (behind + 1).astype(np.uint64)), opens)
    shares = np.array([_share(len(np.unique(word)), len(word)) + (1 << 41), _share(len(np.unique(lines)), len(lines)) + (1 << 42)], np.uint64)
    shapes = [_mixed(shape), _mixed(np.minimum(length, 20).astype(np.uint64) + _MIX), _mixed(np.array([len(first).bit_length() + (1 << 40)], np.uint64)), _mixed(shares)]
    words = [word]
    if len(shape) > 1:
        shapes.append(_mixed(shape[:-1] * np.uint64(3) + shape[1:]))
        words.append(_mixed(word[:-1] * np.uint64(3) + word[1:]))
    for some, low, n in ((shapes, 0, SHAPES), (words, SHAPES, WORDS)):
        for h in some:
            out[low : low + n] += np.bincount((h % np.uint64(n)).astype(np.int64), minlength=n)
    return out


class Space:
    """A latent-semantic space: weights of terms, axes, and the labelled documents' unit vectors."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS):
        self.weight = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + np.float32(0.1)
        x = np.empty(counts.shape, np.float32)
        for i in range(0, len(counts), BLOCK):
            x[i : i + BLOCK] = self._weighted(counts[i : i + BLOCK])
        # the leading right singular vectors of the term matrix, by subspace iteration
        axes = np.random.default_rng(3).normal(size=(counts.shape[1], min(dimensions + 8, counts.shape[1])))
        for _ in range(ROUNDS):
            axes = np.linalg.qr(axes)[0].astype(np.float32)
            axes = np.add.reduce([x[i : i + BLOCK].T @ (x[i : i + BLOCK] @ axes) for i in range(0, max(1, len(x)), BLOCK)]).astype(np.float64)
        axes = np.linalg.qr(axes)[0]
        inner = x @ axes.astype(np.float32)
        _, turn = np.linalg.eigh(inner.T.astype(np.float64) @ inner)
        self.axes = np.ascontiguousarray((axes @ turn[:, ::-1])[:, :dimensions]).astype(np.float32)
        self.labels = labels.astype(np.float32)
        self.prior = float(labels.mean()) if len(labels) else 0.5
        self.vectors = np.concatenate([self.project(counts[i : i + BLOCK]) for i in range(0, max(1, len(counts)), BLOCK)])

    def _weighted(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts.astype(np.float32)) * self.weight
        for half, w in ((x[:, :SHAPES], 1.0), (x[:, SHAPES:], WORD_WEIGHT)):
            half *= np.float32(w) / np.maximum(np.sqrt((half * half).sum(axis=1, keepdims=True)), np.float32(1e-9))
        return x

    def project(self, counts: np.ndarray) -> np.ndarray:
        v = self._weighted(counts) @ self.axes
        return v / np.maximum(np.sqrt((v * v).sum(axis=1, keepdims=True)), 1e-9)

    def scores(self, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """Share of label 1 in the votes of the nearest labelled documents; the labels' own share where a text has no term."""
        if not len(self.vectors):
            return np.full(len(counts), self.prior)
        out, k = np.empty(len(counts)), min(neighbours, len(self.vectors))
        for i in range(0, len(counts), BLOCK):
            cosine = self.project(counts[i : i + BLOCK]) @ self.vectors.T
            best = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            vote = np.maximum(np.take_along_axis(cosine, best, axis=1), 0).astype(np.float64) ** SHARPNESS
            total = vote.sum(axis=1)
            out[i : i + BLOCK] = np.where(total > 1e-12, (vote * self.labels[best]).sum(axis=1) / np.maximum(total, 1e-12), self.prior)
        return np.clip(out, 0, 1)


def held_out(doc_id: Column) -> Column:
    """Whether the CRC-32 of the id as text is divisible by 5; a null id is held out, for nothing is learned from it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_label: int = PER_LABEL) -> Space:
    """Learns from labelled documents that aren't held out: per_label of each label at most, the first ones by a hash of their id.

    Labels other than 0 and 1, null texts and unlabelled documents teach nothing; a repeated document or label counts once (of several texts or labels of one id: the
    least counts, the greater label). Empty tables give a space without documents, in which every score is 0.5."""
    spark = docs.sparkSession
    common.arrow_batches(spark)
    marks = common.fit_columns(labels, {id_col: "long", label_col: "int"}).toDF("doc_id", "label").filter(~held_out(F.col("doc_id")) & F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").alias("label"))
    picked = [tuple(r) for y in (0, 1) for r in marks.filter(F.col("label") == y).orderBy(F.xxhash64("doc_id")).limit(per_label).collect()]
    # at most 2 x per_label ids
    taught = common.fit_columns(docs, {id_col: "long", text_col: "string"}).toDF("doc_id", "text").filter("text IS NOT NULL").join(F.broadcast(spark.createDataFrame(picked, "doc_id long, label int")), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, ROWS):
            counts = [np.minimum(terms(t), 65535).astype(np.uint16).tobytes() for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(counts, pa.binary())], names=["doc_id", "label", "counts"])

    # one row of each id, the copies dropped before any of them travels
    once = taught.mapInArrow(run, "doc_id long, label int, counts binary").groupBy("doc_id").agg(F.max("label").alias("label"), F.min("counts").alias("counts"))
    got = {r[0]: r for r in sorted(tuple(x) for x in once.collect())}
    labels = np.array([r[1] for r in got.values()], np.float32)
    counts = np.frombuffer(b"".join(r[2] for r in got.values()), np.uint16).reshape(-1, TERMS)
    del got
    return Space(counts, labels)


def score(docs: DataFrame, space: Space, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Adds score (0 to 1, higher: label 1 likelier) and predicted (1 from the threshold on) to each row, from its whole text alone.

    A null or blank text has no term and gets the learned labels' share of 1. Repeated rows score alike, other columns are
    kept but for ones named score and predicted, and an empty table gives an empty result."""
    common.arrow_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(space)
    base = docs.drop("score", "predicted")
    at = [f.name.lower() for f in base.schema.fields].index(text_col.lower())
    schema = T.StructType([*base.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, ROWS):
            counts = np.array([terms((t or "").encode()) for t in b.column(at).cast(pa.string()).to_pylist()], np.float32).reshape(-1, TERMS)
            s = model.value.scores(counts)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=schema.names)

    return base.mapInArrow(run, schema)
