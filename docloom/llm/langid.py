"""Language identification by a bidirectional gated recurrent network over bytes, in numpy.

A text is cut into consecutive windows of WINDOW bytes, the last one padded. Over each window one gated recurrent unit runs forwards and one
backwards; every byte gets a probability of each language from both states, and a document's probabilities are the mean over all of its bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Bytes of a window, and units of each direction.
WINDOW, UNITS = 64, 8
#: Windows that go through the network together.
BLOCK = 2048
#: Documents of a language that the network learns from, and windows of each, at most.
PER_LANGUAGE, PER_DOCUMENT = 600, 6
#: Languages that a network tells apart at most: more values of lang are an error, as no column of languages has them.
LANGUAGES = 1000
#: Steps of training, windows a step, and learning rate.
STEPS, BATCH, RATE = 300, 256, 0.03
#: The byte that pads.
PAD = 256
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


def windows(data: bytes) -> np.ndarray:
    """(n, WINDOW) of byte values; what is behind the text's end is PAD."""
    n = -(-len(data) // WINDOW)
    out = np.full(n * WINDOW, PAD, np.int16)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return out.reshape(n, WINDOW)


class Network:
    """Weights by name: e* (3H x 257) what a byte adds to the gates, u* (3H x H) what the state adds, both forwards (f) and backwards (b); o (L x 2H), c (L) the output."""

    def __init__(self, languages: list[str], weights: dict[str, np.ndarray]):
        self.languages, self.weights = languages, weights

    @classmethod
    def fresh(cls, languages: list[str], rng: np.random.Generator) -> Network:
        h, n = UNITS, len(languages)
        w = {}
        for d in "fb":
            w["e" + d] = rng.normal(0, 0.3, (3 * h, 257)).astype(np.float32)
            w["u" + d] = rng.normal(0, 0.3, (3 * h, h)).astype(np.float32)
        return cls(languages, w | {"o": rng.normal(0, 0.3, (n, 2 * h)).astype(np.float32), "c": np.zeros((n, 1), np.float32)})

    def _states(self, ids: np.ndarray, d: str, keep: bool) -> tuple[np.ndarray, list]:
        """(WINDOW, H, n) states of one direction. z and r are logistic, written as (tanh(x / 2) + 1) / 2."""
        h, e, u = UNITS, self.weights["e" + d].copy(), self.weights["u" + d].copy()
        e[: 2 * h] *= 0.5
        u[: 2 * h] *= 0.5
        n = ids.shape[1]
        s, states, tape = np.zeros((h, n), np.float32), np.empty((len(ids), h, n), np.float32), []
        for t in range(len(ids)) if d == "f" else range(len(ids) - 1, -1, -1):
            x = e.take(ids[t], axis=1)
            g = u @ s
            gates = np.tanh(x[: 2 * h] + g[: 2 * h])
            gates *= 0.5
            gates += 0.5
            z, r = gates[:h], gates[h:]
            c = np.tanh(x[2 * h :] + r * g[2 * h :])
            new = c - s
            new *= z
            new += s
            if keep:
                tape.append((t, s, z, r, c, g[2 * h :]))
            s = states[t] = new
        return states, tape

    def _outputs(self, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
        """(WINDOW, L, n) probabilities."""
        h = UNITS
        y = self.weights["o"][:, :h] @ forward
        y += self.weights["o"][:, h:] @ backward
        y += self.weights["c"]
        y -= y.max(axis=1, keepdims=True)
        np.exp(y, out=y)
        y /= y.sum(axis=1, keepdims=True)
        return y

    def probabilities(self, ids: np.ndarray) -> np.ndarray:
        """(n, L): of n windows, the probabilities of all bytes added up; padding adds nothing."""
        ids = np.ascontiguousarray(ids.T)
        p = self._outputs(self._states(ids, "f", False)[0], self._states(ids, "b", False)[0])
        if (ids[-1] == PAD).any():
            p *= (ids != PAD)[:, None, :]
        return p.sum(axis=0, dtype=np.float64).T

    def gradients(self, ids: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy of all bytes, by backpropagation through time."""
        h, ids = UNITS, np.ascontiguousarray(ids.T)
        states = {d: self._states(ids, d, True) for d in "fb"}
        y = self._outputs(states["f"][0], states["b"][0])
        live = (ids != PAD)[:, None, :]
        y[:, labels, np.arange(len(labels))] -= 1
        y *= live / live.sum()
        both = np.concatenate([states["f"][0], states["b"][0]], axis=1)
        out = {"o": np.einsum("tln,thn->lh", y, both), "c": y.sum(axis=(0, 2))[:, None]}
        for k, d in enumerate("fb"):
            u = self.weights["u" + d]
            from_output = np.einsum("lh,tln->thn", self.weights["o"][:, k * h : k * h + h], y)
            gu, carried = np.zeros_like(u), np.zeros((h, ids.shape[1]), np.float32)
            ge = np.zeros((257, 3 * h))
            for t, s, z, r, c, g in reversed(states[d][1]):
                ds = from_output[t] + carried
                dc = ds * z * (1 - c * c)
                dz = ds * (c - s) * z * (1 - z)
                dr = dc * g * r * (1 - r)
                at = np.concatenate([dz, dr, dc])
                inner = np.concatenate([dz, dr, dc * r])
                gu += inner @ s.T
                carried = ds * (1 - z) + u.T @ inner
                for j in range(3 * h):
                    ge[:, j] += np.bincount(ids[t], at[j], 257)
            out["e" + d], out["u" + d] = ge.T.astype(np.float32), gu
        return out


def some_windows(data: bytes) -> np.ndarray:
    """PER_DOCUMENT windows of a text at most, from anywhere in it; which ones follows from the text alone."""
    w = windows(data)
    if len(w) > PER_DOCUMENT:
        w = w[np.sort(np.random.default_rng(zlib.crc32(data)).choice(len(w), PER_DOCUMENT, replace=False))]
    return w


def train(samples: list[np.ndarray], labels: list[str], seed: int = 5) -> Network:
    """A network for the labels' languages, fitted to each document's windows with Adam; languages count equally."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    net = Network.fresh(languages, rng)
    if len(languages) < 2 or not sum(map(len, samples)):
        return net
    x, y = np.concatenate(samples), np.repeat([languages.index(k) for k in labels], [len(w) for w in samples])
    by = [p for p in (np.flatnonzero(y == k) for k in range(len(languages))) if len(p)]
    m = {k: np.zeros_like(v) for k, v in net.weights.items()}
    v = {k: np.zeros_like(w) for k, w in net.weights.items()}
    for step in range(1, STEPS + 1):
        pick = np.concatenate([rng.choice(p, -(-BATCH // len(by))) for p in by])
        rate = RATE * min(1, step / 20) * (1 - 0.95 * step / STEPS)
        for k, g in net.gradients(x[pick], y[pick]).items():
            g = np.clip(g, -1, 1)
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            net.weights[k] = (net.weights[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def held_out(doc_id: Column) -> Column:
    """Whether the CRC-32 of the id as text is divisible by 5; a null id is held out, for nothing is learned from it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Network:
    """Learns from documents that aren't held out and have a lang and a text: about per_language of each, picked by a hash of id and text.

    A null id, text or lang teaches nothing, repeated rows count once, and an empty table gives a network without languages. First the languages are counted; then each is sampled at a rate that leaves twice the bound at most in expectation, and cut to the bound."""
    rows = common.fit_columns(docs, {id_col: "long", text_col: "string", lang_col: "string"}).toDF("doc_id", "text", "lang")
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().limit(LANGUAGES + 1).collect()}
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not counts:
        return Network.fresh([], np.random.default_rng(0))
    rates = docs.sparkSession.createDataFrame([(k, min(1.0, 1.5 * per_language / n)) for k, n in counts.items()], "lang string, rate double")
    turn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    # a row per language, LANGUAGES of them at most: small enough to be sent to every executor
    picked = rows.withColumn("turn", turn).join(F.broadcast(rates), "lang").filter("turn < rate").select("lang", "turn", "text")

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, 200):
            taken = [some_windows(t).tobytes() for t in b.column(2).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(taken, pa.binary())], names=["lang", "turn", "windows"])

    common.arrow_batches(docs.sparkSession)
    # repeated rows are one, dropped before any of them travels
    got = picked.mapInArrow(sample, "lang string, turn double, windows binary").groupBy("lang", "turn").agg(F.min("windows")).collect()
    samples, labels = [], []
    for lang in sorted(counts):
        for r in sorted(tuple(r) for r in got if r[0] == lang)[:per_language]:
            samples.append(np.frombuffer(r[2], np.int16).reshape(-1, WINDOW)), labels.append(lang)
    return train(samples, labels)


def predict(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Adds lang_pred and score, the pooled probability of that language, from the whole text alone.

    A null text, or one without a letter, is `und` with score 0, as is any text where nothing was learned. A text of any length goes through in
    blocks of windows. Repeated rows are labelled alike, other columns but ones named lang_pred and score are kept, and an empty table gives an empty result."""
    common.arrow_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(network)
    base = docs.drop("lang_pred", "score")
    at = [f.name.lower() for f in base.schema.fields].index(text_col.lower())
    schema = T.StructType([*base.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = model.value
        for b in batches:
            texts = b.column(at).cast(pa.string()).to_pylist()
            pooled = np.zeros((len(texts), max(1, len(net.languages))))
            lettered = np.array([bool(net.languages) and t is not None and _LETTER.search(t) is not None for t in texts], bool)

            def flush(held: list) -> None:
                x, of = np.concatenate([h[1] for h in held]), np.repeat([h[0] for h in held], [len(h[1]) for h in held])
                for i in range(0, len(x), BLOCK):
                    np.add.at(pooled, of[i : i + BLOCK], net.probabilities(x[i : i + BLOCK]))

            held, n = [], 0
            for i in np.flatnonzero(lettered):
                w = windows(texts[i].encode())
                held.append((i, w))
                n += len(w)
                if n >= 8 * BLOCK:
                    flush(held)
                    held, n = [], 0
            if held:
                flush(held)
            share = pooled / np.maximum(pooled.sum(axis=1, keepdims=True), 1e-12)
            best = share.argmax(axis=1)
            pred = [net.languages[k] if ok else UNKNOWN for k, ok in zip(best, lettered)]
            score = np.clip(np.where(lettered, share.max(axis=1), 0.0), 0, 1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pred, pa.string()), pa.array(score)], names=schema.names)

    return base.mapInArrow(run, schema)
