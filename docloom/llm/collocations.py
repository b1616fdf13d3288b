"""Phrases whose words keep company: weighted n-grams of deduplicated pieces, counted out of core per hash bucket, scored by their weakest cut."""

from __future__ import annotations

import os
import string
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

BREAK, BLANK = r"[.,;:!?\x0A-\x0D]", r"[\x20\x09]+"
#: Pieces whose n-grams are added up before they are dealt.
CHUNK = 100_000
#: Bits of the filter that says which n-grams may be frequent, and places of each n-gram in it: 4 MB whatever the input. It only saves counting, never drops a frequent one.
BITS, PLACES = 1 << 25, 2
#: What DuckDB may hold of a bucket before it spills to the task's scratch folder.
MEMORY = "200MB"
GRAMS = "lang string, phrase string, f long"


def pieces(docs: DataFrame) -> DataFrame:
    """lang, piece, m: every different piece of a language, its words joined by single spaces, and how often it is there."""
    d = common.fit_columns(docs, {"lang": "string", "text": "string"})
    text = F.translate(F.coalesce("text", F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    each = d.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.explode(F.split(text, BREAK)).alias("piece"))
    return each.select("lang", F.trim(F.regexp_replace("piece", BLANK, " ")).alias("piece")).filter("piece <> ''").groupBy("lang", "piece").agg(F.count("*").alias("m"))


class Words:
    """The words of a chunk of pieces: codes of words and the pieces they are in, and 64-bit hashes of n-grams, the same in every process."""

    def __init__(self, lang: pa.Array, texts: pa.Array) -> None:
        split = pc.split_pattern(texts, " ")
        self.flat = split.flatten()
        self.row = pc.list_parent_indices(split).to_numpy(zero_copy_only=False)
        coded, langs = self.flat.dictionary_encode(), lang.dictionary_encode()
        self.code, self.values = coded.indices.to_numpy(zero_copy_only=False).astype("int64"), coded.dictionary
        self.lang_of, self.langs = langs.indices.to_numpy(zero_copy_only=False).astype("int64"), langs.dictionary
        hashed = pd.util.hash_array(self.values.to_numpy(zero_copy_only=False), categorize=False)
        of_lang = pd.util.hash_array(self.langs.to_numpy(zero_copy_only=False), categorize=False)
        self.word_hash, self.lang_hash = hashed[self.code], of_lang[self.lang_of[self.row]] if len(self.row) else np.empty(0, "uint64")

    def fits(self, n: int) -> np.ndarray:
        """At which places n words of one piece begin."""
        at = np.zeros(len(self.row), bool)
        if len(at) >= n:
            at[: len(at) - n + 1] = self.row[: len(at) - n + 1] == self.row[n - 1 :]
        return at

    def hashes(self, at: np.ndarray, n: int) -> np.ndarray:
        h = self.lang_hash[at] + np.uint64(n)
        for j in range(n):
            h = (h ^ self.word_hash[at + j]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h

    def counted(self, at: np.ndarray, n: int, m: np.ndarray) -> pa.RecordBatch:
        """The different n-grams at these places, and the sums of their pieces' numbers."""
        key, width = self.lang_of[self.row[at]], max(1, len(self.values))
        for j in range(n):
            found, first, key = np.unique(key * width + self.code[at + j], return_index=True, return_inverse=True)
        f = np.zeros(len(found), "int64")
        np.add.at(f, key, m[self.row[at]])
        at = at[first]
        words = [self.flat.take(pa.array(at + j)) for j in range(n)]
        return pa.record_batch([self.langs.take(pa.array(self.lang_of[self.row[at]])), pc.binary_join_element_wise(*words, " ") if n > 1 else words[0], pa.array(f)], ["lang", "phrase", "f"])


def places(h: np.ndarray) -> Iterator[np.ndarray]:
    for k in range(PLACES):
        yield (h >> np.uint64(25 * k)) % np.uint64(BITS)


def may_be(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    ok = np.ones(len(h), bool)
    for p in places(h):
        ok &= (bits[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) == 1
    return ok


def filter_of(frequent: DataFrame, n: int) -> np.ndarray:
    """The filter of a table of n-grams: bits set in every task, joined by 64-bit words, of which there are BITS / 64 at most."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.sized(batches, CHUNK):
            w = Words(b["lang"], b["phrase"])
            h = w.hashes(np.flatnonzero(w.fits(n)), n)
            p = np.unique(np.concatenate(list(places(h))))
            block, start = np.unique(p >> np.uint64(6), return_index=True)
            if len(block):
                yield pa.record_batch([pa.array(block.astype("int64")), pa.array(np.bitwise_or.reduceat(np.uint64(1) << (p & np.uint64(63)), start).view("int64"))], ["block", "bits"])

    rows = frequent.select("lang", "phrase").mapInArrow(bits, "block long, bits long").groupBy("block").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(BITS // 64, "uint64")
    out[rows["block"].to_numpy()] = rows["bits"].to_numpy().view("uint64")
    return out


def grams(table: DataFrame, sizes: list[int], known: int = 0, bits=None) -> DataFrame:
    """n-grams of these sizes, added up by chunk; with a filter, only those all of whose `known`-grams it lets pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.sized(batches, CHUNK):
            w, m = Words(b["lang"], b["piece"]), b["m"].to_numpy()
            ok = np.ones(len(w.row), bool)
            if known:
                at = np.flatnonzero(w.fits(known))
                ok[:] = False
                ok[at] = may_be(bits.value, w.hashes(at, known))
            for n in sizes:
                here = w.fits(n)
                for j in range(n - known + 1 if known else 0):
                    here[: len(here) - j] &= ok[j:]
                at = np.flatnonzero(here)
                if len(at):
                    yield w.counted(at, n, m)

    return table.select("lang", "piece", "m").mapInArrow(run, GRAMS)


def frequent(found: DataFrame, least: int) -> DataFrame:
    """n-grams of which there are `least`: every hash bucket is added up by DuckDB, which spills what doesn't fit to a folder that goes with the task, as Spark's own
    spill files do. A lost executor's buckets are counted again elsewhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        held = common.sized(batches, CHUNK)
        first = next(held, None)
        if first is None:
            return
        with tempfile.TemporaryDirectory() as scratch, duckdb.connect(os.path.join(scratch, "bucket.db"), config={"threads": 1, "memory_limit": MEMORY, "temp_directory": scratch}) as con:
            bucket = pa.RecordBatchReader.from_batches(first.schema, (b for part in ([first], held) for b in part))  # noqa: F841  DuckDB finds it by name
            counted = con.sql(f"SELECT lang, phrase, sum(f)::BIGINT AS f FROM bucket GROUP BY lang, phrase HAVING sum(f) >= {int(least)}").arrow()
            yield from counted.to_batches() if isinstance(counted, pa.Table) else counted

    return common.written(found.repartition("lang", "phrase").mapInArrow(run, GRAMS))


def _part(words: str, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, percent: int = 100) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of 2 to `longest` words that are there `least` times.

    Words are counted first, then pairs of frequent words, then longer phrases all of whose pairs are frequent: a filter of fixed size knows which; it may let more
    pass, and counts are exact. Counts of a phrase's parts are looked up by requests dealt by the part. A null language is `und`; a null or empty text has no words;
    repeated rows count each; ties go by a, then by phrase; an empty table gives an empty result; further columns are left out."""
    common.arrow_batches(docs.sparkSession)
    table = common.written(pieces(docs))
    totals = table.groupBy("lang").agg(F.sum(F.col("m") * F.size(F.split("piece", " "))).alias("n"))
    send = docs.sparkSession.sparkContext.broadcast
    by_size = [frequent(grams(table, [1]), least)]
    for known, sizes in ((1, [2]), (2, list(range(3, longest + 1)))):
        if sizes:
            by_size.append(frequent(grams(table, sizes, known, send(filter_of(by_size[-1], known))), least))
    counts = by_size[0]
    for c in by_size[1:]:
        counts = counts.union(c)
    candidates = by_size[1].union(by_size[2]) if len(by_size) > 2 else by_size[1]
    candidates = candidates.withColumnRenamed("f", "a").withColumn("words", F.split("phrase", " ")).withColumn("s", F.size("words"))
    cuts = F.explode(F.sequence(F.lit(1), F.col("s") - 1))
    halves = candidates.select("lang", "phrase", "words", "s", "a", cuts.alias("k"))
    asked = halves.select("lang", "phrase", "a", "k", F.explode(F.array(F.struct(F.lit(True).alias("first"), _part("words", F.lit(1), F.col("k")).alias("part")), F.struct(F.lit(False).alias("first"), _part("words", F.col("k") + 1, F.col("s") - F.col("k")).alias("part")))).alias("x"))
    told = asked.select("lang", "phrase", "a", "k", "x.first", "x.part").join(counts.select("lang", F.col("phrase").alias("part"), "f"), ["lang", "part"])
    both = told.groupBy("lang", "phrase", "a", "k").agg(F.max(F.when(F.col("first"), F.col("f"))).alias("l"), F.max(F.when(~F.col("first"), F.col("f"))).alias("r"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    both = both.join(common.small(common.written(totals)), "lang").withColumn("over", F.lit(1000).cast("decimal(4,0)") * wide("a") * wide("n")).withColumn("under", wide("l") * wide("r"))
    both = both.withColumn("score", F.expr("over div under"))
    scored = both.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "a", "n", "cut.*")
    # what a longer candidate holds
    sizes = F.sequence(F.lit(2), F.col("s") - 1)
    inner = candidates.filter("s > 2").select("lang", "words", "s", "a", F.explode(sizes).alias("k")).select("lang", "words", "k", "a", F.explode(F.sequence(F.lit(1), F.col("s") - F.col("k") + 1)).alias("i"))
    held = inner.groupBy("lang", _part("words", F.col("i"), F.col("k")).alias("phrase")).agg(F.max("a").alias("held"))
    kept = scored.join(held, ["lang", "phrase"], "left").filter(f"held IS NULL OR cast(100 as decimal(3,0)) * cast(held as decimal(19,0)) < cast({int(percent)} as decimal(5,0)) * cast(a as decimal(19,0))")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return kept.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
