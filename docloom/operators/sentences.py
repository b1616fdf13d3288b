"""Sentences by what a corpus itself shows: abbreviations and words that open sentences are found by their counts (Kiss and Strunk's collocation test of a word and its full stop).

Counting is one aggregation over all words; what the splitter needs of it, two bounded sets, goes to the workers once."""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written

#: Fixed values of the method: share of full stops behind an abbreviation, and the score from which on a word is one.
STOPPED, LEAST = 0.99, 0.3
#: Words of each of a model's two sets, the best by score and by count: some MB for a worker at most, whatever the corpus.
MOST = 50_000
#: Words, marks of sentence ends and what may close them, the same as a pattern, and what comes before a word's letters and after them, as patterns that Java, RE2 and Python read alike.
WORD = r"[^\x20\x09-\x0D]+"
MARKS, CLOSERS = (".", "!", "?", "…"), "\"'”’)]"
END = "[.!?…][.!?…\"'”’)\\]]*\\z"
OPENING = "^[\"'“‘(\\[]+"
CLOSING = "[.,;:!?…\"'”’)\\]]+\\z"
DOTTED = r"[^.!?…]\.\z"
ELLIPSIS = r"(…|\.\.)\z"


def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """A row per word type (lower case, without marks around it; types without a letter are left out): how often it stands before a single full stop (n_period) and not
    (n_plain), in lower case (n_lower), and with a capital after a sentence's end (n_start) and elsewhere (n_mid). Null and empty texts have no words."""
    words = docs.select(F.regexp_extract_all(F.col(text), F.lit(f"({WORD})"), 1).alias("w"))
    pairs = words.select(F.explode(F.arrays_zip(F.col("w").alias("x"), F.concat(F.array(F.lit("")), F.col("w")).alias("p"))).alias("z")).select("z.x", "z.p").filter("x IS NOT NULL")
    # equal words are added up first, so that the patterns see each once a task's share
    ended = F.right(F.rtrim("p", F.lit(CLOSERS)), F.lit(1)).isin(*MARKS)
    held = pairs.groupBy("x", ((F.col("p") == "") | ended).alias("starts")).agg(F.count("*").alias("n"))
    seen = held.withColumn("core", F.regexp_replace("x", OPENING, ""))
    seen = seen.select(F.lower(F.regexp_replace("core", CLOSING, "")).alias("word"), F.col("core").rlike(DOTTED).alias("dotted"), F.col("core").rlike(r"^\p{Ll}").alias("low"), F.col("core").rlike(r"^\p{Lu}").alias("high"), "starts", "n")
    low, high, dotted, starts = (F.col(c) for c in ("low", "high", "dotted", "starts"))
    columns = (("n_period", dotted), ("n_plain", ~dotted), ("n_lower", low), ("n_start", high & starts), ("n_mid", high & ~starts))
    return seen.filter(F.col("word").rlike(r"\p{L}")).groupBy("word").agg(*[F.sum(F.when(c, F.col("n")).otherwise(0)).alias(n) for n, c in columns])


def score(periods: int, words: int) -> Column:
    """How surely a type of counts() is an abbreviation, in a corpus of so many words, of which `periods` stand before a full stop: the log-likelihood ratio of "nearly
    always with one" against "as often as any word", larger for short words and inner full stops, and smaller the more often the word stands without one."""
    p = min(max(periods / words if words else 0.0, 1e-9), 1 - 1e-9)
    with_, without = F.col("n_period"), F.col("n_plain")
    inner = F.length("word") - F.length(F.replace(F.col("word"), F.lit("."), F.lit("")))
    letters = (F.length("word") - inner).cast("double")
    ratio = 2 * (with_ * F.lit(math.log(STOPPED) - math.log(p)) + without * F.lit(math.log(1 - STOPPED) - math.log(1 - p)))
    return ratio * F.exp(-letters) * (inner + 1) * F.pow(letters, -without.cast("double"))


def scored(found: DataFrame) -> DataFrame:
    """counts() with the score of each type; 0 for a type that never stands before a full stop. Reads `found` twice, so it should be a written table."""
    total = found.agg(F.coalesce(F.sum("n_period"), F.lit(0)).alias("p"), F.coalesce(F.sum(F.col("n_period") + F.col("n_plain")), F.lit(0)).alias("n")).first()
    return found.withColumn("score", F.when(F.col("n_period") > 0, score(total.p, total.n)).otherwise(0.0))


class Splitter:
    """split(text) for chunk.pack and chunk.chunk_documents. A sentence ends behind its marks, where white space follows, but for two cases: a full stop of an abbreviation or
    of a single letter ends one only before a capital of a word that is otherwise seen in lower case and has a capital at sentence starts alone; and dots end none before a small letter."""

    def __init__(self, spark: SparkSession | None, abbreviations: set[str], openers: set[str]):
        sets = (frozenset(abbreviations), frozenset(openers))
        self._shared = spark.sparkContext.broadcast(sets) if spark else None
        self._sets = None if spark else sets

    @property
    def sets(self) -> tuple[frozenset, frozenset]:
        return self._shared.value if self._shared is not None else self._sets

    def __call__(self, text: str) -> Iterator[str]:
        abbreviations, openers = self.sets
        start, last = None, None
        for m in _WORD.finditer(text):
            if last is not None and _END.search(last.group()) and self._cuts(last.group(), m.group(), abbreviations, openers):
                yield text[start : last.end()]
                start = None
            start, last = m.start() if start is None else start, m
        if last is not None:
            yield text[start : last.end()]

    @staticmethod
    def _cuts(word: str, then: str, abbreviations: frozenset, openers: frozenset) -> bool:
        core, then = _OPENING.sub("", word), _OPENING.sub("", then)
        kind = unicodedata.category(then[0]) if then else ""
        if _ELLIPSIS.search(core):
            return kind != "Ll"
        name = _CLOSING.sub("", core).lower()
        if _DOTTED.search(core) and (name in abbreviations or (len(name) == 1 and name.isalpha())):
            return kind == "Lu" and _CLOSING.sub("", then).lower() in openers
        return True


_WORD, _END, _OPENING, _CLOSING, _DOTTED, _ELLIPSIS = (re.compile(p.replace(r"\z", r"\Z")) for p in (WORD, END, OPENING, CLOSING, DOTTED, ELLIPSIS))


def sets(found: DataFrame, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """(word) of the abbreviations and of the openers in scored(): the `most` best of each, ties by word."""
    abbreviations = found.filter(F.col("score") >= LEAST).orderBy(F.desc("score"), "word").limit(most)
    openers = found.filter("n_lower > 0 AND n_start > 0 AND n_mid = 0").orderBy(F.desc("n_start"), "word").limit(most)
    return abbreviations.select("word"), openers.select("word")


def learn(docs: DataFrame, text: str = "text", most: int = MOST) -> Splitter:
    """A splitter by the counts over all texts, whole. An empty table gives one that knows single letters only. At most 2 * `most` words come to the driver."""
    found = sets(scored(written(counts(docs, text))), most)
    return Splitter(docs.sparkSession, *[{r.word for r in s.collect()} for s in found])


def sentences(docs: DataFrame, splitter: Splitter, key: str, text: str = "text") -> DataFrame:
    """(key, sent_no from 1, sentence) of each text, whole; nothing is shuffled. Null and blank texts have none."""

    @F.udf("array<string>", useArrow=True)
    def run(t: str | None) -> list[str]:
        return list(splitter(t)) if t else []

    return docs.select(key, F.posexplode(run(F.col(text))).alias("_i", "sentence")).select(key, (F.col("_i") + 1).alias("sent_no"), "sentence")
