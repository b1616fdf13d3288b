"""Keyword taxonomies: labels by hits, and relevance by density.

A keyword hits a text that contains it, anywhere, even within a word. Counting is one projection: the taxonomy goes with the tasks' own
code, so a text is neither exploded nor shuffled. keyword_hits() gives the same counts as rows, and table_hits() those of a taxonomy that is a table of any size.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import written
from .chunk import few

#: The dimensions' names in a taxonomy file, and what a text without a hit is.
DIMENSIONS = {"category": "CATEGORY_KEYWORDS", "tag": "TAG_KEYWORDS", "research_type": "RESEARCH_TYPE_KEYWORDS", "sentiment_type": "SENTIMENT_TYPE"}
DEFAULTS = {"category": "Uncategorized", "research_type": "Unclassified", "sentiment_type": "General Analysis"}
#: Fixed values of the relevance score: least words, matches per so many words, factor of the logarithm, and bounds.
LEAST_WORDS, PER_WORDS, FACTOR, LOWEST, HIGHEST = 100, 1000, 77, 1, 100
TOP_TAGS = 5


@dataclass(frozen=True)
class Taxonomy:
    """Per dimension the labels in order, each with its keywords in order, repeats included. Empty keywords are left out."""

    labels: dict[str, list[tuple[str, list[str]]]]

    @classmethod
    def parse(cls, text: str) -> Taxonomy:
        raw = json.loads(text)
        return cls({dim: [(label, [k for k in keywords if k]) for label, keywords in raw.get(key, {}).items()] for dim, key in DIMENSIONS.items()})

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Taxonomy:
        """From a JSON file anywhere Spark reads: four objects from label to a list of keywords. Its size is that of a vocabulary, not of the corpus."""
        return cls.parse(spark.read.text(path, wholetext=True).first()[0])

    def table(self, spark: SparkSession) -> DataFrame:
        """(dim, label_ord, label, kw_ord, keyword), ordinals from 0."""
        rows = [(dim, i, label, j, k) for dim, labels in self.labels.items() for i, (label, keywords) in enumerate(labels) for j, k in enumerate(keywords)]
        return spark.createDataFrame(rows, "dim string, label_ord int, label string, kw_ord int, keyword string")

    @cached_property
    def _found(self) -> Callable[[Column], Column]:
        """Of a text: how many keywords of each label it has, dimension by dimension, how often tag keywords occur, and its words. All rules take what they need from this one
        column, so that a text goes to Python once for all of them."""
        keywords = [[[k.lower() for k in ks] for _, ks in labels] for labels in self.labels.values()]
        tags = [k.lower() for _, ks in self.labels.get("tag", []) for k in ks]

        @F.arrow_udf("struct<hits:array<array<int>>,matches:long,words:int>")
        def run(texts: pa.Array) -> pa.Array:
            hits, matches = [], []
            for some in few(texts):
                for t in X.listed(some):
                    t = t or ""  # no keyword is empty
                    hits.append([[sum(k in t for k in ks) for ks in labels] for labels in keywords])
                    matches.append(sum(map(t.count, tags)))
            return pa.StructArray.from_arrays([pa.array(hits, pa.list_(pa.list_(pa.int32()))), pa.array(matches, pa.int64()), X.counted(texts)], ["hits", "matches", "words"])

        return run

    def hits(self, cleaned: Column, dim: str) -> Column:
        """array<struct<hits, label_ord, label>>, most hits first, earlier labels first among equals; labels without a hit are left out."""
        if not self.labels[dim]:
            return F.array().cast("array<struct<less:int,label_ord:int,label:string>>")
        names = F.array(*[F.lit(label) for label, _ in self.labels[dim]])
        counts = F.get(self._found(cleaned)["hits"], F.lit(list(self.labels).index(dim)))
        found = F.transform(counts, lambda n, i: F.struct((-n).alias("less"), i.alias("label_ord"), F.get(names, i).alias("label")))
        return F.array_sort(F.filter(found, lambda x: x["less"] < 0))

    def top1(self, cleaned: Column, dim: str) -> Column:
        """The label with the most hits, the earliest of equals, or the dimension's default."""
        return F.coalesce(F.get(self.hits(cleaned, dim), F.lit(0))["label"], F.lit(DEFAULTS[dim]))

    def tags(self, cleaned: Column, n: int = TOP_TAGS) -> Column:
        """The n labels with the most hits, the earliest of equals; as a set, in order of the alphabet."""
        return X.clean_tags(F.transform(F.slice(self.hits(cleaned, "tag"), 1, n), lambda x: x["label"]))

    def relevance(self, cleaned: Column) -> Column:
        """1 to 100: the logarithm of how many tag keywords occur, without overlap and repeats of a keyword in the lists counted again, per 1000 words.

        A text of less than 100 words, or without a match, has 1; halves round to even."""
        found = self._found(cleaned)
        n = found["words"]
        density = found["matches"] / n * PER_WORDS
        scaled = F.greatest(F.lit(LOWEST), F.least(F.lit(HIGHEST), F.bround(F.log10(1 + density) * FACTOR, 0).cast("int")))
        return F.when((n < LEAST_WORDS) | (density == 0), F.lit(LOWEST)).otherwise(scaled)


def keyword_hits(docs: DataFrame, taxonomy: Taxonomy, key: str, cleaned: str) -> DataFrame:
    """(key, dim, label_ord, label, hits) of every label with a hit, as rows."""

    def rows(dim: str) -> Column:
        return F.transform(taxonomy.hits(F.col(cleaned), dim), lambda x: F.struct(F.lit(dim).alias("dim"), x["label_ord"].alias("label_ord"), x["label"].alias("label"), (-x["less"]).alias("hits")))

    per = [rows(dim) for dim in taxonomy.labels]
    return docs.select(key, F.explode(F.concat(*per)).alias("x")).select(key, "x.*")


#: Keywords that one automaton has; more are gone through in further passes over the texts.
SHARD = 200_000


def _automaton(keywords: list[str]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for i, k in enumerate(keywords):
        found.add_word(k, i)
    found.make_automaton()
    return found


def table_hits(docs: DataFrame, keywords: DataFrame, key: str, cleaned: str) -> DataFrame:
    """(key, dim, label_ord, label, hits) of every label with a hit, by a taxonomy of any size as a table (dim, label_ord, label, kw_ord, keyword); a keyword that is listed
    twice counts twice, an empty one never.

    Texts are gone through once for each SHARD keywords, whatever their number, by an automaton of them all; what is found of a text, each keyword once, meets the
    table by keyword. Texts aren't shuffled. A null text has no hit; repeated keys add up."""
    spark = docs.sparkSession
    listed = written(keywords.filter("keyword <> ''").select("dim", "label_ord", "label", "kw_ord", F.lower("keyword").alias("keyword")))
    shards = max(1, -(-listed.select("keyword").distinct().count() // SHARD))
    place = F.pmod(F.xxhash64("keyword"), F.lit(shards))
    found = None
    for shard in range(shards):
        words = spark.sparkContext.broadcast([r[0] for r in listed.filter(place == shard).select("keyword").distinct().toLocalIterator()])  # about SHARD keywords

        def run(batches: Iterator[pa.RecordBatch], words=words) -> Iterator[pa.RecordBatch]:
            automaton = _automaton(words.value)
            for b in batches:
                at, which = [], []
                for i, text in enumerate(b.column(1).to_pylist()):
                    hit = {k for _, k in automaton.iter(text)} if text and words.value else ()
                    at += [i] * len(hit)
                    which += [words.value[k] for k in hit]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(which, pa.string())], names=[key, "keyword"])

        some = docs.select(key, cleaned).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, keyword string")
        found = some if found is None else found.union(some)
    return found.join(listed, "keyword").groupBy(key, "dim", "label_ord", "label").agg(F.count("*").cast("int").alias("hits"))
