"""A corpus pipeline: quality filter, near-copies, repeated passages, mix of sources, tokens. Every stage works on all its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import bpe, common, jaccard, mixing, quality, simhash, suffixes


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject, all rows as they are. A null or empty text has the learned share of good labels as its score; repeated rows
    go or stay together; an empty table gives an empty result."""
    space = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    return quality.score(rows, space).filter("predicted = 1").select("row.*")


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are neither copies nor near copies of an earlier one that stays: sets of five-word shingles with a Jaccard similarity of 0.8 or more.

    SimHash groups come first, and of each only one of several similar documents stays. Fingerprints miss some pairs, so an exact
    prefix filter over what stays finds the rest: no two documents that are left are similar. A null text counts as an empty one, of which one stays; a null
    doc_id comes last; of repeated rows one stays; an empty table gives an empty result."""
    once = common.written(simhash.keep_one(docs, size=5, differ=4, tables=1, least=0.8))
    return jaccard.keep_unlike(once, size=5, least=0.8)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, less what is covered by 100-byte strings that start earlier, too; a character that loses a byte goes. n_chars follows the text.

    A null text stays null; a text that is all repeats becomes empty."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    found = suffixes.dedup(docs.withColumn("_docloom_null", F.col("text").isNull()), length=100, carry=[*rest, "_docloom_null"], as_text=True)
    text = F.when(~F.col("carried._docloom_null"), F.col("kept"))
    columns = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.length("text").cast("long")} | {c: F.col(f"carried.`{c}`") for c in rest}
    return found.withColumn("text", text).select(*[columns[c].alias(c) for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, as often as it takes them. A null source is one of its own; null and wordless texts are never taken, nor a source whose target
    is 0; repeated rows queue each on their own; an empty table gives an empty result."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids and whether the decoded ids are the text again: a row per row. A null or empty text has no ids; ids and sources that are null
    stay so; an empty table gives an empty result."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    rows = docs.select("doc_id", "lang", "source", "text", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("was"))
    found = bpe.round_trip(rows, path, pattern)
    return found.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.sha2("decoded", 256) == F.col("was")).alias("exact"))


STAGES = [("quality", good), ("near_copies", unlike), ("repeats", unrepeated), ("mix", mixture), ("tokens", tokens)]

#: SQL can't express the classifier, XXH64 or the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are written as Parquet in the shared folder and read again. What a stage leaves there goes when the next one is
    written; the last stage's input stays for its result to be read, until common.sweep()."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        since = common.mark()
        path = common.folder(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        common.sweep(spark, since, path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
