"""Sharding by weighted rendezvous hashing of stable record keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common


def turn(key: Column, shard: int) -> Column:
    """60 bits of the MD5 of the key's digits, a stroke and the shard's number; a null key has no digits."""
    text = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f"/{shard}"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def score(key: Column, shard: int, weight: float) -> Column:
    """-ln(u) / weight with u in (0, 1) from a hash of key and shard: the smallest score owns the record, and a shard wins in proportion to its weight."""
    u = (turn(key, shard).cast("double") + 0.5) / float(1 << 60)
    return -F.log(u) / float(weight)


def owner(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key: it depends on the key and the weights only. A shard of weight 0 owns nothing; a null key hashes like any other."""
    live = [(i, w) for i, w in enumerate(weights) if w > 0]
    if not live:
        raise ValueError("one shard at least needs a weight above 0")
    return F.array_min(F.array(*[F.struct(score(key, i, w).alias("score"), F.lit(i).alias("shard")) for i, w in live]))["shard"]


def shard(docs: DataFrame, weights: Sequence[float], more_weight: float = 1.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Puts every row into a shard and numbers the rows of each.

    Adds size (UTF-8 bytes of the text, none for null, plus 8), text_crc32 (of those bytes), law `key`, shard, slot (from 0,
    gapless within the shard) and grown_shard (the shard if one more of weight more_weight were there: rows move only into
    it). Rows of equal key share a shard; repeated rows get a slot each; an empty table gives an empty result. Slots follow
    a bucket, the key, then size and CRC. Buckets are a hash of key and CRC, so no task sorts a whole shard, nor all rows of one key (or of none)."""
    n = len(weights)
    rows = common.fit_columns(docs, {id_col: "long", text_col: "string"})
    rows = rows.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col(text_col).cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
    )
    wide = common.buckets_for(docs.count())
    rows = common.cut(rows.withColumns({"shard": owner(F.col("doc_id"), weights), "grown_shard": owner(F.col("doc_id"), [*weights, more_weight]), "bucket": F.pmod(turn(F.col("doc_id"), -1) + F.col("text_crc32"), F.lit(max(1, wide // n)))}))
    order = [F.col("doc_id").asc_nulls_first(), "size", "text_crc32"]
    rows = common.running_sum(rows, ["shard"], "bucket", order, F.lit(1).cast("long"), "number")
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("number") - 1).alias("slot"), "grown_shard")
