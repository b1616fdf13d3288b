"""The queries of the operators, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Shards of op10.
SHARDS = 24


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import suffixes

    found = suffixes.dedup(_table(spark, sf_dir, "documents"), length=100)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import mixing

    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import langid

    docs = _table(spark, sf_dir, "documents")
    network = langid.fit(docs)
    return langid.predict(docs.select("doc_id", "text"), network).select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import common, warc

    path = common.folder(spark, "warc")
    warc.write(_table(spark, sf_dir, "pages"), path)
    return warc.resolve(warc.reassemble(warc.read_records(spark, path)))


def op5_ego(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import ego

    return ego.group(_table(spark, sf_dir, "embeddings"), cosine=0.9)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import simhash

    found = simhash.group(_table(spark, sf_dir, "documents"), size=4, differ=4, tables=1)
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from . import bpe

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.round_trip(docs, path, pattern))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    space = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return quality.score(docs, space).select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_vafile(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import vafile

    return vafile.topk(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64.0)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import sharding

    return sharding.shard(_table(spark, sf_dir, "documents"), [1.0] * SHARDS)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import collocations

    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import pii

    found = pii.personal(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[pii.count("base", k).alias(f"n_{k}") for k in pii.KINDS], F.sha2(pii.joined("base"), 256).alias("base_sha256"), pii.joined("spans").alias("spans"))


def op13_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import alerts

    return alerts.missing_follow_ups(_table(spark, sf_dir, "clicks"), _table(spark, sf_dir, "sales"))


OP1_SQL = """
WITH d AS MATERIALIZED (
  SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
p AS (
  SELECT doc_id, unnest(range(0, n - 99)) AS i, unnest(list_transform(range(0, n - 99), lambda i: array_slice(b, i + 1, i + 100))) AS x
  FROM d WHERE n >= 100),
w AS (SELECT doc_id, i, row_number() OVER (PARTITION BY x ORDER BY doc_id, i) > 1 AS later FROM p),
s AS (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, true) AS new FROM w WHERE later),
g AS (SELECT doc_id, i, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM s),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS z FROM g GROUP BY doc_id, span),
pieces AS (
  SELECT d.doc_id, coalesce(lag(z) OVER (PARTITION BY d.doc_id ORDER BY a), 0) AS k0, a AS k1 FROM d JOIN spans USING (doc_id)
  UNION ALL SELECT d.doc_id, coalesce(max(z), 0), any_value(d.n) FROM d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id),
kept AS (
  SELECT p.doc_id, string_agg(CASE WHEN k1 > k0 THEN hex(array_slice(b, k0 + 1, k1)) ELSE '' END, '' ORDER BY k0) AS h
  FROM pieces p JOIN d USING (doc_id) GROUP BY p.doc_id),
sums AS (SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, d.n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(h)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)
"""
OP2_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '/' || coalesce(text, '')), 1, 15))::BIGINT AS turn
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS queue,
         sum(sum(size)) OVER ()::DOUBLE AS budget
  FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][((queue - 1) % 3 + 1)::INT]::DOUBLE AS weight, 3.0::DOUBLE * source_size AS most FROM src),
lev AS (
  SELECT *, most / weight AS stops_at,
         (budget - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
aims AS (
  SELECT queue, source, source_size, budget,
         least(most, weight * coalesce((SELECT max(level) FROM lev WHERE level <= stops_at), 1e300)) AS target
  FROM lev),
q AS (
  SELECT d.*, aims.queue, aims.source_size, aims.target, aims.budget,
         sum(size) OVER (PARTITION BY queue ORDER BY turn, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS cum
  FROM d JOIN aims ON d.source IS NOT DISTINCT FROM aims.source),
copies AS (
  SELECT q.*, pass, (cum + pass * source_size)::DOUBLE / target AS finish
  FROM q, (SELECT unnest([0, 1, 2]) AS pass) WHERE size > 0 AND target > 0 AND cum + pass * source_size - size / 2.0::DOUBLE <= target),
ordered AS (
  SELECT *, sum(size) OVER (ORDER BY finish, queue, turn, pass ROWS UNBOUNDED PRECEDING) AS upto FROM copies),
taken AS (
  SELECT queue, turn, cum, sum(size)::BIGINT AS taken FROM ordered WHERE upto <= budget GROUP BY ALL)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(t.taken, 0)::BIGINT AS taken
FROM q LEFT JOIN taken t ON q.size > 0 AND q.queue = t.queue AND q.turn = t.turn AND q.cum = t.cum
"""

OP4_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes < 1000 OR page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN payload_bytes < 1000 OR page_id = last THEN NULL ELSE last END AS refers_to, NULL::VARCHAR AS problem
FROM m
"""
OP5_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
ok AS (
  SELECT * FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(u, v) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u),
least AS (SELECT u AS vec_id, min(v) AS component_id FROM reach GROUP BY u),
n AS (SELECT u AS vec_id, count(*) AS n_links FROM links GROUP BY u)
SELECT l.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, l.component_id, l.vec_id = l.component_id AS kept
FROM least l LEFT JOIN n USING (vec_id)
"""
OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""
OP10_SQL = """
WITH RECURSIVE bits(i, k, v) AS (
  SELECT i::BIGINT, 0, i::BIGINT FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END FROM bits WHERE k < 8),
t AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
d AS (
  SELECT doc_id, coalesce(strlen(text), 0) + 8 AS size,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT)),
                         lambda c, x: xor(c >> 8, t[(xor(c, x) % 256 + 1)::INT])), 4294967295::BIGINT) AS text_crc32
  FROM documents, t),
u AS (
  SELECT doc_id, s, -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '/' || s), 1, 15))::BIGINT::DOUBLE + 0.5::DOUBLE) / 1152921504606846976::DOUBLE) AS score
  FROM (SELECT DISTINCT doc_id FROM documents), (SELECT unnest(range(25)) AS s)),
o AS (
  SELECT doc_id, arg_min(s, (score, s)) FILTER (s < 24) AS shard, arg_min(s, (score, s)) AS grown_shard,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '/-1'), 1, 15))::BIGINT AS turn
  FROM u GROUP BY doc_id)
SELECT d.doc_id, d.size::BIGINT AS size, d.text_crc32, 'key' AS law, o.shard::INT AS shard,
       row_number() OVER (PARTITION BY o.shard ORDER BY (o.turn + d.text_crc32) % greatest(1, ceil((SELECT count(*) FROM documents) / 4096)::BIGINT // 24), d.doc_id NULLS FIRST, d.size, d.text_crc32) - 1 AS slot, o.grown_shard::INT AS grown_shard
FROM d JOIN o ON d.doc_id IS NOT DISTINCT FROM o.doc_id
"""
OP11_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS MATERIALIZED (
  SELECT lang, ws, count(*) AS m FROM (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p) WHERE len(ws) > 0 GROUP BY ALL),
totals AS (SELECT lang, sum(m * len(ws))::HUGEINT AS n FROM w GROUP BY lang),
starts AS (SELECT lang, ws, m, s, unnest(range(1, len(ws) - s + 2)) AS i FROM w, range(1, 6) r(s) WHERE s <= len(ws)),
g AS MATERIALIZED (
  SELECT lang, s::INT AS s, phrase, sum(m)::HUGEINT AS a FROM (SELECT lang, s, m, array_to_string(ws[i:i + s - 1], ' ') AS phrase FROM starts) GROUP BY ALL HAVING sum(m) >= 100),
c AS (SELECT *, string_split(phrase, ' ') AS ws FROM g WHERE s > 1),
cuts AS (SELECT *, unnest(range(1, s)) AS k FROM c),
scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.s, cuts.a, x.a AS l, y.a AS r, n, k, 1000 * cuts.a * n // (x.a * y.a) AS score
  FROM cuts JOIN totals USING (lang) JOIN g x ON x.lang = cuts.lang AND x.phrase = array_to_string(cuts.ws[1:k], ' ')
  JOIN g y ON y.lang = cuts.lang AND y.phrase = array_to_string(cuts.ws[k + 1:], ' ')
  QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY score, k) = 1),
inner_sizes AS (SELECT lang, ws, s, a, unnest(range(2, s)) AS k FROM c WHERE s > 2),
inner_starts AS (SELECT *, unnest(range(1, s - k + 2)) AS i FROM inner_sizes),
held AS (SELECT lang, array_to_string(ws[i:i + k - 1], ' ') AS phrase, max(a) AS held FROM inner_starts GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM scored LEFT JOIN held USING (lang, phrase) WHERE held IS NULL OR 100 * held < 100 * a QUALIFY rank <= 2000
"""
OP13_SQL = """
WITH RECURSIVE bits(i, k, v) AS (
  SELECT i::BIGINT, 0, i::BIGINT FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END FROM bits WHERE k < 8),
t AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
raw AS (
  SELECT client_id, epoch_us(ts) AS us, 0 AS kind, arrived_at, click_id AS id
  FROM (SELECT DISTINCT * FROM clicks WHERE kind = 'error' AND client_id IS NOT NULL AND ts IS NOT NULL)
  UNION ALL SELECT client_id, epoch_us(sold_at), 1, arrived_at, sale_id FROM sales WHERE client_id IS NOT NULL AND sold_at IS NOT NULL),
sums AS (
  SELECT id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(id::VARCHAR, ''))), '..'), lambda x: ('0x' || x)::BIGINT)),
                             lambda c, x: xor(c >> 8, t[(xor(c, x) % 256 + 1)::INT])), 4294967295::BIGINT) AS crc
  FROM (SELECT DISTINCT id FROM raw), t),
dealt AS (
  SELECT client_id, us, kind, coalesce(greatest(0, least(7, floor((epoch_us(arrived_at) // 3600000000 - 473352 + 80 * (crc % 4)) * 8 / 3648))), 7)::INT AS batch
  FROM raw JOIN sums ON raw.id IS NOT DISTINCT FROM sums.id),
marks AS (SELECT b::INT AS batch, (SELECT max(us) FROM dealt WHERE batch < b) - 345600000000 AS mark FROM range(8) r(b)),
judged AS (SELECT dealt.*, coalesce(us < mark, false) AS late FROM dealt JOIN marks USING (batch)),
c AS (SELECT client_id, us, count(*) AS n FROM judged WHERE kind = 0 AND NOT late GROUP BY ALL),
s AS (SELECT DISTINCT client_id, us FROM judged WHERE kind = 1 AND NOT late),
open AS (
  SELECT c.client_id, c.us, c.us + 86400000000 AS due, coalesce(s.us <= c.us + 86400000000, false) AS cancelled, least(coalesce(s.us, c.us + 86400000000), c.us + 86400000000) AS until
  FROM c ASOF LEFT JOIN s ON c.client_id = s.client_id AND s.us >= c.us),
next AS (SELECT open.*, c.us AS next FROM open ASOF LEFT JOIN c ON open.client_id = c.client_id AND c.us > open.until),
opened AS (
  SELECT client_id, min(us) AS us FROM c GROUP BY client_id
  UNION ALL SELECT o.client_id, n.next FROM opened o JOIN next n ON o.client_id = n.client_id AND o.us = n.us AND n.next IS NOT NULL),
alerts AS (SELECT open.client_id, open.us, open.due FROM open JOIN opened USING (client_id, us) WHERE NOT cancelled)
SELECT coalesce((SELECT min(m.batch) FROM marks m WHERE m.mark > a.due), 8)::INT AS batch, a.client_id, a.us AS opened_us, a.due AS due_us, sum(c.n)::BIGINT AS n_rows
FROM alerts a JOIN c ON c.client_id = a.client_id AND c.us BETWEEN a.us AND a.due GROUP BY ALL
UNION ALL SELECT batch, client_id, -1, -1, count(*)::BIGINT FROM judged WHERE late GROUP BY ALL
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_suffixes": op1_suffixes, "op2_mixing": op2_mixing, "op3_langid": op3_langid, "op4_warc": op4_warc, "op5_ego": op5_ego, "op6_simhash": op6_simhash, "op7_bpe": op7_bpe, "op8_quality": op8_quality, "op9_vafile": op9_vafile, "op10_sharding": op10_sharding, "op11_collocations": op11_collocations, "op12_pii": op12_pii, "op13_alerts": op13_alerts}


def oracle_sql() -> dict[str, str]:
    return {"op1_suffixes": OP1_SQL, "op2_mixing": OP2_SQL, "op4_warc": OP4_SQL, "op5_ego": OP5_SQL, "op9_vafile": OP9_SQL, "op10_sharding": OP10_SQL, "op11_collocations": OP11_SQL, "op13_alerts": OP13_SQL}
