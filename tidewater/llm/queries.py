"""The registered queries of the operators and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import (bytebpe, exact_dedup, filter_audit, importance, language_crf, near_dedup, packing, passage_dedup,
                           quality_nbsvm, sharding, suffix_dedup, token_counts, vector_search)
from tidewater.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@_query
def op2_language_crf(spark, sf_dir):
    return language_crf.language_id(table(spark, sf_dir, "documents"))


@_query
def op3_quality_nbsvm(spark, sf_dir):
    return quality_nbsvm.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op4_hyperminhash_dedup(spark, sf_dir):
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"))


@_query
def op5_byte_bpe(spark, sf_dir):
    return bytebpe.encode_decode(table(spark, sf_dir, "documents"), digests=True)


@_query
def op6_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@_query
def op7_suffix_dedup(spark, sf_dir):
    out = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


@_query
def op8_multiprobe_lsh(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return vector_search.nearest(vectors, vectors.filter("vec_id % 100 = 0"))


@_query
def op9_exact_dedup(spark, sf_dir):
    out = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE_SQL["op9_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@_query
def op10_hilbert_shards(spark, sf_dir):
    out = sharding.hilbert_shards(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@_query
def op11_filter_audit(spark, sf_dir):
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE_SQL["op11_filter_audit"] = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), words AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts
), fails AS (
  SELECT doc_id, part,
         CASE WHEN len(w) < 50 THEN 1 ELSE 0 END
       + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
       + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
       + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
       + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
  FROM words
), cells AS (
  SELECT part, mask, count(*) AS n,
         count(*) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)) AS good,
         count(*) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)) AS toxic
  FROM fails GROUP BY ALL
), letter AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), steps AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0) AS earlier
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
), counted AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & (earlier + bit) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & earlier = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & earlier > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & earlier = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & earlier = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY ALL
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM counted
"""


@_query
def op12_passage_dedup(spark, sf_dir):
    out = passage_dedup.passage_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL["op12_passage_dedup"] = r"""
WITH words AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT row, doc_id, p, sha256(array_to_string(w[p:p + 49], ' ')) AS h
  FROM (SELECT *, unnest(range(1, len(w) - 48)) AS p FROM words WHERE len(w) >= 50)
), late AS (
  SELECT row, p FROM (SELECT row, p, doc_id > min(doc_id) OVER (PARTITION BY h) AS gone FROM windows) WHERE gone
), covered AS (
  SELECT DISTINCT row, p + k AS pos FROM late, (SELECT unnest(range(0, 50)) AS k)
), removed AS (
  SELECT row, list(pos) AS gone FROM covered GROUP BY row
)
SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
       sha256(coalesce(array_to_string(list_select(w, list_filter(range(1, len(w) + 1), lambda i: gone IS NULL OR NOT list_contains(gone, i))), ' '), '')) AS kept_sha256
FROM words LEFT JOIN removed USING (row)
"""


@_query
def op13_importance_resampling(spark, sf_dir):
    out = importance.importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


ORACLE_SQL["op13_importance_resampling"] = r"""
WITH RECURSIVE crc_table(b, k, r) AS (
  SELECT b, 0, b FROM range(256) AS bytes(b)
  UNION ALL
  SELECT b, k + 1, CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END FROM crc_table WHERE k < 8
), crc_list AS (
  SELECT list(r ORDER BY b) AS t FROM crc_table WHERE k = 8
), doc_words AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), doc_feature AS (
  SELECT row, unnest(w) AS f FROM doc_words
), target_feature AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS f
  FROM benchmark
), spelled AS (
  SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM doc_feature UNION SELECT f FROM target_feature)
), bucketed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(h), 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT)),
                            lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM spelled, crc_list
), s AS (
  SELECT bucket, count(*) AS n FROM doc_feature JOIN bucketed USING (f) GROUP BY bucket
), t AS (
  SELECT bucket, count(*) AS n FROM target_feature JOIN bucketed USING (f) GROUP BY bucket
), gains AS (
  SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM doc_feature) + 10000)
                                   / ((s.n + 1)::DOUBLE * ((SELECT count(*) FROM target_feature) + 10000)))) AS gain
  FROM s LEFT JOIN t USING (bucket)
), weights AS (
  SELECT row, sum(gain) AS weight FROM doc_feature JOIN bucketed USING (f) JOIN gains USING (bucket) GROUP BY row
), scores AS (
  SELECT doc_id, len(w) AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5)::DOUBLE
                                                     / 4294967296))))::BIGINT AS score
  FROM doc_words LEFT JOIN weights USING (row)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
         count(*) OVER (PARTITION BY n_features >= 20) AS n
  FROM scores
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank
FROM ranked
"""
