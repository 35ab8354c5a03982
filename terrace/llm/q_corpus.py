"""Queries of the operators that work on the corpus's words as a whole: filter audit (11), byte-level
BPE (12); and on its vectors: hard negatives (13)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import byte_bpe, filter_audit, hard_negatives
from .common import table
from .queries import register

RANKS = "byte_bpe_50k.tiktoken"


@register("op12_byte_bpe")
def op12_byte_bpe(spark, sf_dir):
    """Every document encoded and decoded; digests of ids and decoded bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, results=("ids_sha256", "decoded_sha256"))


@register("op11_filter_audit", """
WITH d AS (SELECT doc_id, COALESCE(lang, '') AS part, COALESCE(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM d),
l AS (SELECT doc_id, MAX(CAST(quality = 1 AS INTEGER)) AS good, MAX(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, doc_id, len(words) < 100 AS a, 100 * len(list_distinct(words)) < 80 * len(words) AS b,
             100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
             COALESCE(doc_id > MIN(doc_id) OVER (PARTITION BY text), false) AS e FROM w),
m AS (SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, COUNT(*) AS n,
             COALESCE(SUM(good), 0) AS good, COALESCE(SUM(toxic), 0) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT p.f || q.f || r.f || s.f || t.f AS filter_order, [p.bit, q.bit, r.bit, s.bit, t.bit] AS bits
      FROM x p, x q, x r, x s, x t WHERE p.bit + q.bit + r.bit + s.bit + t.bit = 31 AND (p.bit | q.bit | r.bit | s.bit | t.bit) = 31),
y AS (SELECT filter_order, step, bits[step] AS own, CAST(list_sum(bits[1:step - 1]) AS INTEGER) AS before
      FROM (SELECT *, unnest(range(1, 6)) AS step FROM o)),
z AS (SELECT part, filter_order, step, own, mask & own > 0 AS fails, mask & COALESCE(before, 0) > 0 AS gone, mask, n, good, toxic FROM m CROSS JOIN y),
r AS (SELECT part, filter_order, CAST(step AS INTEGER) AS step, own,
             CAST(SUM(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS kept, CAST(SUM(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed,
             CAST(SUM(CASE WHEN fails AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant, CAST(SUM(CASE WHEN mask = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
             CAST(SUM(CASE WHEN fails AND NOT gone THEN good ELSE 0 END) AS BIGINT) AS good_lost, CAST(SUM(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
      FROM z GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(SUM(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r
""")
def op11_filter_audit(spark, sf_dir):
    """What five filters remove from every language's documents, in every order."""
    return filter_audit.audit(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), table(spark, sf_dir, "labels"))


@register("op13_hard_negatives", """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.vec, c.vec) AS BIGINT) AS score
      FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
             s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT * FROM n WHERE rank <= 10
""")
def op13_hard_negatives(spark, sf_dir):
    """Hard negatives of every hundredth vector."""
    vectors = hard_negatives.whole_numbers(table(spark, sf_dir, "embeddings"), "vec_id", "label", "embedding")
    vectors = vectors.withColumn("label", F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(vectors, vectors.where("id % 100 = 0"))
