"""Queries over vectors (4), pages (6) and shards (7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import hosts, sharding, topk
from .common import staged, table
from .queries import register

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


@register("op4_topk", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND vec_id IS NOT NULL),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.vec, c.vec) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""")
def op4_topk(spark, sf_dir):
    """The five best of all vectors for every fiftieth."""
    vectors, _ = staged(topk.whole_numbers(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 256), "topk-vectors")
    return topk.top_k(vectors, vectors.where("id % 50 = 0"), 5)


HOST_SQL = "translate(regexp_extract(COALESCE(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
BETA_SQL = """
{level}_0 AS (SELECT {keys}, SUM(o.n) AS n, SUM(o.bad) AS bad, MAX(a.mean) AS mean FROM by_host o {join} GROUP BY {keys}),
{level}_s AS (SELECT CASE WHEN SUM(n * (n - 1) * mean * (1 - mean)) > 0 THEN LEAST(1000.0, GREATEST(1.0,
                1 / GREATEST(SUM((bad - n * mean) * (bad - n * mean) - n * mean * (1 - mean)) / SUM(n * (n - 1) * mean * (1 - mean)), 1e-3) - 1)) ELSE 1.0 END AS s
              FROM {level}_0),
{level}_1 AS (SELECT {names}, mean * s + bad AS a, (1 - mean) * s + n - bad AS b FROM {level}_0, {level}_s),
{level}_t AS (SELECT {names}, a / (a + b) AS mean, a / (a + b) - 1.6449 * sqrt(a * b / ((a + b) * (a + b)) / (a + b + 1)) AS low FROM {level}_1)"""


def _beta(level: str, keys: list[str], above: str) -> str:
    join = f"JOIN {above} a USING ({', '.join(keys[:-1])})" if len(keys) > 1 else f"CROSS JOIN {above} a"
    return BETA_SQL.format(level=level, keys=", ".join(keys), names=", ".join(keys), join=join)


def _fits(own: str, path: str) -> str:
    return f"(host = '{own}' OR ends_with(host, '.{own}')) AND starts_with(path, '{path}')"


@register("op6_hosts", f"""
WITH p AS (SELECT page_id, {HOST_SQL} AS host, regexp_extract(COALESCE(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
l AS (SELECT *, string_split(host, '.') AS w FROM p),
k AS (SELECT *, CASE WHEN len(w) >= 3 AND length(w[-1]) = 2 AND w[-2] IN ('co', 'com', 'org', 'net', 'ac', 'gov', 'edu') THEN 2 ELSE 1 END AS few FROM l),
lv AS (SELECT page_id, host, path, array_to_string(w[-few:], '.') AS suffix, array_to_string(w[-few - 1:], '.') AS domain FROM k),
out AS (SELECT doc_id, MAX(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
by_host AS (SELECT host, domain, suffix, CAST(COUNT(*) AS DOUBLE) AS n, CAST(SUM(bad) AS DOUBLE) AS bad FROM lv JOIN out ON doc_id = page_id WHERE host <> '' GROUP BY ALL),
top AS (SELECT (COALESCE(SUM(bad), 0) + 0.5) / (COALESCE(SUM(n), 0) + 1.0) AS mean FROM by_host),
{_beta("suffix", ["suffix"], "top")}, {_beta("domain", ["suffix", "domain"], "suffix_t")}, {_beta("host", ["suffix", "domain", "host"], "domain_t")}
SELECT page_id, lv.host, path,
       CASE WHEN {_fits("www.example.com", "/en/")} THEN 'www.example.com/en/' WHEN {_fits("example.com", "/en/")} THEN 'example.com/en/'
            WHEN {_fits("net", "/es/")} THEN 'net/es/' WHEN {_fits("net", "/fr/")} THEN 'net/fr/' WHEN {_fits("com", "/")} THEN 'com/' END AS rule,
       CASE WHEN {_fits("www.example.com", "/en/")} THEN 'allow' WHEN {_fits("example.com", "/en/")} THEN 'block'
            WHEN {_fits("net", "/es/")} THEN 'block' WHEN {_fits("net", "/fr/")} THEN 'block' WHEN {_fits("com", "/")} THEN 'allow'
            WHEN COALESCE(h.low, d.low, s.low) > 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM lv LEFT JOIN (SELECT host AS hh, low FROM host_t) h ON lv.host = hh LEFT JOIN (SELECT domain AS dd, low FROM domain_t) d ON lv.domain = dd
LEFT JOIN (SELECT suffix AS ss, low FROM suffix_t) s ON lv.suffix = ss
""")
def op6_hosts(spark, sf_dir):
    """Every page judged by rule or host reputation.  Outcome of a page: the label of the same number,
    bad where it is of low quality or toxic."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    bad = labels.groupBy("doc_id").agg(F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("bad"))
    outcomes = pages.select("page_id", "url").join(bad, F.col("doc_id") == F.col("page_id")).select("url", "bad")
    return hosts.judge(pages, outcomes, RULES).select("page_id", "host", "path", "rule", "verdict")


@register("op7_sharding")
def op7_sharding(spark, sf_dir):
    """All documents in eight shards of near equal bytes; equal texts stay together."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.assign(docs, 8).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                           F.lit(None).cast("int").alias("grown_shard"))
