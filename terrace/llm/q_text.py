"""Queries of the operators that read whole texts: BPE (3), decontamination (1), SimHash (8),
suffix-array dedup (10)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import bpe, suffix_dedup
from .common import table
from .decontaminate import find_hits, span_words
from .queries import register
from .simhash import near_duplicates

TOKENIZER = "word_bpe_49k.json"


@register("op3_bpe")
def op3_bpe(spark, sf_dir):
    """Every document encoded and decoded; digests of ids and decoded text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_digest(docs, public_tokenizers.path(TOKENIZER))


WORDS_SQL = """
SELECT {key}, generate_subscripts(w, 1) AS i, unnest(w) AS word
FROM (SELECT {key}, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {table})
"""


@register("op1_decontaminate", f"""
WITH dw AS ({WORDS_SQL.format(key="doc_id", table="documents")}),
iw AS ({WORDS_SQL.format(key="item_id", table="benchmark")}),
isize AS (SELECT item_id, COUNT(*) AS n FROM iw GROUP BY item_id),
iwin AS (SELECT DISTINCT item_id, LEAST(n, 10) AS size,
                string_agg(word, ' ') OVER (PARTITION BY item_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS win, i, n
         FROM iw JOIN isize USING (item_id)),
items AS (SELECT DISTINCT item_id, size, win FROM iwin WHERE i + size - 1 <= n),
sizes AS (SELECT DISTINCT size FROM items),
dsize AS (SELECT doc_id, COUNT(*) AS n FROM dw GROUP BY doc_id),
dwin AS (SELECT doc_id, i, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS ahead FROM dw),
dsized AS (SELECT doc_id, i, size, array_to_string(ahead[1:size], ' ') AS win FROM dwin JOIN sizes ON len(ahead) >= size),
hits AS (SELECT doc_id, i, size, item_id FROM dsized JOIN items USING (size, win)),
hit_words AS (SELECT doc_id, COUNT(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
              FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, COALESCE(s.n, 0) AS n_words, COALESCE(h.n_hit, 0) AS n_hit, COALESCE(t.n_items, 0) AS n_items,
       sha256(COALESCE(t.names, '')) AS items_sha256, COALESCE(h.n_hit, 0) > 0 AS contaminated
FROM documents d LEFT JOIN dsize s USING (doc_id) LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items t USING (doc_id)
""")
def op1_decontaminate(spark, sf_dir):
    """Every document against the automaton of all benchmark items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = find_hits(docs, table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "n_words", span_words().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                       (F.size("items") + F.size("spans") > 0).alias("contaminated"))


@register("op8_simhash")
def op8_simhash(spark, sf_dir):
    """Every document's fingerprint and the component it is linked into."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@register("op10_suffix_dedup")
def op10_suffix_dedup(spark, sf_dir):
    """Every document without the bytes of 50-byte strings that a document with a smaller id has."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.dedup(docs, digest=True).withColumnRenamed("kept", "kept_sha256")
