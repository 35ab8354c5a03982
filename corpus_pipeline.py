"""The corpus pipeline: five stages from raw documents to tokens.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns what it
keeps, with the columns of ``documents`` (the last: ids of tokens).  ``run`` writes every stage as
Parquet to the cluster's shared folder and reads it again for the next one, so a lost executor costs
one stage's tasks, not the stages before.

SQL cannot express the stages' models, fingerprints and token merges, so there is no ``ORACLE_SQL``;
tests compare the whole run with a brute-force version on a small fixture.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import bpe, decontaminate, simhash, suffix_dedup, toxicity
from terrace.llm.common import staged, table

TOKENIZER = "word_bpe_49k.json"
ORACLE_SQL = None


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more by their nearest labelled examples go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays (three-word shingles, at most two differing bits)."""
    return simhash.one_of_each(docs)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that an earlier document has are cut out; documents left empty go."""
    return _measured(suffix_dedup.drop_repeats(docs))


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of ten words of a benchmark item are cut out; documents of which they cover over half go."""
    return _measured(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of ids and decoded text."""
    return bpe.encode(docs, public_tokenizers.path(TOKENIZER), results=("ids", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("toxicity", remove_toxic),
    ("simhash_near_dedup", remove_near_duplicates),
    ("suffix_array_dedup", remove_repeats),
    ("benchmark_decontamination", remove_benchmark),
    ("bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
