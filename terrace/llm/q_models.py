"""Queries of the trained models: toxicity (2), language model (5), quality (9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import lm, quality, toxicity
from .common import fold, table
from .queries import register


@register("op2_toxicity")
def op2_toxicity(spark, sf_dir):
    """Every document scored by its nearest labelled examples of the other four folds."""
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    docs = docs.select("doc_id", "text")
    scores = toxicity.score(docs, toxicity.fit(docs, toxicity.training_labels(labels)))
    return scores.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         F.slice("evidence", 1, 3).alias("evidence"))


def graded(labels):
    """Ratings from the two labels: 0 low quality, 1 toxic only, 2 neither."""
    return labels.select("doc_id", F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2).alias("grade"))


@register("op9_quality")
def op9_quality(spark, sf_dir):
    """Every document's expected grade and whether it is kept (grade 1 or 2 is likelier than not); the ratings of
    the held-out fold are not learnt from."""
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    docs = docs.select("doc_id", "text")
    model = quality.fit(docs, graded(labels.where(fold("doc_id", 5) != 0)))
    return quality.grade(docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "expected_grade", F.col("tail_prob").alias("score"), "tail_prob", "keep")


@register("op5_lm")
def op5_lm(spark, sf_dir):
    """Every document scored by the language model of the documents that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = lm.train(docs.where(fold("doc_id", 7) != 2))
    return lm.score(docs, model).select("doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")
