"""The models that the registered queries and the pipeline learn from a folder of tables."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

from tickloom.llm import language, toxicity
from tickloom.llm.common import broadcast_if_small, fold, table


def toxicity_model(spark: SparkSession, d: str) -> toxicity.ToxicityModel:
    """Learned from the labelled documents outside the held-out fold; of repeated labels the highest counts."""
    docs = table(spark, d, "documents").select("doc_id", "text").where(fold("doc_id", 5) != 0)
    labels = table(spark, d, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return toxicity.train(docs.join(broadcast_if_small(labels), "doc_id"))


def language_model(spark: SparkSession, d: str) -> language.LanguageModel:
    """Learned from the documents outside the held-out fold."""
    return language.train(table(spark, d, "documents"), fold("doc_id", 4) != 2)
