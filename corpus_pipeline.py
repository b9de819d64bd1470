"""Corpus pipeline: toxicity, language, near-duplicates, benchmark passages, and encoding, one after the other.

Every stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept; all but the last return the
columns of `documents`. Models and the benchmark are learned and read from the given folder. Clashing or extra
columns of `docs` are passed through; null and empty texts have the results that the operators' docstrings state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm import bpe, decontamination, language, minhash_dedup, toxicity
from tickloom.llm.common import numbered_columns, table
from tickloom.llm.models import language_model, toxicity_model
from tickloom.session import scratch_path

#: A document is rejected as mixed if no language wrote at least this share of it.
LEAST_SHARE = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not predict as toxic. Null and empty texts stay."""
    plain, back = numbered_columns(docs)
    names = dict(zip(docs.columns, plain.columns))
    scored = toxicity.score(plain, toxicity_model(spark, sf_dir), key=names["doc_id"], text=names["text"], keep=plain.columns)
    return scored.where("predicted = 0").select(back)


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a learned language that wrote at least half of them; texts without letters go."""
    plain, back = numbered_columns(docs)
    names = dict(zip(docs.columns, plain.columns))
    found = language.predict(plain, language_model(spark, sf_dir), key=names["doc_id"], text=names["text"], keep=plain.columns)
    clear = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SHARE)
    return found.where(clear).select(back)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the one with the smallest id."""
    return minhash_dedup.deduplicate(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every remaining document, and digests that prove the round trip."""
    coded = bpe.encode(docs, decode=True)
    return coded.select("doc_id", "n_tokens", "token_ids", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language", keep_languages),
    ("minhash_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("bpe_encoding", encode),
]

#: No stage can be said in SQL. Tests hold near-duplicates, benchmark passages and encoding against brute force, the learned stages against the operators' own predictions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
