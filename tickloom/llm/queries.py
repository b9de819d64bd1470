"""The registered queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import corpus_pipeline
from tickloom.llm import bloom_lm, bpe, collocations, decontamination, embedding_dedup, html_extract, language, merkle, minhash_dedup, substring_dedup, token_counts, toxicity, url_filter
from tickloom.llm.common import fold, table
from tickloom.llm.models import language_model, toxicity_model
from tickloom.llm.oracle import COLLOCATIONS_SQL, EMBEDDINGS_SQL, MERKLE_SQL, REPEATS_SQL
from tickloom.plans.registry import query


@query("op2_token_counts")
def op2_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return token_counts.token_report(table(spark, d, "documents"))


@query("op7_bpe_encoding")
def op7_bpe_encoding(spark: SparkSession, d: str) -> DataFrame:
    coded = bpe.encode(table(spark, d, "documents"), decode=True)
    return coded.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, d: str) -> DataFrame:
    scored = toxicity.score(table(spark, d, "documents"), toxicity_model(spark, d))
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted", "toxic_windows")


@query("op8_language")
def op8_language(spark: SparkSession, d: str) -> DataFrame:
    found = language.predict(table(spark, d, "documents"), language_model(spark, d))
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "languages", "shares")


@query("op9_url_filter")
def op9_url_filter(spark: SparkSession, d: str) -> DataFrame:
    return url_filter.judge(table(spark, d, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")


@query("op10_html_extraction")
def op10_html_extraction(spark: SparkSession, d: str) -> DataFrame:
    return html_extract.extract(table(spark, d, "pages")).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query("op6_minhash_dedup")
def op6_minhash_dedup(spark: SparkSession, d: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, d, "documents"))


@query("op4_decontamination")
def op4_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontamination.find_passages(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query("op1_embedding_dedup", EMBEDDINGS_SQL)
def op1_embedding_dedup(spark: SparkSession, d: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, d, "embeddings"))


@query("op3_lm_scoring")
def op3_lm_scoring(spark: SparkSession, d: str) -> DataFrame:
    remainder = fold("doc_id", 7)
    scored = bloom_lm.score(table(spark, d, "documents"), remainder != 2, keep={"held_out": remainder == 2})
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def tampered() -> Column:
    """Rows whose id has a CRC-32 that 7 divides; rows without an id are left alone."""
    return F.col("doc_id").isNotNull() & (fold("doc_id", 7) == 0)


@query("op11_merkle_manifest", MERKLE_SQL)
def op11_merkle_manifest(spark: SparkSession, d: str) -> DataFrame:
    return merkle.document_manifest(table(spark, d, "documents"), tampered())


@query("op12_substring_dedup", REPEATS_SQL)
def op12_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    return substring_dedup.repeated_spans(table(spark, d, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op13_collocations", COLLOCATIONS_SQL)
def op13_collocations(spark: SparkSession, d: str) -> DataFrame:
    return collocations.collocations(table(spark, d, "documents"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, d: str) -> DataFrame:
    return corpus_pipeline.run(spark, d)
