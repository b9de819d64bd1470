"""Token totals, quantiles and truncated totals from one exact histogram of encoded lengths.

Documents are aggregated by encoded length, so everything after the count has one row per
distinct length, however many documents there are. Suffix sums over that histogram answer
for every context limit L: documents of at least L tokens, their tokens, and the tokens that
are left when every document is cut at L.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tickloom.llm.bpe import count_tokens
from tickloom.session import materialize

#: Lengths in one piece of the histogram; the sums of pieces are carried over by a window over pieces.
PIECE = 1024


def length_histogram(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """One row per distinct encoded length: `n_tokens`, `n_docs`. Null and empty texts have length 0; no rows give no rows."""
    return count_tokens(docs, text, path).groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Sums from either end for every length of a histogram (`n_tokens`, `n_docs`).

    Returns `n_tokens`, `n_docs`, `docs_at_least` and `tokens_at_least` (over lengths >= this one),
    `docs_at_most`, `tokens_at_most` (over lengths <= this one), `truncated_tokens` (the total when
    every document is cut at this length), `quantile` (share of documents at most this long),
    `total_docs` and `total_tokens`.
    """
    rows = histogram.withColumn("tokens", F.col("n_tokens") * F.col("n_docs")).withColumn("piece", F.floor(F.col("n_tokens") / PIECE))
    pieces = rows.groupBy("piece").agg(F.sum("n_docs").alias("piece_docs"), F.sum("tokens").alias("piece_tokens"))
    before = W.orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    whole = W.orderBy("piece").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    carried = pieces.select(
        "piece",
        F.coalesce(F.sum("piece_docs").over(before), F.lit(0)).alias("docs_before"),
        F.coalesce(F.sum("piece_tokens").over(before), F.lit(0)).alias("tokens_before"),
        F.sum("piece_docs").over(whole).alias("total_docs"),
        F.sum("piece_tokens").over(whole).alias("total_tokens"),
    )
    inside = W.partitionBy("piece").orderBy("n_tokens").rowsBetween(W.unboundedPreceding, W.currentRow)
    at_most = rows.join(carried, "piece").select(
        "n_tokens",
        "n_docs",
        "tokens",
        (F.col("docs_before") + F.sum("n_docs").over(inside)).alias("docs_at_most"),
        (F.col("tokens_before") + F.sum("tokens").over(inside)).alias("tokens_at_most"),
        "total_docs",
        "total_tokens",
    )
    docs_at_least = F.col("total_docs") - F.col("docs_at_most") + F.col("n_docs")
    tokens_at_least = F.col("total_tokens") - F.col("tokens_at_most") + F.col("tokens")
    return at_most.select(
        "n_tokens",
        "n_docs",
        docs_at_least.alias("docs_at_least"),
        tokens_at_least.alias("tokens_at_least"),
        "docs_at_most",
        "tokens_at_most",
        (F.col("total_tokens") - tokens_at_least + F.col("n_tokens") * docs_at_least).alias("truncated_tokens"),
        (F.col("docs_at_most") / F.col("total_docs")).alias("quantile"),
        "total_docs",
        "total_tokens",
    )


def token_report(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """`suffix_sums` of the encoded lengths of all rows of `docs`. The histogram is stored, so texts are encoded once."""
    return suffix_sums(materialize(length_histogram(docs, text, path), "lengths"))


def truncated_totals(report: DataFrame, limits: list[int], spark: SparkSession) -> DataFrame:
    """`context_limit`, `truncated_tokens` for each limit: the longest length of the report that is no longer
    than the limit holds the sums; documents beyond it count with the limit. An empty report gives no rows."""
    asked = spark.createDataFrame([(int(x),) for x in limits], "context_limit bigint")
    joined = report.join(F.broadcast(asked), F.col("n_tokens") <= F.col("context_limit"), "right")
    best = joined.groupBy("context_limit").agg(F.max_by(F.struct("tokens_at_most", "docs_at_most"), "n_tokens").alias("at"))
    totals = report.agg(F.max("total_docs").alias("total_docs")).where(F.col("total_docs").isNotNull())
    return best.crossJoin(F.broadcast(totals)).select(  # one row of totals
        "context_limit",
        (F.coalesce("at.tokens_at_most", F.lit(0)) + F.col("context_limit") * (F.col("total_docs") - F.coalesce("at.docs_at_most", F.lit(0)))).alias("truncated_tokens"),
    )
