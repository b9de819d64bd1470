"""Analytics a front end would derive from the dashboard tables (UIA-1 .. UIA-11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.numeric import as_col, count_where, stable_round
from tickloom.operators.ordered import latest_by
from tickloom.streaming.batch import alert_thresholds


def _number(c: str) -> Column:
    return F.coalesce(F.col(c).cast("double"), F.lit(0.0))


def alert_level(volume_ratio: Column | str | None = None) -> Column:
    """UIA-1: the stored level, or one derived from change, volume ratio and type."""
    stored, kind, change = F.upper(F.coalesce("alert_level", F.lit(""))), F.coalesce("alert_type", F.lit("")), _number("change_pct")
    big = F.lit(False) if volume_ratio is None else F.coalesce(as_col(volume_ratio) >= 2, F.lit(False))
    spike = (kind == "volume_spike") | big
    return (
        F.when(stored.isin("HIGH", "MEDIUM", "LOW"), stored)
        .when((change <= -3) & spike, "HIGH")
        .when(spike | (F.abs(change) >= 1.5) | (kind == "model_drift"), "MEDIUM")
        .otherwise("LOW")
    )


def alert_category(c: Column | str = "alert_type") -> Column:
    """UIA-2: model, volume or price."""
    kind = F.coalesce(as_col(c), F.lit(""))
    return F.when(kind.isin("model_drift", "model_signal"), "model").when(kind.isin("volume_spike", "price_and_volume"), "volume").otherwise("price")


def category_counts(alerts: DataFrame) -> DataFrame:
    """UIA-2: numbers on the category tabs, one row."""
    category = alert_category()
    return alerts.agg(
        F.count(F.lit(1)).alias("all"),
        *[F.coalesce(count_where(category == name), F.lit(0)).alias(name) for name in ("price", "volume", "model")],
    )


def alert_evidence(alerts: DataFrame, trend: DataFrame) -> DataFrame:
    """UIA-3: thresholds estimated from the symbol's recent trend, with hit flags and bar ratios (at most 1.4).

    Alerts of symbols without a trend are measured against themselves.
    """
    usual = trend.groupBy("symbol").agg(
        stable_round(F.avg(F.abs("change_pct")), 6).alias("avg_abs_change_pct"),
        stable_round(F.avg("volume"), 6).alias("avg_volume"),
    )
    rows = alerts.join(usual, "symbol", "left").withColumns(
        {
            "avg_abs_change_pct": F.coalesce("avg_abs_change_pct", F.abs(_number("change_pct"))),
            "avg_volume": F.coalesce("avg_volume", _number("volume")),
        }
    )
    bound = alert_thresholds(F.col("avg_abs_change_pct"), F.col("avg_volume"))
    size, volume = F.abs(_number("change_pct")), _number("volume")
    return rows.withColumns(
        {
            "price_bound": stable_round(bound["price"], 4),
            "volume_bound": stable_round(bound["volume"], 2),
            "price_hit": size >= bound["price"],
            "volume_hit": volume >= bound["volume"],
            "price_severe": size >= bound["price_high"],
            "volume_severe": volume >= bound["volume_high"],
            "price_ratio": stable_round(F.least(size / bound["price"], F.lit(1.4)), 6),
            "volume_ratio": stable_round(F.least(volume / bound["volume"], F.lit(1.4)), 6),
        }
    )


def alert_reason() -> Column:
    """UIA-4: why an alert was raised, as a sentence."""
    change = _number("change_pct")
    sign = F.when(change > 0, "+").otherwise("")
    moved = F.concat(F.lit("涨跌幅 "), sign, F.format_string("%.2f", change), F.lit("%"))
    beyond_price = F.format_string(" 超过阈值 %.2f%%", _number("price_threshold"))
    traded = F.concat(F.lit("成交量 "), F.format_number(_number("volume"), 0), F.lit(" 手"))
    beyond_volume = F.concat(F.lit(" 超过阈值 "), F.format_number(_number("volume_threshold"), 0), F.lit(" 手"))
    kind = F.coalesce("alert_type", F.lit(""))
    return (
        F.when(kind == "price_and_volume", F.concat(moved, beyond_price, F.lit("，且"), traded, beyond_volume))
        .when(kind == "price_volatility", F.concat(moved, beyond_price))
        .when(kind == "volume_spike", F.concat(traded, beyond_volume))
        .when(kind.startswith("model_"), "模型类风险信号")
        .otherwise("")
    )


def trend_pivot(trend: DataFrame) -> DataFrame:
    """UIA-5: DSH-17 rows as hour x level, missing levels 0."""
    return trend.groupBy("hour_bucket").pivot("alert_level", ["HIGH", "MEDIUM"]).sum("alert_count").fillna(0, ["HIGH", "MEDIUM"])


def signal_counts(distribution: DataFrame) -> DataFrame:
    """UIA-6: predictions per signal over UP, DOWN and WATCH, missing signals 0, one row."""
    signal = F.upper(F.coalesce("predicted_signal", F.lit("WATCH")))
    return distribution.agg(
        *[F.coalesce(F.sum(F.when(signal == s, F.col("prediction_count"))), F.lit(0)).alias(s) for s in ("UP", "DOWN", "WATCH")]
    )


# Rank of the lists a symbol may come from.
LIST_RANKS = {"latest_ticks": 50, "focus_stocks": 40, "risk_stocks": 35, "optimal_stocks": 30, "ml_predictions": 10}


def symbol_picker(lists: dict[str, DataFrame], limit: int = 100) -> DataFrame:
    """UIA-7: one entry per symbol out of several lists: best list first, readable names preferred."""
    union = None
    for place, (name, rank) in enumerate(LIST_RANKS.items()):
        rows = lists[name].select(
            F.upper(F.trim("symbol")).alias("symbol"),
            F.coalesce("company_name", F.lit("")).alias("company_name"),
            F.lit(name).alias("stock_source"),
            F.lit(rank).alias("rank"),
            F.lit(place).alias("place"),
        )
        union = rows if union is None else union.unionByName(rows)
    readable = (F.trim("company_name") != "") & (F.upper(F.trim("company_name")) != F.col("symbol"))
    scored = union.where("symbol <> ''").withColumns(
        {"score": F.col("rank") + F.when(readable, 20).otherwise(0), "first": -F.col("place")}
    )
    best = latest_by(scored, ["symbol"], ["score", "first", "company_name"])
    return best.orderBy(F.desc("score"), "symbol").limit(limit).select("symbol", "company_name", "stock_source", "score")


def composite_scores(summary: DataFrame, health: DataFrame, quality: DataFrame, metrics: DataFrame) -> DataFrame:
    """UIA-8: trend, flow, technical, risk and overall score of the market, one row.

    `quality` has at most one row, the metric picked by UIA-9; `metrics` are the
    marked rows of the model report (DSH-19). Where several models all look too
    good or abnormal the technical score is held at 70.
    """
    accuracy = metrics.where(F.col("metric_name") == "direction_accuracy").agg(
        F.count(F.lit(1)).alias("models"),
        count_where((F.col("metric_value") >= 0.995) | (F.col("status") == "abnormal")).alias("odd"),
    )
    best = quality.agg(F.max("metric_value").alias("quality"))
    top = F.when((F.col("models") > 1) & (F.col("odd") == F.col("models")), 70.0).otherwise(100.0)
    hundred = F.lit(100.0)
    whole = lambda c: stable_round(c, 0)
    rows = summary.crossJoin(health.select("events_last_minute")).crossJoin(best).crossJoin(accuracy)
    scores = rows.select(
        F.least(hundred, whole(F.abs("avg_change_pct") * 14 + 52)).alias("trend"),
        F.least(hundred, whole(F.col("events_last_minute") / 7)).alias("flow"),
        F.coalesce(F.least(top, whole(F.col("quality") * 100)), F.lit(0.0)).alias("technical"),
        F.least(hundred, whole(F.log10(F.col("alert_count") + 1.0) * 28)).alias("risk"),
    )
    col = F.col
    return scores.withColumn(
        "overall", whole(col("trend") * 0.25 + col("flow") * 0.2 + col("technical") * 0.35 + (100 - col("risk")) * 0.2)
    )


# Metrics by preference, model codes.
CHOSEN_METRICS = [
    "walk_forward_balanced_direction_accuracy", "balanced_direction_accuracy", "direction_macro_f1", "direction_accuracy",
]
MODEL_CODES = {1: "random_forest", 2: "lightgbm", 3: "lstm"}


def quality_metric(metrics: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """UIA-9: per version the metric to show, with its benchmark.

    The chosen model's first metric by preference; without a choice the first
    metric any model has, of its best model. Benchmark: 1/3, or the majority baseline.
    """
    keys = keys or ["model_version"]
    name, value = F.col("metric_name"), F.col("metric_value")
    code = F.max(F.when((F.col("model_name") == "selection") & (name == "best_model_code"), F.round("metric_value")))
    chosen = F.lit(None).cast("string")
    for number, model in MODEL_CODES.items():
        chosen = F.when(F.col("__code") == number, model).otherwise(chosen)
    picks = metrics.groupBy(*keys).agg(code.alias("__code")).select(*keys, chosen.alias("__chosen"))

    place = F.nullif(F.array_position(F.array(*map(F.lit, CHOSEN_METRICS)), name), F.lit(0))
    own = F.col("model_name") == F.col("__chosen")
    rank = F.when(own & place.isNotNull(), place).when(place > 1, place + 10)
    ranked = metrics.join(picks, keys, "left").withColumn("__rank", rank).where(F.col("__rank").isNotNull())
    best = ranked.groupBy(*keys).agg(
        F.min_by(F.struct("model_name", "metric_name", "metric_value"), F.struct("__rank", -value, "model_name")).alias("b")
    ).select(*keys, "b.*")

    baselines = metrics.where(name.isin("majority_baseline_accuracy", "walk_forward_majority_baseline_accuracy")).select(
        *keys, "model_name", F.col("metric_name").alias("__baseline"), F.col("metric_value").alias("__value")
    )
    forward = F.when(name.startswith("walk_forward_"), "walk_forward_majority_baseline_accuracy").otherwise("majority_baseline_accuracy")
    third = name.contains("balanced_direction_accuracy") | name.contains("direction_macro_f1")
    return (
        best.withColumn("__baseline", forward)
        .join(baselines, [*keys, "model_name", "__baseline"], "left")
        .select(
            *keys,
            "model_name",
            "metric_name",
            "metric_value",
            F.when(third, F.lit(1 / 3)).otherwise(F.col("__value")).alias("benchmark"),
            F.when(name.contains("balanced_direction_accuracy"), "balanced")
            .when(name.contains("direction_macro_f1"), "macro")
            .when(F.col("__value").isNotNull(), "accuracy")
            .alias("benchmark_kind"),
        )
    )


def _final_signal() -> Column:
    return F.coalesce(F.nullif("alert_signal", F.lit("")), F.nullif("predicted_signal", F.lit("")), F.lit("WATCH"))


def is_flat_watch() -> Column:
    """UIA-10: a WATCH prediction of almost no movement, made with confidence."""
    return (_final_signal() == "WATCH") & (F.abs(_number("predicted_gap")) <= 0.02) & (_number("confidence") >= 0.95)


def prediction_state() -> dict[str, Column]:
    """UIA-10: text and colour class of a prediction."""
    risk = _number("final_risk_score")
    percent = stable_round(_number("confidence") * 100, 0).cast("int")
    show = lambda c: F.concat(c.cast("string"), F.lit("%"))
    return {
        "state_text": F.when(risk > 0, F.concat(F.lit("风险"), show(stable_round(risk * 100, 0).cast("int"))))
        .when(is_flat_watch(), "低波动")
        .when(percent == 0, "--")
        .otherwise(show(percent)),
        "state_class": F.when(risk > 0, F.when(risk >= 0.55, "r").when(risk >= 0.35, "a").otherwise("g"))
        .when(is_flat_watch(), "a")
        .when(percent == 0, "muted")
        .otherwise(F.when(percent >= 70, "g").when(percent >= 55, "a").otherwise("r")),
    }


def advice() -> Column:
    """UIA-10: cautious, positive, watch or neutral, from signal, change, confidence and alerts."""
    signal, change = F.coalesce("predicted_signal", F.lit("NONE")), _number("change_pct")
    return (
        F.when((_number("high_alert_count") > 0) | (_number("alert_count") >= 8) | (signal == "DOWN") | (change <= -2.0), "cautious")
        .when((signal == "UP") & (_number("confidence") >= 0.60) & (change >= 0) & (_number("alert_count") <= 3), "positive")
        .when(signal == "WATCH", "watch")
        .otherwise("neutral")
    )


def alert_stocks(alerts: DataFrame) -> DataFrame:
    """UIA-11: the newest alert per symbol."""
    rows = alerts.withColumn("symbol", F.upper(F.trim(F.coalesce("symbol", F.lit(""))))).where("symbol <> ''")
    newest = latest_by(rows, ["symbol"], ["created_at", "id"])
    return newest.select("symbol", "company_name", F.coalesce("market", F.lit("")).alias("market"), alert_level().alias("alert_level"))
