"""Evaluation, quality and drift reports (EVA-1 .. EVA-15)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.decision import (
    DOWN,
    FLAT,
    LABEL_NAMES,
    LABELS,
    MIN_ALERT_RETURN,
    RISK_SCORE_BOUND,
    UP,
    UP_CONFIDENCE,
    actual_signal,
    down_confidence_bound,
    downside_evidence,
)
from tickloom.functions.numeric import any_of, count_where, finite, ratio, stable_round
from tickloom.operators.ordered import exact_median, with_following, with_newest, with_previous

# Guard bounds.
LIFT_FLOOR = -0.02
MIN_DOWN_PRECISION = 0.10


def confusion_counts(
    df: DataFrame, keys: list[str], truth: Column | None = None, pred: Column | None = None
) -> DataFrame:
    """Row count and, per class, actual, predicted and correct rows: one aggregation."""
    y = F.col("y_true") if truth is None else truth
    p = F.col("y_pred") if pred is None else pred
    parts = [F.count(F.lit(1)).cast("double").alias("n")]
    for c in LABELS:
        parts += [
            count_where(y == c).cast("double").alias(f"actual_{c}"),
            count_where(p == c).cast("double").alias(f"predicted_{c}"),
            count_where((y == c) & (p == c)).cast("double").alias(f"correct_{c}"),
        ]
    return df.groupBy(*keys).agg(*parts)


def majority_label() -> Column:
    """Most frequent actual class of a counts row, the lowest code on ties."""
    a0, a1, a2 = (F.col(f"actual_{c}") for c in LABELS)
    return F.when((a0 >= a1) & (a0 >= a2), DOWN).when(a1 >= a2, UP).otherwise(FLAT)


def quality_columns() -> dict[str, Column]:
    """EVA-1 metrics of a counts row."""
    n = F.col("n")
    actual = {c: F.col(f"actual_{c}") for c in LABELS}
    predicted = {c: F.col(f"predicted_{c}") for c in LABELS}
    correct = {c: F.col(f"correct_{c}") for c in LABELS}
    accuracy = ratio(sum(correct.values(), F.lit(0.0)), n)
    baseline = ratio(F.greatest(*actual.values()), n)
    recall = {c: ratio(correct[c], actual[c]) for c in LABELS}
    present = sum((F.when(actual[c] > 0, 1.0).otherwise(0.0) for c in LABELS), F.lit(0.0))
    f1 = sum((ratio(2 * correct[c], actual[c] + predicted[c]) for c in LABELS), F.lit(0.0)) / 3
    out = {
        "direction_accuracy": accuracy,
        "balanced_direction_accuracy": ratio(sum(recall.values(), F.lit(0.0)), present),
        "direction_macro_f1": f1,
        "majority_baseline_accuracy": baseline,
        "direction_lift_over_baseline": accuracy - baseline,
        "validation_samples": n,
        "validation_down_ratio": ratio(actual[DOWN], n),
        "validation_up_ratio": ratio(actual[UP], n),
        "validation_flat_ratio": ratio(actual[FLAT], n),
    }
    for c, name in LABEL_NAMES.items():
        out[f"{name}_recall"] = recall[c]
        out[f"{name}_precision"] = ratio(correct[c], predicted[c])
        out[f"predicted_{name}_ratio"] = ratio(predicted[c], n)
    out["risk_recall"] = out["down_recall"]
    out["risk_precision"] = out["down_precision"]
    out["predicted_risk_ratio"] = out["predicted_down_ratio"]
    return out


def direction_metrics(
    df: DataFrame, keys: list[str], truth: Column | None = None, pred: Column | None = None
) -> DataFrame:
    """EVA-1: direction quality per key over y_true / y_pred."""
    counts = confusion_counts(df, keys, truth, pred)
    return counts.select(*keys, *[c.alias(n) for n, c in quality_columns().items()])


def guarded_metrics(df: DataFrame, keys: list[str], risk: bool = True, keep_risk: bool = True) -> DataFrame:
    """EVA-2: metrics after the baseline guard.

    Below the lift floor the majority class replaces the model, unless (risk
    mode) its DOWN calls are still useful. `keep_risk=False` is the stricter
    guard without that exception. Worked out on the counts, so rows are read once.
    """
    pred = F.col("y_pred")
    if risk and keep_risk:
        pred = F.when(pred == UP, FLAT).otherwise(pred)
    raw = quality_columns()
    useful = (raw["down_recall"] > 0) & (raw["down_precision"] >= MIN_DOWN_PRECISION)
    passes = raw["direction_lift_over_baseline"] >= LIFT_FLOOR
    if risk and keep_risk:
        passes = passes | useful
    counts = confusion_counts(df, keys, pred=pred).select(
        "*",
        F.when(passes, 0.0).otherwise(1.0).alias("guard_used"),
        F.when(passes, -1.0).otherwise(majority_label().cast("double")).alias("guard_label"),
        raw["direction_lift_over_baseline"].alias("raw_lift_over_baseline"),
    )
    replaced = F.col("guard_used") == 1.0
    swap = {}
    for c in LABELS:
        chosen = F.col("guard_label") == c
        swap[f"predicted_{c}"] = F.when(
            replaced, F.when(chosen, F.col("n")).otherwise(0.0)
        ).otherwise(F.col(f"predicted_{c}"))
        swap[f"correct_{c}"] = F.when(
            replaced, F.when(chosen, F.col(f"actual_{c}")).otherwise(0.0)
        ).otherwise(F.col(f"correct_{c}"))
    return counts.withColumns(swap).select(
        *keys,
        *[c.alias(n) for n, c in quality_columns().items()],
        "guard_used",
        "guard_label",
        "raw_lift_over_baseline",
    )


def alert_backtest(
    df: DataFrame,
    keys: list[str],
    movement_threshold: float = 0.02,
    risk: bool = True,
    use_evidence: bool = False,
) -> DataFrame:
    """EVA-3: UP / DOWN calls behind the production gates, scored against next_return."""
    ret, pred = finite(F.col("next_return")), F.col("y_pred")
    conf = finite(F.col("confidence")) if "confidence" in df.columns else F.lit(1.0)
    is_up, is_down = pred == UP, pred == DOWN
    floor = -MIN_ALERT_RETURN if risk else -movement_threshold
    weak = [is_up & (conf < UP_CONFIDENCE), is_down & (conf < down_confidence_bound(risk))]
    if "predicted_return" in df.columns:
        weak.append(is_down & F.coalesce(F.col("predicted_return") > floor, F.lit(False)))
    score, no_evidence = F.lit(0.0), F.lit(False)
    if risk and use_evidence:
        score, kinds = downside_evidence(df.columns)
        no_evidence = is_down & ((score < RISK_SCORE_BOUND) | (kinds < 1))
        weak.append(no_evidence)
    rows = df.select(
        *keys,
        ret.alias("r"),
        conf.alias("c"),
        score.alias("s"),
        (is_up | is_down).alias("raw"),
        any_of(weak).alias("weak"),
        no_evidence.alias("thin"),
        F.when(any_of(weak), FLAT).otherwise(pred).alias("f"),
    )
    up, down = F.col("f") == UP, F.col("f") == DOWN
    up_hit, down_hit = up & (F.col("r") > movement_threshold), down & (F.col("r") < -movement_threshold)
    n, alerts = F.count(F.lit(1)), count_where(up | down)
    ups, downs = count_where(up), count_where(down)
    mean = lambda value, mask: F.coalesce(F.avg(F.when(mask, value)), F.lit(0.0))
    bound = lambda v: F.lit(float(v))
    agg = {
        "samples": n.cast("double"),
        "raw_coverage": ratio(count_where(F.col("raw")), n),
        "coverage": ratio(alerts, n),
        "filtered_ratio": ratio(count_where(F.col("weak")), n),
        "weak_down_evidence_ratio": ratio(count_where(F.col("thin")), n),
        "watch_ratio": ratio(count_where(F.col("f") == FLAT), n),
        "hit_rate": ratio(count_where(up_hit | down_hit), alerts),
        "up_count": ups.cast("double"),
        "down_count": downs.cast("double"),
        "up_hit_rate": ratio(count_where(up_hit), ups),
        "down_hit_rate": ratio(count_where(down_hit), downs),
        "avg_confidence": mean(F.col("c"), up | down),
        "down_avg_risk_score": mean(F.col("s"), down),
        "up_avg_return": mean(F.col("r"), up),
        "down_avg_return": mean(F.col("r"), down),
        "down_avg_inverse_return": mean(-F.col("r"), down),
        "movement_threshold": F.first(bound(movement_threshold)),
    }
    return (
        rows.groupBy(*keys)
        .agg(*[c.alias(f"alert_backtest_{k}") for k, c in agg.items()])
        .withColumns(
            {
                "alert_confidence_threshold": bound(UP_CONFIDENCE),
                "alert_up_confidence_threshold": bound(UP_CONFIDENCE),
                "alert_down_confidence_threshold": bound(down_confidence_bound(risk)),
                "alert_down_risk_score_threshold": bound(RISK_SCORE_BOUND if risk else 0.0),
            }
        )
    )


def metrics_to_long(wide: DataFrame, keys: list[str], prefix: str = "") -> DataFrame:
    """EVA-5: (metric_name, metric_value) rows, with a model prefix removed from the names."""
    values = [c for c in wide.columns if c not in keys]
    typed = wide.select(*keys, *[F.col(c).cast("double").alias(c.removeprefix(prefix)) for c in values])
    names = [c.removeprefix(prefix) for c in values]
    return typed.unpivot(keys, names, "metric_name", "metric_value")


def quality_metrics(report: DataFrame) -> DataFrame:
    """EVA-6: the VAL-17 report as metrics, with the drop ratio."""
    wide = report.withColumn("drop_ratio", ratio(F.col("dropped_rows"), F.col("input_rows")))
    return metrics_to_long(wide.withColumn("model_name", F.lit("training_data")), ["model_name"])


def symbol_quality(df: DataFrame, min_rows: int, bucket: Column, tie: str) -> DataFrame:
    """EVA-7: data quality per symbol, with a warning text."""
    order = ["event_time", tie]
    seen = F.struct(F.col("last_price").alias("price"), F.to_date("event_time").alias("day"))
    staged = with_previous(df, ["symbol"], order, bucket, seen, "__prev")
    col, day = F.col, F.to_date("event_time")
    bad = any_of(
        [
            col("high_price") < col("low_price"),
            col("last_price") > col("high_price"),
            col("last_price") < col("low_price"),
            col("open_price") > col("high_price"),
            col("open_price") < col("low_price"),
        ]
    )
    newest = lambda c: F.coalesce(
        F.max_by(c, F.when(col(c).isNotNull(), F.struct(*order))), F.lit("")
    )
    missing = any_of([col(c).isNull() for c in ("open_price", "high_price", "low_price", "last_price")])
    report = staged.groupBy("symbol").agg(
        newest("company_name").alias("company_name"),
        newest("market").alias("market"),
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.min(day).cast("string"), F.lit("")).alias("start_time"),
        F.coalesce(F.max(day).cast("string"), F.lit("")).alias("end_time"),
        F.coalesce(F.max(F.date_diff(day, F.col("__prev.day"))), F.lit(0)).alias("max_gap_days"),
        count_where(col("last_price") == col("__prev.price")).alias("repeated"),
        count_where(F.coalesce("volume", F.lit(0)) <= 0).alias("zero"),
        count_where(bad).alias("bad_ohlc_rows"),
        count_where(missing).alias("missing_price_rows"),
    )
    repeated, zero = ratio(col("repeated"), col("rows")), ratio(col("zero"), col("rows"))
    warning = F.concat_ws(
        "; ",
        F.when(col("rows") < min_rows, "rows_too_few"),
        F.when(col("max_gap_days") > 14, "large_gap"),
        F.when(col("bad_ohlc_rows") > 0, "bad_ohlc"),
        F.when(col("missing_price_rows") > 0, "missing_price"),
        F.when(repeated > 0.25, "many_repeated_close"),
        F.when(zero > 0.05, "many_zero_volume"),
    )
    return report.select(
        "symbol",
        "company_name",
        "market",
        "rows",
        "start_time",
        "end_time",
        "max_gap_days",
        stable_round(repeated, 4).alias("repeated_close_ratio"),
        stable_round(zero, 4).alias("zero_volume_ratio"),
        "bad_ohlc_rows",
        "missing_price_rows",
        warning.alias("warning"),
    )


def quality_summary(report: DataFrame) -> DataFrame:
    """EVA-8: seven numbers over the symbol report, in long form."""
    num = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    wide = report.agg(
        num(F.count(F.lit(1))).alias("symbol_count"),
        num(count_where(F.col("warning") != "")).alias("warning_symbol_count"),
        num(F.min("rows")).alias("min_rows"),
        num(F.max("rows")).alias("max_rows"),
        num(count_where(F.col("bad_ohlc_rows") > 0)).alias("bad_ohlc_symbols"),
        num(count_where(F.col("missing_price_rows") > 0)).alias("missing_price_symbols"),
    )
    middle = exact_median(report, [], "rows", F.floor(F.col("rows") / 1000), "median_rows")
    both = wide.crossJoin(middle.select(num(F.col("median_rows")).alias("median_rows")))
    return both.unpivot([], both.columns, "metric", "value")


def freshness_gate(tables: dict[str, DataFrame], as_of: datetime, max_age_days: int = 10) -> DataFrame:
    """EVA-9: newest date and age per table; `fresh` is false when too old or empty."""
    result = None
    today = F.to_date(F.lit(as_of))
    for name, df in tables.items():
        row = df.agg(F.max(F.to_date("event_time")).alias("latest")).select(
            F.lit(name).alias("table_name"),
            F.col("latest").cast("string").alias("latest_date"),
            F.date_diff(today, "latest").alias("age_days"),
            F.coalesce(F.date_diff(today, "latest") <= max_age_days, F.lit(False)).alias("fresh"),
        )
        result = row if result is None else result.unionByName(row)
    return result


def assert_fresh(gate: DataFrame, allow_stale: bool = False) -> list[str]:
    """EVA-9: stop on stale tables unless allowed; returns the stale names (one row per table)."""
    stale = [r["table_name"] for r in gate.where(~F.col("fresh")).collect()]
    if stale and not allow_stale:
        raise RuntimeError(f"daily data is stale: {', '.join(sorted(stale))}")
    return stale


def _metric(model: str, metric: str) -> Column:
    hit = (F.col("model_name") == model) & (F.col("metric_name") == metric)
    return F.max(F.when(hit, F.col("metric_value")))


# Production gate of the training run.
GATE_INPUTS = {
    "lightgbm_walk_forward_lift": ("lightgbm", "walk_forward_direction_lift_over_baseline"),
    "lightgbm_walk_forward_down_precision": ("lightgbm", "walk_forward_down_precision"),
    "lightgbm_walk_forward_predicted_down_ratio": ("lightgbm", "walk_forward_predicted_down_ratio"),
    "ensemble_lightgbm_weight": ("ensemble", "lightgbm_weight"),
    "training_data_drop_ratio": ("training_data", "drop_ratio"),
}


def quality_gate(
    metrics: DataFrame,
    min_lift: float = 0.0,
    min_precision: float = 0.55,
    min_coverage: float = 0.03,
    max_coverage: float = 0.35,
    min_weight: float = 0.95,
    max_drop: float = 0.05,
) -> DataFrame:
    """EVA-10: the five production checks per model version; a missing metric fails."""
    wide = metrics.groupBy("model_version").agg(
        *[_metric(*where).alias(name) for name, where in GATE_INPUTS.items()]
    )
    col = F.col
    checks = {
        "lightgbm_lift_ok": col("lightgbm_walk_forward_lift") > min_lift,
        "lightgbm_down_precision_ok": col("lightgbm_walk_forward_down_precision") >= min_precision,
        "lightgbm_down_coverage_ok": col("lightgbm_walk_forward_predicted_down_ratio").between(
            min_coverage, max_coverage
        ),
        "lightgbm_weight_ok": col("ensemble_lightgbm_weight") >= min_weight,
        "training_drop_ratio_ok": col("training_data_drop_ratio") <= max_drop,
    }
    flags = {n: F.when(F.coalesce(c, F.lit(False)), 1.0).otherwise(0.0) for n, c in checks.items()}
    return wide.withColumns(flags).withColumn("passed", F.least(*[col(n) for n in flags]))


def recent_versions(metrics: DataFrame, limit: int = 5) -> DataFrame:
    """EVA-12: newest model versions with their metric counts."""
    return (
        metrics.groupBy("model_version")
        .agg(F.count(F.lit(1)).alias("metric_count"), F.max("created_at").alias("latest_metric_time"))
        .orderBy(F.desc("latest_metric_time"), F.desc("model_version"))
        .limit(limit)
    )


def verify_training(metrics: DataFrame, predictions: DataFrame, version_prefix: str = "") -> DataFrame:
    """EVA-11: gate and prediction summary of the newest version with the prefix, one row."""
    chosen = recent_versions(metrics.where(F.col("model_version").startswith(version_prefix)), 1)
    gate = quality_gate(metrics.join(F.broadcast(chosen.select("model_version")), "model_version", "left_semi"))
    written = metrics.where((F.col("model_name") == "quality_gate") & (F.col("metric_name") == "passed")).select(
        "model_version", F.col("metric_value").alias("__written")
    )
    share = lambda c, v: count_where(F.col(c) == v).alias(
        f"{'raw' if c == 'predicted_signal' else 'alert'}_{v.lower()}"
    )
    summary = predictions.groupBy("model_version").agg(
        F.count(F.lit(1)).alias("rows_count"),
        *[share(c, v) for c in ("predicted_signal", "alert_signal") for v in ("DOWN", "UP", "WATCH")],
        stable_round(F.avg("final_risk_score"), 6).alias("avg_risk"),
        F.max("final_risk_score").alias("max_risk"),
    )
    counts = [c for c in summary.columns if c not in ("model_version", "avg_risk", "max_risk")]
    return (
        gate.join(written, "model_version", "left")
        .withColumn("quality_gate_written", F.col("__written").isNotNull())
        .withColumn("quality_gate_passed", F.coalesce(F.col("__written") >= 1.0, F.lit(False)))
        .withColumn("prediction_version", F.concat(F.lit("ensemble-"), "model_version"))
        .join(
            summary.withColumnRenamed("model_version", "prediction_version"), "prediction_version", "left"
        )
        .fillna(0, counts)
        .fillna(0.0, ["avg_risk", "max_risk"])
        .drop("__written")
    )


def evaluated_predictions(
    history: DataFrame,
    bars: DataFrame,
    horizon: int = 5,
    bound: float = 0.02,
    unit: str = "year",
) -> DataFrame:
    """EVA-13: predictions scored against the h-th later bar of their symbol.

    The base bar is the newest one stored by `predicted_at` with the predicted
    price, else the newest one at all. A bar carries its h-th later bar, and bars and
    predictions of a symbol are one time line, cut into pieces of a `unit` of time, along
    which the newest bar is carried forward, at any price and per price step (prices are
    compared on whole cents): no prediction is joined with bars. Use "year" for daily
    bars and "hour" for ticks.
    """
    rows = bars.select("symbol", "event_time", "created_at", "last_price", F.col("event_id").alias("bar_id"))
    later = F.struct(F.col("event_time").alias("at"), F.col("last_price").alias("price"))
    known = with_following(rows, ["symbol"], ["event_time", "created_at", "bar_id"], F.date_trunc(unit, "event_time"), later, horizon, "later")
    # A bar is visible from created_at on, before predictions of the same moment.
    cents = lambda c: F.round(F.col(c) * 100).cast("long")
    bar = F.struct("event_time", "created_at", "bar_id", "later")
    seen = known.select("symbol", cents("last_price").alias("cents"), F.col("created_at").alias("at"), F.lit(0).alias("kind"), F.col("bar_id").alias("row_id"), bar.alias("bar"))
    asked = history.select(
        "symbol",
        cents("current_price").alias("cents"),
        F.col("predicted_at").alias("at"),
        F.lit(1).alias("kind"),
        F.col("id").alias("row_id"),
        F.lit(None).cast(seen.schema["bar"].dataType).alias("bar"),
        F.struct(*history.columns).alias("asked"),
    )
    line = asked.unionByName(seen, allowMissingColumns=True)
    placed = with_newest(line, "symbol", "cents", ["at", "kind", "row_id"], F.date_trunc(unit, "at"), "bar", ("any_price", "same_price"))
    base = placed.where("kind = 1").select("asked.*", F.coalesce("same_price", "any_price").alias("base")).where("base.later IS NOT NULL")
    scored = base.select(
        *history.columns, F.col("base.event_time").alias("base_event_time"), F.col("base.later.at").alias("actual_event_time"), F.col("base.later.price").alias("actual_price")
    )
    return scored.withColumn("actual_signal", actual_signal("current_price", "actual_price", bound)).withColumn(
        "correct", F.col("actual_signal") == F.col("predicted_signal")
    )


def newest_predictions(history: DataFrame, window: int = 50) -> DataFrame:
    """EVA-13: the newest 4 x window predictions, the ones a drift check looks at."""
    return history.orderBy(F.desc("predicted_at"), F.desc("id")).limit(4 * window)


def drift_report(evaluated: DataFrame, window: int = 50, threshold: float = 0.55) -> DataFrame:
    """EVA-14: accuracy over the newest evaluated predictions and the drift decision, one row."""
    newest = evaluated.orderBy(F.desc("predicted_at"), F.desc("id")).limit(window)
    accuracy = F.avg(F.when(F.col("correct"), 1.0).otherwise(0.0))
    return newest.agg(F.count(F.lit(1)).alias("evaluated"), stable_round(accuracy, 6).alias("accuracy")).select(
        (F.col("evaluated") >= window).alias("ready"),
        "evaluated",
        "accuracy",
        F.lit(threshold).alias("threshold"),
        F.when(F.col("evaluated") >= window, F.col("accuracy") < threshold).alias("drift"),
    )


def drift_rows(report: DataFrame, as_of: datetime, version: str | None = None) -> tuple[DataFrame, DataFrame]:
    """EVA-14: the metric row and, on drift, the alert row to append."""
    ready = report.where("ready")
    name = F.concat(F.lit("window_"), F.col("evaluated").cast("string")) if version is None else F.lit(version)
    metric = ready.select(
        F.lit("drift_monitor").alias("model_name"),
        F.lit("recent_direction_accuracy").alias("metric_name"),
        F.col("accuracy").alias("metric_value"),
        name.alias("model_version"),
        F.lit(as_of).alias("created_at"),
    )
    alert = ready.where("drift").select(
        F.sha2(F.concat_ws("|", F.lit("model_drift"), F.lit(as_of).cast("string")), 256).alias("event_id"),
        F.lit("MODEL_DRIFT").alias("symbol"),
        F.lit("模型漂移监控").alias("company_name"),
        F.lit("System").alias("category"),
        F.lit("Model").alias("sector"),
        F.lit("SYSTEM").alias("market"),
        *[F.lit(0.0).alias(c) for c in ("open_price", "high_price", "low_price", "last_price", "previous_close")],
        stable_round(F.col("accuracy") * 100, 4).alias("change_pct"),
        F.lit(1).cast("long").alias("volume"),
        F.lit(0.0).alias("turnover"),
        F.lit(as_of).alias("event_time"),
        F.lit("model_drift").alias("source"),
        F.lit("model_drift").alias("alert_type"),
        F.lit("HIGH").alias("alert_level"),
    )
    return metric, alert
