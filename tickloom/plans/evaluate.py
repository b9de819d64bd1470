"""Registered queries for evaluation, quality and drift (EVA)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.functions.decision import actual_signal
from tickloom.functions.numeric import stable_round
from tickloom.operators import cleaning, evaluation as ev
from tickloom.operators.models import best_models, ensemble_weights
from tickloom.plans import fixtures as fx
from tickloom.plans.model_sql import BEST_SQL
from tickloom.plans.oracle import ANY_FAULT, FAULT_SQL, QUALITY_SQL, counts_sql, cte, rnd, with_ctes
from tickloom.plans.registry import query

SLICE = ["model_version", "model_name", "slice"]


def rounded(df: DataFrame, keys: list[str], digits: int = 8) -> DataFrame:
    return df.select(*keys, *[stable_round(c, digits).alias(c) for c in df.columns if c not in keys])


@query("eva_01_direction_metrics", with_ctes(["quality"], "SELECT * FROM quality"))
def _(spark, d):
    return rounded(ev.direction_metrics(fx.scored(spark, d), SLICE), SLICE)


def guard_sql(risk: bool) -> str:
    pred = "CASE WHEN y_pred=1 THEN 2 ELSE y_pred END" if risk else "y_pred"
    lift = QUALITY_SQL["direction_lift_over_baseline"]
    keep = f"{lift}>=-0.02"
    if risk:
        keep += f" OR ({QUALITY_SQL['down_recall']}>0 AND {QUALITY_SQL['down_precision']}>=0.1)"
    swap = ", ".join(
        f"CASE WHEN guard_used=1 THEN CASE WHEN guard_label={c} THEN n ELSE 0 END ELSE p{c} END AS p{c}, "
        f"CASE WHEN guard_used=1 THEN CASE WHEN guard_label={c} THEN a{c} ELSE 0 END ELSE c{c} END AS c{c}"
        for c in range(3)
    )
    keys = ", ".join(SLICE)
    counts = counts_sql("scored", keys, f"({pred})")
    return f"""SELECT {keys}, {', '.join(f'{rnd(v, 8)} AS {k}' for k, v in QUALITY_SQL.items())}, guard_used, guard_label, {rnd('raw', 8)} AS raw_lift_over_baseline
     FROM (SELECT * REPLACE ({swap}) FROM (SELECT *, {lift} AS raw, CASE WHEN {keep} THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS guard_used,
       CASE WHEN {keep} THEN -1.0::DOUBLE WHEN a0>=a1 AND a0>=a2 THEN 0.0::DOUBLE WHEN a1>=a2 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS guard_label FROM ({counts})))"""


@query("eva_02_baseline_guard", with_ctes(["scored"], guard_sql(True)))
def _(spark, d):
    return rounded(ev.guarded_metrics(fx.scored(spark, d), SLICE), SLICE)


@query("eva_02_strict_baseline_guard", with_ctes(["scored"], guard_sql(False)))
def _(spark, d):
    return rounded(ev.guarded_metrics(fx.scored(spark, d), SLICE, keep_risk=False), SLICE)


@query("eva_03_alert_backtest", with_ctes(["backtest"], "SELECT * FROM backtest"))
def _(spark, d):
    keys = SLICE[:2]
    rows = fx.scored(spark, d).where(F.col("slice") == "main")
    return rounded(ev.alert_backtest(rows, keys, 0.02), keys)


@query("eva_05_collect_metrics", with_ctes(["metrics"], "SELECT model_version, model_name, metric_name, metric_value FROM metrics"))
def _(spark, d):
    return fx.model_metrics(spark, d).drop("created_at")


REPORT = [
    "input_rows", "output_rows", "dropped_rows", *[f"invalid_{f}_rows" for f in cleaning.FAULTS], "duplicate_rows",
]


@query(
    "eva_06_quality_metrics",
    with_ctes(
        ["bars_raw"],
        f""", report AS (SELECT count(*)::DOUBLE AS input_rows, count(*) FILTER (NOT ({ANY_FAULT}))::DOUBLE AS output_rows,
          count(*) FILTER ({ANY_FAULT})::DOUBLE AS dropped_rows, {', '.join(f'count(*) FILTER ({v})::DOUBLE AS invalid_{k}_rows' for k, v in FAULT_SQL.items())},
          0::DOUBLE AS duplicate_rows, {rnd(f'count(*) FILTER ({ANY_FAULT})/count(*)::DOUBLE', 8)} AS drop_ratio FROM bars_raw)
        SELECT 'training_data' AS model_name, metric_name, metric_value FROM (UNPIVOT report ON COLUMNS(*) INTO NAME metric_name VALUE metric_value)""",
    ).replace(")\n, report", "),\nreport"),
)
def _(spark, d):
    rows = ev.quality_metrics(cleaning.quality_report(fx.bars_raw(spark, d)))
    return rows.withColumn("metric_value", stable_round("metric_value", 8))


BAD = "(high_price<low_price OR last_price>high_price OR last_price<low_price OR open_price>high_price OR open_price<low_price)"
cte(
    "symbol_report",
    f"""SELECT symbol, company_name, market, n AS rows, start_time, end_time, max_gap_days, {rnd('rep/n::DOUBLE', 4)} AS repeated_close_ratio,
      {rnd('zero/n::DOUBLE', 4)} AS zero_volume_ratio, bad_ohlc_rows, missing_price_rows,
      concat_ws('; ', CASE WHEN n<500 THEN 'rows_too_few' END, CASE WHEN max_gap_days>14 THEN 'large_gap' END, CASE WHEN bad_ohlc_rows>0 THEN 'bad_ohlc' END,
        CASE WHEN missing_price_rows>0 THEN 'missing_price' END, CASE WHEN rep/n::DOUBLE>0.25 THEN 'many_repeated_close' END, CASE WHEN zero/n::DOUBLE>0.05 THEN 'many_zero_volume' END) AS warning
    FROM (SELECT symbol, any_value(company_name) AS company_name, any_value(market) AS market, count(*) AS n, strftime(min(event_time),'%Y-%m-%d') AS start_time,
      strftime(max(event_time),'%Y-%m-%d') AS end_time, coalesce(max(gap),0) AS max_gap_days, count(*) FILTER (same) AS rep, count(*) FILTER (volume<=0) AS zero,
      count(*) FILTER ({BAD}) AS bad_ohlc_rows, 0 AS missing_price_rows
     FROM (SELECT *, date_diff('day', lag(trade_date) OVER w, trade_date) AS gap, last_price=lag(last_price) OVER w AS same FROM bars_raw
       WINDOW w AS (PARTITION BY symbol ORDER BY event_time)) GROUP BY symbol)""",
    ["bars_raw"],
)


def symbol_report(spark, d) -> DataFrame:
    return ev.symbol_quality(fx.bars_raw(spark, d), 500, fx.by_year(), "event_id")


@query("eva_07_symbol_quality", with_ctes(["symbol_report"], "SELECT * FROM symbol_report"))
def _(spark, d):
    return symbol_report(spark, d)


@query(
    "eva_08_quality_summary",
    with_ctes(
        ["symbol_report"],
        """, s AS (SELECT count(*)::DOUBLE AS symbol_count, count(*) FILTER (warning<>'')::DOUBLE AS warning_symbol_count, min(rows)::DOUBLE AS min_rows,
          quantile_cont(rows,0.5)::DOUBLE AS median_rows, max(rows)::DOUBLE AS max_rows, count(*) FILTER (bad_ohlc_rows>0)::DOUBLE AS bad_ohlc_symbols,
          count(*) FILTER (missing_price_rows>0)::DOUBLE AS missing_price_symbols FROM symbol_report)
        SELECT metric, value FROM (UNPIVOT s ON COLUMNS(*) INTO NAME metric VALUE value)""",
    ).replace(")\n, s AS", "),\ns AS"),
)
def _(spark, d):
    return ev.quality_summary(symbol_report(spark, d))


@query(
    "eva_09_freshness_gate",
    with_ctes(
        ["bars", "index_raw", "ticks", "clock"],
        " UNION ALL ".join(
            f"""SELECT '{n}' AS table_name, strftime(t,'%Y-%m-%d') AS latest_date, date_diff('day',CAST(t AS DATE),CAST(now AS DATE)) AS age_days,
            date_diff('day',CAST(t AS DATE),CAST(now AS DATE))<=10 AS fresh FROM clock, (SELECT max(event_time) AS t FROM {r})"""
            for n, r in (("daily_stock_bars", "bars"), ("daily_index_bars", "index_raw"), ("price_ticks", "ticks"))
        ),
    ),
)
def _(spark, d):
    tables = {"daily_stock_bars": fx.bars(spark, d), "daily_index_bars": fx.index_raw(spark, d), "price_ticks": fx.ticks(spark, d)}
    return ev.freshness_gate(tables, fx.as_of(spark, d))


def gate_input(spark, d) -> DataFrame:
    """Model metrics with ensemble weights and the drop ratio of the version's year."""
    metrics = fx.model_metrics(spark, d).drop("created_at")
    weights = ensemble_weights(metrics).select(
        "model_version",
        F.lit("ensemble").alias("model_name"),
        F.concat("model_name", F.lit("_weight")).alias("metric_name"),
        stable_round("weight", 8).alias("metric_value"),
    )
    bad = ~F.col("ok")
    years = cleaning.standardise(fx.bars_raw(spark, d)).withColumn("ok", ~ev.any_of(list(cleaning.fault_flags().values())))
    drops = years.groupBy(F.concat(F.lit("daily-"), F.year("event_time").cast("string")).alias("model_version")).agg(
        stable_round(F.avg(F.when(bad, 1.0).otherwise(0.0)), 8).alias("metric_value")
    )
    dropped = drops.select("model_version", F.lit("training_data").alias("model_name"), F.lit("drop_ratio").alias("metric_name"), "metric_value")
    return metrics.unionByName(weights).unionByName(dropped)


cte(
    "gate_rows",
    f"""SELECT model_version, model_name, metric_name, metric_value FROM metrics
    UNION ALL SELECT model_version, 'ensemble', model_name||'_weight', {rnd('weight', 8)} FROM weights
    UNION ALL SELECT 'daily-'||year(event_time), 'training_data', 'drop_ratio', {rnd(f'count(*) FILTER ({ANY_FAULT})/count(*)::DOUBLE', 8)} FROM bars_raw GROUP BY 1""",
    ["metrics", "weights", "bars_raw"],
)
CHECKS = """(coalesce(lightgbm_walk_forward_lift>0,false))::INT::DOUBLE AS lightgbm_lift_ok,
  (coalesce(lightgbm_walk_forward_down_precision>=0.55,false))::INT::DOUBLE AS lightgbm_down_precision_ok,
  (coalesce(lightgbm_walk_forward_predicted_down_ratio BETWEEN 0.03 AND 0.35,false))::INT::DOUBLE AS lightgbm_down_coverage_ok,
  (coalesce(ensemble_lightgbm_weight>=0.95,false))::INT::DOUBLE AS lightgbm_weight_ok, (coalesce(training_data_drop_ratio<=0.05,false))::INT::DOUBLE AS training_drop_ratio_ok"""
cte(
    "gate",
    f"""SELECT *, least(lightgbm_lift_ok,lightgbm_down_precision_ok,lightgbm_down_coverage_ok,lightgbm_weight_ok,training_drop_ratio_ok) AS passed FROM (
     SELECT *, {CHECKS} FROM (SELECT model_version, {', '.join(f"max(metric_value) FILTER (model_name='{m}' AND metric_name='{c}') AS {n}" for n, (m, c) in ev.GATE_INPUTS.items())}
     FROM gate_rows GROUP BY 1))""",
    ["gate_rows"],
)


@query("eva_10_quality_gate", with_ctes(["gate"], "SELECT * FROM gate"))
def _(spark, d):
    return ev.quality_gate(gate_input(spark, d))


def versioned_predictions(spark, d) -> DataFrame:
    """Predictions spread over the ensemble versions by symbol."""
    years = F.concat(F.lit("ensemble-daily-"), (F.lit(1996) + F.col("id") % 7).cast("string"))
    return fx.predictions(spark, d).withColumn("model_version", years)


@query(
    "eva_11_verify_training",
    with_ctes(
        ["gate", "predictions"],
        f"""SELECT g.*, 'ensemble-'||g.model_version AS prediction_version, true AS quality_gate_written, passed>=1 AS quality_gate_passed,
        coalesce(rows_count,0) AS rows_count, coalesce(raw_down,0) AS raw_down, coalesce(raw_up,0) AS raw_up, coalesce(raw_watch,0) AS raw_watch,
        coalesce(alert_down,0) AS alert_down, coalesce(alert_up,0) AS alert_up, coalesce(alert_watch,0) AS alert_watch, coalesce(avg_risk,0) AS avg_risk, coalesce(max_risk,0) AS max_risk
        FROM gate g LEFT JOIN (SELECT 'daily-'||(1996+id%7) AS v, count(*) AS rows_count, count(*) FILTER (predicted_signal='DOWN') AS raw_down,
          count(*) FILTER (predicted_signal='UP') AS raw_up, count(*) FILTER (predicted_signal='WATCH') AS raw_watch, count(*) FILTER (alert_signal='DOWN') AS alert_down,
          count(*) FILTER (alert_signal='UP') AS alert_up, count(*) FILTER (alert_signal='WATCH') AS alert_watch, {rnd('avg(final_risk_score)', 6)} AS avg_risk,
          max(final_risk_score) AS max_risk FROM predictions GROUP BY 1) p ON p.v=g.model_version WHERE g.model_version=(SELECT max(model_version) FROM metrics)""",
    ),
)
def _(spark, d):
    rows = gate_input(spark, d)
    passed = ev.quality_gate(rows).select(
        "model_version", F.lit("quality_gate").alias("model_name"), F.lit("passed").alias("metric_name"), F.col("passed").alias("metric_value")
    )
    moment = F.to_timestamp(F.concat(F.substring("model_version", 7, 4), F.lit("-12-31 18:00:00")))
    return ev.verify_training(rows.unionByName(passed).withColumn("created_at", moment), versioned_predictions(spark, d), "daily-")


@query(
    "eva_12_recent_versions",
    with_ctes(
        ["metrics"],
        "SELECT model_version, count(*) AS metric_count, strftime(max(created_at),'%Y-%m-%d %H:%M:%S') AS latest_metric_time FROM metrics GROUP BY 1 ORDER BY max(created_at) DESC, 1 DESC LIMIT 5",
    ),
)
def _(spark, d):
    rows = ev.recent_versions(fx.model_metrics(spark, d))
    return rows.withColumn("latest_metric_time", F.date_format("latest_metric_time", "yyyy-MM-dd HH:mm:ss"))


cte(
    "numbered",
    "SELECT symbol, event_time, created_at, last_price, row_number() OVER (PARTITION BY symbol ORDER BY event_time) AS pos FROM bars",
    ["bars"],
)
cte(
    "evaluated",
    """SELECT h.*, b.base_event_time, a.event_time AS actual_event_time, a.last_price AS actual_price,
      CASE WHEN a.last_price>h.current_price*1.02::DOUBLE THEN 'UP' WHEN a.last_price<h.current_price*0.98::DOUBLE THEN 'DOWN' ELSE 'WATCH' END AS actual_signal
    FROM history h JOIN (SELECT id, coalesce(max(event_time) OVER same, max(event_time) OVER each_price) AS base_event_time FROM (
        SELECT symbol, round(last_price*100) AS cents, created_at AS moment, 0 AS kind, NULL AS id, event_time FROM numbered
        UNION ALL SELECT symbol, round(current_price*100), predicted_at, 1, id, NULL FROM history)
      WINDOW same AS (PARTITION BY symbol, cents ORDER BY moment, kind), each_price AS (PARTITION BY symbol ORDER BY moment, kind)) b ON h.id=b.id
    JOIN numbered p ON p.symbol=h.symbol AND p.event_time=b.base_event_time JOIN numbered a ON a.symbol=h.symbol AND a.pos=p.pos+5""",
    ["history", "numbered"],
)
EVALUATED = "id, symbol, predicted_signal, strftime(base_event_time,'%Y-%m-%d') AS base_day, strftime(actual_event_time,'%Y-%m-%d') AS actual_day, actual_price, actual_signal, actual_signal=predicted_signal AS correct"


@query("eva_13_evaluated_predictions", with_ctes(["evaluated"], f"SELECT {EVALUATED} FROM evaluated"))
def _(spark, d):
    rows = ev.evaluated_predictions(fx.prediction_history(spark, d), fx.bars(spark, d))
    return rows.select(
        "id", "symbol", "predicted_signal", F.date_format("base_event_time", "yyyy-MM-dd").alias("base_day"),
        F.date_format("actual_event_time", "yyyy-MM-dd").alias("actual_day"), "actual_price", "actual_signal", "correct",
    )


@query(
    "eva_14_drift_report",
    with_ctes(
        ["evaluated"],
        f"""SELECT count(*)>=50 AS ready, count(*) AS evaluated, {rnd('avg(c)', 6)} AS accuracy, 0.55::DOUBLE AS threshold,
        CASE WHEN count(*)>=50 THEN {rnd('avg(c)', 6)}<0.55 END AS drift FROM (SELECT (actual_signal=predicted_signal)::INT AS c FROM evaluated
        WHERE id IN (SELECT id FROM history ORDER BY predicted_at DESC, id DESC LIMIT 200) ORDER BY predicted_at DESC, id DESC LIMIT 50)""",
    ),
)
def _(spark, d):
    newest = ev.newest_predictions(fx.prediction_history(spark, d), 50)
    return ev.drift_report(ev.evaluated_predictions(newest, fx.bars(spark, d)), 50)


DRIFT = """(SELECT avg((actual_signal=predicted_signal)::INT) AS a, count(*) AS n FROM (SELECT * FROM evaluated
    WHERE id IN (SELECT id FROM history ORDER BY predicted_at DESC, id DESC LIMIT 200) ORDER BY predicted_at DESC, id DESC LIMIT 50))"""


@query(
    "eva_14_drift_rows",
    with_ctes(
        ["evaluated"],
        f"""SELECT 'ml_model_metrics' AS table_name, {rnd('a', 6)} AS metric_value FROM {DRIFT} WHERE n>=50
        UNION ALL SELECT 'alert_events', {rnd('a*100', 4)} FROM {DRIFT} WHERE n>=50 AND a<0.55""",
    ),
)
def _(spark, d):
    """The metric and alert rows the drift check appends."""
    newest = ev.newest_predictions(fx.prediction_history(spark, d), 50)
    report = ev.drift_report(ev.evaluated_predictions(newest, fx.bars(spark, d)), 50)
    metric, alert = ev.drift_rows(report, fx.as_of(spark, d))
    one = metric.select(F.lit("ml_model_metrics").alias("table_name"), "metric_value")
    return one.unionByName(alert.select(F.lit("alert_events").alias("table_name"), F.col("change_pct").alias("metric_value")))


@query(
    "eva_15_actual_signal",
    with_ctes(
        ["bars"],
        "SELECT event_id, CASE WHEN last_price>previous_close*1.02::DOUBLE THEN 'UP' WHEN last_price<previous_close*0.98::DOUBLE THEN 'DOWN' ELSE 'WATCH' END AS signal FROM bars",
    ),
)
def _(spark, d):
    return fx.bars(spark, d).select("event_id", actual_signal("previous_close", "last_price").alias("signal"))


@query("mod_15_best_model", with_ctes(["metrics"], BEST_SQL))
def _(spark, d):
    return best_models(fx.model_metrics(spark, d)).withColumn("quality", stable_round("quality", 6))
