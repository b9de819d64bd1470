"""Registered queries for front-end analytics (UIA)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.functions.numeric import stable_round
from tickloom.operators import dashboard as dash, ui_metrics as ui
from tickloom.plans import fixtures as fx
from tickloom.plans.dashboards import HEALTH_SOURCE, marked_sql, market, section_sql
from tickloom.plans.oracle import cte, rnd, with_ctes
from tickloom.plans.registry import query


def mixed_alerts(spark, d) -> DataFrame:
    """Alerts with missing levels and some model alerts."""
    i = F.col("id")
    return fx.alerts(spark, d).withColumns(
        {
            "alert_level": F.when(i % 2 == 0, F.lower("alert_level")),
            "alert_type": F.when(i % 7 == 0, "model_drift").when(i % 7 == 1, "model_signal").otherwise(F.col("alert_type")),
            "ratio": F.when(i % 5 != 0, F.col("volume") / 3e6),
        }
    )


cte(
    "mixed",
    """SELECT * REPLACE (CASE WHEN id%2=0 THEN lower(alert_level) END AS alert_level,
      CASE WHEN id%7=0 THEN 'model_drift' WHEN id%7=1 THEN 'model_signal' ELSE alert_type END AS alert_type),
      CASE WHEN id%5<>0 THEN volume/3e6 END AS ratio FROM alerts""",
    ["alerts"],
)
LEVEL = """CASE WHEN upper(alert_level) IN ('HIGH','MEDIUM','LOW') THEN upper(alert_level)
  WHEN change_pct<=-3 AND (alert_type='volume_spike' OR coalesce({r},0)>=2) THEN 'HIGH'
  WHEN alert_type='volume_spike' OR coalesce({r},0)>=2 OR abs(change_pct)>=1.5 OR alert_type='model_drift' THEN 'MEDIUM' ELSE 'LOW' END"""
CATEGORY = """CASE WHEN alert_type IN ('model_drift','model_signal') THEN 'model' WHEN alert_type IN ('volume_spike','price_and_volume') THEN 'volume' ELSE 'price' END"""


@query("uia_01_alert_level", with_ctes(["mixed"], f"SELECT id, {LEVEL.format(r='ratio')} AS level FROM mixed"))
def _(spark, d):
    return mixed_alerts(spark, d).select("id", ui.alert_level("ratio").alias("level"))


@query("uia_02_alert_category", with_ctes(["mixed"], f"SELECT id, {CATEGORY} AS category FROM mixed"))
def _(spark, d):
    return mixed_alerts(spark, d).select("id", ui.alert_category().alias("category"))


@query(
    "uia_02_category_counts",
    with_ctes(
        ["mixed"],
        f"""SELECT count(*) AS "all", count(*) FILTER (c='price') AS price, count(*) FILTER (c='volume') AS volume,
        count(*) FILTER (c='model') AS model FROM (SELECT {CATEGORY} AS c FROM mixed)""",
    ),
)
def _(spark, d):
    return ui.category_counts(mixed_alerts(spark, d))


@query(
    "uia_03_alert_evidence",
    with_ctes(
        ["alerts", "ticks", "clock"],
        f"""SELECT id, {rnd('p', 4)} AS price_bound, {rnd('v', 2)} AS volume_bound, s>=p AS price_hit, volume>=v AS volume_hit, s>=ph AS price_severe,
        volume>=vh AS volume_severe, {rnd('least(s/p,1.4)', 6)} AS price_ratio, {rnd('least(volume/v,1.4)', 6)} AS volume_ratio FROM (
        SELECT id, volume, abs(change_pct) AS s, greatest(2.0::DOUBLE,m*2.5::DOUBLE) AS p, greatest(4.0::DOUBLE,m*4.0::DOUBLE) AS ph,
          greatest(f,w*2.0::DOUBLE) AS v, greatest(f*2.0::DOUBLE,w*4.0::DOUBLE) AS vh FROM (
         SELECT a.*, coalesce(u.m, abs(change_pct)) AS m, coalesce(u.w, volume) AS w, CASE WHEN market IN ('SH','SZ','BJ') THEN 5000000.0::DOUBLE ELSE 1000000.0::DOUBLE END AS f
         FROM alerts a LEFT JOIN (SELECT symbol, {rnd('avg(abs(change_pct))', 6)} AS m, {rnd('avg(volume)', 6)} AS w FROM ticks, clock
           WHERE created_at >= now - INTERVAL 1440 MINUTE GROUP BY 1) u ON a.symbol=u.symbol))""",
    ),
)
def _(spark, d):
    m = market(spark, d, "alerts")
    return ui.alert_evidence(m.alerts, m.since(m.ticks, minutes=1440)).select(
        "id", "price_bound", "volume_bound", "price_hit", "volume_hit", "price_severe", "volume_severe", "price_ratio", "volume_ratio"
    )


@query(
    "uia_04_alert_reason",
    with_ctes(
        ["mixed"],
        """SELECT id, CASE alert_type WHEN 'price_and_volume' THEN moved||beyond||'，且'||traded WHEN 'price_volatility' THEN moved||beyond
        WHEN 'volume_spike' THEN traded ELSE '模型类风险信号' END AS reason FROM (
        SELECT id, alert_type, '涨跌幅 '||CASE WHEN change_pct>0 THEN '+' ELSE '' END||printf('%.2f',change_pct)||'%' AS moved,
          printf(' 超过阈值 %.2f%%',price_threshold) AS beyond,
          '成交量 '||format('{:,}',volume)||' 手 超过阈值 '||format('{:,}',volume_threshold)||' 手' AS traded FROM mixed)""",
    ),
)
def _(spark, d):
    return mixed_alerts(spark, d).select("id", ui.alert_reason().alias("reason"))


@query(
    "uia_05_alert_trend_pivot",
    with_ctes(
        ["alerts", "clock"],
        """SELECT strftime(created_at,'%Y-%m-%d %H:00:00') AS hour_bucket, count(*) FILTER (alert_level='HIGH') AS HIGH,
        count(*) FILTER (alert_level='MEDIUM') AS MEDIUM FROM alerts, clock WHERE created_at >= now - INTERVAL 168 HOUR GROUP BY 1""",
    ),
)
def _(spark, d):
    return ui.trend_pivot(dash.alert_trend(market(spark, d, "alerts"), 168))


@query(
    "uia_06_signal_counts",
    with_ctes(
        ["predictions"],
        """SELECT count(*) FILTER (s='UP') AS UP, count(*) FILTER (s='DOWN') AS DOWN, count(*) FILTER (s='WATCH') AS WATCH
        FROM (SELECT coalesce(nullif(alert_signal,''),'WATCH') AS s FROM predictions)""",
    ),
)
def _(spark, d):
    return ui.signal_counts(dash.signal_distribution(market(spark, d, "predictions")))


PICKED = " UNION ALL ".join(
    f"SELECT symbol, company_name, '{name}' AS stock_source, {rank} AS rank FROM ({section_sql(name)})" for name, rank in ui.LIST_RANKS.items()
)


@query(
    "uia_07_symbol_picker",
    f"""SELECT symbol, company_name, stock_source, rank+20 AS score FROM ({PICKED})
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY rank DESC)=1 ORDER BY score DESC, symbol LIMIT 100""",
)
def _(spark, d):
    m = market(spark, d, "alerts", "predictions")
    return ui.symbol_picker(
        {
            "latest_ticks": dash.latest_ticks(m),
            "focus_stocks": dash.focus_stocks(m),
            "risk_stocks": dash.stock_ranking(m, "risk", 8),
            "optimal_stocks": dash.stock_ranking(m, "optimal", 8),
            "ml_predictions": dash.latest_predictions(m),
        }
    )


def chosen_metrics(spark, d) -> DataFrame:
    """Model metrics with a chosen model in every second version."""
    rows = fx.model_metrics(spark, d)
    year = F.substring("model_version", 7, 4).cast("int")
    picks = rows.select("model_version", "created_at").distinct().where(year % 2 == 0)
    picked = picks.select(
        "model_version",
        F.lit("selection").alias("model_name"),
        F.lit("best_model_code").alias("metric_name"),
        (year % 3 + 1).cast("double").alias("metric_value"),
        "created_at",
    )
    return rows.unionByName(picked)


cte(
    "shown_metric",
    """SELECT b.*, CASE WHEN contains(metric_name,'balanced_direction_accuracy') OR contains(metric_name,'direction_macro_f1') THEN 1/3.0::DOUBLE ELSE v END AS benchmark,
      CASE WHEN contains(metric_name,'balanced_direction_accuracy') THEN 'balanced' WHEN contains(metric_name,'direction_macro_f1') THEN 'macro' WHEN v IS NOT NULL THEN 'accuracy' END AS benchmark_kind
    FROM (SELECT model_version, model_name, metric_name, metric_value FROM (
      SELECT *, CASE CAST(substr(model_version,7,4) AS INT)%2 WHEN 0 THEN ['random_forest','lightgbm','lstm'][CAST(substr(model_version,7,4) AS INT)%3+1] END AS chosen,
        list_position(['walk_forward_balanced_direction_accuracy','balanced_direction_accuracy','direction_macro_f1','direction_accuracy'], metric_name) AS place FROM metrics)
      WHERE place IS NOT NULL AND (model_name=chosen OR place>1)
      QUALIFY row_number() OVER (PARTITION BY model_version ORDER BY CASE WHEN model_name=chosen THEN place ELSE place+10 END, metric_value DESC, model_name)=1) b
    LEFT JOIN (SELECT model_version AS mv, model_name AS mn, metric_value AS v, metric_name AS bn FROM metrics) x ON x.mv=model_version AND x.mn=model_name
      AND x.bn=CASE WHEN metric_name LIKE 'walk_forward_%' THEN 'walk_forward_majority_baseline_accuracy' ELSE 'majority_baseline_accuracy' END""",
    ["metrics"],
)


@query(
    "uia_09_quality_metric",
    with_ctes(
        ["shown_metric"],
        f"SELECT model_version, model_name, metric_name, metric_value, {rnd('benchmark', 8)} AS benchmark, benchmark_kind FROM shown_metric",
    ),
)
def _(spark, d):
    rows = ui.quality_metric(chosen_metrics(spark, d))
    return rows.withColumn("benchmark", stable_round("benchmark", 8))


@query(
    "uia_08_composite_scores",
    with_ctes(
        ["latest", "alerts", "clock", "snapshots", "ticks", "shown_metric", "metrics"],
        f"""SELECT trend, flow, technical, risk, {rnd('trend*0.25+flow*0.2+technical*0.35+(100-risk)*0.2', 0)} AS overall FROM (
        SELECT least(100.0::DOUBLE,{rnd('abs(c)*14+52', 0)}) AS trend, least(100.0::DOUBLE,{rnd('e/7', 0)}) AS flow,
          coalesce(least(CASE WHEN models>1 AND odd=models THEN 70.0::DOUBLE ELSE 100.0::DOUBLE END,{rnd('q*100', 0)}),0) AS technical,
          least(100.0::DOUBLE,{rnd('log10(n+1)*28', 0)}) AS risk FROM
         (SELECT {rnd('avg(change_pct)', 2)} AS c FROM latest), (SELECT count(*) AS n FROM alerts, clock WHERE created_at >= now - INTERVAL 30 MINUTE),
         ({HEALTH_SOURCE}), (SELECT max(metric_value) AS q FROM shown_metric WHERE model_version=(SELECT max(model_version) FROM metrics)),
         (SELECT count(*) AS models, count(*) FILTER (metric_value>=0.995 OR status='abnormal') AS odd FROM ({marked_sql("(SELECT * FROM metrics WHERE model_version=(SELECT max(model_version) FROM metrics))", "model_name", "metric_name, metric_value")}) WHERE metric_name='direction_accuracy'))""",
    ),
)
def _(spark, d):
    m = market(spark, d, "alerts", "snapshots", "metrics")
    report = dash.model_comparison(m)
    newest = report.select("model_version").distinct()
    shown = ui.quality_metric(chosen_metrics(spark, d)).join(F.broadcast(newest), "model_version", "left_semi")
    return ui.composite_scores(dash.summary(m), dash.stream_health(m), shown, report)


@query(
    "uia_10_prediction_state",
    with_ctes(
        ["predictions", "stocks"],
        """SELECT symbol, state_text, state_class, advice FROM (SELECT symbol,
         CASE WHEN r>0 THEN '风险'||CAST(round(CAST(r*100 AS DECIMAL(28,9)),0) AS INT)||'%' WHEN flat THEN '低波动' WHEN c=0 THEN '--' ELSE c||'%' END AS state_text,
         CASE WHEN r>0 THEN CASE WHEN r>=0.55 THEN 'r' WHEN r>=0.35 THEN 'a' ELSE 'g' END WHEN flat THEN 'a' WHEN c=0 THEN 'muted' WHEN c>=70 THEN 'g' WHEN c>=55 THEN 'a' ELSE 'r' END AS state_class,
         CASE WHEN high_alert_count>0 OR alert_count>=8 OR predicted_signal='DOWN' OR change_pct<=-2 THEN 'cautious'
           WHEN predicted_signal='UP' AND confidence>=0.6 AND change_pct>=0 AND alert_count<=3 THEN 'positive' WHEN predicted_signal='WATCH' THEN 'watch' ELSE 'neutral' END AS advice
        FROM (SELECT *, final_risk_score AS r, CAST(round(CAST(confidence*100 AS DECIMAL(28,9)),0) AS INT) AS c,
          alert_signal='WATCH' AND abs(predicted_gap)<=0.02 AND confidence>=0.95 AS flat FROM
          (SELECT s.* REPLACE (CASE WHEN p.alert_signal='' THEN s.predicted_signal ELSE s.alert_signal END AS alert_signal) FROM stocks s JOIN predictions p USING (symbol))))""",
    ),
)
def _(spark, d):
    m = market(spark, d, "alerts", "predictions")
    gap = F.col("predicted_next_price") - F.col("current_price")
    rows = dash.stocks_now(m).withColumn("predicted_gap", stable_round(gap, 2))
    return rows.withColumns({**ui.prediction_state(), "advice": ui.advice()}).select("symbol", "state_text", "state_class", "advice")


@query(
    "uia_11_alert_stocks",
    with_ctes(
        ["mixed"],
        f"""SELECT symbol, company_name, market, {LEVEL.format(r='NULL')} AS alert_level FROM mixed
        QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY created_at DESC, id DESC)=1""",
    ),
)
def _(spark, d):
    return ui.alert_stocks(mixed_alerts(spark, d))
