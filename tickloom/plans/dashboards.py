"""Registered queries for the dashboard (DSH)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import dashboard as dash
from tickloom.plans import fixtures as fx
from tickloom.plans.oracle import cte, money, rnd, with_ctes
from tickloom.plans.registry import ORACLES, query


def market(spark, d, *parts: str) -> dash.Market:
    """The tables a query asks for."""
    now = fx.as_of(spark, d)
    made = {
        "alerts": lambda: fx.alerts(spark, d, now),
        "actions": lambda: fx.alert_actions(spark, d, now),
        "predictions": lambda: fx.predictions(spark, d),
        "snapshots": lambda: fx.snapshots(spark, d),
        "bars": lambda: fx.bars_raw(spark, d),
        "index_bars": lambda: fx.index_raw(spark, d),
        "metrics": lambda: fx.model_metrics(spark, d),
    }
    return dash.Market(now, fx.ticks(spark, d), **{p: made[p]() for p in parts})


TIME = "strftime({c},'%Y-%m-%d %H:%M:%S') AS {c}"
t = lambda c: TIME.format(c=c)
ABNORMAL = "count(*) FILTER (abs(change_pct)>=2 OR volume>=5000000) AS abnormal_count"


@query("dsh_00_latest_ticks", with_ctes(["latest"], "SELECT symbol, event_id, last_price, source FROM latest"))
def _(spark, d):
    return market(spark, d).latest.select("symbol", "event_id", "last_price", "source")


@query(
    "dsh_01_summary",
    with_ctes(
        ["latest", "alerts", "clock"],
        f"""SELECT count(*) AS symbol_count, count(*) FILTER (change_pct>0) AS up_count, count(*) FILTER (change_pct<0) AS down_count,
        count(*) FILTER (change_pct=0) AS flat_count, {rnd('avg(change_pct)', 2)} AS avg_change_pct, CAST(sum(volume) AS BIGINT) AS total_volume,
        {money('turnover')} AS total_turnover, count(DISTINCT source) AS source_count, strftime(max(event_time),'%Y-%m-%d %H:%M:%S') AS latest_event_time,
        (SELECT count(*) FROM alerts, clock WHERE created_at >= now - INTERVAL 30 MINUTE) AS alert_count,
        (SELECT count(*) FROM alerts, clock WHERE created_at >= now - INTERVAL 30 MINUTE AND alert_level='HIGH') AS alert_high_count,
        (SELECT count(*) FROM alerts, clock WHERE created_at >= now - INTERVAL 30 MINUTE AND alert_level='MEDIUM') AS alert_medium_count FROM latest""",
    ),
)
def _(spark, d):
    return dash.summary(market(spark, d, "alerts"))


@query(
    "dsh_02_trend",
    with_ctes(
        ["snapshots"],
        f"""SELECT window_bucket, max(symbol_count) AS symbol_count, {rnd('avg(avg_price)', 2)} AS avg_price,
        {rnd('avg(avg_change_pct)', 2)} AS avg_change_pct, max(total_volume) AS total_volume FROM snapshots GROUP BY 1 ORDER BY 1 DESC LIMIT 12""",
    ),
)
def _(spark, d):
    return dash.trend(market(spark, d, "snapshots"))


@query(
    "dsh_03_market_overview",
    with_ctes(
        ["latest"],
        f"""SELECT market, count(*) AS symbol_count, count(*) FILTER (change_pct>0) AS up_count, count(*) FILTER (change_pct<0) AS down_count,
        {rnd('avg(change_pct)', 2)} AS avg_change_pct, {money('turnover')} AS turnover FROM latest GROUP BY 1""",
    ),
)
def _(spark, d):
    return dash.market_overview(market(spark, d))


cte(
    "recent",
    """SELECT symbol, count(*) AS alert_count, count(*) FILTER (alert_level='HIGH') AS high_alert_count,
      max(CASE alert_level WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 ELSE 1 END) AS risk
    FROM alerts, clock WHERE created_at >= now - INTERVAL 30 MINUTE GROUP BY 1""",
    ["alerts", "clock"],
)
cte(
    "stocks",
    """SELECT t.*, coalesce(a.alert_count,0) AS alert_count, coalesce(a.high_alert_count,0) AS high_alert_count, coalesce(a.risk,0) AS risk,
      p.current_price, p.predicted_next_price, coalesce(p.predicted_signal,'NONE') AS predicted_signal, coalesce(nullif(p.alert_signal,''),'WATCH') AS alert_signal,
      coalesce(p.confidence,0) AS confidence, coalesce(p.model_risk_score,0) AS model_risk_score, coalesce(p.technical_risk_score,0) AS technical_risk_score,
      coalesce(p.sequence_risk_score,0) AS sequence_risk_score, coalesce(p.final_risk_score,0) AS final_risk_score, p.model_version,
      CAST(round(CAST(coalesce(p.predicted_next_price-p.current_price,0) AS DECIMAL(28,9)),2) AS DOUBLE) AS predicted_gap
    FROM latest t LEFT JOIN recent a ON t.symbol=a.symbol LEFT JOIN predictions p ON t.symbol=p.symbol""",
    ["latest", "recent", "predictions"],
)
STOCK = f"symbol, company_name, market, category, sector, last_price, {rnd('change_pct', 2)} AS change_pct, volume, turnover"
RISKS = "model_risk_score, technical_risk_score, sequence_risk_score, final_risk_score"
LOGV = "log10(greatest(volume,1))"


@query(
    "dsh_04_focus_stocks",
    with_ctes(
        ["stocks"],
        f"""SELECT {STOCK}, alert_count, CASE risk WHEN 3 THEN 'HIGH' WHEN 2 THEN 'MEDIUM' WHEN 1 THEN 'LOW' ELSE 'WATCH' END AS risk_level,
        predicted_signal, alert_signal, confidence, {RISKS}, predicted_gap, attention_score FROM (
        SELECT *, {rnd(f"abs(change_pct)*12+least({LOGV},10)*4+risk*18+final_risk_score*25+CASE WHEN alert_signal IN ('UP','DOWN') THEN 8 ELSE 0 END", 2)} AS attention_score
        FROM stocks s) s ORDER BY attention_score DESC, abs(s.change_pct) DESC, s.volume DESC, symbol LIMIT 12""",
    ),
)
def _(spark, d):
    return dash.focus_stocks(market(spark, d, "alerts", "predictions"))


def ranking_sql(by: str) -> str:
    return with_ctes(
        ["stocks"],
        f"""SELECT {STOCK}, alert_count, high_alert_count, predicted_signal, alert_signal, confidence, {RISKS}, predicted_gap,
        {rnd('h', 2)} AS sector_avg_change_pct, optimal_score, risk_score,
        CASE WHEN s.change_pct>0 THEN '价格动量为正；' ELSE '价格动量偏弱；' END||CASE alert_signal WHEN 'UP' THEN '模型看涨；' WHEN 'DOWN' THEN '模型看跌；' ELSE '模型暂无明显方向；' END
          ||CASE WHEN alert_count>0 THEN '近期存在异常告警；' ELSE '近期告警较少；' END AS reason FROM (
        SELECT *, {rnd(f"50+greatest(change_pct,0)*10+least({LOGV}*3,30)+CASE alert_signal WHEN 'UP' THEN 18 WHEN 'DOWN' THEN -18 ELSE 0 END-final_risk_score*35+greatest(h,0)*6-alert_count*8-high_alert_count*12", 2)} AS optimal_score,
          {rnd(f"abs(change_pct)*12+alert_count*20+high_alert_count*18+least({LOGV}*4,40)+final_risk_score*70", 2)} AS risk_score
        FROM (SELECT *, avg(change_pct) OVER (PARTITION BY sector) AS h FROM stocks)) s ORDER BY {by} DESC, symbol LIMIT 10""",
    )


@query("dsh_05_ranking_optimal", ranking_sql("optimal_score"))
def _(spark, d):
    return dash.stock_ranking(market(spark, d, "alerts", "predictions"), "optimal")


@query("dsh_05_ranking_risk", ranking_sql("risk_score"))
def _(spark, d):
    return dash.stock_ranking(market(spark, d, "alerts", "predictions"), "risk")


@query(
    "dsh_06_sector_heat",
    with_ctes(
        ["latest"],
        f"""SELECT sector, count(*) AS symbol_count, count(*) FILTER (change_pct>0) AS up_count, count(*) FILTER (change_pct<0) AS down_count,
        {rnd('avg(change_pct)', 2)} AS avg_change_pct, {money('turnover')} AS turnover, {ABNORMAL} FROM latest GROUP BY 1""",
    ),
)
def _(spark, d):
    return dash.heat(market(spark, d), "sector")


@query(
    "dsh_07_category_heat",
    with_ctes(
        ["latest"],
        f"""SELECT category, count(*) AS symbol_count, {rnd('avg(change_pct)', 2)} AS avg_change_pct, {money('turnover')} AS turnover, {ABNORMAL} FROM latest GROUP BY 1""",
    ),
)
def _(spark, d):
    return dash.heat(market(spark, d), "category")


cte(
    "alert_rows",
    """SELECT a.*, coalesce(x.status,'OPEN') AS action_status, coalesce(x.note,'') AS action_note, coalesce(x.handled_by,'') AS handled_by, x.handled_at
    FROM alerts a LEFT JOIN actions x ON a.id=x.alert_id""",
    ["alerts", "actions"],
)


def alert_columns(digits: int) -> str:
    return f"""id, symbol, company_name, category, sector, market, last_price, {rnd('change_pct', digits)} AS change_pct, volume, turnover,
    alert_type, alert_level, price_threshold, volume_threshold, strftime(event_time,'%Y-%m-%d %H:%M:%S') AS event_time,
    strftime(created_at,'%Y-%m-%d %H:%M:%S') AS created_at, source, action_status, action_note, handled_by, strftime(handled_at,'%Y-%m-%d %H:%M:%S') AS handled_at"""


@query(
    "dsh_08_latest_alerts",
    with_ctes(["alert_rows"], f"SELECT {alert_columns(4)} FROM alert_rows r ORDER BY r.created_at DESC, id DESC LIMIT 20"),
)
def _(spark, d):
    return dash.latest_alerts(market(spark, d, "alerts", "actions"))


@query(
    "dsh_09_latest_ticks",
    with_ctes(
        ["ticks"],
        f"SELECT symbol, company_name, category, sector, market, last_price, {rnd('change_pct', 2)} AS change_pct, volume, turnover, {t('event_time')}, source FROM ticks k ORDER BY k.created_at DESC, id DESC LIMIT 20",
    ),
)
def _(spark, d):
    return dash.latest_ticks(market(spark, d))


@query(
    "dsh_09_latest_metrics",
    with_ctes(
        ["metrics"],
        "SELECT model_name, metric_name, metric_value, model_version FROM metrics ORDER BY created_at DESC, model_version, model_name, metric_name LIMIT 6",
    ),
)
def _(spark, d):
    return dash.latest_metrics(market(spark, d, "metrics"))


PREDICTION = f"""symbol, company_name, category, sector, current_price, predicted_next_price, {rnd('predicted_next_price-current_price', 2)} AS predicted_gap,
  predicted_signal, coalesce(nullif(alert_signal,''),'WATCH') AS alert_signal, confidence, {RISKS}, model_version, strftime(created_at,'%Y-%m-%d %H:%M:%S') AS created_at"""


@query(
    "dsh_09_latest_predictions",
    with_ctes(["predictions"], f"SELECT {PREDICTION} FROM predictions p ORDER BY p.created_at DESC, id DESC LIMIT 12"),
)
def _(spark, d):
    return dash.latest_predictions(market(spark, d, "predictions"))


def signal_sql(c: str) -> str:
    return with_ctes(
        ["predictions"],
        f"SELECT coalesce(nullif({c},''),'WATCH') AS predicted_signal, count(*) AS prediction_count FROM predictions GROUP BY 1",
    )


@query("dsh_10_signal_distribution", signal_sql("alert_signal"))
def _(spark, d):
    return dash.signal_distribution(market(spark, d, "predictions"))


@query("dsh_10_raw_signal_distribution", signal_sql("p.predicted_signal").replace("FROM predictions GROUP", "FROM predictions p GROUP"))
def _(spark, d):
    return dash.signal_distribution(market(spark, d, "predictions"), "predicted_signal")


@query(
    "dsh_11_daily_freshness",
    with_ctes(
        ["bars_raw", "index_raw", "clock"],
        """SELECT strftime(s,'%Y-%m-%d') AS stock_latest_trade_date, date_diff('day',s,CAST(now AS DATE)) AS stock_age_days, stock_rows, stock_symbols,
        strftime(i,'%Y-%m-%d') AS index_latest_trade_date, date_diff('day',i,CAST(now AS DATE)) AS index_age_days, index_rows, index_symbols,
        CASE WHEN s IS NULL OR i IS NULL THEN 'MISSING' WHEN date_diff('day',s,CAST(now AS DATE))>10 OR date_diff('day',i,CAST(now AS DATE))>10 THEN 'STALE' ELSE 'OK' END AS status
        FROM clock, (SELECT max(trade_date) AS s, count(*) AS stock_rows, count(DISTINCT symbol) AS stock_symbols FROM bars_raw),
        (SELECT max(trade_date) AS i, count(*) AS index_rows, count(DISTINCT symbol) AS index_symbols FROM index_raw)""",
    ),
)
def _(spark, d):
    return dash.daily_freshness(market(spark, d, "bars", "index_bars"))


def search_sql(where: str, limit: int) -> str:
    return with_ctes(
        ["stocks"],
        f"""SELECT {STOCK}, {t('event_time')}, source, alert_count, predicted_signal, alert_signal, confidence, final_risk_score, predicted_gap
        FROM stocks s WHERE {where} ORDER BY abs(s.change_pct) DESC, alert_count DESC, s.turnover DESC, symbol LIMIT {limit}""",
    )


@query("dsh_12_search_stocks", search_sql("symbol ILIKE '%s3%' OR company_name ILIKE '%s3%' OR category ILIKE '%s3%' OR sector ILIKE '%s3%'", 500))
def _(spark, d):
    return dash.search_stocks(market(spark, d, "alerts", "predictions"), " s3 ", 500)


@query("dsh_12_search_all", search_sql("true", 20))
def _(spark, d):
    return dash.search_stocks(market(spark, d, "alerts", "predictions"), "", 0)


NEWEST = "(SELECT symbol FROM ticks ORDER BY created_at DESC, id DESC LIMIT 1)"


def newest_symbol(m: dash.Market) -> str:
    return m.ticks.orderBy(F.desc("created_at"), F.desc("id")).select("symbol").first()[0]


@query(
    "dsh_13_stock_detail",
    with_ctes(
        ["stocks"],
        f"""SELECT {STOCK}, open_price, high_price, low_price, previous_close, {t('event_time')}, source, alert_count, high_alert_count,
        predicted_signal, alert_signal, coalesce(predicted_next_price,0) AS predicted_next_price, confidence, {RISKS}, predicted_gap,
        coalesce(model_version,'') AS model_version, 'OK' AS status FROM stocks WHERE symbol={NEWEST}
        UNION ALL BY NAME SELECT 'NO SUCH CODE' AS symbol, 'NOT_FOUND' AS status""",
    ),
)
def _(spark, d):
    m = market(spark, d, "alerts", "predictions")
    return dash.stock_detail(m, newest_symbol(m)).unionByName(dash.stock_detail(m, "no such code"))


@query(
    "dsh_13_stock_bundle",
    with_ctes(
        ["ticks", "clock", "alert_rows"],
        f"""SELECT 'stock' AS section, 1 AS row_count UNION ALL
        SELECT 'recent_trend', least(300, count(*)) FROM ticks, clock WHERE symbol={NEWEST} AND created_at >= now - INTERVAL 30 MINUTE UNION ALL
        SELECT 'recent_alerts', least(10, count(*)) FROM alert_rows WHERE symbol={NEWEST}""",
    ),
)
def _(spark, d):
    m = market(spark, d, "alerts", "actions", "predictions")
    return dash.reconciliation(dash.stock_bundle(m, newest_symbol(m))).withColumnRenamed("table_name", "section")


@query(
    "dsh_14_stock_trend",
    with_ctes(
        ["ticks", "clock"],
        f"""SELECT {t('event_time')}, {t('created_at')}, open_price, last_price, {rnd('change_pct', 2)} AS change_pct, volume, turnover, source
        FROM (SELECT * FROM ticks, clock WHERE symbol={NEWEST} AND created_at >= now - INTERVAL 5000 MINUTE ORDER BY created_at DESC, event_time DESC, id DESC LIMIT 300)""",
    ),
)
def _(spark, d):
    m = market(spark, d)
    return dash.stock_trend(m, newest_symbol(m), 5000)


@query(
    "dsh_15_candles_from_ticks",
    with_ctes(
        ["ticks"],
        f"""SELECT symbol, strftime(event_time,'%Y-%m-%d') AS day, arg_min(open_price,(event_time,id)) AS open, max(high_price) AS high, min(low_price) AS low,
        arg_max(last_price,(event_time,id)) AS close, arg_min(previous_close,(event_time,id)) AS previous_close,
        {rnd('arg_max(change_pct,(event_time,id))', 4)} AS change_pct, max(volume) AS volume, max(turnover) AS turnover, 'price_ticks_aggregated' AS source
        FROM ticks GROUP BY 1, 2""",
    ),
)
def _(spark, d):
    return dash.candles_from_ticks(fx.ticks(spark, d)).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


TOP_BAR = "(SELECT max(symbol) FROM bars_raw)"


@query(
    "dsh_15_stock_daily",
    with_ctes(
        ["bars_raw"],
        f"""SELECT strftime(trade_date,'%Y-%m-%d') AS trade_date, open_price AS open, high_price AS high, low_price AS low, last_price AS close, previous_close,
        change_pct, volume, turnover, source FROM bars_raw b WHERE symbol={TOP_BAR} ORDER BY b.trade_date DESC LIMIT 120""",
    ),
)
def _(spark, d):
    m = market(spark, d, "bars")
    return dash.stock_daily(m, m.bars.agg(F.max("symbol")).first()[0], 0)


@query(
    "dsh_16_search_alerts",
    with_ctes(
        ["alert_rows"],
        f"""SELECT {alert_columns(2)} FROM alert_rows r WHERE alert_level='HIGH' AND alert_type='price_and_volume' AND action_status='OPEN'
        ORDER BY r.created_at DESC, id DESC LIMIT 1000""",
    ),
)
def _(spark, d):
    return dash.search_alerts(market(spark, d, "alerts", "actions"), "", "high", "price_and_volume", "open", 1000)


@query(
    "dsh_17_alert_trend",
    with_ctes(
        ["alerts", "clock"],
        """SELECT strftime(created_at,'%Y-%m-%d %H:00:00') AS hour_bucket, alert_level, count(*) AS alert_count FROM alerts, clock
        WHERE created_at >= now - INTERVAL 1000 HOUR GROUP BY 1, 2""",
    ),
)
def _(spark, d):
    return dash.alert_trend(market(spark, d, "alerts"), 1000)


@query(
    "dsh_18_alert_types",
    with_ctes(
        ["alerts", "clock"],
        "SELECT alert_type, count(*) AS cnt FROM alerts, clock WHERE created_at >= now - INTERVAL 7 DAY GROUP BY 1",
    ),
)
def _(spark, d):
    return dash.alert_stats(market(spark, d, "alerts"))["type_dist"]


@query(
    "dsh_18_alert_sectors",
    with_ctes(
        ["alerts", "clock"],
        """SELECT sector, count(*) AS cnt, count(*) FILTER (alert_level='HIGH') AS high_cnt FROM alerts, clock
        WHERE created_at >= now - INTERVAL 7 DAY GROUP BY 1 ORDER BY 2 DESC, 3 DESC, 1 LIMIT 10""",
    ),
)
def _(spark, d):
    return dash.alert_stats(market(spark, d, "alerts"))["sector_heat"]


@query(
    "dsh_18_alert_symbols",
    with_ctes(
        ["alerts", "clock"],
        f"""SELECT symbol, company_name, count(*) AS cnt, count(*) FILTER (alert_level='HIGH') AS high_cnt, {rnd('avg(abs(change_pct))', 2)} AS avg_change
        FROM alerts, clock WHERE created_at >= now - INTERVAL 30 DAY GROUP BY 1, 2 ORDER BY 3 DESC, 4 DESC, 1 LIMIT 10""",
    ),
)
def _(spark, d):
    return dash.alert_stats(market(spark, d, "alerts"))["top_symbols"]


# Events and snapshot heartbeats of the last minute.
HEALTH_SOURCE = """SELECT (SELECT count(*) FROM ticks, clock WHERE created_at >= now - INTERVAL 1 MINUTE)
  + (SELECT count(*) FROM snapshots, clock WHERE latest_event_time >= now - INTERVAL 1 MINUTE) AS e"""


def marked_sql(rows: str, keys: str, columns: str) -> str:
    return f"""SELECT {columns}, CASE WHEN odd THEN 'abnormal' ELSE 'normal' END AS status,
      CASE WHEN odd THEN 'Validation data may be insufficient or skewed; metric is for reference only.' END AS warning
    FROM (SELECT *, metric_name='direction_accuracy' AND (metric_value<0.55 OR (metric_value>0.95 AND b>0.8) OR b>0.85 OR f>0.9) AS odd
      FROM (SELECT *, coalesce(max(metric_value) FILTER (metric_name='majority_baseline_accuracy') OVER (PARTITION BY {keys}),0) AS b,
        coalesce(max(metric_value) FILTER (metric_name='validation_flat_ratio') OVER (PARTITION BY {keys}),0) AS f FROM {rows}))"""


@query(
    "dsh_19_model_comparison",
    with_ctes(
        ["metrics"],
        marked_sql(
            "(SELECT * FROM metrics WHERE model_version=(SELECT model_version FROM metrics ORDER BY created_at DESC, model_version DESC LIMIT 1))",
            "model_name",
            "model_name, metric_name, metric_value, model_version, strftime(created_at,'%Y-%m-%d %H:%M:%S') AS created_at",
        )
        + " ORDER BY CASE model_name WHEN 'lstm' THEN 3 WHEN 'lightgbm' THEN 4 ELSE 5 END, model_name, metric_name LIMIT 200",
    ),
)
def _(spark, d):
    return dash.model_comparison(market(spark, d, "metrics"))


@query(
    "dsh_20_abnormal_metrics",
    with_ctes(
        ["metrics"],
        marked_sql("metrics", "model_version, model_name", "model_version, model_name, metric_name, metric_value"),
    ),
)
def _(spark, d):
    rows = fx.model_metrics(spark, d)
    return dash.mark_abnormal(rows, ["model_version", "model_name"]).drop("created_at")


@query(
    "dsh_21_history",
    with_ctes(
        ["ticks", "clock"],
        f"""SELECT row_number() OVER (ORDER BY k.event_time DESC, id DESC) AS seq, symbol, company_name, category, sector, market, last_price,
        {rnd('change_pct', 2)} AS change_pct, volume, turnover, {t('event_time')}, source FROM ticks k, clock WHERE created_at >= now - INTERVAL 100000 MINUTE
        ORDER BY k.event_time DESC, id DESC LIMIT 100000""",
    ),
)
def _(spark, d):
    return dash.history(market(spark, d), "", 100000, 100000)


@query(
    "dsh_22_latest_prediction",
    with_ctes(["predictions", "ticks"], f"SELECT {PREDICTION} FROM predictions WHERE symbol={NEWEST}"),
)
def _(spark, d):
    m = market(spark, d, "predictions")
    return dash.latest_prediction(m, newest_symbol(m))


@query(
    "dsh_23_reconciliation",
    with_ctes(
        ["ticks", "bars_raw", "index_raw"],
        """SELECT 'price_ticks' AS table_name, count(*) AS row_count FROM ticks UNION ALL SELECT 'daily_stock_bars', count(*) FROM bars_raw
        UNION ALL SELECT 'daily_index_bars', count(*) FROM index_raw""",
    ),
)
def _(spark, d):
    return dash.reconciliation(
        {
            "price_ticks": fx.ticks(spark, d),
            "daily_stock_bars": fx.bars_raw(spark, d),
            "daily_index_bars": fx.index_raw(spark, d),
        }
    )


SECTIONS = {
    "stream_status": "str_13_stream_health", "summary": "dsh_01_summary", "trend": "dsh_02_trend", "market_overview": "dsh_03_market_overview",
    "source_status": "str_14_source_status", "focus_stocks": "dsh_04_focus_stocks", "optimal_stocks": "dsh_05_ranking_optimal",
    "risk_stocks": "dsh_05_ranking_risk", "model_comparison": "dsh_19_model_comparison", "daily_data_freshness": "dsh_11_daily_freshness",
    "sector_heat": "dsh_06_sector_heat", "category_heat": "dsh_07_category_heat", "latest_alerts": "dsh_08_latest_alerts",
    "latest_ticks": "dsh_09_latest_ticks", "ml_metrics": "dsh_09_latest_metrics", "signal_distribution": "dsh_10_signal_distribution",
    "raw_signal_distribution": "dsh_10_raw_signal_distribution", "ml_predictions": "dsh_09_latest_predictions",
}


def section_sql(name: str) -> str:
    """The SQL of a home-page section; rankings have 8 places there."""
    sql = ORACLES[SECTIONS[name]]
    return sql.replace("LIMIT 10", "LIMIT 8") if name in ("optimal_stocks", "risk_stocks") else sql


@query("dsh_24_dashboard", " UNION ALL ".join(f"SELECT '{s}' AS section, (SELECT count(*) FROM ({section_sql(s)})) AS row_count" for s in SECTIONS))
def _(spark, d):
    """All home-page sections at once; the result lists each section and its rows."""
    parts = ["alerts", "actions", "predictions", "snapshots", "bars", "index_bars", "metrics"]
    m = market(spark, d, *parts)
    from tickloom.session import materialize

    m.latest = materialize(m.latest, "latest")
    return dash.reconciliation(dash.dashboard(m)).withColumnRenamed("table_name", "section")
