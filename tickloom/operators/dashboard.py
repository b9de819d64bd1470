"""Dashboard queries over ticks, bars, alerts, predictions and metrics (DSH, STR-13, STR-14).

`Market` holds the tables and the time `as_of` that stands for "now". Sorted
reports end their order in a unique key, so a limit always picks the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tickloom.functions.numeric import all_of, any_of, count_where, money_sum, stable_round
from tickloom.operators.ordered import latest_by
from tickloom.schema import time_text

TICK_ORDER = ["created_at", "id"]


def bounded(limit: int, default: int) -> int:
    """The limit the caller asks for; the default where none is given."""
    return default if limit <= 0 else limit


def upper_text(symbol: str | None) -> str:
    return (symbol or "").strip().upper()


@dataclass
class Market:
    as_of: datetime
    ticks: DataFrame
    alerts: DataFrame | None = None
    actions: DataFrame | None = None
    predictions: DataFrame | None = None
    snapshots: DataFrame | None = None
    bars: DataFrame | None = None
    index_bars: DataFrame | None = None
    metrics: DataFrame | None = None

    @cached_property
    def latest(self) -> DataFrame:
        """DSH-0: newest tick per symbol."""
        return latest_by(self.ticks, ["symbol"], TICK_ORDER)

    @cached_property
    def latest_predictions(self) -> DataFrame:
        return latest_by(self.predictions, ["symbol"], ["id"])

    def since(self, df: DataFrame, **ago: float) -> DataFrame:
        return df.where(F.col("created_at") >= F.lit(self.as_of - timedelta(**ago)))

    def recent_alerts(self) -> DataFrame:
        """Alerts of the last 30 minutes, counted per symbol."""
        level = F.col("alert_level")
        weight = F.when(level == "HIGH", 3).when(level == "MEDIUM", 2).otherwise(1)
        return (
            self.since(self.alerts, minutes=30)
            .groupBy("symbol")
            .agg(
                F.count(F.lit(1)).alias("alert_count"),
                count_where(level == "HIGH").alias("high_alert_count"),
                F.max(weight).alias("risk"),
            )
        )

    def seconds_since(self, c: Column) -> Column:
        return F.timestamp_diff("SECOND", c, F.lit(self.as_of))


def _ups() -> Column:
    return count_where(F.col("change_pct") > 0)


def _downs() -> Column:
    return count_where(F.col("change_pct") < 0)


def _abnormal() -> Column:
    return count_where((F.abs("change_pct") >= 2) | (F.col("volume") >= 5_000_000))


def _mean_change(digits: int = 2) -> Column:
    return stable_round(F.avg("change_pct"), digits)


def shown_signal(c: str = "alert_signal") -> Column:
    return F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("WATCH"))


def _score(c: str) -> Column:
    return stable_round(F.coalesce(F.col(c), F.lit(0.0)), 4).alias(c)


RISK_SCORES = ["model_risk_score", "technical_risk_score", "sequence_risk_score", "final_risk_score"]


def _gap() -> Column:
    gap = F.col("predicted_next_price") - F.col("current_price")
    return stable_round(F.coalesce(gap, F.lit(0.0)), 2).alias("predicted_gap")


def _prediction_columns() -> list[str]:
    return [
        "symbol", "current_price", "predicted_next_price", "predicted_signal", "alert_signal", "confidence",
        *RISK_SCORES, "model_version",
    ]


# --- Stream and source health --------------------------------------------------------------------


def stream_health(m: Market, strict_replay: bool = False) -> DataFrame:
    """STR-13: event counts of the last minutes, newest times, mode and state of the stream, one row."""
    epoch = F.timestamp_seconds(F.lit(0))
    recent = lambda c, n: count_where(F.col(c) >= F.lit(m.as_of - timedelta(minutes=n)))
    prices = m.ticks.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.coalesce(recent("created_at", 1), F.lit(0)).alias("p1"),
        F.coalesce(recent("created_at", 5), F.lit(0)).alias("p5"),
        F.count_distinct("symbol").alias("total_symbols"),
        F.count_distinct("source").alias("source_count"),
        F.max("event_time").alias("event_at"),
        F.max("created_at").alias("price_at"),
        F.max_by("source", F.struct(*TICK_ORDER)).alias("latest_source"),
    )
    beats = m.snapshots.agg(
        F.coalesce(recent("latest_event_time", 1), F.lit(0)).alias("m1"),
        F.coalesce(recent("latest_event_time", 5), F.lit(0)).alias("m5"),
        F.max("latest_event_time").alias("metric_at"),
    )
    price_at, metric_at = F.coalesce("price_at", epoch), F.coalesce("metric_at", epoch)
    newest = F.greatest(price_at, metric_at)
    within = lambda **ago: newest >= F.lit(m.as_of - timedelta(**ago))
    prefix = "replay_" if strict_replay else "replay"
    return prices.crossJoin(beats).select(
        "total_events",
        (F.col("p1") + F.col("m1")).alias("events_last_minute"),
        (F.col("p5") + F.col("m5")).alias("events_last_5_minutes"),
        "total_symbols",
        "source_count",
        time_text("event_at").alias("latest_event_time"),
        time_text("price_at").alias("latest_price_created_at"),
        time_text("metric_at").alias("latest_metric_created_at"),
        m.seconds_since(newest).alias("seconds_since_last_event"),
        F.when(~within(minutes=10), "OFFLINE")
        .when(F.col("latest_source").startswith(prefix) & (price_at >= metric_at), "REPLAY")
        .when(F.col("price_at").isNotNull() | F.col("metric_at").isNotNull(), "LIVE")
        .otherwise("OFFLINE")
        .alias("current_mode"),
        F.when(within(seconds=30), "FLOWING").when(within(minutes=5), "DELAYED").otherwise("STOPPED").alias("stream_state"),
    )


def source_status(m: Market) -> DataFrame:
    """STR-14: rows, symbols, age and state per source."""
    newest = F.col("newest")
    return (
        m.ticks.groupBy("source")
        .agg(
            F.count(F.lit(1)).alias("success_count"),
            F.count_distinct("symbol").alias("symbol_count"),
            F.max("event_time").alias("event_at"),
            F.max("created_at").alias("newest"),
        )
        .select(
            "source",
            "success_count",
            "symbol_count",
            time_text("event_at").alias("latest_event_time"),
            m.seconds_since(newest).alias("seconds_since_last_event"),
            F.when(newest >= F.lit(m.as_of - timedelta(minutes=10)), "OK")
            .when(newest >= F.lit(m.as_of - timedelta(minutes=60)), "DELAYED")
            .otherwise("OFFLINE")
            .alias("status"),
        )
        .orderBy(F.desc("success_count"), "source")
    )


# --- Overview ------------------------------------------------------------------------------------


def summary(m: Market) -> DataFrame:
    """DSH-1: market summary over the latest ticks with the alerts of 30 minutes, one row."""
    change = F.col("change_pct")
    market = m.latest.agg(
        F.count(F.lit(1)).alias("symbol_count"),
        F.coalesce(_ups(), F.lit(0)).alias("up_count"),
        F.coalesce(_downs(), F.lit(0)).alias("down_count"),
        F.coalesce(count_where(change == 0), F.lit(0)).alias("flat_count"),
        F.coalesce(_mean_change(), F.lit(0.0)).alias("avg_change_pct"),
        F.coalesce(F.sum("volume"), F.lit(0)).alias("total_volume"),
        F.coalesce(money_sum("turnover"), F.lit(0.0)).alias("total_turnover"),
        F.count_distinct("source").alias("source_count"),
        time_text(F.max("event_time")).alias("latest_event_time"),
    )
    level = F.col("alert_level")
    alerts = m.since(m.alerts, minutes=30).agg(
        F.count(F.lit(1)).alias("alert_count"),
        F.coalesce(count_where(level == "HIGH"), F.lit(0)).alias("alert_high_count"),
        F.coalesce(count_where(level == "MEDIUM"), F.lit(0)).alias("alert_medium_count"),
    )
    return market.crossJoin(alerts)


def trend(m: Market, limit: int = 12) -> DataFrame:
    """DSH-2: the newest minutes, partial snapshots merged on reading."""
    return (
        m.snapshots.groupBy("window_bucket")
        .agg(
            F.max("symbol_count").alias("symbol_count"),
            stable_round(F.avg("avg_price"), 2).alias("avg_price"),
            stable_round(F.avg("avg_change_pct"), 2).alias("avg_change_pct"),
            F.max("total_volume").alias("total_volume"),
        )
        .orderBy(F.desc("window_bucket"))
        .limit(limit)
    )


def market_overview(m: Market) -> DataFrame:
    """DSH-3: latest ticks per market, by turnover."""
    return (
        m.latest.groupBy("market")
        .agg(
            F.count(F.lit(1)).alias("symbol_count"),
            _ups().alias("up_count"),
            _downs().alias("down_count"),
            _mean_change().alias("avg_change_pct"),
            money_sum("turnover").alias("turnover"),
        )
        .orderBy(F.desc("turnover"), "market")
    )


def heat(m: Market, dimension: str, limit: int = 10) -> DataFrame:
    """DSH-6 (sector) and DSH-7 (category): abnormal moves per dimension."""
    counts = [F.count(F.lit(1)).alias("symbol_count")]
    if dimension == "sector":
        counts += [_ups().alias("up_count"), _downs().alias("down_count")]
    return (
        m.latest.groupBy(dimension)
        .agg(
            *counts,
            _mean_change().alias("avg_change_pct"),
            money_sum("turnover").alias("turnover"),
            _abnormal().alias("abnormal_count"),
        )
        .orderBy(F.desc("abnormal_count"), F.desc(F.abs("avg_change_pct")), F.desc("turnover"), dimension)
        .limit(limit)
    )


def daily_freshness(m: Market, max_age_days: int = 10) -> DataFrame:
    """DSH-11: newest day, age and size of the two bar tables, one row."""

    def one(df: DataFrame, kind: str) -> DataFrame:
        return df.agg(
            F.max("trade_date").alias(f"{kind}_latest"),
            F.count(F.lit(1)).alias(f"{kind}_rows"),
            F.count_distinct("symbol").alias(f"{kind}_symbols"),
        )

    today = F.to_date(F.lit(m.as_of))
    age = {k: F.date_diff(today, f"{k}_latest") for k in ("stock", "index")}
    missing = any_of([F.col(f"{k}_latest").isNull() for k in age])
    return one(m.bars, "stock").crossJoin(one(m.index_bars, "index")).select(
        *[
            c
            for k in age
            for c in (
                F.date_format(f"{k}_latest", "yyyy-MM-dd").alias(f"{k}_latest_trade_date"),
                age[k].alias(f"{k}_age_days"),
                F.col(f"{k}_rows"),
                F.col(f"{k}_symbols"),
            )
        ],
        F.when(missing, "MISSING").when(any_of([a > max_age_days for a in age.values()]), "STALE").otherwise("OK").alias("status"),
    )


# --- Stocks --------------------------------------------------------------------------------------


def stocks_now(m: Market, latest: DataFrame | None = None) -> DataFrame:
    """Latest ticks with recent alerts and the latest prediction."""
    return (
        (m.latest if latest is None else latest)
        .join(m.recent_alerts(), "symbol", "left")
        .join(m.latest_predictions.select(*_prediction_columns()), "symbol", "left")
        .withColumns({c: F.coalesce(c, F.lit(0)) for c in ("alert_count", "high_alert_count", "risk")})
        .withColumns({"shown": shown_signal(), "risk_now": F.coalesce("final_risk_score", F.lit(0.0))})
    )


def _stock_columns() -> list[Column]:
    return [
        *map(F.col, ["symbol", "company_name", "market", "category", "sector"]),
        stable_round("last_price", 2).alias("last_price"),
        stable_round("change_pct", 2).alias("change_pct"),
        F.col("volume"),
        stable_round("turnover", 2).alias("turnover"),
    ]


def _signal_columns() -> list[Column]:
    return [
        F.coalesce("predicted_signal", F.lit("NONE")).alias("predicted_signal"),
        F.col("shown").alias("alert_signal"),
        _score("confidence"),
    ]


def _log_volume() -> Column:
    return F.log10(F.greatest(F.col("volume"), F.lit(1)).cast("double"))


def focus_stocks(m: Market, limit: int = 12) -> DataFrame:
    """DSH-4: stocks by attention score."""
    risk = F.col("risk")
    attention = (
        F.abs("change_pct") * 12
        + F.least(_log_volume(), F.lit(10.0)) * 4
        + risk * 18
        + F.col("risk_now") * 25
        + F.when(F.col("shown").isin("UP", "DOWN"), 8).otherwise(0)
    )
    scored = stocks_now(m).withColumn("attention_score", stable_round(attention, 2))
    return (
        scored.orderBy(F.desc("attention_score"), F.desc(F.abs("change_pct")), F.desc("volume"), "symbol")
        .limit(limit)
        .select(
            *_stock_columns(),
            "alert_count",
            F.when(risk == 3, "HIGH").when(risk == 2, "MEDIUM").when(risk == 1, "LOW").otherwise("WATCH").alias("risk_level"),
            *_signal_columns(),
            *[_score(c) for c in RISK_SCORES],
            _gap(),
            "attention_score",
        )
    )


def stock_ranking(m: Market, kind: str = "optimal", limit: int = 10) -> DataFrame:
    """DSH-5: stocks by `optimal` or `risk` score, with a reason."""
    sector = m.latest.groupBy("sector").agg(F.avg("change_pct").alias("sector_mean"))
    rows = stocks_now(m).join(sector, "sector", "left")
    change, shown = F.col("change_pct"), F.col("shown")
    mean = F.coalesce("sector_mean", F.lit(0.0))
    alerts, high, risk = F.col("alert_count"), F.col("high_alert_count"), F.col("risk_now")
    zero = F.lit(0.0)
    optimal = (
        50
        + F.greatest(change, zero) * 10
        + F.least(_log_volume() * 3, F.lit(30.0))
        + F.when(shown == "UP", 18).when(shown == "DOWN", -18).otherwise(0)
        - risk * 35
        + F.greatest(mean, zero) * 6
        - alerts * 8
        - high * 12
    )
    danger = F.abs(change) * 12 + alerts * 20 + high * 18 + F.least(_log_volume() * 4, F.lit(40.0)) + risk * 70
    reason = F.concat(
        F.when(change > 0, "价格动量为正；").otherwise("价格动量偏弱；"),
        F.when(shown == "UP", "模型看涨；").when(shown == "DOWN", "模型看跌；").otherwise("模型暂无明显方向；"),
        F.when(alerts > 0, "近期存在异常告警；").otherwise("近期告警较少；"),
    )
    by = "risk_score" if kind.lower() == "risk" else "optimal_score"
    return (
        rows.withColumns({"optimal_score": stable_round(optimal, 2), "risk_score": stable_round(danger, 2), "reason": reason})
        .orderBy(F.desc(by), "symbol")
        .limit(bounded(limit, 10))
        .select(
            *_stock_columns(),
            "alert_count",
            "high_alert_count",
            *_signal_columns(),
            *[_score(c) for c in RISK_SCORES],
            _gap(),
            stable_round(mean, 2).alias("sector_avg_change_pct"),
            "optimal_score",
            "risk_score",
            "reason",
        )
    )


def search_stocks(m: Market, keyword: str = "", limit: int = 20) -> DataFrame:
    """DSH-12: stocks whose code, name, category or sector contains the keyword, whatever its case."""
    word = keyword.strip()
    rows = m.latest
    if word:
        rows = rows.where(any_of([F.col(c).ilike(f"%{word}%") for c in ("symbol", "company_name", "category", "sector")]))
    return (
        stocks_now(m, rows)
        .orderBy(F.desc(F.abs("change_pct")), F.desc("alert_count"), F.desc("turnover"), "symbol")
        .limit(bounded(limit, 20))
        .select(
            *_stock_columns(),
            time_text("event_time").alias("event_time"),
            "source",
            "alert_count",
            *_signal_columns(),
            _score("final_risk_score"),
            _gap(),
        )
    )


def stock_detail(m: Market, symbol: str) -> DataFrame:
    """DSH-13: one symbol's newest state; a NOT_FOUND row where there is none."""
    wanted = upper_text(symbol)
    one = Market(
        m.as_of,
        m.ticks.where(F.col("symbol") == wanted),
        alerts=m.alerts.where(F.col("symbol") == wanted),
        predictions=m.predictions.where(F.col("symbol") == wanted),
    )
    prices = ["open_price", "high_price", "low_price", "previous_close"]
    found = stocks_now(one).select(
        *_stock_columns(),
        *[stable_round(c, 2).alias(c) for c in prices],
        time_text("event_time").alias("event_time"),
        "source",
        "alert_count",
        "high_alert_count",
        *_signal_columns(),
        stable_round(F.coalesce("predicted_next_price", F.lit(0.0)), 2).alias("predicted_next_price"),
        *[_score(c) for c in RISK_SCORES],
        _gap(),
        F.coalesce("model_version", F.lit("")).alias("model_version"),
    )
    asked = m.ticks.sparkSession.range(1).select(F.lit(wanted).alias("symbol"))
    return asked.join(found, "symbol", "left").withColumn(
        "status", F.when(F.col("last_price").isNull(), "NOT_FOUND").otherwise("OK")
    )


def stock_bundle(m: Market, symbol: str) -> dict[str, DataFrame]:
    """DSH-13: a symbol's newest state with its trend of 30 minutes and its ten newest alerts."""
    return {"stock": stock_detail(m, symbol), "recent_trend": stock_trend(m, symbol, 30), "recent_alerts": search_alerts(m, symbol, limit=10)}


def stock_trend(m: Market, symbol: str, minutes: int = 30, limit: int = 300) -> DataFrame:
    """DSH-14: a symbol's newest ticks in the window, oldest first."""
    rows = m.since(m.ticks.where(F.col("symbol") == upper_text(symbol)), minutes=bounded(minutes, 30))
    return (
        rows.orderBy(F.desc("created_at"), F.desc("event_time"), F.desc("id"))
        .limit(limit)
        .orderBy("event_time", "id")
        .select(
            time_text("event_time").alias("event_time"),
            time_text("created_at").alias("created_at"),
            *[stable_round(c, 2).alias(c) for c in ("open_price", "last_price", "change_pct")],
            "volume",
            stable_round("turnover", 2).alias("turnover"),
            "source",
        )
    )


def candles_from_ticks(ticks: DataFrame) -> DataFrame:
    """DSH-15: daily candles per symbol out of ticks; one aggregation, nothing is sorted or listed."""
    at = F.struct("event_time", "id")
    return ticks.groupBy("symbol", F.to_date("event_time").alias("day")).agg(
        stable_round(F.min_by("open_price", at), 2).alias("open"),
        stable_round(F.max("high_price"), 2).alias("high"),
        stable_round(F.min("low_price"), 2).alias("low"),
        stable_round(F.max_by("last_price", at), 2).alias("close"),
        stable_round(F.min_by("previous_close", at), 2).alias("previous_close"),
        stable_round(F.max_by("change_pct", at), 4).alias("change_pct"),
        F.max("volume").alias("volume"),
        stable_round(F.max("turnover"), 2).alias("turnover"),
        F.lit("price_ticks_aggregated").alias("source"),
    )


def stock_daily(m: Market, symbol: str, days: int = 120) -> DataFrame:
    """DSH-15: a symbol's newest daily candles, from bars or else from ticks, oldest first."""
    wanted, n = upper_text(symbol), bounded(days, 120)
    bars = (
        m.bars.where(F.col("symbol") == wanted)
        .orderBy(F.desc("trade_date"), F.desc("event_id"))
        .limit(n)
        .select(
            "symbol",
            F.col("trade_date").alias("day"),
            stable_round("open_price", 2).alias("open"),
            stable_round("high_price", 2).alias("high"),
            stable_round("low_price", 2).alias("low"),
            stable_round("last_price", 2).alias("close"),
            stable_round("previous_close", 2).alias("previous_close"),
            stable_round("change_pct", 4).alias("change_pct"),
            "volume",
            stable_round("turnover", 2).alias("turnover"),
            "source",
        )
    )
    rows = bars
    if bars.isEmpty():
        rows = candles_from_ticks(m.ticks.where(F.col("symbol") == wanted)).orderBy(F.desc("day")).limit(n)
    return rows.orderBy("day").select(F.date_format("day", "yyyy-MM-dd").alias("trade_date"), *rows.columns[2:])


def history(m: Market, symbol: str = "", minutes: int = 30, limit: int = 200) -> DataFrame:
    """DSH-21: newest ticks of a window, numbered newest first."""
    rows = m.since(m.ticks, minutes=bounded(minutes, 30))
    if symbol and symbol.strip():
        rows = rows.where(F.col("symbol") == upper_text(symbol))
    newest = [F.desc("event_time"), F.desc("id")]
    return (
        rows.orderBy(*newest)
        .limit(bounded(limit, 200))
        .select(
            F.row_number().over(W.orderBy(*newest)).alias("seq"),
            "symbol",
            "company_name",
            "category",
            "sector",
            "market",
            stable_round("last_price", 2).alias("last_price"),
            stable_round("change_pct", 2).alias("change_pct"),
            "volume",
            stable_round("turnover", 2).alias("turnover"),
            time_text("event_time").alias("event_time"),
            "source",
        )
    )


# --- Alerts --------------------------------------------------------------------------------------


def _alert_rows(m: Market) -> DataFrame:
    actions = m.actions.withColumnRenamed("alert_id", "id")
    return m.alerts.join(actions, "id", "left").withColumn("action_status", F.coalesce("status", F.lit("OPEN")))


def _alert_columns(change_digits: int) -> list[Column | str]:
    return [
        "id", "symbol", "company_name", "category", "sector", "market",
        stable_round("last_price", 2).alias("last_price"),
        stable_round("change_pct", change_digits).alias("change_pct"),
        "volume",
        stable_round("turnover", 2).alias("turnover"),
        "alert_type", "alert_level",
        stable_round("price_threshold", 2).alias("price_threshold"),
        "volume_threshold",
        time_text("event_time").alias("event_time"),
        time_text("created_at").alias("created_at"),
        "source", "action_status",
        F.coalesce("note", F.lit("")).alias("action_note"),
        F.coalesce("handled_by", F.lit("")).alias("handled_by"),
        time_text("handled_at").alias("handled_at"),
    ]


def latest_alerts(m: Market, limit: int = 20) -> DataFrame:
    """DSH-8: newest alerts with their handling state."""
    newest = m.alerts.orderBy(F.desc("created_at"), F.desc("id")).limit(limit)
    few = Market(m.as_of, m.ticks, alerts=newest, actions=m.actions)
    return _alert_rows(few).orderBy(F.desc("created_at"), F.desc("id")).select(*_alert_columns(4))


def search_alerts(
    m: Market, symbol: str = "", level: str = "", kind: str = "", status: str = "", limit: int = 20
) -> DataFrame:
    """DSH-16: newest alerts under optional filters."""
    tests = [F.lit(True)]
    if symbol.strip():
        tests.append(F.col("symbol") == upper_text(symbol))
    if level.strip():
        tests.append(F.col("alert_level") == upper_text(level))
    if kind.strip():
        tests.append(F.col("alert_type") == kind.strip())
    if status.strip():
        tests.append(F.col("action_status") == upper_text(status))
    return (
        _alert_rows(m)
        .where(all_of(tests))
        .orderBy(F.desc("created_at"), F.desc("id"))
        .limit(bounded(limit, 20))
        .select(*_alert_columns(2))
    )


def alert_trend(m: Market, hours: int = 24) -> DataFrame:
    """DSH-17: alerts per hour and level over the last hours, one at least."""
    return (
        m.since(m.alerts, hours=max(hours, 1))
        .groupBy(F.date_format("created_at", "yyyy-MM-dd HH:00:00").alias("hour_bucket"), "alert_level")
        .agg(F.count(F.lit(1)).alias("alert_count"))
        .orderBy("hour_bucket", "alert_level")
    )


def alert_stats(m: Market) -> dict[str, DataFrame]:
    """DSH-18: alert types and sectors of 7 days, most frequent symbols of 30 days."""
    n, high = F.count(F.lit(1)).alias("cnt"), count_where(F.col("alert_level") == "HIGH").alias("high_cnt")
    week = m.since(m.alerts, days=7)
    sector = F.coalesce(F.nullif(F.col("sector"), F.lit("")), F.lit("未分类")).alias("sector")
    top = [F.desc("cnt"), F.desc("high_cnt")]
    return {
        "type_dist": week.groupBy("alert_type").agg(n).orderBy(F.desc("cnt"), "alert_type"),
        "sector_heat": week.groupBy(sector).agg(n, high).orderBy(*top, "sector").limit(10),
        "top_symbols": m.since(m.alerts, days=30)
        .groupBy("symbol", "company_name")
        .agg(n, high, stable_round(F.avg(F.abs("change_pct")), 2).alias("avg_change"))
        .orderBy(*top, "symbol")
        .limit(10),
    }


# --- Models --------------------------------------------------------------------------------------


def latest_ticks(m: Market, limit: int = 20) -> DataFrame:
    """DSH-9: newest ticks."""
    return (
        m.ticks.orderBy(F.desc("created_at"), F.desc("id"))
        .limit(limit)
        .select(
            "symbol", "company_name", "category", "sector", "market",
            stable_round("last_price", 2).alias("last_price"),
            stable_round("change_pct", 2).alias("change_pct"),
            "volume",
            stable_round("turnover", 2).alias("turnover"),
            time_text("event_time").alias("event_time"),
            "source",
        )
    )


METRIC_ORDER = ["model_version", "model_name", "metric_name"]


def latest_metrics(m: Market, limit: int = 6) -> DataFrame:
    """DSH-9: newest model metrics."""
    return (
        m.metrics.orderBy(F.desc("created_at"), *METRIC_ORDER)
        .limit(limit)
        .select("model_name", "metric_name", "metric_value", "model_version")
    )


def _shown_prediction() -> list[Column | str]:
    return [
        "symbol", "company_name", "category", "sector",
        stable_round("current_price", 2).alias("current_price"),
        stable_round("predicted_next_price", 2).alias("predicted_next_price"),
        _gap(),
        "predicted_signal",
        shown_signal().alias("alert_signal"),
        _score("confidence"),
        *[_score(c) for c in RISK_SCORES],
        "model_version",
        time_text("created_at").alias("created_at"),
    ]


def latest_predictions(m: Market, limit: int = 12) -> DataFrame:
    """DSH-9: newest predictions."""
    return m.predictions.orderBy(F.desc("created_at"), F.desc("id")).limit(limit).select(*_shown_prediction())


def latest_prediction(m: Market, symbol: str) -> DataFrame:
    """DSH-22: a symbol's newest prediction."""
    rows = m.predictions.where(F.col("symbol") == upper_text(symbol))
    return rows.orderBy(F.desc("created_at"), F.desc("id")).limit(1).select(*_shown_prediction())


def signal_distribution(m: Market, column: str = "alert_signal") -> DataFrame:
    """DSH-10: predictions per signal; `predicted_signal` gives the raw distribution."""
    return (
        m.predictions.groupBy(shown_signal(column).alias("predicted_signal"))
        .agg(F.count(F.lit(1)).alias("prediction_count"))
        .orderBy(F.desc("prediction_count"), "predicted_signal")
    )


# Order of the model report.
MODEL_ORDER = ["selection", "ensemble", "lstm", "lightgbm", "random_forest"]


def mark_abnormal(metrics: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """DSH-20: accuracy rows marked abnormal from their model's baseline and flat share.

    The model's own metrics are gathered by one aggregation and joined back, so
    a model with many rows is no single task.
    """
    keys = keys or ["model_name"]
    of = lambda name: F.max(F.when(F.col("metric_name") == name, F.col("metric_value")))
    facts = metrics.groupBy(*keys).agg(
        of("majority_baseline_accuracy").alias("__base"), of("validation_flat_ratio").alias("__flat")
    )
    value, base, flat = F.col("metric_value"), F.coalesce("__base", F.lit(0.0)), F.coalesce("__flat", F.lit(0.0))
    odd = (value < 0.55) | ((value > 0.95) & (base > 0.80)) | (base > 0.85) | (flat > 0.90)
    is_odd = (F.col("metric_name") == "direction_accuracy") & odd
    return (
        metrics.join(facts, keys)
        .withColumn("status", F.when(is_odd, "abnormal").otherwise("normal"))
        .withColumn(
            "warning",
            F.when(is_odd, "Validation data may be insufficient or skewed; metric is for reference only."),
        )
        .drop("__base", "__flat")
    )


def model_comparison(m: Market, limit: int = 200) -> DataFrame:
    """DSH-19: metrics of the newest model version (drift rows do not name it), marked by DSH-20."""
    newest = (
        m.metrics.where(F.col("model_name") != "drift_monitor")
        .orderBy(F.desc("created_at"), F.desc("model_version"))
        .limit(1)
        .select("model_version")
    )
    place = F.coalesce(
        F.nullif(F.array_position(F.array(*map(F.lit, MODEL_ORDER)), F.col("model_name")), F.lit(0)), F.lit(99)
    )
    rows = (
        m.metrics.join(F.broadcast(newest), "model_version", "left_semi")
        .select("model_name", "metric_name", "metric_value", "model_version", time_text("created_at").alias("created_at"))
    )
    return mark_abnormal(rows).orderBy(place, "model_name", "metric_name").limit(limit)


def reconciliation(tables: dict[str, DataFrame]) -> DataFrame:
    """DSH-23: row counts of several tables."""
    result = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        result = row if result is None else result.unionByName(row)
    return result


def dashboard(m: Market) -> dict[str, DataFrame]:
    """DSH-24: all sections of the home page over one `latest` table."""
    return {
        "stream_status": stream_health(m),
        "summary": summary(m),
        "trend": trend(m),
        "market_overview": market_overview(m),
        "source_status": source_status(m),
        "focus_stocks": focus_stocks(m),
        "optimal_stocks": stock_ranking(m, "optimal", 8),
        "risk_stocks": stock_ranking(m, "risk", 8),
        "model_comparison": model_comparison(m),
        "daily_data_freshness": daily_freshness(m),
        "sector_heat": heat(m, "sector"),
        "category_heat": heat(m, "category"),
        "latest_alerts": latest_alerts(m),
        "latest_ticks": latest_ticks(m),
        "ml_metrics": latest_metrics(m),
        "signal_distribution": signal_distribution(m),
        "raw_signal_distribution": signal_distribution(m, "predicted_signal"),
        "ml_predictions": latest_predictions(m),
    }
