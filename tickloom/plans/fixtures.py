"""Quote, bar, alert, prediction and metric tables derived from the given tables.

Every registered query starts from these views, so its work grows with `events`
and `lineitem`. The same views are written as SQL in `oracle.py`.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.functions.decision import display_confidence
from tickloom.functions.numeric import stable_round
from tickloom.functions.quotes import change_pct, passes_stream_filter
from tickloom.operators.cleaning import clean_bars
from tickloom.operators.evaluation import (
    alert_backtest,
    direction_metrics,
    metrics_to_long,
)
from tickloom.operators.ordered import computed_once, latest_by, with_position, with_previous
from tickloom.session import materialize
from tickloom.streaming.batch import build_alerts, history_baseline, minute_snapshot

TICK_ORDER = ["created_at", "id"]


def by_hour() -> Column:
    return F.date_trunc("hour", F.col("event_time"))


def by_year() -> Column:
    return F.year("event_time")


_STORED: dict[tuple[str, str, str], DataFrame] = {}


def stored(spark: SparkSession, d: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A derived table, written once per session and folder, as the daily tables are in production."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _STORED:
        _STORED[key] = materialize(build(), name)
    return _STORED[key]


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def ticks_from_events(events: DataFrame) -> DataFrame:
    """Quote ticks out of the `events` rows; stateless, so it also runs on a stream."""
    user, k = F.col("user_id"), F.col("k")
    parsed = computed_once(
        events.select(
            "event_id",
            "user_id",
            "event_type",
            F.get_json_object("props", "$.k").cast("int").alias("k"),
            stable_round("value", 2).alias("previous_close"),
            F.col("ts").cast("timestamp").alias("event_time"),
        )
    )
    moved = stable_round((k - 50) * 0.24, 4)
    last = stable_round(F.col("previous_close") * (1 + F.col("change_pct") / 100), 2)
    priced = computed_once(parsed.withColumn("change_pct", moved).withColumn("last_price", last))
    return priced.select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("event_id"),
        "user_id",
        F.concat(F.lit("U"), F.lpad(user.cast("string"), 5, "0")).alias("symbol"),
        F.concat(F.lit("User "), user.cast("string")).alias("company_name"),
        F.concat(F.lit("C"), (user % 5).cast("string")).alias("category"),
        F.concat(F.lit("S"), (user % 7).cast("string")).alias("sector"),
        F.element_at(F.array(*map(F.lit, ["SH", "SZ", "BJ", "HK"])), (user % 4 + 1).cast("int")).alias("market"),
        F.col("previous_close").alias("open_price"),
        F.greatest("previous_close", "last_price").alias("high_price"),
        F.least("previous_close", "last_price").alias("low_price"),
        "last_price",
        "previous_close",
        "change_pct",
        (k.cast("long") * 100000).alias("volume"),
        stable_round(F.col("last_price") * (k.cast("long") * 100000), 2).alias("turnover"),
        "event_time",
        F.col("event_time").alias("created_at"),
        F.col("event_type").alias("source"),
    )


def ticks_raw(spark: SparkSession, d: str) -> DataFrame:
    """All ticks, before VAL-11, as a stored table."""
    return stored(spark, d, "ticks_raw", lambda: ticks_from_events(table(spark, d, "events")))


def ticks(spark: SparkSession, d: str) -> DataFrame:
    return ticks_raw(spark, d).where(passes_stream_filter())


def as_of(spark: SparkSession, d: str) -> datetime:
    """The clock of the tick queries: the newest tick."""
    return ticks(spark, d).agg(F.max("created_at")).first()[0]


def _bars(lines: DataFrame, key: str, scale: float) -> DataFrame:
    day = F.to_date("l_shipdate")
    spread = lambda c: stable_round(scale * (0.95 + c), 2)
    return (
        lines.groupBy(F.col(key).alias("k"), day.alias("trade_date"))
        .agg(
            F.avg("l_discount").alias("mean"),
            F.max("l_discount").alias("top"),
            F.min("l_discount").alias("bottom"),
            F.sum("l_quantity").alias("quantity"),
            F.sum("l_extendedprice").alias("extended"),
        )
        .select(
            "k",
            "trade_date",
            spread(F.col("mean")).alias("last_price"),
            spread((F.col("top") + F.col("bottom")) / 2).alias("open_price"),
            spread(F.col("top")).alias("high_price"),
            spread(F.col("bottom")).alias("low_price"),
            (F.col("quantity") * 1000).cast("long").alias("volume"),
            stable_round("extended", 2).alias("turnover"),
            F.to_timestamp(F.concat(F.date_format("trade_date", "yyyy-MM-dd"), F.lit(" 15:00:00"))).alias(
                "event_time"
            ),
        )
        .withColumn("created_at", F.col("event_time"))
    )


def _with_previous_close(bars: DataFrame) -> DataFrame:
    return (
        with_previous(bars, ["symbol"], ["event_time"], by_year(), F.col("last_price"), "previous_close")
        .withColumn("previous_close", F.coalesce("previous_close", "open_price"))
        .withColumn("change_pct", change_pct("last_price", "previous_close"))
    )


def bars_raw(spark: SparkSession, d: str) -> DataFrame:
    """Daily stock bars: one row per (l_suppkey, ship day), with planted faults."""
    return stored(spark, d, "bars_raw", lambda: _stock_bars(spark, d))


def _stock_bars(spark: SparkSession, d: str) -> DataFrame:
    k, day = F.col("k"), F.dayofyear("trade_date")
    prefix = F.element_at(F.array(*map(F.lit, ["60", "30", "00", "80"])), (k % 4 + 1).cast("int"))
    market = F.element_at(F.array(*map(F.lit, ["SH", "SZ", "SZ", "BJ"])), (k % 4 + 1).cast("int"))
    bars = _bars(table(spark, d, "lineitem"), "l_suppkey", 100.0).select(
        "*",
        F.concat(prefix, F.lpad(k.cast("string"), 4, "0")).alias("symbol"),
        F.concat(F.lit("Supplier "), k.cast("string")).alias("company_name"),
        F.concat(F.lit("C"), (k % 5).cast("string")).alias("category"),
        F.concat(F.lit("S"), (k % 7).cast("string")).alias("sector"),
        market.alias("market"),
        F.lit("akshare_cold_start").alias("source"),
    )
    bars = bars.withColumn(
        "high_price", F.when((k + day) % 89 == 0, F.col("low_price") - 1).otherwise(F.col("high_price"))
    ).withColumn("volume", F.when((k + day) % 97 == 0, F.lit(0)).otherwise(F.col("volume")))
    return _with_previous_close(bars).withColumn(
        "event_id",
        F.concat(
            F.lit("cold-akshare-"), F.col("symbol"), F.lit("-"), F.date_format("trade_date", "yyyyMMdd")
        ),
    )


# The three broad indices.
INDEX_SYMBOLS = {"A": "INDEX_SH000001", "N": "INDEX_SZ399006", "R": "INDEX_SH000300"}


def index_raw(spark: SparkSession, d: str) -> DataFrame:
    """Daily index bars: one row per (l_returnflag, ship day)."""
    return stored(spark, d, "index_raw", lambda: _index_bars(spark, d))


def _index_bars(spark: SparkSession, d: str) -> DataFrame:
    names = F.create_map(*[F.lit(x) for pair in INDEX_SYMBOLS.items() for x in pair])
    bars = _bars(table(spark, d, "lineitem"), "l_returnflag", 1000.0).select(
        "*",
        names[F.col("k")].alias("symbol"),
        F.lit("Market Index").alias("category"),
        F.lit("Index").alias("sector"),
        F.lit("INDEX").alias("market"),
        F.lit("akshare_index").alias("source"),
    )
    return (
        _with_previous_close(bars.withColumn("company_name", F.col("symbol")))
        .withColumn(
            "event_id",
            F.concat(
                F.lit("index-akshare-"), F.col("symbol"), F.lit("-"), F.date_format("trade_date", "yyyyMMdd")
            ),
        )
    )


def bars(spark: SparkSession, d: str) -> DataFrame:
    """Clean stock bars (VAL-17)."""
    return stored(spark, d, "bars", lambda: clean_bars(bars_raw(spark, d), order=["event_id"]))


def snapshots(spark: SparkSession, d: str) -> DataFrame:
    """Minute snapshots written by four micro-batches (event_id % 4)."""
    rows = ticks(spark, d).withColumn("batch_id", (F.col("id") % 4).cast("long"))
    return minute_snapshot(rows, ["batch_id"])


def alerts(spark: SparkSession, d: str, now: datetime | None = None) -> DataFrame:
    """Alert events: STR-10 over all ticks, with the last day as baseline."""

    def build() -> DataFrame:
        rows = ticks(spark, d)
        return build_alerts(rows, history_baseline(rows, now or as_of(spark, d)), keep=["id", "created_at"])

    return stored(spark, d, "alerts", build)


def alert_actions(spark: SparkSession, d: str, now: datetime | None = None) -> DataFrame:
    """Handling records: a third of the alerts resolved, a third acknowledged."""
    k = F.col("id") % 3
    return (
        alerts(spark, d, now)
        .where(k < 2)
        .select(
            F.col("id").alias("alert_id"),
            F.when(k == 0, "RESOLVED").otherwise("ACKED").alias("status"),
            F.concat(F.lit("note "), F.col("id").cast("string")).alias("note"),
            F.lit("user").alias("handled_by"),
            (F.col("created_at") + F.expr("INTERVAL 5 MINUTES")).alias("handled_at"),
        )
    )


def predictions(spark: SparkSession, d: str) -> DataFrame:
    """Current predictions: one per symbol, probabilities from a rule on the user id."""
    latest = latest_by(ticks(spark, d), ["symbol"], TICK_ORDER)
    u = F.col("user_id")
    probs = latest.withColumn("prob_down", (u * 37 % 100) / 100.0).withColumn(
        "prob_up", F.round((u * 17 % 100) / 100.0 * (1 - F.col("prob_down")), 6)
    ).withColumn("prob_flat", F.round(1 - F.col("prob_down") - F.col("prob_up"), 6))
    down, up = F.col("prob_down"), F.col("prob_up")
    signal = lambda bound: F.when(down >= bound, "DOWN").when(up >= bound, "UP").otherwise("WATCH")
    return probs.select(
        u.alias("id"),
        "symbol",
        "company_name",
        "category",
        "sector",
        F.col("last_price").alias("current_price"),
        stable_round(F.col("last_price") * (1 + (up - down) * 0.02), 2).alias("predicted_next_price"),
        "prob_down",
        "prob_up",
        "prob_flat",
        signal(0.5).alias("predicted_signal"),
        F.when(u % 10 == 0, "").otherwise(signal(0.6)).alias("alert_signal"),
        stable_round(display_confidence(), 4).alias("confidence"),
        stable_round("prob_down", 4).alias("model_risk_score"),
        stable_round(down * 0.8, 4).alias("technical_risk_score"),
        stable_round(up * 0.5, 4).alias("sequence_risk_score"),
        stable_round("prob_down", 4).alias("final_risk_score"),
        F.lit("ensemble-daily-1").alias("model_version"),
        "created_at",
    )


def prediction_history(spark: SparkSession, d: str) -> DataFrame:
    """Past predictions: one at every clean bar of a symbol."""
    turn = F.col("pos") % 3
    return (
        with_position(bars(spark, d), ["symbol"], ["event_time"], by_year())
        .select(
            F.concat(F.lit("p-"), F.col("event_id")).alias("id"),
            "symbol",
            "company_name",
            "category",
            "sector",
            F.col("last_price").alias("current_price"),
            F.when(turn == 0, "UP").when(turn == 1, "DOWN").otherwise("WATCH").alias("predicted_signal"),
            F.concat(F.lit("daily-"), F.year("event_time").cast("string")).alias("model_version"),
            (F.col("event_time") + F.expr("INTERVAL 1 HOUR")).alias("predicted_at"),
        )
    )


MODELS = ["random_forest", "lightgbm", "lstm"]


def scored(spark: SparkSession, d: str) -> DataFrame:
    """Every clean bar scored by three models, with the truth; slices `main` and `walk_forward`."""
    day, move = F.dayofyear("event_time"), F.col("change_pct")
    members = F.explode(
        F.array(*[F.struct(F.lit(i).alias("m"), F.lit(n).alias("model_name")) for i, n in enumerate(MODELS)])
    )
    m, k = F.col("m"), F.col("k")
    hit = (k * 31 + day * 17 + m * 7) % 10 < 4 + m * 2
    return (
        bars(spark, d)
        .select(
            "symbol",
            "event_time",
            F.col("k").cast("long").alias("k"),
            move.alias("change_pct"),
            members.alias("member"),
            F.concat(F.lit("daily-"), F.year("event_time").cast("string")).alias("model_version"),
            F.when(day % 2 == 0, "main").otherwise("walk_forward").alias("slice"),
            F.when(move > 2, 1).when(move < -2, 0).otherwise(2).alias("y_true"),
        )
        .select("*", "member.m", "member.model_name")
        .drop("member")
        .withColumn("y_pred", F.when(hit, F.col("y_true")).otherwise(((k + day + m) % 3).cast("int")))
        .withColumn("next_return", move / 100)
        .withColumn("confidence", 0.5 + (k * 13 + day * 7) % 50 / 100.0)
        .withColumn("predicted_return", ((k * 7 + day * 3) % 41 - 20) / 1000.0)
    )


def model_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Model metrics in long form: EVA-1 of both slices and EVA-3 of the main slice."""
    return stored(spark, d, "model_metrics", lambda: _model_metrics(spark, d))


def _model_metrics(spark: SparkSession, d: str) -> DataFrame:
    rows = scored(spark, d)
    keys = ["model_version", "model_name"]
    quality = metrics_to_long(direction_metrics(rows, [*keys, "slice"]), [*keys, "slice"]).withColumn(
        "metric_name",
        F.when(F.col("slice") == "main", F.col("metric_name")).otherwise(
            F.concat(F.lit("walk_forward_"), F.col("metric_name"))
        ),
    )
    backtest = metrics_to_long(
        alert_backtest(rows.where(F.col("slice") == "main"), keys, movement_threshold=0.02), keys
    )
    moment = F.to_timestamp(F.concat(F.substring("model_version", 7, 4), F.lit("-12-31 18:00:00")))
    return (
        quality.select(*keys, "metric_name", "metric_value")
        .unionByName(backtest)
        .withColumn("created_at", moment)
        .withColumn("metric_value", stable_round("metric_value", 8))
    )
