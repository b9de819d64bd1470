"""The body of a micro-batch as plain table operators (STR-1 .. STR-11).

The same functions run on a micro-batch and on a whole table. Time windows are
taken back from the argument `as_of`, never from the clock.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.numeric import money_sum, stable_round
from tickloom.operators.ordered import earliest_by, latest_by, with_position
from tickloom.schema import QUOTE_COLUMNS

STATE_KEYS = ["symbol", "source"]
STATE_VALUES = ["last_price", "change_pct", "volume"]

# Alert rule.
MAINLAND_VOLUME = 5_000_000.0
OTHER_VOLUME = 1_000_000.0


def minute_bucket(c: Column | str = "event_time") -> Column:
    """STR-5: the minute of a timestamp as text."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:00")


def event_order() -> Column:
    """When a quote happened; of quotes of the same time the shorter event id comes first, then text order, so that e9 is before e10."""
    return F.struct("event_time", F.length("event_id").alias("digits"), "event_id")


def dedup_events(batch: DataFrame) -> DataFrame:
    """STR-1: one row per event id within the batch; of copies that differ the first by time, then by content."""
    return earliest_by(batch, ["event_id"], ["event_time", *[c for c in batch.columns if c not in ("event_id", "event_time")]])


def compact_snapshots(batch: DataFrame) -> DataFrame:
    """STR-2: one row per unchanged (symbol, source, price, change, volume): the earliest, so that replays are equal."""
    ordered = batch.withColumn("__at", event_order())
    return earliest_by(ordered, [*STATE_KEYS, *STATE_VALUES], ["__at"]).drop("__at")


def minute_snapshot(batch: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """STR-6: market snapshot per minute."""
    return batch.groupBy(minute_bucket().alias("window_bucket"), *(keys or [])).agg(
        F.count_distinct("symbol").alias("symbol_count"),
        stable_round(F.avg("last_price"), 2).alias("avg_price"),
        stable_round(F.avg("change_pct"), 4).alias("avg_change_pct"),
        F.sum("volume").alias("total_volume"),
        money_sum("turnover").alias("total_turnover"),
        F.max("event_time").alias("latest_event_time"),
    )


def symbol_numbers(symbols: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """`symbol` and a `number` from 0 that it keeps: symbols that `known` has not go on behind its last one, in order."""
    new = symbols.select("symbol").where("symbol IS NOT NULL").distinct()
    first = 0
    if known is not None:
        new = new.join(known.select("symbol"), "symbol", "left_anti")
        first = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
    numbered = with_position(new, [], ["symbol"], F.substring("symbol", 1, 2)).select("symbol", (F.col("pos") - 1 + first).cast("long").alias("number"))
    return numbered if known is None else known.select("symbol", "number").unionByName(numbered)


def minute_parts(batch: DataFrame, numbers: DataFrame) -> DataFrame:
    """Sums and symbol bitmaps per minute that merge exactly, whatever batches the quotes of a minute come in.

    A bitmap holds the symbols of one range of numbers, so that it stays small; a minute has a row for each range it saw.
    """
    number = F.coalesce("number", F.lit(-1))
    rows = batch.join(numbers, "symbol", "left").withColumn("symbol_range", F.when(number >= 0, F.bitmap_bucket_number("number")).otherwise(-1))
    return rows.groupBy(minute_bucket().alias("window_bucket"), "symbol_range").agg(
        F.bitmap_construct_agg(F.when(number >= 0, F.bitmap_bit_position("number"))).alias("symbols"),
        *[F.count(c).alias(f"{c}_n") for c in ("last_price", "change_pct")],
        *[F.sum(F.col(c).cast("decimal(28,9)")).alias(f"{c}_sum") for c in ("last_price", "change_pct")],
        F.sum("volume").alias("total_volume"),
        F.sum(F.col("turnover").cast("decimal(20,2)")).alias("total_turnover"),
        F.max("event_time").alias("latest_event_time"),
    )


def merge_minute_parts(parts: DataFrame) -> DataFrame:
    """STR-6 over parts of any number of batches: the snapshot that one batch with all their quotes gives."""
    sums = [F.sum(c).alias(c) for c in ("last_price_n", "change_pct_n", "last_price_sum", "change_pct_sum", "total_volume", "total_turnover")]
    latest = F.max("latest_event_time").alias("latest_event_time")
    ranges = parts.groupBy("window_bucket", "symbol_range").agg(F.bitmap_or_agg("symbols").alias("symbols"), *sums, latest)
    minutes = ranges.groupBy("window_bucket").agg(F.sum(F.bitmap_count("symbols")).alias("symbol_count"), *sums, latest)
    mean = lambda c, digits: stable_round(F.try_divide(F.col(f"{c}_sum").cast("double"), F.col(f"{c}_n")), digits)
    return minutes.select(
        "window_bucket",
        "symbol_count",
        mean("last_price", 2).alias("avg_price"),
        mean("change_pct", 4).alias("avg_change_pct"),
        "total_volume",
        F.col("total_turnover").cast("double").alias("total_turnover"),
        "latest_event_time",
    )


def symbol_stats(batch: DataFrame) -> DataFrame:
    """STR-7: per-symbol statistics; `last_price` is the highest price of the batch."""
    return batch.groupBy("symbol", "company_name", "category", "sector").agg(
        stable_round(F.max("last_price"), 2).alias("last_price"),
        F.max_by("last_price", event_order()).alias("latest_price"),
        stable_round(F.avg("change_pct"), 4).alias("change_pct"),
        F.sum("volume").alias("volume"),
        money_sum("turnover").alias("turnover"),
    )


def dimension_stats(batch: DataFrame, dimension: str) -> DataFrame:
    """STR-8: statistics per category or sector."""
    return batch.groupBy(dimension).agg(
        F.count_distinct("symbol").alias("symbol_count"),
        stable_round(F.avg("change_pct"), 4).alias("avg_change_pct"),
        money_sum("turnover").alias("turnover"),
    )


def latest_state(stored: DataFrame, order: list[str]) -> DataFrame:
    """STR-3: newest stored values per (symbol, source)."""
    return latest_by(
        stored.select(*STATE_KEYS, *STATE_VALUES, *order), STATE_KEYS, order
    ).select(*STATE_KEYS, *STATE_VALUES)


def keep_changed(batch: DataFrame, state: DataFrame | None) -> DataFrame:
    """STR-4: rows whose price, change or volume differs from the stored state."""
    compact = compact_snapshots(batch)
    if state is None:
        return compact
    old = {c: f"__old_{c}" for c in STATE_VALUES}
    previous = state.withColumnsRenamed(old)
    same = F.lit(True)
    for c in STATE_VALUES:
        same = same & F.col(c).eqNullSafe(F.col(old[c]))
    return (
        compact.join(previous, STATE_KEYS, "left")
        .where(F.col(old["last_price"]).isNull() | ~same)
        .select(*batch.columns)
    )


def history_baseline(history: DataFrame, as_of: datetime, days: int = 1) -> DataFrame:
    """STR-9: mean absolute change and mean volume per symbol over the last day, all sources."""
    return (
        history.where(F.col("created_at") >= F.lit(as_of - timedelta(days=days)))
        .groupBy("symbol")
        .agg(
            F.coalesce(stable_round(F.avg(F.abs("change_pct")), 6), F.lit(0.0)).alias("avg_abs_change_pct"),
            F.coalesce(stable_round(F.avg("volume"), 6), F.lit(0.0)).alias("avg_volume"),
        )
    )


PARTS = "array<struct<batch_id:bigint,at:timestamp,moves:bigint,move_sum:double,volumes:bigint,volume_sum:bigint>>"
HOUR_SUMS = ["moves", "move_sum", "volumes", "volume_sum"]


def hour_sums(history: DataFrame, keys: list[str]) -> DataFrame:
    """Sums that merge to STR-9's means, per symbol and `keys`: nulls are left out of either mean."""
    move, volume = F.abs("change_pct"), F.col("volume").cast("long")
    sums = [F.count(move), F.coalesce(F.sum(move), F.lit(0.0)), F.count(volume), F.coalesce(F.sum(volume), F.lit(0).cast("long"))]
    return history.groupBy("symbol", *keys).agg(*[s.alias(n) for s, n in zip(sums, HOUR_SUMS)])


def merge_hours(parts: list[DataFrame]) -> DataFrame:
    """One row per symbol: the sums of an hour, and the `parts` (one for each batch) they are made of. `parts` are tables with `symbol` and `parts`."""
    rows = parts[0].select("symbol", "parts")
    for more in parts[1:]:
        rows = rows.unionByName(more.select("symbol", "parts"))
    merged = rows.groupBy("symbol").agg(F.flatten(F.collect_list("parts")).alias("parts"))
    return with_sums(merged)


def with_sums(hours: DataFrame) -> DataFrame:
    def total(name: str) -> Column:
        zero = F.lit(0.0) if name == "move_sum" else F.lit(0).cast("long")
        return F.aggregate("parts", zero, lambda sum_, part: sum_ + part[name])

    return hours.withColumns({name: total(name) for name in HOUR_SUMS})


def as_parts(sums: DataFrame) -> DataFrame:
    """Sums with `batch_id` and `at` as rows of one part each."""
    return sums.select("symbol", F.array(F.struct("batch_id", "at", *HOUR_SUMS)).cast(PARTS).alias("parts"))


def baseline_of_hours(hours: DataFrame, edge: DataFrame, since: datetime) -> DataFrame:
    """STR-9 from merged sums: whole `hours`, and of the hour that `since` cuts the parts from then on."""
    kept = with_sums(edge.select("symbol", F.filter("parts", lambda p: p["at"] >= F.lit(since)).alias("parts")).where(F.size("parts") > 0))
    rows = hours.select("symbol", *HOUR_SUMS).unionByName(kept.select("symbol", *HOUR_SUMS))
    sums = rows.groupBy("symbol").agg(*[F.sum(n).alias(n) for n in HOUR_SUMS])
    mean = lambda top, n: F.coalesce(stable_round(F.try_divide(F.col(top).cast("double"), F.col(n)), 6), F.lit(0.0))
    return sums.select("symbol", mean("move_sum", "moves").alias("avg_abs_change_pct"), mean("volume_sum", "volumes").alias("avg_volume"))


def empty_baseline(batch: DataFrame) -> DataFrame:
    """STR-9: the fallback when no history can be read."""
    return batch.select("symbol").distinct().select(
        "symbol", F.lit(0.0).alias("avg_abs_change_pct"), F.lit(0.0).alias("avg_volume")
    )


def alert_thresholds(move: Column, volume: Column) -> dict[str, Column]:
    """The four thresholds from a symbol's mean absolute change and mean volume."""
    base = F.when(F.upper("market").isin("SH", "SZ", "BJ"), MAINLAND_VOLUME).otherwise(OTHER_VOLUME)
    return {
        "price": F.greatest(F.lit(2.0), move * 2.5),
        "volume": F.greatest(base, volume * 2.0),
        "price_high": F.greatest(F.lit(4.0), move * 4.0),
        "volume_high": F.greatest(base * 2.0, volume * 4.0),
    }


def build_alerts(changed: DataFrame, baseline: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """STR-10: price and volume alerts against the symbol's own baseline."""
    move = F.coalesce("avg_abs_change_pct", F.lit(0.0))
    usual = F.coalesce("avg_volume", F.lit(0.0))
    bound = alert_thresholds(move, usual)
    size = F.abs("change_pct")
    by_price = F.coalesce(size >= bound["price"], F.lit(False))
    by_volume = F.coalesce(F.col("volume") >= bound["volume"], F.lit(False))
    severe = (
        F.coalesce(size >= bound["price_high"], F.lit(False))
        | (by_price & by_volume)
        | ((usual > 0) & (F.col("volume") >= bound["volume_high"]))
    )
    return (
        changed.join(baseline, "symbol", "left")
        .where(by_price | by_volume)
        .select(
            *(keep or []),
            *QUOTE_COLUMNS,
            F.when(by_price & by_volume, "price_and_volume")
            .when(by_price, "price_volatility")
            .otherwise("volume_spike")
            .alias("alert_type"),
            F.when(severe, "HIGH").otherwise("MEDIUM").alias("alert_level"),
            stable_round(bound["price"], 2).alias("price_threshold"),
            stable_round(bound["volume"], 0).cast("long").alias("volume_threshold"),
        )
    )


def suppress_recent(
    alerts: DataFrame, stored: DataFrame, as_of: datetime, minutes: int = 10, within_batch: bool = False
) -> DataFrame:
    """STR-11: drop alerts whose (symbol, type) was raised in the last minutes; 0 turns it off."""
    keys = ["symbol", "alert_type"]
    if minutes > 0:
        recent = (
            stored.where(F.col("created_at") >= F.lit(as_of - timedelta(minutes=minutes)))
            .select(*keys)
            .distinct()
        )
        alerts = alerts.join(recent, keys, "left_anti")
    return alerts.dropDuplicates(keys) if within_batch else alerts
