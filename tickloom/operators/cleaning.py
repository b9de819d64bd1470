"""Cleaning and source selection of quote and bar tables (VAL-13 .. VAL-20)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.numeric import any_of, finite, stable_round
from tickloom.functions.quotes import (
    PRICES,
    VENDOR_PREFIXES,
    change_limit,
    change_pct,
    clean_symbol,
    detect_market,
    is_valid_tick,
    normalized_text,
    safe_double,
    safe_long,
    text_or,
    trade_date,
)
from tickloom.operators.ordered import computed_once, earliest_by, latest_by, with_previous
from tickloom.schema import TEXT_DEFAULTS, add_missing_columns

# Fixed values.
NUMBERS = [*PRICES, "previous_close", "change_pct", "volume", "turnover"]
TRAINING_SOURCES = ["akshare_cold_start", "sina", "tencent", "eastmoney"]
BAR_KEYS = ["symbol", "event_time", "source"]
FAULTS = ["time", "identity", "price", "volume", "ohlc", "change"]


def _known(c: str) -> Column:
    """Numbers that can be used: infinities and NaN count as missing."""
    return F.when(finite(F.col(c).cast("double"), float("nan")) == F.col(c), F.col(c))


def standardise(df: DataFrame) -> DataFrame:
    """VAL-17, first step: text defaults and typed numbers."""
    df = add_missing_columns(df, {**TEXT_DEFAULTS, **{c: 0.0 for c in NUMBERS}, "event_time": None})
    symbol = clean_symbol("symbol")
    return df.withColumns(
        {
            "symbol": symbol,
            "company_name": text_or("company_name", symbol),
            "category": text_or("category", "Unknown"),
            "sector": text_or("sector", "Other"),
            "market": F.upper(text_or("market", "UNKNOWN")),
            "source": text_or("source", ""),
            "event_time": F.col("event_time").cast("timestamp"),
            **{c: _known(c) for c in NUMBERS},
        }
    )


def fault_flags() -> dict[str, Column]:
    """VAL-17: the six reasons to reject a row; a row may have several."""
    five = [*PRICES, "previous_close"]
    yes = lambda c: F.coalesce(c, F.lit(False))
    col = F.col
    return {
        "time": col("event_time").isNull(),
        "identity": col("symbol") == "",
        "price": any_of([col(c).isNull() | yes(col(c) <= 0) for c in five]),
        "volume": col("volume").isNull() | yes(col("volume") <= 0),
        "ohlc": any_of(
            [
                yes(col("high_price") < col("low_price")),
                yes(col("open_price") > col("high_price")),
                yes(col("open_price") < col("low_price")),
                yes(col("last_price") > col("high_price")),
                yes(col("last_price") < col("low_price")),
            ]
        ),
        "change": ~F.coalesce(F.abs("change_pct") < change_limit("symbol", "market"), F.lit(False)),
    }


def clean_bars(df: DataFrame, order: list[str]) -> DataFrame:
    """VAL-17: valid rows, one per (symbol, event_time, source).

    `order` breaks ties between copies; the last one stays. Copies are reduced
    before the shuffle, so a key with any number of them is one row per task.
    """
    valid = computed_once(standardise(df)).where(~any_of(list(fault_flags().values())))
    return latest_by(valid, BAR_KEYS, order)


def quality_report(df: DataFrame) -> DataFrame:
    """VAL-17: counts of rows in, out, rejected by each rule and removed as copies, in one pass."""
    flags = fault_flags()
    bad = any_of(list(flags.values()))
    counts = [F.sum(F.when(flags[f], 1).otherwise(0)).alias(f"invalid_{f}_rows") for f in FAULTS]
    kept = F.when(~bad, F.struct(*BAR_KEYS))
    return (
        standardise(df)
        .agg(
            F.count(F.lit(1)).alias("input_rows"),
            F.count_distinct(kept).alias("output_rows"),
            F.sum(F.when(bad, 0).otherwise(1)).alias("valid_rows"),
            *counts,
        )
        .select(
            "input_rows",
            "output_rows",
            (F.col("input_rows") - F.col("output_rows")).alias("dropped_rows"),
            *[f"invalid_{f}_rows" for f in FAULTS],
            (F.col("valid_rows") - F.col("output_rows")).alias("duplicate_rows"),
        )
    )


def select_training_sources(df: DataFrame, priority: list[str] | None = None) -> DataFrame:
    """VAL-18: one source per symbol, by priority, then by more rows, then by name."""
    names = priority or TRAINING_SOURCES
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, names)), F.col("source")), F.lit(0)), F.lit(len(names) + 1))
    chosen = (
        df.groupBy("symbol", "source")
        .agg(F.count(F.lit(1)).alias("rows"))
        .groupBy("symbol")
        .agg(F.min_by("source", F.struct(rank, -F.col("rows"), "source")).alias("source"))
    )
    return df.join(chosen, ["symbol", "source"], "left_semi")


def collapse_repeats(df: DataFrame, bucket: Column, order: list[str] | None = None) -> DataFrame:
    """VAL-19: drop rows that repeat the price of the row before them."""
    price = F.coalesce(F.col("last_price").cast("double"), F.lit(0.0))
    return (
        with_previous(df, ["symbol"], order or ["event_time"], bucket, price, "__prev")
        .where(F.col("__prev").isNull() | (F.abs(price - F.col("__prev")) > 1e-8))
        .drop("__prev")
    )


# Vendor order by market.
VENDOR_ORDER = {
    "mainland": ["sina", "tencent", "eastmoney"],
    "HK": ["eastmoney", "sina", "tencent"],
    "other": ["eastmoney", "tencent", "sina"],
}


def source_rank(configured: list[str]) -> Column:
    """VAL-13: rank of a row's source for its market; null where the source is not configured."""
    allowed = [s for s in configured if s in VENDOR_PREFIXES]
    market = detect_market("symbol", "market")

    def rank(order: list[str]) -> Column:
        used = [s for s in order if s in allowed]
        return F.nullif(F.array_position(F.array(*map(F.lit, used)).cast("array<string>"), F.col("source")), F.lit(0))

    return (
        F.when(market.isin("SH", "SZ", "BJ"), rank(VENDOR_ORDER["mainland"]))
        .when(market == "HK", rank(VENDOR_ORDER["HK"]))
        .otherwise(rank(VENDOR_ORDER["other"]))
    )


def first_valid_quote(captured: DataFrame, configured: list[str], order: list[str]) -> DataFrame:
    """VAL-13: of all captured quotes, the first valid one per symbol by source rank."""
    ranked = captured.withColumn("source_rank", source_rank(configured))
    return earliest_by(
        ranked.where(F.col("source_rank").isNotNull() & is_valid_tick()), ["symbol"], ["source_rank", *order]
    )


# Column names of the daily-bar vendors.
DAILY_ALIASES = {
    "date": ["日期", "date"],
    "open": ["开盘", "open"],
    "high": ["最高", "high"],
    "low": ["最低", "low"],
    "close": ["收盘", "close"],
    "previous": ["昨收"],
    "change": ["涨跌幅"],
    "volume": ["成交量", "volume"],
    "amount": ["成交额", "amount"],
}
DAILY_SOURCES = {"stock": "akshare_cold_start", "index": "akshare_index"}


def _alias(df: DataFrame, names: list[str]) -> Column:
    present = [F.col(f"`{n}`").cast("string") for n in names if n in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def chain_previous_close(rows: DataFrame, keys: list[str], order: list[str], bucket: Column) -> DataFrame:
    """VAL-15: the last positive close before each row, valid or not."""
    close = safe_double(_alias(rows, DAILY_ALIASES["close"]))
    return with_previous(rows, keys, order, bucket, F.when(close > 0, close), "chained_close")


def normalise_daily(rows: DataFrame, kind: str = "stock", vendor: str = "eastmoney") -> DataFrame:
    """VAL-14: canonical daily bars from a vendor's text rows.

    Rows carry the vendor's columns plus symbol, company_name, category, sector
    and market. A `chained_close` column (VAL-15) overrides the previous close
    where it is positive; else the vendor's own, else the close before the change.
    """
    get = lambda name: _alias(rows, DAILY_ALIASES[name])
    close = safe_double(get("close"))
    moved = safe_double(get("change"))
    implied = F.when((moved > -99) & (close > 0), close / (1 + moved / 100)).otherwise(close)
    given = safe_double(get("previous")) if kind == "stock" else F.lit(0.0)
    if "chained_close" in rows.columns:
        given = F.coalesce(F.nullif(F.col("chained_close"), F.lit(0.0)), given)
    previous = F.when(given > 0, given).otherwise(implied)
    if kind == "index":
        volume = safe_long(F.coalesce(get("volume"), _alias(rows, ["amount"])), 1)
        amount = safe_double(get("amount"))
    elif vendor == "tencent":
        volume = safe_long(_alias(rows, ["成交量", "amount"]))
        amount = F.lit(0.0)
    else:
        volume = safe_long(get("volume"))
        amount = safe_double(get("amount"))
    day = trade_date(get("date"))
    price = lambda name: stable_round(F.coalesce(safe_double(get(name), -1.0), close), 2)
    quoted = lambda name: F.when(get(name).isNull(), stable_round(close, 2)).otherwise(
        F.when(price(name) == -1.0, stable_round(close, 2)).otherwise(price(name))
    )
    prefix = "cold-akshare-" if kind == "stock" else "index-akshare-"
    return (
        rows.withColumns(normalized_text())
        .withColumns(
            {
                "open_price": quoted("open"),
                "high_price": quoted("high"),
                "low_price": quoted("low"),
                "last_price": stable_round(close, 2),
                "change_pct": change_pct(close, previous),
                "previous_close": stable_round(previous, 2),
                "volume": volume,
                "turnover": stable_round(amount, 2),
                "trade_date": day,
                "event_time": F.to_timestamp(F.concat(day.cast("string"), F.lit(" 15:00:00"))),
                "source": F.lit(DAILY_SOURCES[kind]),
                "event_id": F.concat(F.lit(prefix), F.col("symbol"), F.lit("-"), F.date_format(day, "yyyyMMdd")),
            }
        )
        .where(day.isNotNull())
    )


def watch_list(wanted: DataFrame, catalogue: DataFrame) -> DataFrame:
    """VAL-20: wanted symbols with catalogue data or defaults, mainland markets only."""
    names = wanted.select(clean_symbol("symbol").alias("symbol")).where("symbol <> ''").distinct()
    known = catalogue.withColumn("symbol", clean_symbol("symbol")).dropDuplicates(["symbol"])
    return (
        names.join(known, "symbol", "left")
        .select(
            "symbol",
            F.coalesce("company_name", "symbol").alias("company_name"),
            F.coalesce("category", F.lit("A Share Cold Start")).alias("category"),
            F.coalesce("sector", F.lit("Other")).alias("sector"),
            F.coalesce("market", detect_market("symbol")).alias("market"),
        )
        .where(detect_market("symbol", "market").isin("SH", "SZ", "BJ"))
    )
