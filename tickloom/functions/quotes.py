"""Quote cleaning and validation as column expressions (VAL-1 .. VAL-12, VAL-16)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tickloom.functions.numeric import all_of, any_of, as_col, stable_round

PRICES = ["open_price", "high_price", "low_price", "last_price"]

# Daily change limits in percent, by market.
MAINLAND = ["SH", "SZ"]
OVERSEAS = ["US", "NASDAQ", "NYSE"]
GROWTH_BOARD_PREFIX = "^(300|301|688)"
LIMIT_BJ = 31.0
LIMIT_GROWTH_BOARD = 21.0
LIMIT_MAIN_BOARD = 11.0
LIMIT_HK = 30.0
LIMIT_OVERSEAS = 25.0
LIMIT_INDEX = 15.0


def text_or(c: Column | str, default: Column | str) -> Column:
    """Trimmed text, or the default when null or blank."""
    other = F.lit(default) if isinstance(default, str) else default
    return F.coalesce(F.nullif(F.trim(as_col(c)), F.lit("")), other)


def clean_symbol(c: Column | str) -> Column:
    return F.upper(F.trim(F.coalesce(as_col(c), F.lit(""))))


def detect_market(symbol: Column | str, hint: Column | str | None = None) -> Column:
    """VAL-1: the hint wins, otherwise the code pattern decides."""
    code = clean_symbol(symbol)
    guessed = (
        F.when(code.rlike("^6[0-9]{5}$"), "SH")
        .when(code.rlike("^[03][0-9]{5}$"), "SZ")
        .when(code.rlike("^[48][0-9]{5}$"), "BJ")
        .when(code.rlike("^[0-9]{5}$"), "HK")
        .otherwise("UNKNOWN")
    )
    if hint is None:
        return guessed
    given = F.coalesce(as_col(hint), F.lit(""))
    return F.when(given != "", F.upper(given)).otherwise(guessed)


def change_pct(price: Column | str, previous: Column | str) -> Column:
    """VAL-2: percent change, 0 without a previous close."""
    p, q = as_col(price), as_col(previous)
    return F.coalesce(stable_round((p - q) / F.nullif(q, F.lit(0.0)) * 100, 4), F.lit(0.0))


def change_limit(symbol: Column | str, market_hint: Column | str | None = None) -> Column:
    """VAL-3: the market's sanity limit in percent, null for unknown markets."""
    market = detect_market(symbol, market_hint)
    return (
        F.when(market == "BJ", LIMIT_BJ)
        .when(
            market.isin(MAINLAND),
            F.when(clean_symbol(symbol).rlike(GROWTH_BOARD_PREFIX), LIMIT_GROWTH_BOARD).otherwise(
                LIMIT_MAIN_BOARD
            ),
        )
        .when(market == "HK", LIMIT_HK)
        .when(market.isin(OVERSEAS), LIMIT_OVERSEAS)
        .when(market == "INDEX", LIMIT_INDEX)
    )


def is_valid_ohlc(require_volume: Column | bool = True) -> Column:
    """VAL-4: positive prices, open and last inside [low, high]; missing values count as 0."""
    price = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in PRICES}
    last = price["last_price"]
    needs_volume = F.lit(require_volume) if isinstance(require_volume, bool) else require_volume
    return all_of(
        [
            F.least(*price.values()) > 0,
            F.coalesce(F.col("previous_close"), last) > 0,
            ~needs_volume | (F.coalesce(F.col("volume"), F.lit(0)) > 0),
            price["open_price"].between(price["low_price"], price["high_price"]),
            last.between(price["low_price"], price["high_price"]),
        ]
    )


def is_valid_tick() -> Column:
    """VAL-5: VAL-4 (indices may have no volume) and a change below the market's limit."""
    market = detect_market("symbol", "market")
    moved = F.abs(F.coalesce(F.col("change_pct"), F.lit(0.0)))
    return F.coalesce(
        is_valid_ohlc(market != "INDEX") & (moved < change_limit("symbol", "market")), F.lit(False)
    )


def normalized_text() -> dict[str, Column]:
    """VAL-6: the five text columns of a quote, cleaned; use with `withColumns`."""
    symbol = clean_symbol("symbol")
    return {
        "symbol": symbol,
        "company_name": text_or("company_name", symbol),
        "category": text_or("category", "Unknown"),
        "sector": text_or("sector", "Other"),
        "market": detect_market("symbol", "market"),
    }


def safe_double(c: Column | str, default: float = 0.0) -> Column:
    """VAL-7: text to double; blanks, dashes and bad numbers give the default."""
    text = F.trim(as_col(c).cast("string"))
    return F.coalesce(text.try_cast("double"), F.lit(float(default)))


def safe_long(c: Column | str, default: int = 0) -> Column:
    """VAL-7: as safe_double, thousands commas removed, truncated toward zero."""
    text = F.replace(F.trim(as_col(c).cast("string")), F.lit(","), F.lit(""))
    return F.coalesce(text.try_cast("double").try_cast("long"), F.lit(int(default)))


def scaled_price(c: Column | str) -> Column:
    """VAL-8: a vendor price; values from 100000 up are given in cents."""
    raw = safe_double(c)
    return F.when(F.abs(raw) >= 100000, stable_round(raw / 100, 2)).otherwise(stable_round(raw, 2))


# Vendor code prefixes by market. HK codes are padded to five digits.
VENDOR_PREFIXES = {
    "eastmoney": {"SH": "1.", "SZ": "0.", "BJ": "0.", "HK": "116."},
    "sina": {"SH": "sh", "SZ": "sz", "BJ": "sz", "HK": "rt_hk"},
    "tencent": {"SH": "sh", "SZ": "sz", "BJ": "sz", "HK": "hk"},
}


def vendor_code(vendor: str, symbol: Column | str, hint: Column | str | None = None) -> Column:
    """VAL-9: the vendor's key for a symbol; null where the market is not offered."""
    market = detect_market(symbol, hint)
    code = clean_symbol(symbol)
    padded = F.when(F.length(code) < 5, F.lpad(code, 5, "0")).otherwise(code)
    result = F.lit(None).cast("string")
    for name, prefix in VENDOR_PREFIXES[vendor].items():
        body = padded if name == "HK" else code
        result = F.when(market == name, F.concat(F.lit(prefix), body)).otherwise(result)
    return result


def canonical_quote() -> dict[str, Column]:
    """VAL-10: rounded prices, change and turnover of a raw quote; use with `withColumns`."""
    rounded = {c: stable_round(c, 2) for c in [*PRICES, "previous_close"]}
    return {
        **rounded,
        "change_pct": change_pct("last_price", "previous_close"),
        "volume": F.col("volume").cast("long"),
        "turnover": stable_round(F.col("last_price") * F.col("volume"), 2),
    }


def passes_stream_filter(limits: str = "flat") -> Column:
    """VAL-11: the stream's sanity filter; rows where it is null are dropped.

    `limits="flat"` uses one limit per market, `"shared"` the finer VAL-3 limits.
    """
    moved = F.abs(F.col("change_pct"))
    market = F.col("market")
    if limits == "shared":
        within = moved < change_limit("symbol", "market")
    else:
        within = any_of(
            [
                market.isin([*MAINLAND, "BJ"]) & (moved < LIMIT_MAIN_BOARD),
                (market == "HK") & (moved < LIMIT_HK),
                market.isin(OVERSEAS) & (moved < LIMIT_OVERSEAS),
            ]
        )
    positive = [F.col(c) > 0 for c in [*PRICES, "previous_close", "volume"]]
    return all_of(
        [
            F.length("symbol") > 0,
            F.col("event_time").isNotNull(),
            *positive,
            F.col("open_price").between(F.col("low_price"), F.col("high_price")),
            F.col("last_price").between(F.col("low_price"), F.col("high_price")),
            within,
        ]
    )


def trade_date(c: Column | str) -> Column:
    """VAL-16: date from `yyyy-mm-dd`, `yyyy/mm/dd` or `yyyymmdd...`; null if unreadable."""
    digits = F.regexp_replace(F.trim(as_col(c).cast("string")), "[-/]", "")
    return F.try_to_timestamp(F.substring(digits, 1, 8), F.lit("yyyyMMdd")).cast("date")
