"""Fixed schemas and parameter values. Parameters are defaults of arguments, never globals read inside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The quote event, field names and types.
QUOTE_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("company_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("sector", T.StringType()),
        T.StructField("market", T.StringType()),
        T.StructField("open_price", T.DoubleType()),
        T.StructField("high_price", T.DoubleType()),
        T.StructField("low_price", T.DoubleType()),
        T.StructField("last_price", T.DoubleType()),
        T.StructField("previous_close", T.DoubleType()),
        T.StructField("change_pct", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("turnover", T.DoubleType()),
        T.StructField("event_time", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)
QUOTE_COLUMNS = QUOTE_SCHEMA.fieldNames()
TEXT_DEFAULTS = {
    "symbol": "",
    "company_name": "",
    "category": "Unknown",
    "sector": "Other",
    "market": "UNKNOWN",
    "source": "",
}
CATALOGUE_SCHEMA = "symbol string, company_name string, category string, sector string, market string"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def time_text(c: Column | str) -> Column:
    """Timestamp as the wire format."""
    return F.date_format(c, TIME_FORMAT)


def add_missing_columns(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Tolerant reading: columns a source lacks are added with their default."""
    absent = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df
