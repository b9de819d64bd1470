"""Technical, cross-sectional and index features over price rows (FEA-1 .. FEA-27).

Input rows are clean (VAL-17), of one source per symbol (VAL-18) and without
repeated prices (VAL-19), so (symbol, event_time) is unique.

A symbol's rows are cut into segments (see `ordered.with_segments`), so a symbol
of any length is spread over many tasks. Every segment starts with copies of the
`WARM_UP` rows before it. Row frames of at most 20 rows are exact with that; the
exponential averages forget a row by the factor 25/27 per step at the slowest,
so what lies before the warm-up weighs less than 1e-20 of the value, below the
precision of a double. Daily bars of one symbol normally fit one segment. The
frames themselves are worked out in `rolling`, on whole segments at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tickloom.functions.numeric import clip, finite, flag, ratio, stable_round
from tickloom.operators import rolling
from tickloom.operators.cleaning import clean_bars, collapse_repeats, select_training_sources
from tickloom.operators.ordered import latest_by, with_position, with_segments
from tickloom.session import materialize, ship_package

SEGMENT_ROWS = 2048
WARM_UP = 800
HORIZONS = (1, 3, 5)

# The broad indices and the names of their feature columns.
INDEX_PREFIXES = {"INDEX_SH000001": "index_sh", "INDEX_SZ399006": "index_cyb", "INDEX_SH000300": "index_hs300"}
INDEX_MEASURES = ["return_1", "return_3", "return_5", "volatility_5", "volatility_10"]
INDEX_COLUMNS = [f"{p}_{m}" for p in INDEX_PREFIXES.values() for m in INDEX_MEASURES]
INDEX_ALL = [*INDEX_COLUMNS, *[f"market_index_{m}" for m in INDEX_MEASURES]]

# The feature list.
FEATURES = """
change_pct_scaled return_1 return_3 momentum_5 momentum_10 momentum_20 volume_change turnover_change
ma_5_gap ma_10_gap ma_20_gap volume_ratio volume_ratio_20_raw turnover_ratio
volatility_5 volatility_10 volatility_20 max_drawdown_5 max_drawdown_10 max_drawdown_20
high_low_range price_vs_ma20 relative_sector_change_pct relative_market_change_pct
current_vs_market_index_return relative_sh_index_return_1 relative_cyb_index_return_1
sector_relative_change market_relative_change sector_avg_change_pct market_avg_change_pct
sector_momentum_5 market_momentum_5 market_up_ratio sector_up_ratio
sector_return_1 sector_return_3 sector_momentum_3
sector_relative_return_1 sector_relative_return_3 sector_relative_return_5
sector_relative_return_10 sector_relative_return_20
sector_return_rank_5 sector_return_rank_10 sector_return_rank_20 sector_strength_rank
sector_volatility_5 sector_up_ratio_3
index_sh_return_1 index_sh_return_3 index_sh_volatility_5 index_sh_volatility_10
index_cyb_return_1 index_cyb_return_3 index_cyb_volatility_5 index_cyb_volatility_10
index_hs300_return_1 index_hs300_return_3 index_hs300_volatility_5 index_hs300_volatility_10
market_index_return_1 market_index_return_3 market_index_return_5
market_index_volatility_5 market_index_volatility_10
relative_hs300_return_1 relative_hs300_return_3 relative_hs300_return_5
relative_market_index_return_1 relative_market_index_return_3 relative_market_index_return_5
index_up_3d rsi_14 macd macd_signal macd_hist volume_price_corr money_flow_ratio vol_regime
price_position_20 up_streak_3 down_streak_3 volume_spike_20 volume_up_breakout volume_down_breakout
volume_expansion_streak_3 volume_expansion_streak_5
return_3_x_volume_ratio_20 momentum_5_x_volume_ratio_20
""".split()

def _ordered():
    return W.partitionBy("symbol", "segment").orderBy("pos")


def _last(n: int):
    """The frame of the newest n rows."""
    return _ordered().rowsBetween(-(n - 1), 0)


def _growth(c: str, n: int) -> Column:
    return ratio(F.col(c), F.lag(c, n).over(_ordered()), None)


def _change(c: str, n: int = 1) -> Column:
    """Relative change to the row n before; 0 where there is none."""
    return F.coalesce(_growth(c, n) - 1, F.lit(0.0))


def numbered(df: DataFrame) -> DataFrame:
    """Adds `nth`, the row's place in its segment."""
    return df.withColumn("nth", F.row_number().over(_ordered()))


def _std(c: str, n: int, least: int) -> Column:
    """Deviation over the newest n rows; 0 with fewer than `least` (a frame of n rows has min(n, nth) of them)."""
    return F.coalesce(F.when(F.col("nth") >= least, F.stddev_samp(c).over(_last(n))), F.lit(0.0))


def index_features(index_bars: DataFrame, bucket: Column) -> DataFrame:
    """FEA-12: returns and volatility of the three indices, one row per day."""
    rows = (
        index_bars.withColumn("symbol", F.upper("symbol"))
        .where(F.col("symbol").isin(list(INDEX_PREFIXES)) & F.col("event_time").isNotNull())
        .withColumn("last_price", F.coalesce(F.col("last_price").cast("double"), F.lit(0.0)))
        .select("symbol", "event_time", "event_id", "last_price")
    )
    placed = with_position(rows, ["symbol"], ["event_time", "event_id"], bucket)
    cut = with_segments(placed, SEGMENT_ROWS, before=16)
    measured = numbered(cut).withColumns({f"return_{n}": _change("last_price", n) for n in (1, 3, 5)}).withColumns(
        {"volatility_5": _std("return_1", 5, 2), "volatility_10": _std("return_1", 10, 3)}
    )
    daily = latest_by(
        measured.where("is_core").select("symbol", F.to_date("event_time").alias("trade_date"), "pos", *INDEX_MEASURES),
        ["symbol", "trade_date"],
        ["pos"],
    )
    pick = lambda s, m: F.max(F.when(F.col("symbol") == s, F.col(m)))
    return daily.groupBy("trade_date").agg(
        *[F.coalesce(pick(s, m), F.lit(0.0)).alias(f"{p}_{m}") for s, p in INDEX_PREFIXES.items() for m in INDEX_MEASURES]
    )


def attach_index(df: DataFrame, index: DataFrame) -> DataFrame:
    """FEA-13, 14: the day's index features, and those of the row's own market.

    `index` has one row per calendar day, a fixed bound, so it is broadcast.
    """
    joined = df.withColumn("__day", F.to_date("event_time")).join(
        F.broadcast(index.withColumnRenamed("trade_date", "__day")), "__day", "left"
    )
    joined = joined.drop("__day").withColumns({c: F.coalesce(c, F.lit(0.0)) for c in INDEX_COLUMNS})
    growth = F.col("symbol").startswith("300")
    own = {
        f"market_index_{m}": F.when(F.col("market") == "SH", F.col(f"index_sh_{m}"))
        .when(growth, F.col(f"index_cyb_{m}"))
        .otherwise(F.col(f"index_hs300_{m}"))
        for m in INDEX_MEASURES
    }
    return joined.withColumns(own)


RELATIVE = [*rolling.BESIDE_INDEX, "index_up_3d"]
#: The features of a symbol's own rows.
OWN = [c for c in FEATURES if c in rolling.MAKERS and c not in RELATIVE and c not in rolling.BESIDE_MEANS]


CROSS_INPUTS = ["change_pct", "return_1", "return_3", "momentum_5", "momentum_10", "momentum_20", "volatility_5"]


def sector_table(rows: DataFrame) -> DataFrame:
    """FEA-7, 8, 11: means and up ratios per (sector, time), and the sector's strength rank.

    The rank window holds one row per sector of a moment, not the sector's rows.
    """
    mean = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    share = lambda c: F.coalesce(F.avg(flag(F.col(c) > 0)), F.lit(0.5)) - 0.5
    stats = rows.groupBy("sector", "event_time").agg(
        mean("change_pct").alias("sector_mean_change"),
        share("change_pct").alias("sector_up_ratio"),
        mean("return_1").alias("sector_return_1"),
        mean("return_3").alias("sector_return_3"),
        mean("return_3").alias("sector_momentum_3"),
        *[mean(f"momentum_{n}").alias(f"sector_momentum_{n}") for n in (5, 10, 20)],
        mean("volatility_5").alias("sector_volatility_5"),
        share("return_3").alias("sector_up_ratio_3"),
    )
    moment = W.partitionBy("event_time")
    stats = stats.withColumn("__strength", stable_round("sector_return_1", 9))
    rank = F.rank().over(moment.orderBy("__strength"))
    ties = F.count(F.lit(1)).over(W.partitionBy("event_time", "__strength"))
    return stats.withColumn(
        "sector_strength_rank", (rank + (ties - 1) / 2) / F.count(F.lit(1)).over(moment) - 0.5
    ).drop("__strength")


def market_table(rows: DataFrame) -> DataFrame:
    """FEA-7, 8: means and up ratio per (market, time)."""
    return rows.groupBy("market", "event_time").agg(
        F.coalesce(F.avg("change_pct"), F.lit(0.0)).alias("market_mean_change"),
        (F.coalesce(F.avg(flag(F.col("change_pct") > 0)), F.lit(0.5)) - 0.5).alias("market_up_ratio"),
        F.coalesce(F.avg("momentum_5"), F.lit(0.0)).alias("market_momentum_5"),
    )


RANKED_SPANS = (5, 10, 20)


def with_sector_ranks(rows: DataFrame) -> DataFrame:
    """FEA-10: percentile rank of momentum 5 / 10 / 20 within (sector, time), equal values sharing the mean rank.

    A group has one row per symbol of the sector, so all windows run over one exchange by (sector, time).
    """
    group = ["sector", "event_time"]
    whole = W.partitionBy(*group)

    def rank(value: str) -> Column:
        first = F.rank().over(whole.orderBy(F.col(value).asc_nulls_last()))
        ties = F.count(F.lit(1)).over(W.partitionBy(*group, value))
        mean = (first + (ties - 1) / 2) / F.count(value).over(whole)
        return F.when(F.col(value).isNotNull(), mean - 0.5).otherwise(0.0)

    return rows.withColumns({f"sector_return_rank_{n}": rank(f"momentum_{n}") for n in RANKED_SPANS})


def sector_ranks(rows: DataFrame) -> DataFrame:
    """FEA-10: only the ranks, per (symbol, time)."""
    return with_sector_ranks(rows).select("symbol", "event_time", *[f"sector_return_rank_{n}" for n in RANKED_SPANS])


def cross_stats(rows: DataFrame, ranks: bool = True) -> DataFrame:
    """Rows with what their sector and their market did at the time, and their ranks (FEA-7 .. FEA-11).

    A sector's row carries the markets of its time as a map, so that one exchange of the rows, by (sector, time), serves all of it.
    """
    markets = market_table(rows).where(F.col("market").isNotNull())
    values = [c for c in markets.columns if c not in ("market", "event_time")]
    by_time = markets.groupBy("event_time").agg(F.map_from_entries(F.collect_list(F.struct("market", F.struct(*values)))).alias("__markets"))
    moment = sector_table(rows).join(by_time, "event_time")
    joined = (with_sector_ranks(rows) if ranks else rows).join(moment, ["sector", "event_time"])
    own = joined.withColumn("__market", F.try_element_at("__markets", F.col("market"))).where(F.col("__market").isNotNull())
    return own.withColumns({c: F.col("__market")[c] for c in values}).drop("__markets", "__market")


def relative_features(df: DataFrame) -> DataFrame:
    """FEA-7, 9: rows beside the means of their sector and market."""
    return df.withColumns({n: make(F.col) for n, make in rolling.BESIDE_MEANS.items()}).drop("sector_mean_change", "market_mean_change")


def cross_section(df: DataFrame, ranks: bool = True) -> DataFrame:
    """FEA-7 .. FEA-11 for every row.

    All grouping runs on a narrow copy of the rows; where there is more to a row, the result meets the wide
    rows in one join on their unique key.
    """
    names = ["symbol", "event_time", "sector", "market", *CROSS_INPUTS]
    done = relative_features(cross_stats(df.select(*names), ranks))
    if set(df.columns) <= set(names):
        return done
    return df.join(done.drop("sector", "market", *CROSS_INPUTS), ["symbol", "event_time"])


def guard(df: DataFrame) -> DataFrame:
    """FEA-26: every listed feature finite and within [-5, 5]."""
    return df.withColumns({c: clip(finite(F.col(c).cast("double")), -5, 5) for c in FEATURES if c in df.columns})


def typed(df: DataFrame) -> DataFrame:
    """Numbers of the input rows as doubles, missing ones as 0."""
    numbers = ["open_price", "high_price", "low_price", "last_price", "change_pct", "volume", "turnover"]
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numbers})


def placed_rows(rows: DataFrame, bucket: Column) -> DataFrame:
    """Typed rows with `pos` and `group_rows`."""
    return with_position(typed(rows), ["symbol"], ["event_time"], bucket)


def placed_features(
    placed: DataFrame,
    index: DataFrame | None,
    horizons: tuple[int, ...] = (),
    names: list[str] | None = None,
    kept: list[str] | None = None,
    guarded: bool = False,
) -> DataFrame:
    """The features `names` (all per-symbol ones by default) in one pass over the segments, beside the columns `kept` of the placed rows (all by default).

    `guarded`: FEA-26 holds for them. What no frame is made of is taken from the placed rows and the index.
    """
    names = [*OWN, *(RELATIVE if index is not None else [])] if names is None else names
    indexed = {*RELATIVE, *INDEX_ALL}
    with_index = index is not None and (kept is None or bool({*names, *kept} & indexed))
    made = [*names, *[f"{c}_{h}" for h in horizons for c in ("next_price", "future_min", "future_max")]]
    kept = [*placed.columns, *(INDEX_ALL if with_index else [])] if kept is None else ["symbol", "event_time", "pos", "group_rows", *kept]
    kept = [c for c in dict.fromkeys(kept) if c not in made]
    means = rolling.MEANS if set(names) & set(rolling.BESIDE_MEANS) else []
    there = [c for c in placed.columns if c in {*kept, *made, *rolling.INPUTS, *means, "pos", "group_rows"} or with_index and c == "market"]
    cut = with_segments(placed.select(*there), SEGMENT_ROWS, before=WARM_UP, after=max(horizons, default=0)).repartition("symbol", "segment")
    if with_index:  # joined after the shuffle, so these columns are not moved
        cut = attach_index(cut, index)
    cut = cut.sortWithinPartitions("symbol", "segment", "pos")
    schema = StructType([*[cut.schema[c] for c in kept], *[StructField(c, DoubleType()) for c in made]])
    ship_package(cut.sparkSession)
    return cut.mapInArrow(rolling.measure(["symbol", "segment"], kept, made, set(FEATURES) if guarded else set()), schema)


def symbol_features(
    rows: DataFrame, index: DataFrame | None, bucket: Column, horizons: tuple[int, ...] = (), names: list[str] | None = None
) -> DataFrame:
    """The per-symbol features `names` (all by default), with `pos` and `group_rows`."""
    return placed_features(placed_rows(rows, bucket), index, horizons, names)


def prepared_rows(raw: DataFrame, bucket: Column, order: list[str]) -> DataFrame:
    """FEA-27, first half: clean, one source per symbol, no repeated prices.

    The following steps read their input twice (piece summaries and rows), so the
    clean rows are written once instead of being worked out four times.
    """
    clean = materialize(clean_bars(raw, order), "clean")
    return collapse_repeats(select_training_sources(clean), bucket)


def cross_inputs(placed: DataFrame) -> DataFrame:
    """What the cross section reads of a row, with its place."""
    names = [c for c in CROSS_INPUTS if c in OWN]
    return placed_features(placed, None, (), names, ["sector", "market", "change_pct"]).select("symbol", "pos", "event_time", "sector", "market", *CROSS_INPUTS)


def cross_table(inputs: DataFrame) -> DataFrame:
    """What sector and market did at the time of each row, and its ranks, by (symbol, pos)."""
    return cross_stats(inputs).drop("event_time", "sector", "market", *CROSS_INPUTS)


def framed(
    placed: DataFrame, cross: DataFrame, index: DataFrame, horizons: tuple[int, ...] = (), names: list[str] | None = None, kept: list[str] | None = None
) -> DataFrame:
    """FEA-27, last half: the listed features `names` (all by default) of every row, beside the columns `kept` (all by default).

    What the cross section says meets the rows before their features are made: no wide row is moved, and nothing that was not asked for is.
    """
    made = placed_features(placed.join(cross, ["symbol", "pos"]), index, horizons, FEATURES if names is None else names, kept, guarded=True)
    return made.drop("sector_mean_change", "market_mean_change")


def feature_frame(
    raw: DataFrame,
    index_bars: DataFrame,
    bucket: Column,
    order: list[str],
    horizons: tuple[int, ...] = (),
) -> DataFrame:
    """FEA-27: raw rows to the full feature list; `horizons` adds the future prices labels need."""
    rows = materialize(prepared_rows(raw, bucket, order), "prepared")
    placed = materialize(placed_rows(rows, bucket), "placed")
    index = materialize(index_features(index_bars, bucket), "index_features")
    inputs = materialize(cross_inputs(placed), "cross_inputs")
    cross = materialize(cross_table(inputs), "cross")
    return framed(placed, cross, index, horizons)
