"""Registered queries for the time-series features (FEA)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.functions.numeric import stable_round, stable_round_double
from tickloom.operators import features as fe
from tickloom.plans import fixtures as fx
from tickloom.plans.oracle import cte, rnd, with_ctes
from tickloom.plans.registry import query

cte(
    "rows",
    """SELECT symbol, event_time, market, sector, category, company_name, source, event_id, k, open_price, high_price, low_price, last_price,
      change_pct, CAST(volume AS DOUBLE) AS volume, turnover FROM bars
    QUALIFY coalesce(abs(last_price-lag(last_price) OVER (PARTITION BY symbol ORDER BY event_time))>1e-8, true)""",
    ["bars"],
)


def growth(c: str, n: int = 1, w: str = "s") -> str:
    return f"coalesce({c}/nullif(lag({c},{n}) OVER {w},0)-1,0)"


def frame(n: int) -> str:
    return f"(PARTITION BY symbol ORDER BY event_time ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def std(c: str, n: int, least: int) -> str:
    return f"CASE WHEN count({c}) OVER {frame(n)}>={least} THEN coalesce(stddev_samp({c}) OVER {frame(n)},0) ELSE 0 END"


def mean_20(c: str) -> str:
    return f"CASE WHEN count({c}) OVER {frame(20)}>=5 THEN avg({c}) OVER {frame(20)} END"


S = "WINDOW s AS (PARTITION BY symbol ORDER BY event_time)"
cte(
    "trend",
    f"""SELECT *, ma_20_gap AS price_vs_ma20, {std('return_1', 5, 2)} AS volatility_5, {std('return_1', 10, 3)} AS volatility_10, {std('return_1', 20, 5)} AS volatility_20
    FROM (SELECT *, change_pct/100 AS change_pct_scaled, {growth('last_price')} AS return_1, {growth('last_price', 3)} AS return_3,
      {growth('last_price', 5)} AS momentum_5, {growth('last_price', 10)} AS momentum_10, {growth('last_price', 20)} AS momentum_20,
      {growth('volume')} AS volume_change, {growth('turnover')} AS turnover_change,
      {', '.join(f"last_price/(avg(last_price) OVER {frame(n)})-1 AS ma_{n}_gap" for n in (5, 10, 20))},
      (high_price-low_price)/last_price AS high_low_range FROM rows {S})""",
    ["rows"],
)
cte(
    "drawdown",
    "SELECT symbol, event_time, "
    + ", ".join(
        f"""CASE WHEN len(p{n})>=2 THEN list_min(list_transform(range(1,len(p{n})+1), lambda i: p{n}[i]/list_max(p{n}[1:i])-1)) ELSE 0 END AS max_drawdown_{n}"""
        for n in (5, 10, 20)
    )
    + " FROM (SELECT symbol, event_time, "
    + ", ".join(f"list(last_price) OVER {frame(n)} AS p{n}" for n in (5, 10, 20))
    + " FROM rows)",
    ["rows"],
)
cte(
    "vols",
    f"""SELECT *, volume_ratio_20_raw-1 AS volume_ratio,
      CASE WHEN flow20>1e-8 THEN avg(flow) OVER {frame(5)}/flow20-1 ELSE 0 END AS money_flow_ratio,
      (volume_ratio_20_raw>=2)::INT::DOUBLE AS volume_spike_20, (return_1>0 AND volume_ratio_20_raw>=1.5)::INT::DOUBLE AS volume_up_breakout,
      (return_1<0 AND volume_ratio_20_raw>=1.5)::INT::DOUBLE AS volume_down_breakout,
      sum((volume_ratio_20_raw>=1.2)::INT) OVER {frame(3)}/3.0::DOUBLE AS volume_expansion_streak_3,
      sum((volume_ratio_20_raw>=1.2)::INT) OVER {frame(5)}/5.0::DOUBLE AS volume_expansion_streak_5,
      return_3*volume_ratio_20_raw AS return_3_x_volume_ratio_20, momentum_5*volume_ratio_20_raw AS momentum_5_x_volume_ratio_20,
      CASE WHEN count(*) OVER {frame(5)}>=3 THEN coalesce(covar_samp(volume,last_price) OVER {frame(5)}/nullif((stddev_samp(volume) OVER {frame(5)})*(stddev_samp(last_price) OVER {frame(5)}),0),0) ELSE 0 END AS volume_price_corr
    FROM (SELECT *, coalesce(volume/({mean_20('volume')}),1) AS volume_ratio_20_raw, coalesce(turnover/({mean_20('turnover')})-1,0) AS turnover_ratio,
      last_price*volume AS flow, {mean_20('last_price*volume')} AS flow20 FROM trend)""",
    ["trend"],
)
cte(
    "osc",
    f"""SELECT *, CASE WHEN hi-lo>1e-8 THEN (last_price-lo)/(hi-lo)-0.5 ELSE 0 END AS price_position_20,
      (coalesce(100-100/(1+g/nullif(l,0)),50)-50)/50 AS rsi_14,
      (volatility_5>volatility_20 AND volatility_20>0)::INT::DOUBLE AS vol_regime,
      CASE WHEN n3=3 THEN up3 ELSE 0 END/3.0::DOUBLE AS up_streak_3, CASE WHEN n3=3 THEN dn3 ELSE 0 END/3.0::DOUBLE AS down_streak_3
    FROM (SELECT *, min(last_price) OVER {frame(20)} AS lo, max(last_price) OVER {frame(20)} AS hi,
      avg(greatest(delta,0)) OVER {frame(14)} AS g, avg(greatest(-delta,0)) OVER {frame(14)} AS l,
      count(*) OVER {frame(3)} AS n3, sum((return_1>0)::INT) OVER {frame(3)} AS up3, sum((return_1<0)::INT) OVER {frame(3)} AS dn3
      FROM (SELECT *, coalesce(last_price-lag(last_price) OVER s,0) AS delta FROM trend {S}))""",
    ["trend"],
)
UNB = "(PARTITION BY symbol ORDER BY event_time ROWS UNBOUNDED PRECEDING)"


def ema(c: str, span: int) -> str:
    a = f"(2.0::DOUBLE/{span + 1})"
    return f"list_reduce(list({c}) OVER {UNB}, lambda a, x: a*(1-{a})+x*{a})"


cte(
    "macds",
    f"""SELECT symbol, event_time, m/last_price AS macd, sg/last_price AS macd_signal, (m-sg)/last_price AS macd_hist
    FROM (SELECT *, {ema('m', 9)} AS sg FROM (SELECT symbol, event_time, last_price, {ema('last_price', 12)}-{ema('last_price', 26)} AS m FROM rows))""",
    ["rows"],
)
cte(
    "index_days",
    f"""SELECT CAST(event_time AS DATE) AS day, symbol, return_1, return_3, return_5, {std('return_1', 5, 2)} AS volatility_5, {std('return_1', 10, 3)} AS volatility_10
    FROM (SELECT *, {growth('last_price')} AS return_1, {growth('last_price', 3)} AS return_3, {growth('last_price', 5)} AS return_5 FROM index_raw {S})""",
    ["index_raw"],
)
cte(
    "index_wide",
    "SELECT day, "
    + ", ".join(
        f"coalesce(max({m}) FILTER (symbol='{s}'),0) AS {p}_{m}" for s, p in fe.INDEX_PREFIXES.items() for m in fe.INDEX_MEASURES
    )
    + " FROM index_days GROUP BY day",
    ["index_days"],
)
OWN = ", ".join(
    f"CASE WHEN market='SH' THEN index_sh_{m} WHEN symbol LIKE '300%' THEN index_cyb_{m} ELSE index_hs300_{m} END AS market_index_{m}"
    for m in fe.INDEX_MEASURES
)
cte(
    "with_index",
    f"""SELECT *, {OWN} FROM (SELECT t.*, {', '.join(f'coalesce(i.{c},0) AS {c}' for c in fe.INDEX_COLUMNS)}
      FROM trend t LEFT JOIN index_wide i ON CAST(t.event_time AS DATE)=i.day)""",
    ["trend", "index_wide"],
)
RELATIVE = {
    "current_vs_market_index_return": "change_pct_scaled-market_index_return_1",
    "relative_sh_index_return_1": "return_1-index_sh_return_1",
    "relative_cyb_index_return_1": "return_1-index_cyb_return_1",
    "relative_hs300_return_1": "return_1-index_hs300_return_1",
    "relative_hs300_return_3": "return_3-index_hs300_return_3",
    "relative_hs300_return_5": "momentum_5-index_hs300_return_5",
    "relative_market_index_return_1": "return_1-market_index_return_1",
    "relative_market_index_return_3": "return_3-market_index_return_3",
    "relative_market_index_return_5": "momentum_5-market_index_return_5",
}
cte(
    "relative",
    f"""SELECT *, {', '.join(f'{v} AS {k}' for k, v in RELATIVE.items())},
      ({rnd(f'sum(market_index_return_1) OVER {frame(3)}', 9)}>0)::INT::DOUBLE AS index_up_3d FROM with_index""",
    ["with_index"],
)



def over(dim: str, call: str) -> str:
    return f"{call} OVER (PARTITION BY {dim}, event_time)"


def pct_rank(n: int) -> str:
    c = f"momentum_{n}"
    return f"""(rank() OVER (PARTITION BY sector,event_time ORDER BY {c})+(count(*) OVER (PARTITION BY sector,event_time,{c})-1)/2.0::DOUBLE)
      /count(*) OVER (PARTITION BY sector,event_time)-0.5 AS sector_return_rank_{n}"""


cte(
    "cross_stats",
    f"""SELECT *, {over('sector', 'avg(change_pct)')}/100 AS sector_avg_change_pct, (change_pct-{over('sector', 'avg(change_pct)')})/100 AS sector_relative_change,
      {over('market', 'avg(change_pct)')}/100 AS market_avg_change_pct, (change_pct-{over('market', 'avg(change_pct)')})/100 AS market_relative_change,
      {over('market', 'avg((change_pct>0)::INT)')}-0.5 AS market_up_ratio, {over('sector', 'avg((change_pct>0)::INT)')}-0.5 AS sector_up_ratio,
      {over('sector', 'avg(return_1)')} AS sector_return_1, {over('sector', 'avg(return_3)')} AS sector_return_3, {over('sector', 'avg(return_3)')} AS sector_momentum_3,
      {', '.join(f"{over('sector', f'avg(momentum_{n})')} AS sector_momentum_{n}" for n in (5, 10, 20))},
      {over('market', 'avg(momentum_5)')} AS market_momentum_5, {over('sector', 'avg(volatility_5)')} AS sector_volatility_5,
      {over('sector', 'avg((return_3>0)::INT)')}-0.5 AS sector_up_ratio_3, {', '.join(pct_rank(n) for n in (5, 10, 20))} FROM trend""",
    ["trend"],
)
cte(
    "cross_rows",
    f"""SELECT c.*, sector_relative_change AS relative_sector_change_pct, market_relative_change AS relative_market_change_pct,
      return_1-sector_return_1 AS sector_relative_return_1, return_3-sector_return_3 AS sector_relative_return_3,
      {', '.join(f'momentum_{n}-sector_momentum_{n} AS sector_relative_return_{n}' for n in (5, 10, 20))}, st.sector_strength_rank
    FROM cross_stats c JOIN (SELECT sector AS sec, event_time AS at, (rank() OVER (PARTITION BY event_time ORDER BY v)
        +(count(*) OVER (PARTITION BY event_time, v)-1)/2.0::DOUBLE)/count(*) OVER (PARTITION BY event_time)-0.5 AS sector_strength_rank
      FROM (SELECT sector, event_time, {rnd('any_value(sector_return_1)', 9)} AS v FROM cross_stats GROUP BY 1, 2)) st
      ON c.sector=st.sec AND c.event_time=st.at""",
    ["cross_stats"],
)


def shown(names: list[str]) -> str:
    return ", ".join(rnd(f"least(5,greatest(-5,{n}))", 6) + f" AS {n}" for n in names)


def output(df: DataFrame, names: list[str]) -> DataFrame:
    """Features rounded to 6 digits, with their key."""
    return rounded(fe.guard(df.select("symbol", "event_time", *names)), names)


def rounded(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(
        "symbol",
        F.date_format("event_time", "yyyy-MM-dd").alias("day"),
        *[stable_round_double(n, 6).alias(n) for n in names],
    )


def rows_of(spark, d) -> DataFrame:
    """Clean bars of one source without repeated prices."""
    build = lambda: fe.prepared_rows(fx.bars_raw(spark, d), fx.by_year(), ["event_id"])
    return fx.stored(spark, d, "prepared", build)


def index_days(spark, d) -> DataFrame:
    return fx.stored(spark, d, "index_features", lambda: fe.index_features(fx.index_raw(spark, d), fx.by_year()))


def placed_table(spark, d) -> DataFrame:
    """Those bars with their place in their symbol's rows."""
    return fx.stored(spark, d, "placed", lambda: fe.placed_rows(rows_of(spark, d), fx.by_year()))


def per_symbol(spark, d, names: list[str], with_index: bool = False) -> DataFrame:
    index = index_days(spark, d) if with_index else None
    return fe.placed_features(placed_table(spark, d), index, (), names, [])


def symbol_table(spark, d) -> DataFrame:
    """The per-symbol features that the cross section reads."""
    return fx.stored(spark, d, "cross_inputs", lambda: fe.cross_inputs(placed_table(spark, d)))


def cross_table(spark, d) -> DataFrame:
    return fx.stored(spark, d, "cross", lambda: fe.cross_table(symbol_table(spark, d)))


KEY = "symbol, strftime(event_time,'%Y-%m-%d') AS day"


SOURCE_OF: dict[str, str] = {}


def register(name: str, source: str, names: str, kind: str) -> None:
    columns = names.split()
    SOURCE_OF.update({c: source for c in columns})

    def run(spark, d):
        if kind == "symbol":
            df = per_symbol(spark, d, columns)
        elif kind == "index":
            df = per_symbol(spark, d, columns, True)
        else:
            df = fe.cross_section(symbol_table(spark, d).drop("pos"), ranks=kind == "ranks")
        return output(df, columns)

    query(name, with_ctes([source], f"SELECT {KEY}, {shown(columns)} FROM {source}"))(run)


register("fea_01_returns", "trend", "return_1 return_3 momentum_5 momentum_10 momentum_20 volume_change turnover_change", "symbol")
register("fea_02_ma_gaps", "trend", "ma_5_gap ma_10_gap ma_20_gap price_vs_ma20", "symbol")
register("fea_03_volume_ratio", "vols", "volume_ratio_20_raw volume_ratio turnover_ratio", "symbol")
register("fea_04_volatility", "trend", "volatility_5 volatility_10 volatility_20", "symbol")
register("fea_05_max_drawdown", "drawdown", "max_drawdown_5 max_drawdown_10 max_drawdown_20", "symbol")
register("fea_06_range", "trend", "high_low_range change_pct_scaled", "symbol")
register(
    "fea_07_cross_section",
    "cross_rows",
    "sector_avg_change_pct market_avg_change_pct sector_relative_change market_relative_change relative_sector_change_pct relative_market_change_pct sector_up_ratio market_up_ratio",
    "cross",
)
register(
    "fea_08_sector_returns",
    "cross_rows",
    "sector_return_1 sector_return_3 sector_momentum_3 sector_momentum_5 sector_momentum_10 sector_momentum_20 market_momentum_5 sector_volatility_5 sector_up_ratio_3",
    "cross",
)
register(
    "fea_09_sector_relative_returns", "cross_rows", " ".join(f"sector_relative_return_{n}" for n in (1, 3, 5, 10, 20)), "cross"
)
register("fea_10_sector_ranks", "cross_rows", "sector_return_rank_5 sector_return_rank_10 sector_return_rank_20", "ranks")
register("fea_11_sector_strength", "cross_rows", "sector_strength_rank", "cross")


@query(
    "fea_12_index_features",
    with_ctes(
        ["index_wide"],
        "SELECT strftime(day,'%Y-%m-%d') AS trade_date, " + ", ".join(f"{rnd(c, 6)} AS {c}" for c in fe.INDEX_COLUMNS) + " FROM index_wide",
    ),
)
def _(spark, d):
    days = fe.index_features(fx.index_raw(spark, d), fx.by_year())
    return days.select(
        F.date_format("trade_date", "yyyy-MM-dd").alias("trade_date"), *[stable_round(c, 6).alias(c) for c in fe.INDEX_COLUMNS]
    )


@query(
    "fea_13_attach_index",
    with_ctes(
        ["with_index"],
        f"SELECT {KEY}, " + ", ".join(f"{rnd(c, 6)} AS {c}" for c in fe.INDEX_COLUMNS) + " FROM with_index",
    ),
)
def _(spark, d):
    rows = fe.attach_index(rows_of(spark, d), index_days(spark, d))
    return rows.select(
        "symbol", F.date_format("event_time", "yyyy-MM-dd").alias("day"), *[stable_round(c, 6).alias(c) for c in fe.INDEX_COLUMNS]
    )


register("fea_14_market_index", "with_index", " ".join(f"market_index_{m}" for m in fe.INDEX_MEASURES), "index")
register("fea_15_relative_index", "relative", " ".join(RELATIVE), "index")
register("fea_16_index_up_3d", "relative", "index_up_3d", "index")
register("fea_17_rsi", "osc", "rsi_14", "symbol")
register("fea_18_macd", "macds", "macd macd_signal macd_hist", "symbol")
register("fea_19_money_flow", "vols", "money_flow_ratio", "symbol")
register("fea_20_price_position", "osc", "price_position_20", "symbol")
register("fea_21_vol_regime", "osc", "vol_regime", "symbol")
register("fea_22_streaks", "osc", "up_streak_3 down_streak_3", "symbol")
register(
    "fea_23_volume_breakouts",
    "vols",
    "volume_spike_20 volume_up_breakout volume_down_breakout volume_expansion_streak_3 volume_expansion_streak_5",
    "symbol",
)
register("fea_24_interactions", "vols", "return_3_x_volume_ratio_20 momentum_5_x_volume_ratio_20", "symbol")
register("fea_25_volume_price_corr", "vols", "volume_price_corr", "symbol")


def full_frame(spark, d, names: list[str] | None = None, kept: list[str] | None = None) -> DataFrame:
    """The whole feature list over all bars, as the model jobs read it: written once.

    With `names`, every row with these features, the future prices and the columns `kept` only. Such a narrow frame is made when it
    is read, as the whole one takes twenty times the room of the bars.
    """
    make = lambda: fe.framed(placed_table(spark, d), cross_table(spark, d), index_days(spark, d), fe.HORIZONS, names, kept)
    return fx.stored(spark, d, "features", make) if names is None else make()


@query(
    "fea_26_guarded_range",
    with_ctes(
        ["rows"],
        " UNION ALL ".join(f"SELECT '{c}' AS feature, count(*) AS rows, 0 AS bad FROM rows" for c in fe.FEATURES),
    ),
)
def _(spark, d):
    """Every feature is finite and within [-5, 5] on every row."""
    df = full_frame(spark, d)
    bad = [
        F.sum(F.when(F.col(c).isNull() | F.isnan(c) | (F.abs(c) > 5), 1).otherwise(0)).alias(c) for c in fe.FEATURES
    ]
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *bad)
    return wide.unpivot(["rows"], fe.FEATURES, "feature", "bad")


SOURCE_OF.update({c: "relative" for c in [*fe.INDEX_COLUMNS, *[f"market_index_{m}" for m in fe.INDEX_MEASURES]]})
PARTS = ["trend", "drawdown", "vols", "osc", "macds", "relative", "cross_rows"]
ALL_COLUMNS = ", ".join(f"{rnd(f'least(5,greatest(-5,{SOURCE_OF[c]}.{c}))', 6)} AS {c}" for c in fe.FEATURES)
JOINS = " ".join(f"JOIN {p} ON {p}.symbol=rows.symbol AND {p}.event_time=rows.event_time" for p in PARTS)


@query(
    "fea_27_feature_frame",
    with_ctes(
        ["rows", *PARTS],
        f"SELECT rows.symbol, strftime(rows.event_time,'%Y-%m-%d') AS day, {ALL_COLUMNS} FROM rows {JOINS}",
    ),
)
def _(spark, d):
    """Raw bars to the full feature list, from the first step to the last."""
    df = fe.feature_frame(fx.bars_raw(spark, d), fx.index_raw(spark, d), fx.by_year(), ["event_id"])
    return rounded(df, fe.FEATURES)  # guarded by the last step
