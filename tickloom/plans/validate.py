"""Registered queries for projection, cleaning and validation (VAL)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.functions import quotes as q
from tickloom.operators import cleaning
from tickloom.plans import fixtures as fx
from tickloom.plans.oracle import ANY_FAULT, FAULT_SQL, STREAM_FILTER, cte, limit_sql, pct, rnd, with_ctes
from tickloom.plans.registry import query
from tickloom.schema import time_text


def codes(spark, d) -> DataFrame:
    """Symbol codes of every shape, with and without a market hint."""
    e = F.col("event_id")
    return fx.table(spark, d, "events").select(
        e.alias("id"),
        F.when(e % 4 < 2, F.lpad((e * 7919 % 1000000).cast("string"), 6, "0"))
        .when(e % 4 == 2, F.lpad((e * 31 % 100000).cast("string"), 5, "0"))
        .otherwise(F.concat(F.lit(" x"), e.cast("string")))
        .alias("symbol"),
        F.when(e % 5 == 0, "hk").when(e % 5 == 1, "Us").when(e % 5 == 2, "INDEX").otherwise("").alias("market"),
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


cte(
    "codes",
    """SELECT event_id AS id, CASE WHEN event_id%4<2 THEN lpad(CAST(event_id*7919%1000000 AS VARCHAR),6,'0')
      WHEN event_id%4=2 THEN lpad(CAST(event_id*31%100000 AS VARCHAR),5,'0') ELSE ' x'||event_id END AS symbol,
      CASE event_id%5 WHEN 0 THEN 'hk' WHEN 1 THEN 'Us' WHEN 2 THEN 'INDEX' ELSE '' END AS market, value,
      CAST(json_extract_string(props,'$.k') AS INT) AS k FROM events""",
)
GUESS = """CASE WHEN regexp_matches(trim(symbol),'^6[0-9]{5}$') THEN 'SH' WHEN regexp_matches(trim(symbol),'^[03][0-9]{5}$') THEN 'SZ'
  WHEN regexp_matches(trim(symbol),'^[48][0-9]{5}$') THEN 'BJ' WHEN regexp_matches(trim(symbol),'^[0-9]{5}$') THEN 'HK' ELSE 'UNKNOWN' END"""
MARKET = f"CASE WHEN market<>'' THEN upper(market) ELSE {GUESS} END"
cte("coded", f"SELECT *, {MARKET} AS m, upper(trim(symbol)) AS s FROM codes", ["codes"])


@query("val_01_detect_market", with_ctes(["coded"], f"SELECT id, m AS market, {GUESS} AS guessed FROM coded"))
def _(spark, d):
    return codes(spark, d).select(
        "id", q.detect_market("symbol", "market").alias("market"), q.detect_market("symbol").alias("guessed")
    )


@query(
    "val_02_change_pct",
    with_ctes(
        ["codes"],
        f"SELECT id, {pct('value', 'p')} AS change_pct FROM (SELECT *, CASE WHEN k%10=0 THEN 0 ELSE value+k END AS p FROM codes)",
    ),
)
def _(spark, d):
    rows = codes(spark, d).withColumn("p", F.when(F.col("k") % 10 == 0, 0.0).otherwise(F.col("value") + F.col("k")))
    return rows.select("id", q.change_pct("value", "p").alias("change_pct"))


@query(
    "val_03_change_limit",
    with_ctes(["coded"], f"SELECT id, CAST({limit_sql('m', 's')} AS DOUBLE) AS change_limit FROM coded"),
)
def _(spark, d):
    return codes(spark, d).select("id", q.change_limit("symbol", "market").alias("change_limit"))


OHLC = """least(open_price,high_price,low_price,last_price)>0 AND previous_close>0
  AND open_price BETWEEN low_price AND high_price AND last_price BETWEEN low_price AND high_price"""


@query(
    "val_04_valid_ohlc",
    with_ctes(
        ["bars_raw"],
        f"SELECT event_id, ({OHLC} AND volume>0) AS valid, ({OHLC}) AS valid_without_volume FROM bars_raw",
    ),
)
def _(spark, d):
    return fx.bars_raw(spark, d).select(
        "event_id", q.is_valid_ohlc().alias("valid"), q.is_valid_ohlc(False).alias("valid_without_volume")
    )


TICK_FIELDS = "event_id, market, symbol, open_price, high_price, low_price, last_price, previous_close, change_pct"


@query(
    "val_05_valid_tick",
    with_ctes(
        ["bars_raw", "index_raw", "ticks_raw"],
        f"""SELECT event_id, ({OHLC} AND (market='INDEX' OR volume>0) AND coalesce(abs(change_pct)<{limit_sql()},false)) AS valid
        FROM (SELECT {TICK_FIELDS}, volume FROM bars_raw UNION ALL SELECT {TICK_FIELDS}, 0 FROM index_raw
          UNION ALL SELECT {TICK_FIELDS}, volume FROM ticks_raw)""",
    ),
)
def _(spark, d):
    cols = [*TICK_FIELDS.split(", "), "volume"]
    silent = fx.index_raw(spark, d).withColumn("volume", F.lit(0).cast("long"))
    rows = (
        fx.bars_raw(spark, d).select(*cols).unionByName(silent.select(*cols)).unionByName(
            fx.ticks_raw(spark, d).select(*cols)
        )
    )
    return rows.select("event_id", q.is_valid_tick().alias("valid"))


def untidy(spark, d) -> DataFrame:
    """Ticks with blank, padded and missing text."""
    i = F.col("id")
    return fx.ticks_raw(spark, d).select(
        "id",
        F.concat(F.lit(" "), F.lower("symbol"), F.lit(" ")).alias("symbol"),
        F.when(i % 3 == 0, "  ").when(i % 3 == 1, F.concat(F.lit(" "), "company_name")).alias("company_name"),
        F.when(i % 4 > 0, F.concat("category", F.lit(" "))).alias("category"),
        F.when(i % 5 == 0, "").otherwise(F.col("sector")).alias("sector"),
        F.when(i % 2 == 0, F.lower("market")).alias("market"),
    )


@query(
    "val_06_normalize_text",
    with_ctes(
        ["ticks_raw"],
        """SELECT id, symbol, CASE WHEN id%3=1 THEN company_name ELSE symbol END AS company_name,
        CASE WHEN id%4>0 THEN category ELSE 'Unknown' END AS category, CASE WHEN id%5=0 THEN 'Other' ELSE sector END AS sector,
        CASE WHEN id%2=0 THEN market ELSE 'UNKNOWN' END AS market FROM ticks_raw""",
    ),
)
def _(spark, d):
    return untidy(spark, d).withColumns(q.normalized_text())


def raw_numbers(spark, d) -> DataFrame:
    i, k = F.col("id"), F.col("k")
    return codes(spark, d).select(
        "id",
        F.when(i % 6 == 0, "--")
        .when(i % 6 == 1, " ")
        .when(i % 6 == 2, F.concat(F.lit(" "), (k + 1).cast("string"), F.lit(","), F.lpad((i % 1000).cast("string"), 3, "0")))
        .when(i % 6 == 3, F.concat(F.lit("-"), k.cast("string"), F.lit(".75 ")))
        .when(i % 6 == 4, "abc")
        .otherwise((i * 137).cast("string"))
        .alias("raw"),
    )


cte(
    "raw_numbers",
    """SELECT id, CASE id%6 WHEN 0 THEN '--' WHEN 1 THEN ' ' WHEN 2 THEN ' '||(k+1)||','||lpad(CAST(id%1000 AS VARCHAR),3,'0')
      WHEN 3 THEN '-'||k||'.75 ' WHEN 4 THEN 'abc' ELSE CAST(id*137 AS VARCHAR) END AS raw FROM codes""",
    ["codes"],
)
AS_DOUBLE = "coalesce(TRY_CAST(trim(raw) AS DOUBLE),0)"


@query(
    "val_07_safe_numbers",
    with_ctes(
        ["raw_numbers"],
        f"""SELECT id, {AS_DOUBLE} AS as_double,
        CAST(coalesce(trunc(TRY_CAST(replace(trim(raw),',','') AS DOUBLE)),-1) AS BIGINT) AS as_long FROM raw_numbers""",
    ),
)
def _(spark, d):
    return raw_numbers(spark, d).select(
        "id", q.safe_double("raw").alias("as_double"), q.safe_long("raw", -1).alias("as_long")
    )


@query(
    "val_08_scaled_price",
    with_ctes(
        ["raw_numbers"],
        f"SELECT id, CASE WHEN abs(x)>=100000 THEN {rnd('x/100', 2)} ELSE {rnd('x', 2)} END AS price FROM (SELECT id, {AS_DOUBLE} AS x FROM raw_numbers)",
    ),
)
def _(spark, d):
    return raw_numbers(spark, d).select("id", q.scaled_price("raw").alias("price"))


def _vendor_sql(sh: str, sz: str, hk: str) -> str:
    padded = "CASE WHEN length(s)<5 THEN lpad(s,5,'0') ELSE s END"
    return f"CASE m WHEN 'SH' THEN '{sh}'||s WHEN 'SZ' THEN '{sz}'||s WHEN 'BJ' THEN '{sz}'||s WHEN 'HK' THEN '{hk}'||{padded} END"


@query(
    "val_09_vendor_codes",
    with_ctes(
        ["coded"],
        f"""SELECT id, {_vendor_sql('1.', '0.', '116.')} AS eastmoney, {_vendor_sql('sh', 'sz', 'rt_hk')} AS sina,
        {_vendor_sql('sh', 'sz', 'hk')} AS tencent, m NOT IN ('SH','SZ','BJ','HK') AS rejected FROM coded""",
    ),
)
def _(spark, d):
    codes_of = [q.vendor_code(v, "symbol", "market").alias(v) for v in q.VENDOR_PREFIXES]
    return codes(spark, d).select("id", *codes_of).withColumn("rejected", F.col("sina").isNull())


@query(
    "val_10_canonical_quote",
    with_ctes(
        ["ticks_raw"],
        f"""SELECT id, {rnd('open_price*1.00123', 2)} AS open_price, {rnd('high_price*1.00123', 2)} AS high_price,
        {rnd('low_price*1.00123', 2)} AS low_price, {rnd('last_price*1.00123', 2)} AS last_price, {rnd('previous_close', 2)} AS previous_close,
        {pct('last_price*1.00123', 'previous_close')} AS change_pct, volume, {rnd('last_price*1.00123*volume', 2)} AS turnover FROM ticks_raw""",
    ),
)
def _(spark, d):
    cols = ["open_price", "high_price", "low_price", "last_price"]
    rows = fx.ticks_raw(spark, d).withColumns({c: F.col(c) * 1.00123 for c in cols})
    return rows.withColumns(q.canonical_quote()).select(
        "id", *cols, "previous_close", "change_pct", "volume", "turnover"
    )


@query(
    "val_11_stream_filter",
    with_ctes(
        ["ticks_raw"],
        f"SELECT event_id, symbol, market, last_price, change_pct, volume, strftime(event_time,'%Y-%m-%d %H:%M:%S') AS event_time FROM ticks_raw WHERE {STREAM_FILTER}",
    ),
)
def _(spark, d):
    return fx.ticks(spark, d).select(
        "event_id", "symbol", "market", "last_price", "change_pct", "volume", time_text("event_time").alias("event_time")
    )


@query(
    "val_11_stream_filter_shared_limits",
    with_ctes(
        ["ticks_raw"],
        f"""SELECT event_id, symbol FROM ticks_raw WHERE volume>0 AND least(open_price,high_price,low_price,last_price,previous_close)>0
        AND open_price BETWEEN low_price AND high_price AND last_price BETWEEN low_price AND high_price AND abs(change_pct)<{limit_sql()}""",
    ),
)
def _(spark, d):
    return fx.ticks_raw(spark, d).where(q.passes_stream_filter("shared")).select("event_id", "symbol")


def captured(spark, d) -> DataFrame:
    """Every tick as captured from three vendors; some vendors' copies are broken."""
    vendors = F.explode(F.array(*[F.lit(v) for v in q.VENDOR_PREFIXES])).alias("vendor")
    i = F.col("id")
    broken = ((F.col("source") == "sina") & (i % 2 == 0)) | ((F.col("source") == "tencent") & (i % 3 == 0))
    return (
        fx.ticks_raw(spark, d)
        .select("*", vendors)
        .withColumn("source", F.col("vendor"))
        .withColumn("volume", F.when(broken, F.lit(0)).otherwise(F.col("volume")))
    )


@query(
    "val_13_source_fallback",
    with_ctes(
        ["ticks_raw"],
        f"""SELECT symbol, source, event_id, last_price FROM (
        SELECT * REPLACE (CASE WHEN (source='sina' AND id%2=0) OR (source='tencent' AND id%3=0) THEN 0 ELSE volume END AS volume),
          CASE WHEN market IN ('SH','SZ','BJ') THEN list_position(['sina','tencent','eastmoney'],source)
            ELSE list_position(['eastmoney','sina','tencent'],source) END AS source_rank
        FROM (SELECT t.* EXCLUDE (source), v.source FROM ticks_raw t, (VALUES ('eastmoney'),('sina'),('tencent')) AS v(source)))
        WHERE {OHLC} AND volume>0 AND abs(change_pct)<{limit_sql()}
        QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY source_rank, created_at, id)=1""",
    ),
)
def _(spark, d):
    rows = cleaning.first_valid_quote(captured(spark, d), ["yahoo", "eastmoney", "sina", "tencent"], ["created_at", "id"])
    return rows.select("symbol", "source", "event_id", "last_price")


def _sent(c: str) -> str:
    """A price as it comes back: one vendor sends cents, which are read as such from 100000 up."""
    return f"CASE WHEN id%3=0 AND round({c}*100)<100000 THEN round({c}*100) ELSE {c} END AS {c}"


@query(
    "val_12_vendor_payloads",
    with_ctes(
        ["ticks_raw"],
        f"""SELECT id, symbol, market, company_name, category, sector, source, open_price, high_price, low_price, last_price, previous_close, volume,
        {pct('last_price', 'previous_close')} AS change_pct, {rnd('last_price*volume', 2)} AS turnover FROM (
        SELECT id, symbol, market, company_name, category, sector, CASE id%3 WHEN 0 THEN 'eastmoney' WHEN 1 THEN 'sina' ELSE 'tencent' END AS source,
        {', '.join(map(_sent, ('open_price', 'high_price', 'low_price', 'last_price', 'previous_close')))}, volume FROM ticks_raw)""",
    ),
)
def _(spark, d):
    """Vendor payload strings of three formats, built from the ticks and parsed back."""
    from tickloom.sources.captures import parse_vendor_payloads, vendor_payloads

    return parse_vendor_payloads(vendor_payloads(fx.ticks_raw(spark, d)))


def vendor_daily(spark, d) -> DataFrame:
    """Bars as a vendor's text rows; closes of 0 are planted."""
    broken = (F.col("k") + F.dayofyear("trade_date")) % 53 == 0
    text = lambda c: F.col(c).cast("decimal(20,2)").cast("string")
    return fx.bars_raw(spark, d).select(
        "symbol", "company_name", "category", "sector", "market",
        F.date_format("trade_date", "yyyy/MM/dd").alias("date"),
        text("open_price").alias("open"),
        text("high_price").alias("high"),
        text("low_price").alias("low"),
        F.when(broken, "--").otherwise(text("last_price")).alias("close"),
        F.col("volume").cast("string").alias("volume"),
        text("turnover").alias("amount"),
    )


@query(
    "val_14_vendor_daily_rows",
    with_ctes(
        ["bars_raw"],
        """SELECT 'cold-akshare-'||symbol||'-'||strftime(trade_date,'%Y%m%d') AS event_id, close AS last_price, close AS previous_close, 0.0::DOUBLE AS change_pct,
        volume, turnover, strftime(trade_date,'%Y-%m-%d')||' 15:00:00' AS event_time
        FROM (SELECT *, CASE WHEN (k+dayofyear(trade_date))%53=0 THEN 0.0::DOUBLE ELSE last_price END AS close FROM bars_raw)""",
    ),
)
def _(spark, d):
    bars = cleaning.normalise_daily(vendor_daily(spark, d))
    return bars.select("event_id", "last_price", "previous_close", "change_pct", "volume", "turnover", time_text("event_time").alias("event_time"))


@query(
    "val_15_chained_close",
    with_ctes(
        ["bars_raw"],
        f"""SELECT event_id, close AS last_price, {rnd('prev', 2)} AS previous_close, {pct('close', 'prev')} AS change_pct FROM (
         SELECT *, coalesce(last_value(CASE WHEN close>0 THEN close END IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY event_time
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), close) AS prev
         FROM (SELECT *, CASE WHEN (k+dayofyear(trade_date))%53=0 THEN 0 ELSE last_price END AS close FROM bars_raw))
        WHERE least(open_price,high_price,low_price,close)>0 AND prev>0 AND volume>0
          AND open_price BETWEEN low_price AND high_price AND close BETWEEN low_price AND high_price
          AND abs({pct('close', 'prev')})<{limit_sql()}""",
    ),
)
def _(spark, d):
    rows = vendor_daily(spark, d)
    chained = cleaning.chain_previous_close(rows, ["symbol"], ["date"], F.substring("date", 1, 4))
    bars = cleaning.normalise_daily(chained, vendor="sina").where(q.is_valid_tick())
    return bars.select("event_id", "last_price", "previous_close", "change_pct")


@query(
    "val_16_trade_date",
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey%4=3 THEN NULL ELSE strftime(l_shipdate,'%Y-%m-%d') END AS trade_date FROM lineitem",
)
def _(spark, d):
    day, p = F.col("l_shipdate"), F.col("l_partkey") % 4
    text = (
        F.when(p == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(p == 1, F.date_format(day, "yyyy/MM/dd HH:mm:ss"))
        .when(p == 2, F.date_format(day, "yyyyMMdd"))
        .otherwise("n/a")
    )
    return fx.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", q.trade_date(text).cast("string").alias("trade_date")
    )


@query(
    "val_17_clean_bars",
    with_ctes(
        ["bars"],
        "SELECT event_id, symbol, last_price, previous_close, change_pct, volume, turnover FROM bars",
    ),
)
def _(spark, d):
    raw = fx.bars_raw(spark, d)
    doubled = raw.unionByName(raw.withColumn("event_id", F.concat(F.lit("a"), "event_id")))
    return cleaning.clean_bars(doubled, ["event_id"]).select(
        "event_id", "symbol", "last_price", "previous_close", "change_pct", "volume", "turnover"
    )


@query(
    "val_17_quality_report",
    with_ctes(
        ["bars_raw"],
        f"""SELECT 2*count(*) AS input_rows, count(*) FILTER (NOT ({ANY_FAULT})) AS output_rows,
        2*count(*) - count(*) FILTER (NOT ({ANY_FAULT})) AS dropped_rows,
        {', '.join(f'2*count(*) FILTER ({v}) AS invalid_{k}_rows' for k, v in FAULT_SQL.items())},
        count(*) FILTER (NOT ({ANY_FAULT})) AS duplicate_rows FROM bars_raw""",
    ),
)
def _(spark, d):
    raw = fx.bars_raw(spark, d)
    return cleaning.quality_report(raw.unionByName(raw))


def two_sources(spark, d) -> DataFrame:
    """Ticks and bars of several sources per symbol."""
    rows = fx.ticks(spark, d)
    renamed = F.when(F.col("id") % 3 == 0, "sina").when(F.col("id") % 11 == 0, "tencent").otherwise(F.col("source"))
    return rows.withColumn("source", F.when(F.col("user_id") % 2 == 0, renamed).otherwise(F.col("source")))


@query(
    "val_18_training_source",
    with_ctes(
        ["ticks"],
        """, src AS (SELECT * REPLACE (CASE WHEN user_id%2<>0 THEN source WHEN id%3=0 THEN 'sina' WHEN id%11=0 THEN 'tencent' ELSE source END AS source) FROM ticks),
        best AS (SELECT symbol, source FROM (SELECT symbol, source, count(*) AS c FROM src GROUP BY ALL)
          QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY coalesce(list_position(['akshare_cold_start','sina','tencent','eastmoney'],source),99), c DESC, source)=1)
        SELECT event_id, symbol, source FROM src SEMI JOIN best USING (symbol, source)""",
    ).replace(")\n, src", "),\nsrc"),
)
def _(spark, d):
    return cleaning.select_training_sources(two_sources(spark, d)).select("event_id", "symbol", "source")


@query(
    "val_19_collapse_repeats",
    with_ctes(
        ["bars"],
        """SELECT event_id, symbol, last_price FROM bars
        QUALIFY coalesce(abs(last_price-lag(last_price) OVER (PARTITION BY symbol ORDER BY event_time))>1e-8, true)""",
    ),
)
def _(spark, d):
    return cleaning.collapse_repeats(fx.bars(spark, d), fx.by_year()).select("event_id", "symbol", "last_price")


@query(
    "val_20_watch_list",
    with_ctes(
        ["codes"],
        f"""SELECT symbol, coalesce(company_name, symbol) AS company_name, coalesce(category,'A Share Cold Start') AS category,
        coalesce(sector,'Other') AS sector, m AS market FROM (
        SELECT w.symbol, c.company_name, c.category, c.sector, coalesce(c.market, {GUESS.replace('symbol', 'w.symbol')}) AS m
        FROM (SELECT DISTINCT upper(trim(symbol)) AS symbol FROM codes) w
        LEFT JOIN (SELECT DISTINCT lpad(CAST(s_suppkey AS VARCHAR),6,'0') AS symbol, s_name AS company_name, 'Supplier' AS category,
           CASE WHEN s_nationkey%2=0 THEN 'Nation' END AS sector, CASE s_nationkey%3 WHEN 0 THEN 'SH' WHEN 1 THEN 'HK' ELSE 'SZ' END AS market FROM supplier) c ON w.symbol=c.symbol)
        WHERE m IN ('SH','SZ','BJ')""",
    ),
)
def _(spark, d):
    n = F.col("s_nationkey")
    catalogue = fx.table(spark, d, "supplier").select(
        F.lpad(F.col("s_suppkey").cast("string"), 6, "0").alias("symbol"),
        F.col("s_name").alias("company_name"),
        F.lit("Supplier").alias("category"),
        F.when(n % 2 == 0, "Nation").alias("sector"),
        F.when(n % 3 == 0, "SH").when(n % 3 == 1, "HK").otherwise("SZ").alias("market"),
    )
    return cleaning.watch_list(codes(spark, d), catalogue)
