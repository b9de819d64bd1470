"""The derived tables of `fixtures.py` as DuckDB common table expressions."""

from __future__ import annotations


def rnd(expr: str, digits: int) -> str:
    """The SQL side of `stable_round`."""
    return f"CAST(round(CAST(({expr}) AS DECIMAL(38,9)), {digits}) AS DOUBLE)"


def money(expr: str) -> str:
    """The SQL side of `money_sum`."""
    return f"CAST(sum(CAST({expr} AS DECIMAL(20,2))) AS DOUBLE)"


CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, sql: str, deps: list[str] | None = None) -> None:
    CTES[name] = (deps or [], sql)


def with_ctes(names: list[str], body: str) -> str:
    """`body` behind the expressions it needs, in dependency order."""
    done: list[str] = []

    def add(name: str) -> None:
        if name not in done:
            for dep in CTES[name][0]:
                add(dep)
            done.append(name)

    for name in names:
        add(name)
    parts = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in done)
    return f"WITH {parts}\n{body}"


def pct(value: str, previous: str) -> str:
    return f"coalesce({rnd(f'({value}-{previous})/nullif({previous},0)*100', 4)}, 0)"


cte(
    "ticks_raw",
    f"""
 SELECT *, {rnd('last_price*volume', 2)} AS turnover FROM (
  SELECT *, greatest(open_price,last_price) AS high_price, least(open_price,last_price) AS low_price FROM (
   SELECT *, {rnd('previous_close*(1+change_pct/100)', 2)} AS last_price FROM (
    SELECT event_id AS id, 'e'||event_id AS event_id, user_id,
      'U'||lpad(CAST(user_id AS VARCHAR),5,'0') AS symbol, 'User '||user_id AS company_name,
      'C'||(user_id%5) AS category, 'S'||(user_id%7) AS sector,
      CASE user_id%4 WHEN 0 THEN 'SH' WHEN 1 THEN 'SZ' WHEN 2 THEN 'BJ' ELSE 'HK' END AS market,
      {rnd('value', 2)} AS open_price, {rnd('value', 2)} AS previous_close,
      {rnd("(CAST(json_extract_string(props,'$.k') AS INT)-50)*0.24", 4)} AS change_pct,
      CAST(json_extract_string(props,'$.k') AS BIGINT)*100000 AS volume,
      ts AS event_time, ts AS created_at, event_type AS source
    FROM events)))
""",
)
STREAM_FILTER = """length(symbol)>0 AND event_time IS NOT NULL AND open_price>0 AND high_price>0 AND low_price>0
  AND last_price>0 AND previous_close>0 AND volume>0
  AND open_price BETWEEN low_price AND high_price AND last_price BETWEEN low_price AND high_price
  AND ((market IN ('SH','SZ','BJ') AND abs(change_pct)<11) OR (market='HK' AND abs(change_pct)<30)
    OR (market IN ('US','NASDAQ','NYSE') AND abs(change_pct)<25))"""
cte("ticks", f"SELECT * FROM ticks_raw WHERE {STREAM_FILTER}", ["ticks_raw"])
cte("clock", "SELECT max(created_at) AS now FROM ticks", ["ticks"])
cte(
    "latest",
    "SELECT * FROM ticks QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY created_at DESC, id DESC)=1",
    ["ticks"],
)
cte(
    "baseline",
    f"""SELECT symbol, coalesce({rnd('avg(abs(change_pct))', 6)},0) AS avg_abs_change_pct,
      coalesce({rnd('avg(volume)', 6)},0) AS avg_volume
    FROM ticks, clock WHERE created_at >= now - INTERVAL 1 DAY GROUP BY symbol""",
    ["ticks", "clock"],
)


def alert_sql(rows: str, base: str) -> str:
    return f"""
 SELECT * EXCLUDE (m, v, floor_volume, p1, v1, p2, v2),
   CASE WHEN p1 AND v1 THEN 'price_and_volume' WHEN p1 THEN 'price_volatility' ELSE 'volume_spike' END AS alert_type,
   CASE WHEN p2 OR (p1 AND v1) OR v2 THEN 'HIGH' ELSE 'MEDIUM' END AS alert_level,
   {rnd('greatest(2.0, m*2.5)', 2)} AS price_threshold,
   CAST({rnd('greatest(floor_volume, v*2)', 0)} AS BIGINT) AS volume_threshold
 FROM (SELECT *, abs(change_pct) >= greatest(2.0, m*2.5) AS p1, volume >= greatest(floor_volume, v*2) AS v1,
     abs(change_pct) >= greatest(4.0, m*4.0) AS p2, v > 0 AND volume >= greatest(floor_volume*2, v*4) AS v2
   FROM (SELECT t.*, coalesce(b.avg_abs_change_pct, 0) AS m, coalesce(b.avg_volume, 0) AS v,
       CASE WHEN market IN ('SH','SZ','BJ') THEN 5000000.0 ELSE 1000000.0 END AS floor_volume
     FROM {rows} t LEFT JOIN {base} b ON t.symbol = b.symbol))
 WHERE p1 OR v1"""


cte("alerts", alert_sql("ticks", "baseline"), ["ticks", "baseline"])
cte(
    "actions",
    """SELECT id AS alert_id, CASE id%3 WHEN 0 THEN 'RESOLVED' ELSE 'ACKED' END AS status, 'note '||id AS note,
      'user' AS handled_by, created_at + INTERVAL 5 MINUTE AS handled_at FROM alerts WHERE id%3 < 2""",
    ["alerts"],
)
cte(
    "snapshots",
    f"""SELECT strftime(event_time, '%Y-%m-%d %H:%M:00') AS window_bucket, id%4 AS batch_id,
      count(DISTINCT symbol) AS symbol_count, {rnd('avg(last_price)', 2)} AS avg_price,
      {rnd('avg(change_pct)', 4)} AS avg_change_pct, CAST(sum(volume) AS BIGINT) AS total_volume,
      {money('turnover')} AS total_turnover, max(event_time) AS latest_event_time
    FROM ticks GROUP BY 1, 2""",
    ["ticks"],
)


def confidence(down: str = "prob_down", up: str = "prob_up", flat: str = "prob_flat") -> str:
    return f"""least(0.95, greatest(0, CASE WHEN {flat} >= greatest({down},{up})
      THEN 0.5+0.5*least(1,greatest(0,abs({up}-{down})))
      ELSE 0.5+0.5*least(1,greatest(0,(greatest({down},{up},{flat})-1/3.0::DOUBLE)/(1-1/3.0::DOUBLE))) END))"""


def _signal(bound: float) -> str:
    return f"CASE WHEN prob_down>={bound} THEN 'DOWN' WHEN prob_up>={bound} THEN 'UP' ELSE 'WATCH' END"


cte(
    "predictions",
    f"""
 SELECT user_id AS id, symbol, company_name, category, sector, last_price AS current_price,
   {rnd('last_price*(1+(prob_up-prob_down)*0.02)', 2)} AS predicted_next_price, prob_down, prob_up, prob_flat,
   {_signal(0.5)} AS predicted_signal,
   CASE WHEN user_id%10=0 THEN '' ELSE {_signal(0.6)} END AS alert_signal,
   {rnd(confidence(), 4)} AS confidence, {rnd('prob_down', 4)} AS model_risk_score,
   {rnd('prob_down*0.8', 4)} AS technical_risk_score, {rnd('prob_up*0.5', 4)} AS sequence_risk_score,
   {rnd('prob_down', 4)} AS final_risk_score, 'ensemble-daily-1' AS model_version, created_at
 FROM (SELECT *, {rnd('1-prob_down-prob_up', 6)} AS prob_flat FROM (
   SELECT *, {rnd('(user_id*17%100)/100.0::DOUBLE*(1-prob_down)', 6)} AS prob_up FROM (
     SELECT *, (user_id*37%100)/100.0::DOUBLE AS prob_down FROM latest)))
""",
    ["latest"],
)


def _bar_sql(key: str, scale: int) -> str:
    spread = lambda e: rnd(f"{scale}*(0.95+{e})", 2)
    return f"""SELECT {key} AS k, CAST(l_shipdate AS DATE) AS trade_date,
      {spread('avg(l_discount)')} AS last_price, {spread('(max(l_discount)+min(l_discount))/2')} AS open_price,
      {spread('max(l_discount)')} AS high_price, {spread('min(l_discount)')} AS low_price,
      CAST(sum(l_quantity)*1000 AS BIGINT) AS volume, {rnd('sum(l_extendedprice)', 2)} AS turnover,
      CAST(l_shipdate AS DATE) + INTERVAL 15 HOUR AS event_time,
      CAST(l_shipdate AS DATE) + INTERVAL 15 HOUR AS created_at
    FROM lineitem GROUP BY {key}, CAST(l_shipdate AS DATE)"""


cte(
    "bars_raw",
    f"""
 SELECT *, {pct('last_price', 'previous_close')} AS change_pct,
   'cold-akshare-'||symbol||'-'||strftime(trade_date,'%Y%m%d') AS event_id FROM (
  SELECT *, coalesce(lag(last_price) OVER (PARTITION BY symbol ORDER BY event_time), open_price) AS previous_close FROM (
   SELECT * REPLACE (CASE WHEN (k+dayofyear(trade_date))%89=0 THEN low_price-1 ELSE high_price END AS high_price,
       CASE WHEN (k+dayofyear(trade_date))%97=0 THEN 0 ELSE volume END AS volume),
     CASE k%4 WHEN 0 THEN '60' WHEN 1 THEN '30' WHEN 2 THEN '00' ELSE '80' END||lpad(CAST(k AS VARCHAR),4,'0') AS symbol,
     'Supplier '||k AS company_name, 'C'||(k%5) AS category, 'S'||(k%7) AS sector,
     CASE k%4 WHEN 0 THEN 'SH' WHEN 3 THEN 'BJ' ELSE 'SZ' END AS market, 'akshare_cold_start' AS source
   FROM ({_bar_sql('l_suppkey', 100)})))
""",
)
cte(
    "index_raw",
    f"""
 SELECT *, {pct('last_price', 'previous_close')} AS change_pct,
   'index-akshare-'||symbol||'-'||strftime(trade_date,'%Y%m%d') AS event_id FROM (
  SELECT *, coalesce(lag(last_price) OVER (PARTITION BY symbol ORDER BY event_time), open_price) AS previous_close FROM (
   SELECT *, CASE k WHEN 'A' THEN 'INDEX_SH000001' WHEN 'N' THEN 'INDEX_SZ399006' ELSE 'INDEX_SH000300' END AS symbol,
     'Market Index' AS category, 'Index' AS sector, 'INDEX' AS market, 'akshare_index' AS source
   FROM ({_bar_sql('l_returnflag', 1000)})))
""",
)


def limit_sql(market: str = "market", symbol: str = "symbol") -> str:
    return f"""CASE {market} WHEN 'BJ' THEN 31.0 WHEN 'SH' THEN
      CASE WHEN {symbol}[:3] IN ('300','301','688') THEN 21.0 ELSE 11.0 END WHEN 'SZ' THEN
      CASE WHEN {symbol}[:3] IN ('300','301','688') THEN 21.0 ELSE 11.0 END
      WHEN 'HK' THEN 30.0 WHEN 'US' THEN 25.0 WHEN 'NASDAQ' THEN 25.0 WHEN 'NYSE' THEN 25.0 WHEN 'INDEX' THEN 15.0 END"""


FAULT_SQL = {
    "time": "event_time IS NULL",
    "identity": "symbol = ''",
    "price": "coalesce(least(open_price,high_price,low_price,last_price,previous_close),0) <= 0",
    "volume": "coalesce(volume,0) <= 0",
    "ohlc": """(high_price<low_price OR open_price>high_price OR open_price<low_price
       OR last_price>high_price OR last_price<low_price)""",
    "change": f"NOT coalesce(abs(change_pct) < {limit_sql()}, false)",
}
ANY_FAULT = " OR ".join(f"({v})" for v in FAULT_SQL.values())
cte("bars", f"SELECT * FROM bars_raw WHERE NOT ({ANY_FAULT})", ["bars_raw"])
cte(
    "history",
    """SELECT 'p-'||event_id AS id, symbol, company_name, category, sector, last_price AS current_price,
     CASE pos%3 WHEN 0 THEN 'UP' WHEN 1 THEN 'DOWN' ELSE 'WATCH' END AS predicted_signal,
     'daily-'||year(event_time) AS model_version, event_time + INTERVAL 1 HOUR AS predicted_at
   FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY event_time) AS pos FROM bars)""",
    ["bars"],
)
cte(
    "scored",
    """SELECT *, CASE WHEN (k*31+d*17+m*7)%10 < 4+m*2 THEN y_true ELSE (k+d+m)%3 END AS y_pred,
     change_pct/100 AS next_return, 0.5+((k*13+d*7)%50)/100.0::DOUBLE AS confidence,
     ((k*7+d*3)%41-20)/1000.0::DOUBLE AS predicted_return FROM (
    SELECT symbol, event_time, k, change_pct, m, model_name, dayofyear(event_time) AS d,
      'daily-'||year(event_time) AS model_version,
      CASE WHEN dayofyear(event_time)%2=0 THEN 'main' ELSE 'walk_forward' END AS slice,
      CASE WHEN change_pct>2 THEN 1 WHEN change_pct<-2 THEN 0 ELSE 2 END AS y_true
    FROM bars, (VALUES (0,'random_forest'),(1,'lightgbm'),(2,'lstm')) AS v(m, model_name))""",
    ["bars"],
)


def counts_sql(rows: str, keys: str, pred: str = "y_pred") -> str:
    parts = ["CAST(count(*) AS DOUBLE) AS n"]
    for c in range(3):
        parts += [
            f"CAST(count(*) FILTER (y_true={c}) AS DOUBLE) AS a{c}",
            f"CAST(count(*) FILTER ({pred}={c}) AS DOUBLE) AS p{c}",
            f"CAST(count(*) FILTER (y_true={c} AND {pred}={c}) AS DOUBLE) AS c{c}",
        ]
    return f"SELECT {keys}, {', '.join(parts)} FROM {rows} GROUP BY ALL"


def div(a: str, b: str) -> str:
    return f"coalesce(({a})/nullif({b},0),0)"


ACC = div("c0+c1+c2", "n")
BASE = div("greatest(a0,a1,a2)", "n")
QUALITY_SQL = {
    "direction_accuracy": ACC,
    "balanced_direction_accuracy": div(
        f"{div('c0', 'a0')}+{div('c1', 'a1')}+{div('c2', 'a2')}", "((a0>0)::INT+(a1>0)::INT+(a2>0)::INT)"
    ),
    "direction_macro_f1": f"({div('2*c0', 'a0+p0')}+{div('2*c1', 'a1+p1')}+{div('2*c2', 'a2+p2')})/3",
    "majority_baseline_accuracy": BASE,
    "direction_lift_over_baseline": f"{ACC}-{BASE}",
    "validation_samples": "n",
    "validation_down_ratio": div("a0", "n"),
    "validation_up_ratio": div("a1", "n"),
    "validation_flat_ratio": div("a2", "n"),
}
for _c, _n in ((0, "down"), (1, "up"), (2, "watch")):
    QUALITY_SQL[f"{_n}_recall"] = div(f"c{_c}", f"a{_c}")
    QUALITY_SQL[f"{_n}_precision"] = div(f"c{_c}", f"p{_c}")
    QUALITY_SQL[f"predicted_{_n}_ratio"] = div(f"p{_c}", "n")
QUALITY_SQL["risk_recall"] = QUALITY_SQL["down_recall"]
QUALITY_SQL["risk_precision"] = QUALITY_SQL["down_precision"]
QUALITY_SQL["predicted_risk_ratio"] = QUALITY_SQL["predicted_down_ratio"]


def quality_sql(counts: str, keys: str, digits: int = 8) -> str:
    cols = ", ".join(f"{rnd(v, digits)} AS {k}" for k, v in QUALITY_SQL.items())
    return f"SELECT {keys}, {cols} FROM ({counts})"


def backtest_sql(rows: str, keys: str, threshold: float = 0.02, digits: int = 8) -> str:
    """EVA-3 in risk mode without evidence columns."""
    r = lambda e: rnd(e, digits)
    return f"""
 SELECT {keys}, CAST(count(*) AS DOUBLE) AS alert_backtest_samples,
  {r("count(*) FILTER (y_pred IN (0,1))/count(*)::DOUBLE")} AS alert_backtest_raw_coverage,
  {r("count(*) FILTER (f<2)/count(*)::DOUBLE")} AS alert_backtest_coverage,
  {r("count(*) FILTER (weak)/count(*)::DOUBLE")} AS alert_backtest_filtered_ratio,
  0.0::DOUBLE AS alert_backtest_weak_down_evidence_ratio,
  {r("count(*) FILTER (f=2)/count(*)::DOUBLE")} AS alert_backtest_watch_ratio,
  {r(f"coalesce(count(*) FILTER ((f=1 AND next_return>{threshold}) OR (f=0 AND next_return<-{threshold}))/nullif(count(*) FILTER (f<2),0)::DOUBLE,0)")} AS alert_backtest_hit_rate,
  CAST(count(*) FILTER (f=1) AS DOUBLE) AS alert_backtest_up_count,
  CAST(count(*) FILTER (f=0) AS DOUBLE) AS alert_backtest_down_count,
  {r(f"coalesce(count(*) FILTER (f=1 AND next_return>{threshold})/nullif(count(*) FILTER (f=1),0)::DOUBLE,0)")} AS alert_backtest_up_hit_rate,
  {r(f"coalesce(count(*) FILTER (f=0 AND next_return<-{threshold})/nullif(count(*) FILTER (f=0),0)::DOUBLE,0)")} AS alert_backtest_down_hit_rate,
  {r("coalesce(avg(confidence) FILTER (f<2),0)")} AS alert_backtest_avg_confidence,
  0.0::DOUBLE AS alert_backtest_down_avg_risk_score,
  {r("coalesce(avg(next_return) FILTER (f=1),0)")} AS alert_backtest_up_avg_return,
  {r("coalesce(avg(next_return) FILTER (f=0),0)")} AS alert_backtest_down_avg_return,
  {r("coalesce(avg(-next_return) FILTER (f=0),0)")} AS alert_backtest_down_avg_inverse_return,
  {threshold}::DOUBLE AS alert_backtest_movement_threshold,
  0.64::DOUBLE AS alert_confidence_threshold, 0.64::DOUBLE AS alert_up_confidence_threshold,
  0.68::DOUBLE AS alert_down_confidence_threshold, 0.55::DOUBLE AS alert_down_risk_score_threshold
 FROM (SELECT *, CASE WHEN weak THEN 2 ELSE y_pred END AS f FROM (
   SELECT *, (y_pred=1 AND confidence<0.64) OR (y_pred=0 AND confidence<0.68)
     OR (y_pred=0 AND predicted_return>-0.01) AS weak FROM {rows}))
 GROUP BY ALL"""


cte(
    "quality",
    quality_sql(counts_sql("scored", "model_version, model_name, slice"), "model_version, model_name, slice"),
    ["scored"],
)
cte(
    "backtest",
    backtest_sql("(SELECT * FROM scored WHERE slice='main')", "model_version, model_name"),
    ["scored"],
)
cte(
    "metrics",
    """SELECT *, CAST(substr(model_version,7,4)||'-12-31 18:00:00' AS TIMESTAMP) AS created_at FROM (
     SELECT model_version, model_name, CASE WHEN slice='main' THEN metric_name ELSE 'walk_forward_'||metric_name END
       AS metric_name, metric_value
     FROM (UNPIVOT quality ON COLUMNS(* EXCLUDE (model_version, model_name, slice)) INTO NAME metric_name VALUE metric_value)
     UNION ALL SELECT model_version, model_name, metric_name, metric_value
     FROM (UNPIVOT backtest ON COLUMNS(* EXCLUDE (model_version, model_name)) INTO NAME metric_name VALUE metric_value))""",
    ["quality", "backtest"],
)
