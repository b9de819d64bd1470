"""Hand-made rows for the column rules."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tickloom.functions import decision as dc, quotes as q
from tickloom.operators import cleaning, dashboard as dash, evaluation as ev, labels as lb
from tickloom.sources import captures, tables
from tickloom.streaming import batch as sb


def one(spark, column, **values):
    fields = ", ".join(
        f"{k} {'string' if isinstance(v, str) or v is None else 'long' if isinstance(v, int) else 'double'}" for k, v in values.items()
    )
    return spark.createDataFrame([tuple(values.values())], fields).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("price,previous,want", [(110.0, 100.0, 10.0), (100.0, 0.0, 0.0)])
def test_change_pct(spark, price, previous, want):
    assert one(spark, q.change_pct("p", "c"), p=price, c=previous) == want


@pytest.mark.parametrize(
    "symbol,hint,want",
    [
        ("600519", "", "SH"), ("000001", "", "SZ"), ("300750", "", "SZ"), ("430047", "", "BJ"), ("830799", "", "BJ"),
        ("00700", "", "HK"), ("AAPL", "", "UNKNOWN"), ("159915", "", "UNKNOWN"), ("600519", "hk", "HK"),
    ],
)
def test_market(spark, symbol, hint, want):
    assert one(spark, q.detect_market("s", "h"), s=symbol, h=hint) == want


@pytest.mark.parametrize(
    "symbol,market,want",
    [("300750", "SZ", 21.0), ("688001", "SH", 21.0), ("600519", "SH", 11.0), ("830799", "BJ", 31.0), ("00700", "HK", 30.0),
     ("AAPL", "NASDAQ", 25.0), ("I", "INDEX", 15.0), ("X", "MARS", None)],
)
def test_limits(spark, symbol, market, want):
    assert one(spark, q.change_limit("s", "h"), s=symbol, h=market) == want


def test_vendor_codes(spark):
    code = lambda v, s, m="": one(spark, q.vendor_code(v, "s", "h"), s=s, h=m)
    assert code("eastmoney", "600519") == "1.600519"
    assert code("sina", "000001") == "sz000001"
    assert code("tencent", "700", "HK") == "hk00700"
    assert code("sina", "00700") == "rt_hk00700"
    assert code("eastmoney", "AAPL", "NASDAQ") is None


@pytest.mark.parametrize("text,as_double,as_long", [("--", 0.0, 0), (" ", 0.0, 0), ("1,234", 0.0, 1234), ("-2.9", -2.9, -2), ("abc", 0.0, 0)])
def test_safe_numbers(spark, text, as_double, as_long):
    assert one(spark, q.safe_double("x"), x=text) == as_double
    assert one(spark, q.safe_long("x"), x=text) == as_long


def test_default_sector(spark):
    row = spark.createDataFrame([(" 600519 ", "", None, " ", "")], "symbol string, company_name string, category string, sector string, market string")
    got = row.withColumns(q.normalized_text()).first().asDict()
    assert got == {"symbol": "600519", "company_name": "600519", "category": "Unknown", "sector": "Other", "market": "SH"}


def quote(**change):
    base = dict(
        event_id="e", symbol="600519", company_name="n", category="c", sector="s", market="SH", open_price=10.0, high_price=11.0,
        low_price=9.0, last_price=10.0, previous_close=10.0, change_pct=0.0, volume=5, turnover=50.0,
        event_time="2026-01-01 10:00:00", source="sina",
    )
    return base | change


SCHEMA = (
    "event_id string, symbol string, company_name string, category string, sector string, market string, open_price double, high_price double,"
    " low_price double, last_price double, previous_close double, change_pct double, volume long, turnover double, event_time string, source string"
)


def quotes(spark, *rows):
    return spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA).withColumn("event_time", F.to_timestamp("event_time"))


@pytest.mark.parametrize(
    "change,kept",
    [
        ({}, True), ({"change_pct": None}, False), ({"volume": 0}, False), ({"last_price": 11.5}, False), ({"low_price": 10.5}, False),
        ({"change_pct": 10.99}, True), ({"change_pct": 11.0}, False), ({"change_pct": -11.0}, False),
        ({"market": "HK", "change_pct": 29.9}, True), ({"market": "INDEX"}, False), ({"market": "NYSE", "change_pct": 24.0}, True),
        ({"symbol": ""}, False), ({"event_time": None}, False), ({"previous_close": 0.0}, False),
    ],
)
def test_stream_filter(spark, change, kept):
    assert (quotes(spark, quote(**change)).where(q.passes_stream_filter()).count() == 1) is kept


def test_index_tick_without_volume(spark):
    rows = quotes(spark, quote(market="INDEX", volume=0), quote(volume=0))
    assert [r[0] for r in rows.select(q.is_valid_tick()).collect()] == [True, False]


def test_clean_keeps_one_copy_and_counts_faults(spark):
    rows = quotes(spark, quote(), quote(event_id="f"), quote(symbol="", event_id="g"), quote(volume=0, high_price=8.0, event_id="h"))
    assert [r["event_id"] for r in cleaning.clean_bars(rows, ["event_id"]).collect()] == ["f"]
    report = cleaning.quality_report(rows).first().asDict()
    assert report["input_rows"] == 4 and report["output_rows"] == 1 and report["duplicate_rows"] == 1
    assert report["invalid_volume_rows"] == 1 and report["invalid_ohlc_rows"] == 1 and report["invalid_identity_rows"] == 1


def test_unknown_market_is_a_change_fault(spark):
    assert cleaning.quality_report(quotes(spark, quote(market="MARS"))).first()["invalid_change_rows"] == 1


def test_alert_rule(spark):
    rows = quotes(
        spark,
        quote(symbol="A", change_pct=2.0),
        quote(symbol="B", change_pct=4.0),
        quote(symbol="C", volume=5_000_000),
        quote(symbol="D", change_pct=-3.0, volume=6_000_000),
        quote(symbol="E", change_pct=2.4),
        quote(symbol="F", change_pct=1.9, volume=4_999_999),
    )
    base = spark.createDataFrame([("E", 1.0, 0.0)], "symbol string, avg_abs_change_pct double, avg_volume double")
    got = {r["symbol"]: (r["alert_type"], r["alert_level"]) for r in sb.build_alerts(rows, base).collect()}
    assert got == {
        "A": ("price_volatility", "MEDIUM"),
        "B": ("price_volatility", "HIGH"),
        "C": ("volume_spike", "MEDIUM"),
        "D": ("price_and_volume", "HIGH"),
    }


def test_keep_changed(spark):
    rows = quotes(spark, quote(symbol="A"), quote(symbol="A", event_id="x"), quote(symbol="B"), quote(symbol="C", last_price=10.5))
    state = quotes(spark, quote(symbol="A"), quote(symbol="C")).select("symbol", "source", "last_price", "change_pct", "volume")
    assert sorted(r["symbol"] for r in sb.keep_changed(rows, state).collect()) == ["B", "C"]
    assert sb.keep_changed(rows, None).count() == 3


@pytest.mark.parametrize("status,want", [("resolved", "RESOLVED"), (" open ", "OPEN"), ("bogus", "ACKED"), (None, "ACKED")])
def test_action_upsert(spark, status, want):
    schema = "alert_id long, status string, note string, handled_by string, handled_at timestamp"
    old = spark.createDataFrame([(42, "OPEN", "", "user", None), (7, "ACKED", "", "user", None)], schema)
    new = spark.createDataFrame([(42, status, "n", "ops", None)], schema)
    got = {r["alert_id"]: (r["status"], r["handled_by"]) for r in tables.upsert_actions(old, new).collect()}
    assert got == {42: (want, "ops"), 7: ("ACKED", "user")}


def test_csv_line_escapes(spark):
    row = spark.createDataFrame([('a,"b"', None, 3)], "x string, y string, z long")
    assert row.select(tables.csv_line(["x", "y", "z"])).first()[0] == '"a,""b""","","3"'


@pytest.mark.parametrize(
    "down,up,flat,want",
    [(0.4, 0.4, 0.2, 0), (0.2, 0.4, 0.4, 1), (0.2, 0.2, 0.6, 2), (0.3, 0.3, 0.3, 0)],
)
def test_argmax_ties(spark, down, up, flat, want):
    assert one(spark, dc.argmax_direction(False), prob_down=down, prob_up=up, prob_flat=flat) == want
    assert one(spark, dc.argmax_direction(True), prob_down=down, prob_up=up, prob_flat=flat) == (2 if want == 1 else want)


def test_confidence(spark):
    assert one(spark, dc.display_confidence(), prob_down=1.0, prob_up=0.0, prob_flat=0.0) == 0.95
    assert one(spark, dc.display_confidence(), prob_down=0.1, prob_up=0.3, prob_flat=0.6) == pytest.approx(0.6)


def test_direction_metrics_of_one_class(spark):
    rows = spark.createDataFrame([(2, 2), (2, 0)], "y_true int, y_pred int")
    got = ev.direction_metrics(rows, []).first()
    assert got["direction_accuracy"] == 0.5 and got["balanced_direction_accuracy"] == 0.5
    assert got["majority_baseline_accuracy"] == 1.0 and got["down_recall"] == 0.0 and got["down_precision"] == 0.0


def test_guard_replaces_a_weak_model(spark):
    rows = spark.createDataFrame([(2, 1)] * 8 + [(0, 1)] * 2, "y_true int, y_pred int")
    strict = ev.guarded_metrics(rows, [], keep_risk=False).first()
    assert strict["guard_used"] == 1.0 and strict["guard_label"] == 2.0 and strict["direction_accuracy"] == 0.8
    kept = ev.guarded_metrics(rows, []).first()
    assert kept["guard_used"] == 0.0 and kept["direction_accuracy"] == 0.8


def test_class_weights_have_mean_one(spark):
    rows = spark.createDataFrame([(0,)] * 3 + [(2,)] * 9, "next_direction int")
    got = {r["next_direction"]: r["weight"] for r in lb.class_weights(rows, risk=False).collect()}
    assert sum(got.values()) / 2 == pytest.approx(1.0) and got[0] == pytest.approx(3 * got[2])
    assert {r[0]: r[1] for r in lb.class_weights(rows).collect()}[0] == pytest.approx(got[0] * 1.35)


def test_time_split_of_short_symbols(spark):
    rows = spark.createDataFrame([("A", i, 2) for i in (1, 2)] + [("B", 1, 1)], "symbol string, seq long, seq_rows long")
    got = [(r["symbol"], r["seq"], r["is_train"]) for r in lb.time_split(rows).orderBy("seq").collect()]
    assert got == [("A", 1, True), ("A", 2, False)]


def test_global_split_fallback(spark):
    rows = quotes(spark, *[quote(symbol=f"S{i}", event_time=f"2026-01-0{i} 10:00:00") for i in range(1, 6)])
    got = lb.global_split(rows, F.year("event_time")).where("is_train").count()
    assert got == 4


def test_replay_mode(spark):
    rows = quotes(spark, quote(source="replay")).select("*", F.lit(1).alias("id"), F.col("event_time").alias("created_at"))
    beats = rows.select((F.col("created_at") - F.expr("INTERVAL 1 MINUTE")).alias("latest_event_time"))
    m = dash.Market(rows.first()["created_at"], rows, snapshots=beats)
    assert dash.stream_health(m).first()["current_mode"] == "REPLAY"
    assert dash.stream_health(m, strict_replay=True).first()["current_mode"] == "LIVE"


def test_stock_daily_falls_back_to_ticks(spark):
    rows = quotes(spark, quote(), quote(event_id="f", last_price=10.5, event_time="2026-01-01 11:00:00"))
    rows = rows.select("*", F.monotonically_increasing_id().alias("id"), F.col("event_time").alias("created_at"))
    bars = rows.withColumn("trade_date", F.to_date("event_time")).where("false")
    got = dash.stock_daily(dash.Market(None, rows, bars=bars), "600519").first()
    assert (got["open"], got["close"], got["source"]) == (10.0, 10.5, "price_ticks_aggregated")


def test_freshness_gate(spark):
    rows = quotes(spark, quote())
    from datetime import datetime

    gate = ev.freshness_gate({"a": rows, "b": rows.where("false")}, datetime(2026, 1, 5))
    assert {r["table_name"]: r["fresh"] for r in gate.collect()} == {"a": True, "b": False}
    with pytest.raises(RuntimeError):
        ev.assert_fresh(gate)
    assert ev.assert_fresh(gate, allow_stale=True) == ["b"]


def test_broken_catalogue_gives_fallback(spark, tmp_path):
    bad = tmp_path / "symbols.json"
    bad.write_text("[{not json")
    assert [r["symbol"] for r in tables.read_catalogue(spark, str(bad), ["600000"]).collect()] == ["600000"]
    good = tmp_path / "good.json"
    good.write_text('[{"symbol": "600519", "company_name": "n"}]')
    assert [r["symbol"] for r in tables.read_catalogue(spark, str(good), ["600000"]).collect()] == ["600519"]


def test_captured_quotes_take_catalogue_text(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"quotes": [{"symbol": "aapl", "company_name": "old", "last_price": 2.5}]}')
    (tmp_path / "b.json").write_text('[{"symbol": "X", "company_name": "x"}]')
    names = spark.createDataFrame([("AAPL", "Apple", "c", "s", "US")], "symbol string, company_name string, category string, sector string, market string")
    got = {r["symbol"]: r["company_name"] for r in captures.read_captured_quotes(spark, str(tmp_path), names).collect()}
    assert got == {"AAPL": "Apple", "X": "x"}


def test_catalogue_of_json_lines(spark, tmp_path):
    lines = tmp_path / "lines.json"
    lines.write_text('{"symbol": "600519"}\n{"symbol": "600520"}\n')
    assert sorted(r["symbol"] for r in tables.read_catalogue(spark, str(lines), ["600000"]).collect()) == ["600519", "600520"]
    lines.write_text('{"symbol": "600519"}\n{"symbol": ')
    assert [r["symbol"] for r in tables.read_catalogue(spark, str(lines), ["600000"]).collect()] == ["600000"]
