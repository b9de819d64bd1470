"""Row-frame features over whole segments against plain sums, the cross section against the rows themselves, and what a narrow frame stores."""

from __future__ import annotations

from datetime import datetime, timedelta
from statistics import stdev

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from tickloom.operators import features as fe, rolling
from tickloom.plans import fixtures as fx

NAMES = ["return_1", "ma_5_gap", "volatility_5", "max_drawdown_20", "macd", "price_position_20", "future_min_3", "next_price_3"]


def prices(n: int, seed: int) -> list[float]:
    return [10 + (k * 7 + seed * 3) % 11 + (k % 5) / 10 for k in range(n)]


@pytest.mark.parametrize("batch", [1, 7, 1000])
def test_segments_are_whole_however_rows_come_in(monkeypatch, batch):
    monkeypatch.setattr(rolling, "CHUNK_ROWS", 5)
    lengths = [1, 2, 30, 4, 64]
    rows = [{"symbol": None if s == 3 else f"s{s}", "segment": 0, "pos": k + 1, "is_core": k != 1, **dict.fromkeys(rolling.INPUTS, p)} for s, n in enumerate(lengths) for k, p in enumerate(prices(n, s))]
    table = pa.Table.from_pylist(rows)
    out = pa.Table.from_batches(rolling.measure(["symbol", "segment"], ["symbol", "pos"], NAMES, set())(iter(table.to_batches(max_chunksize=batch)))).to_pylist()
    assert len(out) == sum(r["is_core"] for r in rows)
    found = {(r["symbol"], r["pos"]): r for r in out}
    for s, n in enumerate(lengths):
        p, fast, slow = prices(n, s), None, None
        moves = [0.0] + [p[k] / p[k - 1] - 1 for k in range(1, n)]
        for k in range(n):
            fast = p[0] if fast is None else fast + (p[k] - fast) * 2 / 13
            slow = p[0] if slow is None else slow + (p[k] - slow) * 2 / 27
            if k == 1:
                continue
            r, five, twenty = found[None if s == 3 else f"s{s}", k + 1], p[max(0, k - 4) : k + 1], p[max(0, k - 19) : k + 1]
            assert r["return_1"] == pytest.approx(moves[k])
            assert r["ma_5_gap"] == pytest.approx(p[k] / (sum(five) / len(five)) - 1)
            assert r["volatility_5"] == pytest.approx(stdev(moves[max(0, k - 4) : k + 1]) if k else 0.0)
            assert r["max_drawdown_20"] == pytest.approx(min(0.0, *[x / max(twenty[: i + 1]) - 1 for i, x in enumerate(twenty)]) if k else 0.0)
            assert r["macd"] == pytest.approx((fast - slow) / p[k])
            low, high = min(twenty), max(twenty)
            assert r["price_position_20"] == pytest.approx((p[k] - low) / (high - low) - 0.5 if high > low else 0.0)
            assert r["next_price_3"] == (p[k + 3] if k + 3 < n else None)
            assert r["future_min_3"] == (min(p[k + 1 : k + 4]) if k + 1 < n else None)


def test_equal_values_deviate_by_nothing():
    f = rolling.Frames(lambda name: np.full(9, 0.1), np.arange(9) == 0)
    assert not f.deviation("x", 5)[1:].any()


def test_cross_section_is_the_same_beside_wide_and_narrow_rows(spark):
    at = datetime(2024, 1, 1)
    data = [(f"s{k}", at + timedelta(days=day), f"S{k % 3}", ["SH", "SZ"][k % 2], "x", *[float((k * 7 + day * 5 + i) % 9 - 4) for i in range(len(fe.CROSS_INPUTS))]) for k in range(12) for day in range(4)]
    wide = spark.createDataFrame(data, ["symbol", "event_time", "sector", "market", "more", *fe.CROSS_INPUTS])
    a, b = fe.cross_section(wide).drop("more"), fe.cross_section(wide.drop("more"))
    assert sorted(map(tuple, a.select(*sorted(a.columns)).collect())) == sorted(map(tuple, b.select(*sorted(a.columns)).collect()))
    means = wide.groupBy("market", "event_time").agg((F.avg("change_pct") / 100.0).alias("m"))
    far = b.join(means, ["market", "event_time"]).where(F.abs(F.col("m") - F.col("market_avg_change_pct")) > 1e-12)
    assert b.count() == 48 and far.isEmpty()


@pytest.mark.parametrize("name", ["fea_10_sector_ranks", "lab_07_limit_rows", "lab_08_time_split", "lab_10_sequences", "lab_10_sequence_cap", "mod_11_alert_filter"])
def test_a_query_of_few_columns_stores_no_wide_rows(spark, sf_dir, name, monkeypatch):
    monkeypatch.setattr(fx, "_STORED", {})
    __spark_entry__.queries()[name](spark, sf_dir).count()
    assert max(len(df.columns) for df in fx._STORED.values()) < 40
