"""Ordered operators against plain windows and brute force, on both ways of cutting."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window as W, functions as F

from tickloom.operators import ordered
from tickloom.operators.features import _ema
from tickloom.operators.ordered import (
    exact_median,
    latest_by,
    with_following,
    with_newest,
    with_percent_rank,
    with_position,
    with_previous,
    with_running_max,
    with_segments,
)


@pytest.fixture(scope="module")
def frame():
    """One key holds most of the rows, all of them within one bucket; one has a single row."""
    rng = np.random.default_rng(3)
    keys = ["HOT"] * 700 + ["A"] * 250 + ["B"] * 49 + ["ONE"]
    rows = pd.DataFrame({"k": keys, "t": rng.permutation(1000), "v": rng.integers(0, 20, 1000).astype(float)})
    rows.loc[rows.sample(frac=0.2, random_state=1).index, "v"] = np.nan
    return rows


@pytest.fixture(scope="module")
def table(spark, frame):
    rows = [(k, int(t), None if np.isnan(v) else float(v)) for k, t, v in frame.itertuples(index=False)]
    return spark.createDataFrame(rows, "k string, t long, v double").repartition(5)


BOTH = pytest.mark.parametrize("max_rows", [10_000, 40])


def bucket():
    """Wide buckets: all rows of a key fall into two of them."""
    return F.floor(F.col("t") / 500)


@BOTH
def test_position(table, frame, max_rows):
    got = with_position(table, ["k"], ["t"], bucket(), max_rows=max_rows).toPandas()
    want = frame.assign(pos=frame.groupby("k")["t"].rank().astype(int), n=frame.groupby("k")["t"].transform("size"))
    both = got.merge(want, on=["k", "t"])
    assert len(both) == 1000
    assert (both["pos_x"] == both["pos_y"]).all() and (both["group_rows"] == both["n"]).all()


@BOTH
def test_position_without_keys(table, max_rows):
    got = with_position(table, [], ["t"], bucket(), max_rows=max_rows).toPandas()
    assert (got["pos"] == got["t"] + 1).all() and set(got["group_rows"]) == {1000}


@BOTH
def test_previous_value(table, frame, max_rows):
    got = with_previous(table, ["k"], ["t"], bucket(), F.col("v"), "prev", max_rows=max_rows).toPandas()
    want = frame.sort_values("t").assign(prev=lambda x: x.groupby("k")["v"].transform(lambda s: s.ffill().shift()))
    both = got.merge(want, on=["k", "t"])
    pd.testing.assert_series_equal(both["prev_x"], both["prev_y"], check_names=False)


@BOTH
def test_running_max(table, frame, max_rows):
    got = with_running_max(table, ["k"], ["t"], bucket(), "v", "top", max_rows=max_rows).toPandas()
    want = frame.sort_values("t").assign(top=lambda x: x.groupby("k")["v"].transform(lambda s: s.cummax().ffill()))
    both = got.merge(want, on=["k", "t"])
    pd.testing.assert_series_equal(both["top_x"], both["top_y"], check_names=False)


@BOTH
@pytest.mark.parametrize("n", [1, 5, 60])
def test_following_value(table, frame, max_rows, n):
    value = F.struct("t", "v")
    got = with_following(table, ["k"], ["t"], bucket() if n < 60 else F.floor(F.col("t") / 7), value, n, "next", max_rows=max_rows).select("k", "t", "next.*").toDF("k", "t", "nt", "nv").toPandas()
    want = frame.sort_values("t").assign(wt=lambda x: x.groupby("k")["t"].shift(-n), wv=lambda x: x.groupby("k")["v"].shift(-n))
    both = got.merge(want, on=["k", "t"])
    assert len(both) == 1000
    pd.testing.assert_series_equal(both["nt"].astype(float), both["wt"], check_names=False)
    pd.testing.assert_series_equal(both["nv"], both["wv"], check_names=False)


@BOTH
def test_newest_of_key_and_step(table, frame, max_rows):
    stepped = table.withColumn("step", F.when(F.col("t") % 11 > 0, F.col("t") % 3))
    got = with_newest(stepped, "k", "step", ["t"], F.floor(F.col("t") / 50), "v", ("every", "same"), max_rows=max_rows).toPandas()
    rows = frame.sort_values("t").assign(step=lambda x: (x["t"] % 3).where(x["t"] % 11 > 0, -1))
    rows["every"] = rows.groupby("k")["v"].transform(lambda s: s.cummax().ffill())
    rows["same"] = rows.groupby(["k", "step"])["v"].transform(lambda s: s.cummax().ffill())
    both = got.merge(rows, on=["k", "t"])
    assert len(both) == 1000
    for c in ("every", "same"):
        pd.testing.assert_series_equal(both[f"{c}_x"], both[f"{c}_y"], check_names=False)


@BOTH
def test_percent_rank(table, frame, max_rows):
    got = with_percent_rank(table, ["k"], "v", F.floor(F.col("v") / 100), "r", max_rows=min(max_rows, 12)).toPandas()
    want = frame.assign(r=frame.groupby("k")["v"].rank(pct=True))
    both = got.merge(want, on=["k", "t"])
    pd.testing.assert_series_equal(both["r_x"], both["r_y"], check_names=False)


@BOTH
def test_exact_median(table, frame, max_rows):
    got = exact_median(table, ["k"], "v", F.floor(F.col("v") / 100), "m", max_rows=min(max_rows, 12)).toPandas()
    want = frame.groupby("k")["v"].median().dropna()
    assert dict(zip(got["k"], got["m"])) == want.to_dict()


def test_segments_equal_plain_window(table):
    placed = with_position(table, ["k"], ["t"], bucket())
    cut = with_segments(placed, 50, before=9, after=3)
    w = W.partitionBy("k", "segment").orderBy("pos")
    plain = W.partitionBy("k").orderBy("t")

    def measures(spec):
        return {
            "mean": F.avg("v").over(spec.rowsBetween(-9, 0)),
            "lag": F.lag("v", 9).over(spec),
            "ahead": F.lead("v", 3).over(spec),
            "low": F.min("v").over(spec.rowsBetween(1, 3)),
        }

    got = cut.withColumns(measures(w)).where("is_core").drop("segment", "is_core").toPandas()
    want = table.withColumns(measures(plain)).toPandas()
    columns = ["k", "t", "mean", "lag", "ahead", "low"]
    order = lambda x: x[columns].sort_values(["k", "t"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(order(got), order(want))


def test_short_group_has_no_copies(table):
    cut = with_segments(with_position(table, ["k"], ["t"], bucket()), 50, before=9)
    sizes = {r["k"]: r["count"] for r in cut.groupBy("k").count().collect()}
    assert sizes["ONE"] == 1 and sizes["B"] == 49 and sizes["A"] == 250 + 4 * 9


def test_margins_must_fit(table):
    with pytest.raises(ValueError):
        with_segments(table, 5, before=6)


def test_latest_by(table, frame):
    got = {r["k"]: r["t"] for r in latest_by(table, ["k"], ["t"]).collect()}
    assert got == frame.groupby("k")["t"].max().to_dict()


def test_ema_over_segments(spark):
    """Segments with a warm-up give the recursive average to the last digits."""
    n = 5000
    rng = np.random.default_rng(5)
    price = 100 * np.exp(np.cumsum(rng.normal(0, 0.01, n)))
    table = spark.createDataFrame([("S", i, float(p)) for i, p in enumerate(price)], "symbol string, t long, x double")
    placed = with_position(table, ["symbol"], ["t"], F.floor(F.col("t") / 1000))
    cut = with_segments(placed, 2048, before=800)
    w = W.partitionBy("symbol", "segment").orderBy("pos")
    cut = cut.withColumn("nth", F.row_number().over(w))
    out = cut.withColumns({f"e{s}": _ema("x", s) for s in (9, 12, 26)}).where("is_core").orderBy("t").toPandas()
    for span in (9, 12, 26):
        want = pd.Series(price).ewm(span=span, adjust=False).mean()
        assert np.allclose(out[f"e{span}"], want, rtol=1e-12)


def test_cut_is_stored_once(table):
    staged, pieces = ordered.cut(table, ["k"], ["t"], bucket(), [], max_rows=40)
    top = pieces.agg(F.max("__rows")).first()[0]
    assert top <= 120
    assert staged.count() == 1000 == pieces.agg(F.sum("__rows")).first()[0]
