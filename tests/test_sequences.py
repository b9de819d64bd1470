"""Windows of the sequence member: the split, the bound on training windows, forward folds."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from tickloom.operators import labels as lb, models as md


@pytest.fixture(scope="module")
def rows(spark):
    day = datetime(2024, 1, 1)
    data = [
        (f"s{s}", day + timedelta(days=k), 10.0, ((s * 7 + k * 3) % 11 - 5) / 100, (s + k) % 3, k + 1, 200, ((k * 5 + s) % 7) / 7)
        for s in range(20)
        for k in range(200)
    ]
    return spark.createDataFrame(data, "symbol string, event_time timestamp, last_price double, next_return double, next_direction int, seq long, seq_rows long, return_1 double").persist()


@pytest.mark.parametrize("cap, train", [(0, 20 * 156), (800, 800), (400, 400)])
def test_cap_bounds_training_windows_only(rows, cap, train):
    windows = lb.time_split(lb.sequences(rows, 5, cap, ["return_1"]))
    assert windows.where("is_train").count() == train
    assert windows.where("NOT is_train").count() == 20 * 40
    newest = windows.where("is_train").groupBy("symbol").min("seq").collect()
    assert {r["min(seq)"] for r in newest} == {max(5, 161 - train // 20)}


def test_sequence_member_has_forward_folds_and_a_held_out_decision(rows):
    spec = md.Spec("lstm", "sequence", window=3, hidden=4, epochs=5, features=["return_1"])
    model = md.train_sequence(rows, spec, 5, True, cap=1000)
    assert any(k.startswith("walk_forward_") for k in model.metrics) and "walk_forward_skipped" not in model.metrics
    assert model.decision["mode"] in ("argmax", "direction_gate", "majority_class")


def test_no_windows_is_an_error(rows):
    with pytest.raises(ValueError, match="no training"):
        md.train_sequence(rows, md.Spec("lstm", "sequence", window=500, features=["return_1"]))


@pytest.mark.parametrize("window", [1, 4, 7])
def test_scaler_counts_rows_as_often_as_windows_hold_them(spark, window):
    rows = [(s, float(k), k, n, float((k * 7 + n) % 11)) for s, n in (("A", 30), ("B", 8), ("C", 3), ("D", window)) for k in range(1, n + 1)]
    table = spark.createDataFrame(rows, "symbol string, event_time double, seq long, seq_rows long, return_1 double")
    windows = lb.sequences(table, window, 0, ["return_1"]).where("symbol <> 'A' OR seq BETWEEN 12 AND 20")
    held = [v[0] for r in windows.collect() for v in r["sequence"]]
    mean = sum(held) / len(held)
    got = lb.fit_scaler(windows, ["return_1"]).first()
    assert got["mean"] == pytest.approx(mean) and got["std"] == pytest.approx((sum((x - mean) ** 2 for x in held) / len(held)) ** 0.5)
    assert sum(r["held"] for r in lb.held_rows(windows).collect()) == len(held)
    with pytest.raises(Exception, match="gaps"):
        lb.held_rows(windows.where("symbol <> 'A' OR seq <> 15")).collect()


@pytest.mark.parametrize("cap, older, newest", [(0, 20 * 124, 20 * 32), (400, 20 * 16, 20 * 4), (60, 20 * 2, 20), (20, 16, 4)])
def test_a_capped_symbol_keeps_windows_to_train_and_to_tune_on(rows, cap, older, newest):
    train = lb.time_split(lb.sequences(rows, 5, cap, ["return_1"])).where("is_train").drop("is_train")
    split = lb.tuning_split(train, 5)
    assert (split.where("is_train").count(), split.where("NOT is_train").count()) == (older, newest)


def test_few_windows_a_symbol_train_a_sequence_member(rows):
    spec = md.Spec("lstm", "sequence", window=3, hidden=4, epochs=3, features=["return_1"])
    model = md.train_sequence(rows, spec, 5, True, cap=60, with_folds=False)
    assert model.metrics["raw_validation_samples"] == 20 * 40
