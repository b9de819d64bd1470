"""Successive halving against the whole grid, with members whose quality is known."""

from __future__ import annotations

from types import SimpleNamespace

from tickloom.operators import models as md


def test_halving_finds_the_grids_best_with_fewer_fits(spark, monkeypatch):
    names = [f"{p}{n}" for p in ("", "guarded_", "walk_forward_", "walk_forward_guarded_") for n in ("direction_accuracy", "balanced_direction_accuracy", "direction_macro_f1", "direction_lift_over_baseline", "down_recall", "down_precision", "predicted_down_ratio")]
    sizes = []

    def train(data, spec, horizon=5, *_):
        sizes.append(data.count())
        if spec.depth < 0:
            raise ValueError("broken")
        quality = 0.3 + 0.1 * spec.depth - 0.02 * horizon
        return SimpleNamespace(metrics={n: quality for n in names})

    monkeypatch.setattr(md, "train", train)
    rows = [(s, float(k), k, 40) for s in "AB" for k in range(1, 41)]
    table = spark.createDataFrame(rows, "symbol string, event_time double, seq long, seq_rows long")
    specs = [md.Spec(name, "boosted", depth=depth) for name in ("lightgbm", "other") for depth in (1, 2, 3, -1)]
    grid = md.best_settings(md.search(lambda h, t: table, specs, [1, 5], [0.02], spark)).select("model_name", "setting").collect()
    assert len(sizes) == 16 and set(sizes) == {80}
    sizes.clear()
    report, fits = md.halving_search(lambda h, t: table, specs, [1, 5], [0.02], spark)
    assert fits == {0.25: 16, 1.0: 6} and sorted(set(sizes)) == [20, 80] and sizes.count(80) == 6
    best = md.best_settings(report.where("finished")).select("model_name", "setting").collect()
    assert sorted(best) == sorted(grid)
    assert report.count() == 16 and report.where("error = 'broken'").count() == 4 and report.where("finished").count() == 6
    part = md.newest_part(table, 0.25).where("symbol = 'A'").orderBy("seq").collect()
    assert [(r["seq"], r["seq_rows"], r["event_time"]) for r in part] == [(k, 10, 30.0 + k) for k in range(1, 11)]
