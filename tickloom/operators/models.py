"""Model training, decisions and ensembles on MLlib (MOD-1 .. MOD-18, EVA-4, SNK-10)."""

from __future__ import annotations

import json
import warnings
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import (
    GBTRegressionModel,
    GBTRegressor,
    IsotonicRegression,
    IsotonicRegressionModel,
    LinearRegression,
    LinearRegressionModel,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tickloom.functions.decision import (
    DOWN,
    FLAT,
    LABELS,
    PROBS,
    UP,
    alert_filter,
    argmax_direction,
    display_confidence,
    gated_direction,
    majority_direction,
    normalized_probabilities,
    return_override,
    signal_name,
)
from tickloom.functions.numeric import clip, ratio, stable_round
from tickloom.operators.evaluation import (
    LIFT_FLOOR,
    alert_backtest,
    direction_metrics,
    guarded_metrics,
    quality_columns,
)
from tickloom.operators.features import FEATURES
from tickloom.operators.labels import (
    CATEGORIES,
    class_weights,
    category_encoder,
    fit_scaler,
    scale_sequences,
    scale_windows,
    sequences,
    time_split,
    train_end,
    tuning_split,
    walk_forward,
)
from tickloom.session import materialize

# Evidence columns of the risk score.
EVIDENCE = [
    "return_1", "return_3", "momentum_5", "volume_ratio_20_raw", "volume_down_breakout",
    "relative_market_index_return_3", "relative_market_index_return_5", "sector_relative_return_5",
    "current_vs_market_index_return",
]
# The gates the decision tuner tries, in order.
GATE_PROBS = [0.34, 0.38, 0.42, 0.46, 0.50, 0.55, 0.60, 0.66, 0.72, 0.78]
GATE_MARGINS = [-0.04, 0.0, 0.04, 0.08, 0.12, 0.16, 0.20, 0.24]


@dataclass
class Spec:
    """What to train. `forest` and `boosted` are trees, `sequence` a perceptron over windows."""

    name: str
    kind: str
    class_trees: int = 120
    return_trees: int = 80
    depth: int = 12
    min_rows: int = 10
    columns: str = "0.6"
    step: float = 0.02
    sample: float = 0.8
    calibration: str | None = None
    threshold: float = 0.02
    window: int = 30
    hidden: int = 48
    epochs: int = 60
    features: list[str] = field(default_factory=lambda: list(FEATURES))


# Production settings of the three members.
FOREST = Spec("random_forest", "forest", calibration="sigmoid", threshold=0.015)
BOOSTED = Spec("lightgbm", "boosted", class_trees=500, return_trees=500, depth=5, min_rows=80, columns="0.85")
SEQUENCE = Spec("lstm", "sequence")


@dataclass
class DirectionModel:
    """Class probabilities from one model of all classes, or from one yes / no model per class."""

    models: dict[str, Model]
    calibrators: dict[int, Model] = field(default_factory=dict)
    calibration: str | None = None

    def with_probabilities(self, df: DataFrame) -> DataFrame:
        """MOD-5: adds prob_down, prob_up and prob_flat."""
        score = {c: F.lit(0.0) for c in LABELS}
        for key, model in self.models.items():
            raw, out = f"__raw_{key}", f"__p_{key}"
            model = model.copy({model.probabilityCol: out, model.rawPredictionCol: raw, model.predictionCol: f"__y_{key}"})
            df = model.transform(df).drop(raw, f"__y_{key}").withColumn(out, vector_to_array(out))
            if key == "all":
                score = {c: F.coalesce(F.get(F.col(out), c), F.lit(0.0)) for c in LABELS}
            else:
                score[int(key)] = F.col(out)[1]
        if "all" not in self.models and len(self.models) == 1:
            score[FLAT] = 1 - score[DOWN]
        names = {c: f"__s_{c}" for c in LABELS}
        df = df.withColumns({names[c]: score[c] for c in LABELS})
        for c, model in self.calibrators.items():
            df = _calibrated(df, model, names[c], self.calibration)
        if self.calibrators and UP not in self.calibrators:
            df = df.withColumn(names[FLAT], 1 - F.col(names[DOWN])).withColumn(names[UP], F.lit(0.0))
        ordered = [names[DOWN], names[UP], names[FLAT]]
        return df.withColumns(normalized_probabilities(ordered)).drop(*ordered, *[f"__p_{k}" for k in self.models])


@dataclass
class TrainedModel:
    spec: Spec
    price: Model
    direction: DirectionModel
    decision: dict
    metrics: dict[str, float]
    horizon: int
    risk: bool
    encoder: PipelineModel | None = None
    scaler: list[dict] | None = None
    #: The test rows as they were scored, stored: the metrics can be worked out again from them. Not part of a saved model.
    scored: DataFrame | None = None

    @property
    def name(self) -> str:
        return self.spec.name


# --- Training ------------------------------------------------------------------------------------


def _assemble(df: DataFrame, encoder: PipelineModel, features: list[str]) -> DataFrame:
    inputs = [*features, *[f"{c}_hot" for c in ["symbol", *CATEGORIES]]]
    coded = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep").transform(encoder.transform(df))
    return coded.drop(*[f"{c}_index" for c in CATEGORIES], *[f"{c}_hot" for c in ["symbol", *CATEGORIES]])


def _weighted(df: DataFrame, risk: bool) -> DataFrame:
    return df.join(F.broadcast(class_weights(df, risk)), "next_direction").withColumn("label", F.col("next_direction").cast("double"))


def _fit_direction(train: DataFrame, spec: Spec, risk: bool) -> DirectionModel:
    rows = _weighted(train, risk)
    common = dict(featuresCol="features", weightCol="weight", maxDepth=spec.depth, minInstancesPerNode=spec.min_rows, seed=42)
    if spec.kind == "forest":
        forest = RandomForestClassifier(
            labelCol="label", numTrees=spec.class_trees, featureSubsetStrategy=spec.columns, **common
        )
        return DirectionModel({"all": forest.fit(rows)})
    models = {}
    for c in [DOWN] if risk else LABELS:
        target = rows.withColumn("is_class", (F.col("next_direction") == c).cast("double"))
        boosted = GBTClassifier(
            labelCol="is_class", maxIter=spec.class_trees, stepSize=spec.step, subsamplingRate=spec.sample,
            featureSubsetStrategy=spec.columns, **common,
        )
        models[str(c)] = boosted.fit(target)
    return DirectionModel(models)


def _calibrated(df: DataFrame, model: Model, column: str, method: str | None) -> DataFrame:
    if method == "isotonic":
        scored = model.copy({model.featuresCol: column, model.predictionCol: "__iso"}).transform(df)
        return scored.withColumn(column, F.col("__iso")).drop("__iso")
    weight, bias = float(model.coefficients[0]), float(model.intercept)
    return df.withColumn(column, 1 / (1 + F.exp(-(F.col(column) * weight + bias))))


def fit_calibrated(train: DataFrame, spec: Spec, risk: bool, folds: int = 3) -> DirectionModel:
    """MOD-2: a classifier whose probabilities are calibrated on out-of-fold scores."""
    fold = F.pmod(F.xxhash64("symbol", "event_time"), F.lit(folds))
    staged = train.withColumn("__fold", fold)
    parts = None
    for f in range(folds):
        member = _fit_direction(staged.where(F.col("__fold") != f), spec, risk)
        scored = member.with_probabilities(staged.where(F.col("__fold") == f)).select("next_direction", *PROBS)
        parts = scored if parts is None else parts.unionByName(scored)
    parts = parts.persist()
    model = _fit_direction(train, spec, risk)
    for c in [DOWN] if risk else LABELS:
        rows = parts.select(
            F.col(PROBS[c]).alias("score"), (F.col("next_direction") == c).cast("double").alias("label")
        )
        if spec.calibration == "isotonic":
            model.calibrators[c] = IsotonicRegression(featuresCol="score", labelCol="label").fit(rows)
        else:
            vectors = VectorAssembler(inputCols=["score"], outputCol="v").transform(rows)
            model.calibrators[c] = LogisticRegression(featuresCol="v", labelCol="label").fit(vectors)
    parts.unpersist()
    model.calibration = spec.calibration
    return model


def _direction(train: DataFrame, spec: Spec, risk: bool) -> DirectionModel:
    return fit_calibrated(train, spec, risk) if spec.calibration else _fit_direction(train, spec, risk)


def _fit_price(train: DataFrame, spec: Spec) -> Model:
    common = dict(featuresCol="features", labelCol="next_return", maxDepth=spec.depth, minInstancesPerNode=spec.min_rows, seed=42)
    if spec.kind == "forest":
        return RandomForestRegressor(numTrees=spec.return_trees, featureSubsetStrategy=spec.columns, **common).fit(train)
    return GBTRegressor(
        maxIter=spec.return_trees, stepSize=spec.step, subsamplingRate=spec.sample, featureSubsetStrategy=spec.columns, **common
    ).fit(train)


def decide(decision: dict | None, risk: bool) -> Column:
    """MOD-7: the class by a tuned decision."""
    mode = (decision or {}).get("mode", "argmax")
    if mode == "majority_class":
        return majority_direction(int(decision["label"]), risk)
    if mode == "direction_gate":
        return gated_direction(decision["min_direction_prob"], decision["min_direction_margin"], risk)
    return argmax_direction(risk)


# --- Decision tuning -----------------------------------------------------------------------------


def decision_grid(df: DataFrame, risk: bool = True, label: str = "next_direction") -> DataFrame:
    """MOD-9: quality of every gate of the grid, and of the plain argmax (candidate 0).

    What a gate decides depends only on how many of the bounds a row passes, so
    rows are first counted by those numbers (under 2000 cells); the candidates
    are scored on the cells.
    """
    down, up, flat = (F.coalesce(F.col(c), F.lit(0.0)) for c in PROBS)
    top = down if risk else F.greatest(up, down)
    side = F.lit(DOWN) if risk else F.when(up >= down, UP).otherwise(DOWN)
    passed = lambda value, bounds: sum((F.when(value >= b, 1).otherwise(0) for b in bounds), F.lit(0))
    cells = df.groupBy(
        passed(top, GATE_PROBS).alias("probs"),
        passed(top - flat, GATE_MARGINS).alias("margins"),
        side.alias("side"),
        argmax_direction(risk).alias("best"),
        F.col(label).alias("y"),
    ).agg(F.count(F.lit(1)).alias("rows"))
    gates = [(0, 0, 0, 0.0, 0.0)]
    for i, p in enumerate(GATE_PROBS):
        gates += [(len(gates) + j, i + 1, j + 1, p, m) for j, m in enumerate(GATE_MARGINS)]
    grid = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(n).alias("candidate"), F.lit(i).alias("need_probs"), F.lit(j).alias("need_margins"),
                    F.lit(p).alias("min_prob"), F.lit(m).alias("min_margin"),
                )
                for n, i, j, p, m in gates
            ]
        )
    )
    rows = cells.withColumn("g", grid).select("*", "g.*")
    gated = F.when((F.col("probs") >= F.col("need_probs")) & (F.col("margins") >= F.col("need_margins")), F.col("side"))
    pred = F.when(F.col("candidate") == 0, F.col("best")).otherwise(F.coalesce(gated, F.lit(FLAT)))
    rows = rows.withColumn("pred", pred)
    total = lambda c: F.sum(F.when(c, F.col("rows")).otherwise(0)).cast("double")
    sums = [F.sum("rows").cast("double").alias("n")]
    for c in LABELS:
        sums += [
            total(F.col("y") == c).alias(f"actual_{c}"),
            total(F.col("pred") == c).alias(f"predicted_{c}"),
            total((F.col("y") == c) & (F.col("pred") == c)).alias(f"correct_{c}"),
        ]
    counts = rows.groupBy("candidate", "min_prob", "min_margin").agg(*sums)
    q = quality_columns()
    lift, covered = q["direction_lift_over_baseline"], q["predicted_down_ratio"]
    floor_lift = F.greatest(lift, F.lit(-0.20))
    share = q["validation_down_ratio"]
    widest = F.least(F.lit(0.42), F.greatest(F.lit(0.12), share * 1.15))
    if risk:
        score = (
            q["down_precision"] * 0.36 + q["down_recall"] * 0.28 + q["balanced_direction_accuracy"] * 0.18
            + q["direction_macro_f1"] * 0.10 + floor_lift * 0.08
            - F.greatest(0.03 - covered, F.lit(0.0)) * 2.0
            - F.greatest(covered - widest, F.lit(0.0)) * 3.5
            - F.when((q["down_precision"] < 0.35) & (covered > share), (0.35 - q["down_precision"]) * 1.5).otherwise(0.0)
        )
    else:
        penalty = F.when(lift < 0, F.least(F.abs(lift), F.lit(0.30)) * 1.2).otherwise(0.0)
        score = q["balanced_direction_accuracy"] * 0.45 + q["direction_macro_f1"] * 0.30 + floor_lift * 0.25 - penalty
    return counts.select(
        "candidate", "min_prob", "min_margin", "n", *[f"actual_{c}" for c in LABELS],
        q["direction_accuracy"].alias("accuracy"), q["majority_baseline_accuracy"].alias("baseline"), lift.alias("lift"),
        q["down_recall"].alias("down_recall"), q["down_precision"].alias("down_precision"),
        covered.alias("predicted_down_ratio"), widest.alias("max_down_coverage"), score.alias("score"),
    )


def tune_decision(df: DataFrame, risk: bool = True) -> dict | None:
    """MOD-9: the decision to use, from the 81 scored candidates; None with too few rows or one class."""
    rows = sorted(decision_grid(df, risk).collect(), key=lambda r: r["candidate"])
    if not rows or rows[0]["n"] < 12 or sum(rows[0][f"actual_{c}"] > 0 for c in LABELS) < 2:
        return None
    best = rows[0]
    for row in rows[1:]:
        if row["score"] > best["score"] + 1e-6:
            best = row
    usable = best["lift"] >= LIFT_FLOOR or (
        risk
        and best["down_recall"] > 0
        and best["down_precision"] >= 0.30
        and 0.03 <= best["predicted_down_ratio"] <= best["max_down_coverage"] + 0.05
    )
    if not usable:
        label = max(LABELS, key=lambda c: (best[f"actual_{c}"], -c))
        return {"mode": "majority_class", "label": label, "calibration_accuracy": best["baseline"], "calibration_lift_over_baseline": 0.0}
    chosen = {"mode": "argmax"}
    if best["candidate"] > 0:
        chosen = {"mode": "direction_gate", "min_direction_prob": best["min_prob"], "min_direction_margin": best["min_margin"]}
    facts = {"accuracy": "accuracy", "majority_baseline": "baseline", "lift_over_baseline": "lift"}
    facts |= {c: c for c in ("down_recall", "down_precision", "predicted_down_ratio", "max_down_coverage")}
    return chosen | {f"calibration_{k}": float(best[v]) for k, v in facts.items()}


# --- Tabular training ----------------------------------------------------------------------------


def _one_row(df: DataFrame, prefix: str = "") -> dict[str, float]:
    row = df.first()
    return {f"{prefix}{k}": float(v) for k, v in row.asDict().items() if v is not None} if row else {}


def _guard_metrics(scored: DataFrame, risk: bool, prefix: str = "") -> dict[str, float]:
    """EVA-1 of the guarded decision, with the raw and guarded variants beside it."""
    guarded = _one_row(guarded_metrics(scored, [], risk))
    raw = _one_row(direction_metrics(scored, []), f"{prefix}raw_")
    out = {f"{prefix}{k}": v for k, v in guarded.items() if not k.startswith(("guard_", "raw_"))}
    out |= {f"{prefix}guarded_{k.removeprefix(prefix)}": v for k, v in list(out.items())}
    return out | raw | {
        f"{prefix}validation_guard_used": guarded.get("guard_used", 0.0),
        f"{prefix}validation_guard_label": guarded.get("guard_label", -1.0),
        f"{prefix}guarded_used_majority_baseline": guarded.get("guard_used", 0.0),
        f"{prefix}guarded_raw_lift_over_baseline": guarded.get("raw_lift_over_baseline", 0.0),
    }


def walk_forward_scored(vectors: DataFrame, spec: Spec, risk: bool, fit: Callable | None = None, newest: int = 0) -> DataFrame | None:
    """EVA-4: `fold`, `symbol`, `y_true`, `y_pred` of three forward folds; each tunes its decision inside the training part. None without rows.

    `fit(rows, spec, risk)` gives a member of the spec's kind; by default a tabular one. `newest` bounds the
    training rows of each symbol and fold; 0 takes all.
    """
    fit = fit or _fit_direction
    folds = walk_forward(vectors)
    scored = None
    for f in [r["fold"] for r in folds.select("fold").distinct().orderBy("fold").collect()]:
        rows = folds.where(F.col("fold") == f)
        train, validation = rows.where("is_train"), rows.where(~F.col("is_train"))
        size = train.groupBy("symbol").agg(F.max("seq").alias("seq_rows"))
        train = train.drop("seq_rows", "is_train").join(size, "symbol")
        inner = time_split(train)
        if newest:
            train = train.where(F.col("seq") > F.col("seq_rows") - newest)
            inner = inner.where(~F.col("is_train") | (F.col("seq") > train_end() - newest))
        tuner = fit(inner.where("is_train"), spec, risk)
        decision = tune_decision(tuner.with_probabilities(inner.where(~F.col("is_train"))), risk)
        model = fit(train, spec, risk)
        part = model.with_probabilities(validation).select(
            F.lit(f).alias("fold"), "symbol", F.col("next_direction").alias("y_true"), decide(decision, risk).alias("y_pred")
        )
        scored = part if scored is None else scored.unionByName(part)
    return None if scored is None else materialize(scored, "fold-scores")


def walk_forward_metrics(vectors: DataFrame, spec: Spec, risk: bool, fit: Callable | None = None, newest: int = 0) -> dict[str, float]:
    """EVA-4: direction quality over the forward folds together."""
    scored = walk_forward_scored(vectors, spec, risk, fit, newest)
    return {} if scored is None else _guard_metrics(scored, risk, "walk_forward_")


def train_tabular(
    dataset: DataFrame, spec: Spec, horizon: int = 5, risk: bool = True, with_folds: bool = True
) -> TrainedModel:
    """MOD-1: return regressor and direction classifier with tuned decision, evaluation and back-test."""
    encoder = category_encoder(dataset)
    keep = ["symbol", "event_time", "next_return", "next_direction", "seq", "seq_rows", "features", *EVIDENCE]
    vectors = _assemble(dataset, encoder, spec.features).select(*[c for c in keep if c == "features" or c in dataset.columns]).persist()
    try:
        split = time_split(vectors)
        train, test = split.where("is_train").drop("is_train"), split.where(~F.col("is_train")).drop("is_train")
        cut = F.greatest(F.lit(1), F.least(F.col("seq_rows") - 1, F.floor(F.col("seq_rows") * F.lit(0.8))))
        inner = time_split(train.withColumn("seq_rows", cut))
        price = _fit_price(train, spec)
        tuner = _direction(inner.where("is_train").drop("is_train"), spec, risk)
        decision = tune_decision(tuner.with_probabilities(inner.where(~F.col("is_train"))), risk) or {"mode": "argmax"}
        direction = _direction(train, spec, risk)
        scored = direction.with_probabilities(price.transform(test).withColumnRenamed("prediction", "predicted_return"))
        scored = scored.withColumns(
            {"y_true": F.col("next_direction"), "y_pred": decide(decision, risk), "confidence": display_confidence()}
        )
        scored = _stored_scores(scored)
        metrics = {"return_mae": scored.agg(F.avg(F.abs(F.col("next_return") - F.col("predicted_return")))).first()[0] or 0.0}
        metrics |= _guard_metrics(scored, risk)
        metrics |= _one_row(alert_backtest(scored, [], spec.threshold, risk, use_evidence=True))
        metrics |= {k: float(v) for k, v in decision.items() if k.startswith("calibration_")}
        metrics |= {"direction_threshold": spec.threshold, "prediction_horizon": float(horizon), "risk_target_enabled": float(risk)}
        metrics |= walk_forward_metrics(vectors, spec, risk) if with_folds else {"walk_forward_skipped": 1.0}
        if metrics.get("validation_guard_used") == 1.0:
            decision = {"mode": "majority_class", "label": int(metrics["validation_guard_label"])}
    finally:
        vectors.unpersist()
    return TrainedModel(spec, price, direction, decision, metrics, horizon, risk, encoder=encoder, scored=scored)


def _stored_scores(scored: DataFrame) -> DataFrame:
    """Scored rows without vectors and windows, written once."""
    wide = [f.name for f in scored.schema.fields if isinstance(f.dataType, VectorUDT) or f.name == "sequence"]
    return materialize(scored.drop(*wide), "scored")


@dataclass
class SequenceDirection:
    """A perceptron over flattened windows, scaled by the rows it was fitted on."""

    scaler: list[dict]
    model: DirectionModel

    def vectors(self, windows: DataFrame) -> DataFrame:
        return _flat(scale_windows(windows, self.scaler))

    def with_probabilities(self, windows: DataFrame) -> DataFrame:
        return self.model.with_probabilities(self.vectors(windows))


def fit_sequence(windows: DataFrame, spec: Spec, risk: bool) -> SequenceDirection:
    """MOD-4: scaler (LAB-11) and network of one set of training windows."""
    scaler = [r.asDict() for r in fit_scaler(windows, spec.features).orderBy("place").collect()]
    label = (F.col("next_direction") == DOWN).cast("double") if risk else F.col("next_direction").cast("double")
    layers = [spec.window * len(spec.features), spec.hidden, 2 if risk else 3]
    network = MultilayerPerceptronClassifier(layers=layers, maxIter=spec.epochs, seed=42, labelCol="label")
    model = network.fit(_flat(scale_windows(windows, scaler)).withColumn("label", label))
    return SequenceDirection(scaler, DirectionModel({str(DOWN) if risk else "all": model}))


def train_sequence(
    dataset: DataFrame, spec: Spec, horizon: int = 5, risk: bool = True, cap: int = 80000, with_folds: bool = True
) -> TrainedModel:
    """MOD-4: perceptron and linear regression over flattened, scaled windows (LAB-10, LAB-11).

    `cap` bounds the training windows only. The decision is tuned on the newest part of the training windows, by
    a network that has not seen them; a side without windows is an error.
    """
    windows = time_split(sequences(dataset, spec.window, cap, spec.features)).persist()
    try:
        train, test = windows.where("is_train").drop("is_train"), windows.where(~F.col("is_train")).drop("is_train")
        if train.isEmpty() or test.isEmpty():
            raise ValueError(f"no training or no test windows of {spec.window} rows")
        inner = tuning_split(train, spec.window)
        tuner = fit_sequence(inner.where("is_train"), spec, risk)
        decision = tune_decision(tuner.with_probabilities(inner.where(~F.col("is_train"))), risk) or {"mode": "argmax"}
        direction = fit_sequence(train, spec, risk)
        price = LinearRegression(labelCol="next_return", regParam=0.01).fit(direction.vectors(train))
        scored = price.transform(direction.vectors(test)).withColumnRenamed("prediction", "predicted_return")
        scored = direction.model.with_probabilities(scored).withColumns(
            {"y_true": F.col("next_direction"), "y_pred": decide(decision, risk), "confidence": display_confidence()}
        )
        scored = _stored_scores(scored)
        metrics = {"return_mae": scored.agg(F.avg(F.abs(F.col("next_return") - F.col("predicted_return")))).first()[0] or 0.0}
        metrics |= _guard_metrics(scored, risk)
        metrics |= _one_row(alert_backtest(scored, [], spec.threshold, risk))
        metrics |= {k: float(v) for k, v in decision.items() if k.startswith("calibration_")}
        if with_folds:
            newest = max(1, cap // max(dataset.agg(F.count_distinct("symbol")).first()[0], 1)) if cap > 0 else 0
            every = sequences(dataset, spec.window, features=spec.features)
            metrics |= walk_forward_metrics(every, spec, risk, fit_sequence, newest)
        else:
            metrics["walk_forward_skipped"] = 1.0
    finally:
        windows.unpersist()
    return TrainedModel(spec, price, direction.model, decision, metrics, horizon, risk, scaler=direction.scaler, scored=scored)


def _flat(windows: DataFrame) -> DataFrame:
    return windows.withColumn("features", array_to_vector(F.flatten("sequence"))).drop("sequence")


def train(dataset: DataFrame, spec: Spec, horizon: int = 5, risk: bool = True, with_folds: bool = True) -> TrainedModel:
    if spec.kind == "sequence":
        return train_sequence(dataset, spec, horizon, risk, with_folds=with_folds)
    return train_tabular(dataset, spec, horizon, risk, with_folds)


# --- Prediction ----------------------------------------------------------------------------------


def _finish(scored: DataFrame, decision: dict | None, risk: bool, version: str, threshold: float) -> DataFrame:
    """Decision, override, confidence and alert filter of scored rows."""
    rows = scored.withColumn(
        "predicted_direction", return_override(decide(decision, risk), F.col("predicted_return"), risk=risk)
    ).withColumns(
        {
            "predicted_signal": signal_name("predicted_direction"),
            "confidence": display_confidence(),
            "model_version": F.lit(version),
        }
    )
    return rows.withColumns(alert_filter(rows.columns, threshold, risk))


def predict_latest(features: DataFrame, model: TrainedModel, version: str) -> DataFrame:
    """MOD-12 (MOD-4 for sequences): the newest row of each symbol, scored."""
    if model.spec.kind == "sequence":
        rows = features.withColumns({"seq": F.col("pos"), "seq_rows": F.col("group_rows")})
        tail = rows.where(F.col("seq") > F.col("seq_rows") - model.spec.window)
        windows = sequences(tail, model.spec.window, 0, model.spec.features).where(F.col("seq") == F.col("seq_rows"))
        scaler = features.sparkSession.createDataFrame(model.scaler)
        latest = _flat(scale_sequences(windows, scaler)).select("symbol", "event_time", "features")
        latest = latest.join(features.where(F.col("pos") == F.col("group_rows")), ["symbol", "event_time"])
    else:
        latest = _assemble(features.where(F.col("pos") == F.col("group_rows")), model.encoder, model.spec.features)
    price = model.price.transform(latest).withColumnRenamed("prediction", "predicted_return")
    scored = model.direction.with_probabilities(price).drop("features")
    risk_score = F.col("prob_down") if model.spec.kind == "sequence" else F.lit(0.0)
    scored = scored.withColumns(
        {
            "predicted_next_price": stable_round(F.col("last_price") * (1 + F.col("predicted_return")), 2),
            "sequence_risk_score": risk_score,
        }
    )
    return _finish(scored, model.decision, model.risk, f"{model.name}-{version}", model.spec.threshold)


ENSEMBLE_COLUMNS = [
    "symbol", "company_name", "category", "sector", "last_price", "predicted_next_price", "predicted_signal",
    "alert_signal", "confidence", "model_risk_score", "technical_risk_score", "sequence_risk_score", "final_risk_score",
    "model_version",
]


def combine_predictions(members: DataFrame, weights: DataFrame, base: DataFrame, version: str, threshold: float = 0.02, risk: bool = True) -> DataFrame:
    """MOD-14: weighted average of the members' predictions per symbol, decided and filtered again.

    `members` has (symbol, model_name, predicted_next_price, probabilities,
    sequence_risk_score), `weights` (model_name, weight; one row per model),
    `base` the symbol's data and evidence. Symbols a member has not scored are left out.
    """
    used = weights.where(F.col("weight") > 0)
    size = used.agg(F.count(F.lit(1)).alias("__members"))
    rows = members.join(F.broadcast(used), "model_name")
    mean = lambda c: F.sum(F.col(c) * F.col("weight")) / F.sum("weight")
    joined = rows.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("__found"),
        stable_round(mean("predicted_next_price"), 2).alias("predicted_next_price"),
        *[clip(mean(c), 0, 1).alias(c) for c in [*PROBS, "sequence_risk_score"]],
    )
    joined = joined.crossJoin(F.broadcast(size)).where(F.col("__found") == F.col("__members")).drop("__found", "__members")
    rows = base.join(joined, "symbol")
    moved = ratio(F.col("predicted_next_price") - F.col("last_price"), F.col("last_price"))
    return _finish(rows.withColumn("predicted_return", moved), None, risk, f"ensemble-{version}", threshold).select(*ENSEMBLE_COLUMNS)


def predict_ensemble(features: DataFrame, models: list[TrainedModel], version: str) -> DataFrame:
    """MOD-14: all models' newest predictions combined; with one usable model, that model's own."""
    spark = features.sparkSession
    weights = ensemble_weights(metrics_frame(spark, models, version)).collect()
    usable = {r["model_name"]: r["weight"] for r in weights if r["weight"] > 0}
    used = [m for m in models if m.name in usable]
    if len(used) < 2:
        pool = [m for m in models if m.name != "random_forest"] or models
        best = best_models(metrics_frame(spark, pool, version)).first()["model_name"]
        chosen = next(m for m in pool if m.name == best)
        return predict_latest(features, chosen, version).select(*ENSEMBLE_COLUMNS)
    columns = ["symbol", "predicted_next_price", *PROBS, "sequence_risk_score"]
    members = None
    for m in used:
        part = predict_latest(features, m, version).select(F.lit(m.name).alias("model_name"), *columns)
        members = part if members is None else members.unionByName(part)
    newest = features.where(F.col("pos") == F.col("group_rows"))
    base = newest.select("symbol", "company_name", "category", "sector", "last_price", *EVIDENCE)
    total = sum(usable.values())
    threshold = sum(m.spec.threshold * usable[m.name] for m in used) / total
    shares = spark.createDataFrame(list(usable.items()), "model_name string, weight double")
    return combine_predictions(members, shares, base, version, threshold, used[0].risk)


# --- Metrics, weights and selection --------------------------------------------------------------


def metrics_frame(spark: SparkSession, models: list[TrainedModel], version: str) -> DataFrame:
    """EVA-5: trained models' metrics in long form."""
    rows = [(version, m.name, k.removeprefix(f"{m.name}_"), float(v)) for m in models for k, v in m.metrics.items()]
    return spark.createDataFrame(rows, "model_version string, model_name string, metric_name string, metric_value double")


def _wide(metrics: DataFrame, names: set[str]) -> DataFrame:
    pick = lambda n: F.max(F.when(F.col("metric_name") == n, F.col("metric_value"))).alias(n)
    return metrics.where(F.col("metric_name").isin(sorted(names))).groupBy("model_version", "model_name").agg(*[pick(n) for n in sorted(names)])


def _first(default: float, *names: str) -> Column:
    return F.coalesce(*[F.col(n) for n in names], F.lit(default))


SCORE_METRICS = {
    f"{p}{m}"
    for p in ("", "walk_forward_")
    for m in (
        "balanced_direction_accuracy", "direction_macro_f1", "direction_lift_over_baseline", "down_recall",
        "down_precision", "predicted_down_ratio",
    )
} | {
    "calibration_lift_over_baseline", "calibration_max_down_coverage", "alert_backtest_hit_rate",
    "alert_backtest_coverage", "alert_backtest_down_hit_rate", "alert_backtest_down_avg_inverse_return",
    "alert_backtest_up_avg_return", "walk_forward_validation_guard_used", "return_mae", "price_mae",
}


def weight_score(risk: bool = True) -> Column:
    """MOD-13: a model's raw ensemble weight from its wide metrics row; never below 0.005."""
    balanced = _first(0.0, "walk_forward_balanced_direction_accuracy")
    f1 = _first(0.0, "walk_forward_direction_macro_f1", "direction_macro_f1")
    part = lambda value, low, high: clip(value, low, high)
    if risk:
        recall = _first(0.0, "walk_forward_down_recall", "down_recall")
        precision = _first(0.0, "walk_forward_down_precision", "down_precision")
        covered = _first(0.0, "walk_forward_predicted_down_ratio", "predicted_down_ratio")
        hit = _first(0.0, "alert_backtest_down_hit_rate", "alert_backtest_hit_rate")
        gained = _first(0.0, "alert_backtest_down_avg_inverse_return")
        score = (
            recall * 0.38 + precision * 0.22 + balanced * 0.16 + f1 * 0.10
            + part(hit - 0.35, 0, 0.35) * 0.08 + part(gained, 0, 0.08) * 0.06
        )
        score = score * F.when(covered < 0.03, 0.50).otherwise(1.0)
        score = score * F.when(covered > 0.60, 0.35).when(covered > 0.50, 0.55).when(covered > 0.42, 0.75).otherwise(1.0)
        return F.when((recall <= 0) | (covered <= 0), 0.005).otherwise(F.greatest(score, F.lit(0.005)))
    own = _first(0.0, "balanced_direction_accuracy", "walk_forward_balanced_direction_accuracy")
    first_lift = _first(0.0, "direction_lift_over_baseline")
    lift = _first(0.0, "walk_forward_direction_lift_over_baseline", "direction_lift_over_baseline")
    name = F.col("model_name")
    score = (
        balanced * 0.45 + own * 0.20 + f1 * 0.20
        + F.greatest(lift, F.lit(-0.20)) * 0.10 + F.greatest(first_lift, F.lit(-0.20)) * 0.05
        + part(_first(0.0, "alert_backtest_hit_rate") - 0.33, 0, 0.25) * 0.04
        + part(_first(0.0, "calibration_lift_over_baseline"), 0, 0.20) * 0.01
    )
    for value in (lift, first_lift):
        score = score * F.when(value < 0, F.greatest(F.lit(0.15), 1.0 + value * 8.0)).otherwise(1.0)
    score = score * F.when(_first(0.0, "alert_backtest_coverage") <= 0, 0.80).otherwise(1.0)
    score = score * F.when(name == "lstm", F.when(lift <= 0, 0.14).otherwise(0.70)).when(name == "random_forest", 0.85).otherwise(1.0)
    weak = (lift <= -0.03) | (first_lift <= -0.03)
    return F.when(weak, 0.005).otherwise(F.greatest(score, F.lit(0.005)))


def ensemble_weights(metrics: DataFrame, risk: bool = True, anchor_share: float = 0.85, sequence_cap: float = 0.10) -> DataFrame:
    """MOD-13: normalised weight per (version, model).

    In risk mode the boosted model keeps at least `anchor_share`; the others
    share the rest by score, under their caps. A version has a handful of rows.
    """
    scored = _wide(metrics, SCORE_METRICS).withColumn("raw", weight_score(risk))
    version = W.partitionBy("model_version")
    name, anchor = F.col("model_name"), F.col("model_name") == "lightgbm"
    plain = F.col("raw") / F.sum("raw").over(version)
    if not risk:
        return scored.select("model_version", "model_name", plain.alias("weight"))
    budget = max(0.0, 1.0 - anchor_share)
    lift = _first(0.0, "walk_forward_direction_lift_over_baseline")
    covered = _first(0.0, "walk_forward_predicted_down_ratio")
    widest = F.greatest(_first(0.42, "calibration_max_down_coverage") + 0.08, F.lit(0.50))
    doubtful = (lift <= 0) | (_first(0.0, "alert_backtest_down_avg_inverse_return") <= 0) | (_first(0.0, "walk_forward_validation_guard_used") >= 1)
    cap = F.lit(min(budget, sequence_cap))
    cap = F.when(doubtful, F.least(cap, F.lit(0.05))).otherwise(cap)
    cap = F.when(covered > 0.55, F.least(cap, F.lit(0.03))).otherwise(cap)
    cap = F.when((lift < 0) & (covered > widest), 0.0).otherwise(cap)
    caps = F.when(name == "lstm", cap).when(name == "random_forest", F.least(F.lit(budget), F.lit(0.05))).otherwise(budget)
    others = F.sum(F.when(~anchor, F.col("raw"))).over(version)
    share = F.when(~anchor, F.least(budget * F.col("raw") / others, caps))
    staged = scored.select(
        "model_version", "model_name", plain.alias("plain"), share.alias("share"),
        F.max(anchor.cast("int")).over(version).alias("anchored"),
    )
    rest = F.least(F.coalesce(F.sum("share").over(version), F.lit(0.0)), F.lit(budget))
    staged = staged.withColumn("w", F.coalesce("share", F.greatest(F.lit(anchor_share), 1.0 - rest)))
    weight = F.when(F.col("anchored") == 1, F.col("w") / F.sum("w").over(version)).otherwise(F.col("plain"))
    return staged.select("model_version", "model_name", weight.alias("weight")).where(F.col("weight") > 0)


def quality_score() -> Column:
    """MOD-15: a model's direction quality from its wide metrics row."""
    own, f1 = _first(0.0, "balanced_direction_accuracy"), _first(0.0, "direction_macro_f1")
    lift = _first(-0.5, "walk_forward_direction_lift_over_baseline", "direction_lift_over_baseline")
    score = (
        _first(0.0, "walk_forward_balanced_direction_accuracy", "balanced_direction_accuracy") * 0.35
        + _first(0.0, "walk_forward_direction_macro_f1", "direction_macro_f1") * 0.25
        + own * 0.20 + f1 * 0.10
        + F.greatest(lift, F.lit(-0.5)) * 0.05 - F.least(_first(0.05, "return_mae"), F.lit(0.2)) * 0.05
        + F.least(_first(0.0, "alert_backtest_down_avg_inverse_return"), F.lit(0.0)) * 5.0
        + clip(_first(0.0, "alert_backtest_up_avg_return"), 0, 0.02) * 3.0
    )
    return score - F.when(lift < 0, F.least(F.abs(lift), F.lit(0.30)) * 0.35).otherwise(0.0)


def best_models(metrics: DataFrame) -> DataFrame:
    """MOD-15: the model to use per version: best quality above the baseline, else best quality, else least error."""
    wide = _wide(metrics, SCORE_METRICS)
    directed = F.coalesce("balanced_direction_accuracy", "walk_forward_balanced_direction_accuracy", "direction_macro_f1").isNotNull()
    lift = _first(-1.0, "walk_forward_direction_lift_over_baseline", "direction_lift_over_baseline")
    place = F.array_position(F.array(*map(F.lit, ["lightgbm", "lstm", "random_forest"])), F.col("model_name"))
    tier = (
        F.when(directed & (lift > 0), 0)
        .when(directed, 1)
        .when(F.col("return_mae").isNotNull(), 2)
        .when(F.col("price_mae").isNotNull(), 3)
        .otherwise(4)
    )
    error = F.when(tier == 2, F.col("return_mae")).when(tier == 3, F.col("price_mae")).otherwise(F.lit(0.0))
    key = F.when(directed, -stable_round("quality", 9)).otherwise(error)
    ranked = wide.withColumn("quality", quality_score()).withColumns({"tier": tier, "key": key, "place": place})
    return ranked.groupBy("model_version").agg(
        F.min_by(F.struct("model_name", "quality"), F.struct("tier", "key", "place", "model_name")).alias("b")
    ).select("model_version", "b.model_name", F.col("b.quality").alias("quality"))


# --- Parameter search ----------------------------------------------------------------------------


def search_score() -> Column:
    """MOD-16: score of a tried setting from its wide metrics row."""
    lift = _first(0.0, "walk_forward_direction_lift_over_baseline", "direction_lift_over_baseline")
    own = F.coalesce(F.col("direction_lift_over_baseline"), lift)
    guarded = F.coalesce(F.col("guarded_direction_lift_over_baseline"), own)
    forward = F.coalesce(F.col("walk_forward_guarded_direction_lift_over_baseline"), lift)
    zero, floor = F.lit(0.0), F.lit(-0.2)
    score = (
        _first(0.0, "walk_forward_balanced_direction_accuracy", "balanced_direction_accuracy") * 0.52
        + _first(0.0, "walk_forward_direction_macro_f1", "direction_macro_f1") * 0.23
        + F.greatest(lift, floor) * 0.15 + F.greatest(own, floor) * 0.07
        + F.greatest(_first(0.0, "calibration_lift_over_baseline"), zero) * 0.03
        + F.greatest(guarded, zero) * 0.02 + F.greatest(forward, zero) * 0.03
    )
    short = F.abs(F.least(lift, zero)) + F.abs(F.least(own, zero))
    return score - F.when((lift < 0) | (own < 0), F.least(short, F.lit(0.5))).otherwise(0.0)


SEARCH_METRICS = SCORE_METRICS | {
    "direction_accuracy", "majority_baseline_accuracy", "walk_forward_direction_accuracy",
    "walk_forward_majority_baseline_accuracy", "guarded_direction_lift_over_baseline",
    "walk_forward_guarded_direction_lift_over_baseline",
}


def search_report(tried: DataFrame) -> DataFrame:
    """MOD-16: one row per tried setting with pass flags and score.

    `tried` has (model_name, setting, error, metric_name, metric_value); a failed
    setting has an error and no metrics.
    """
    pick = lambda n: F.max(F.when(F.col("metric_name") == n, F.col("metric_value"))).alias(n)
    wide = tried.groupBy("model_name", "setting").agg(F.max("error").alias("error"), *[pick(n) for n in sorted(SEARCH_METRICS)])
    fine = F.col("error").isNull()
    yes = lambda *names: fine & F.coalesce(F.least(*[F.col(n) for n in names]) >= 0, F.lit(False)) & F.col(names[0]).isNotNull() & F.col(names[1]).isNotNull()
    return wide.withColumns(
        {
            "passes_baseline": yes("direction_lift_over_baseline", "walk_forward_direction_lift_over_baseline"),
            "operational_passes_baseline": yes(
                "guarded_direction_lift_over_baseline", "walk_forward_guarded_direction_lift_over_baseline"
            ),
            "score": search_score(),
        }
    )


def best_settings(report: DataFrame) -> DataFrame:
    """MOD-16: per model the best passing setting, else the best operationally passing one, else the best."""
    order = F.struct(F.col("passes_baseline").cast("int"), F.col("operational_passes_baseline").cast("int"), "score", "setting")
    rest = [c for c in report.columns if c != "model_name"]
    return report.groupBy("model_name").agg(F.max_by(F.struct(*rest), order).alias("b")).select("model_name", "b.*")


def _tried(data: DataFrame, spec: Spec, setting: str, horizon: int) -> list[tuple]:
    """The metrics of one setting as rows; a failure is a row with its error."""
    try:
        metrics = train(data, spec, horizon).metrics
        return [(spec.name, setting, None, k, float(v)) for k, v in metrics.items()]
    except Exception as exc:  # noqa: BLE001  a failed setting is a result
        return [(spec.name, setting, str(exc), None, None)]


TRIED = "model_name string, setting string, error string, metric_name string, metric_value double"


def search(
    datasets: Callable[[int, float], DataFrame], specs: list[Spec], horizons: list[int], thresholds: list[float], spark: SparkSession
) -> DataFrame:
    """MOD-16: every spec on every horizon and threshold; failures become rows with their error."""
    rows = []
    for h in horizons:
        for t in thresholds:
            data = datasets(h, t).persist()
            for i, spec in enumerate(specs):
                rows += _tried(data, spec, _setting(i, spec, h, t), h)
            data.unpersist()
    return search_report(spark.createDataFrame(rows, TRIED))


def _setting(i: int, spec: Spec, horizon: int, threshold: float) -> str:
    return f"{i}-{spec.kind}-d{spec.depth}-h{horizon}-t{threshold:g}"


def newest_part(data: DataFrame, share: float) -> DataFrame:
    """The newest `share` of each symbol's rows, numbered from 1 again."""
    left_out = F.floor(F.col("seq_rows") * F.lit(1.0 - share))
    return data.where(F.col("seq") > left_out).withColumns({"seq": F.col("seq") - left_out, "seq_rows": F.col("seq_rows") - left_out})


def halving_search(
    datasets: Callable[[int, float], DataFrame],
    specs: list[Spec],
    horizons: list[int],
    thresholds: list[float],
    spark: SparkSession,
    shares: tuple[float, ...] = (0.25, 1.0),
    keep: int = 2,
    side_by_side: int = 3,
) -> tuple[DataFrame, dict[float, int]]:
    """MOD-16 by successive halving: all settings on the newest part of the rows, then of each model the best 1 / `keep` on more.

    Settings of a round run side by side, each in a scheduler pool of its own. Returns the report, in which a setting that was
    left behind has the metrics of its last round, and how many settings each share of the rows was tried with. A setting
    that fails goes on no further and keeps its error.
    """
    grid = {_setting(i, spec, h, t): (spec, h, t) for h in horizons for t in thresholds for i, spec in enumerate(specs)}
    left, done, fits = list(grid), {}, {}
    for n, share in enumerate(shares):
        made = {(h, t): (newest_part(datasets(h, t), share) if share < 1 else datasets(h, t)).persist() for h, t in {grid[x][1:] for x in left}}

        def attempt(setting: str, made=made) -> list[tuple]:
            spec, h, t = grid[setting]
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", setting)
            return _tried(made[h, t], spec, setting, h)

        with ThreadPool(side_by_side) as pool:
            results = pool.map(inheritable_thread_target(spark)(attempt), left)
        for data in made.values():
            data.unpersist()
        done |= dict(zip(left, results, strict=True))
        fits[share] = len(left)
        if n + 1 < len(shares):
            ranked = search_report(spark.createDataFrame([r for x in left for r in done[x]], TRIED)).where("error IS NULL").collect()
            left = []
            for model in sorted({r["model_name"] for r in ranked}):
                own = sorted((r for r in ranked if r["model_name"] == model), key=_rank, reverse=True)
                left += [r["setting"] for r in own[: -(-len(own) // keep)]]
    report = search_report(spark.createDataFrame([r for rows in done.values() for r in rows], TRIED))
    return report.withColumn("finished", F.col("setting").isin(left)), fits


def _rank(row) -> tuple:
    """The order of `best_settings`."""
    return tuple((row[c] is not None, row[c] or 0) for c in ("passes_baseline", "operational_passes_baseline", "score")) + (row["setting"],)


# --- Model store ---------------------------------------------------------------------------------

PRICE_LOADERS = {"forest": RandomForestRegressionModel, "boosted": GBTRegressionModel, "sequence": LinearRegressionModel}
CLASS_LOADERS = {
    "forest": RandomForestClassificationModel,
    "boosted": GBTClassificationModel,
    "sequence": MultilayerPerceptronClassificationModel,
}


class ModelStore:
    """SNK-10: versioned model sets under a folder, with a registry table."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def save(self, spark: SparkSession, models: list[TrainedModel], version: str, saved_at: datetime) -> None:
        rows = []
        for m in models:
            base = f"{self.root}/models/{version}/{m.name}"
            m.price.write().overwrite().save(f"{base}/price")
            for key, model in m.direction.models.items():
                model.write().overwrite().save(f"{base}/direction-{key}")
            for c, model in m.direction.calibrators.items():
                model.write().overwrite().save(f"{base}/calibrator-{c}")
            if m.encoder is not None:
                m.encoder.write().overwrite().save(f"{base}/encoder")
            extra = {
                "spec": m.spec.__dict__, "decision": m.decision, "metrics": m.metrics, "horizon": m.horizon, "risk": m.risk,
                "scaler": m.scaler, "parts": list(m.direction.models), "calibrators": list(m.direction.calibrators),
                "calibration": m.direction.calibration,
            }
            rows.append((version, m.name, saved_at, json.dumps(extra)))
        schema = "version string, model_name string, saved_at timestamp, extra string"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{self.root}/registry")

    def load_latest(self, spark: SparkSession, prefix: str = "") -> tuple[list[TrainedModel], str]:
        """The newest version with the prefix; members that cannot be read are left out."""
        try:
            registry = spark.read.parquet(f"{self.root}/registry").where(F.col("version").startswith(prefix))
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            raise FileNotFoundError(f"no saved models under {self.root}") from exc
        newest = registry.agg(F.max(F.struct("saved_at", "version")).alias("m")).first()["m"]
        if newest is None:
            raise FileNotFoundError(f"no saved models with prefix {prefix!r}")
        models = []
        for row in registry.where(F.col("version") == newest["version"]).collect():
            try:
                models.append(self._load(row))
            except Exception as exc:  # noqa: BLE001  a broken member is left out, and said
                warnings.warn(f"model {row['model_name']} of {row['version']} cannot be read: {exc}", stacklevel=2)
        if not models:
            raise FileNotFoundError(f"version {newest['version']} is incomplete")
        return models, newest["version"]

    def _load(self, row) -> TrainedModel:
        extra = json.loads(row["extra"])
        spec = Spec(**extra["spec"])
        base = f"{self.root}/models/{row['version']}/{row['model_name']}"
        loader = CLASS_LOADERS[spec.kind]
        reader = IsotonicRegressionModel if extra["calibration"] == "isotonic" else LogisticRegressionModel
        direction = DirectionModel(
            {k: loader.load(f"{base}/direction-{k}") for k in extra["parts"]},
            {c: reader.load(f"{base}/calibrator-{c}") for c in extra["calibrators"]},
            extra["calibration"],
        )
        encoder = None if spec.kind == "sequence" else PipelineModel.load(f"{base}/encoder")
        price = PRICE_LOADERS[spec.kind].load(f"{base}/price")
        return TrainedModel(
            spec, price, direction, extra["decision"], extra["metrics"], extra["horizon"], extra["risk"], encoder, extra["scaler"]
        )


def predict_saved(features: DataFrame, store: ModelStore, prefix: str = "") -> DataFrame:
    """MOD-17: predictions of the newest saved set; metrics stay as they are."""
    models, version = store.load_latest(features.sparkSession, prefix)
    return predict_ensemble(features, models, version)
