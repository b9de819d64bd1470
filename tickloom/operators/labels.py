"""Labels and data sets (LAB-1 .. LAB-16).

Feature rows carry `pos` (1-based) and `group_rows` of their symbol and, per
horizon h, next_price_h, future_min_h and future_max_h (computed in the feature
pass), so a label for any threshold is a projection.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tickloom.functions.decision import DOWN, FLAT, LABELS, UP
from tickloom.functions.numeric import count_where, ratio
from tickloom.operators.features import FEATURES
from tickloom.operators.ordered import exact_median, with_position, with_segments

# Fixed values.
MIN_MOVE = 0.02
RISK_FALL = 0.03
RISK_RANGE = 0.06
DOWN_BOOST = 1.35
TRAIN_SHARE = 0.8
FOLDS = 3
FIRST_TRAIN_SHARE = 0.5
FOLD_SHARE = 0.1
THRESHOLDS = [0.003, 0.005, 0.01, 0.015, 0.02]
CATEGORIES = ["category", "sector"]
# Slots that symbols are hashed into, so that the width of a row does not grow with the catalogue.
SYMBOL_SLOTS = 256


def with_future(df: DataFrame, horizon: int) -> DataFrame:
    """LAB-1, 2: forward return, lowest forward return and forward range; rows without a future go."""
    price = F.col("last_price")
    rel = lambda value: F.when(F.abs(price) > 1e-8, value / price).otherwise(0.0)
    nxt, low, high = (F.col(f"{n}_{horizon}") for n in ("next_price", "future_min", "future_max"))
    spare = [c for c in df.columns if c.startswith(("next_price_", "future_min_", "future_max_"))]
    return (
        df.where(nxt.isNotNull())
        .withColumns(
            {
                "next_price": nxt,
                "next_return": rel(nxt - price),
                "future_min_price": low,
                "future_max_price": high,
                "future_min_return": rel(low - price),
                "future_range_return": rel(high - low),
                "seq": F.col("pos"),
                "seq_rows": F.col("group_rows") - horizon,
            }
        )
        .drop(*spare)
    )


def adaptive_threshold(floor: float = MIN_MOVE) -> Column:
    """LAB-3: the 20-row volatility, at least the floor."""
    return F.greatest(F.col("volatility_20"), F.lit(floor))


def risk_label(threshold: Column) -> Column:
    """LAB-4: DOWN where the price falls, or dips within a wide range, else FLAT."""
    t = F.greatest(threshold, F.lit(RISK_FALL))
    dip = F.col("future_min_return")
    falls = (
        (F.col("next_return") <= -t)
        | (dip <= -t)
        | ((F.col("future_range_return") >= RISK_RANGE) & (dip <= -(t * 0.7)))
    )
    return F.when(falls, DOWN).otherwise(FLAT)


def direction_label(threshold: Column) -> Column:
    """LAB-5: UP / DOWN strictly beyond the threshold, else FLAT."""
    ret = F.col("next_return")
    return F.when(ret > threshold, UP).when(ret < -threshold, DOWN).otherwise(FLAT)


def labelled(df: DataFrame, horizon: int = 5, threshold: float | None = None, risk: bool = True) -> DataFrame:
    """LAB-1 .. LAB-5: the supervised data set of one horizon and threshold (None: adaptive)."""
    rows = with_future(df, horizon)
    t = adaptive_threshold() if threshold is None else F.lit(float(threshold))
    rows = rows.withColumn("direction_threshold", t)
    t = F.col("direction_threshold")
    return rows.withColumns(
        {
            "next_direction": risk_label(t) if risk else direction_label(t),
            "target_mode": F.lit("downside_risk" if risk else "direction"),
        }
    )


def model_datasets(df: DataFrame, thresholds: dict[str, float], horizon: int = 5, risk: bool = True) -> dict[str, DataFrame]:
    """LAB-6: one data set per model over the same features; equal thresholds share one."""
    made: dict[float, DataFrame] = {}
    return {name: made.setdefault(t, labelled(df, horizon, t, risk)) for name, t in thresholds.items()}


def limit_rows(df: DataFrame, cap: int, window: int, bucket: Column) -> DataFrame:
    """LAB-7: the newest rows of every symbol, then the newest `cap` rows of all; 0 keeps everything.

    Rows are picked by their positions; nothing is sorted in one place.
    """
    if cap <= 0:
        return df
    size = df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("symbol").alias("symbols")).first()
    if size["rows"] <= cap:
        return df
    per_symbol = max(cap // max(size["symbols"], 1), window + 2)
    rows = df.where(F.col("seq") > F.col("seq_rows") - per_symbol)
    rows = rows.drop("seq", "seq_rows")
    placed = with_position(rows, [], ["event_time", "symbol"], bucket, "__at", "__all")
    kept = placed.where(F.col("__at") > F.col("__all") - cap).drop("__at", "__all")
    return with_position(kept, ["symbol"], ["event_time"], bucket, "seq", "seq_rows")


def train_end(share: float = TRAIN_SHARE) -> Column:
    """Position of a symbol's last training row."""
    n = F.col("seq_rows")
    return F.greatest(F.lit(1), F.least(n - 1, F.floor(n * F.lit(share))))


def time_split(df: DataFrame, share: float = TRAIN_SHARE) -> DataFrame:
    """LAB-8: `is_train` per symbol by time; symbols with one row are left out."""
    return df.where(F.col("seq_rows") >= 2).withColumn("is_train", F.col("seq") <= train_end(share))


def global_split(df: DataFrame, bucket: Column, share: float = TRAIN_SHARE) -> DataFrame:
    """LAB-8: the fallback when every symbol has a single row: one split over all rows."""
    placed = with_position(df, [], ["event_time", "symbol"], bucket, "__at", "__all")
    n = F.col("__all")
    cut = F.greatest(F.lit(1), F.least(n - 1, F.floor(n * F.lit(share))))
    return placed.withColumn("is_train", F.col("__at") <= cut).drop("__at", "__all")


def tuning_split(train: DataFrame, window: int) -> DataFrame:
    """LAB-8 inside the training windows: `is_train` for the older ones, the newest are left to tune a decision on.

    A symbol whose older windows went by a cap is split among the windows it has; its share of all rows would leave only the
    newest part. Where that leaves no window to train on, one split over all windows by time serves, as for single rows.
    """
    first = train.groupBy("symbol").agg(F.min("seq").alias("__first"))
    gone = F.when(F.col("__first") > window, F.col("__first") - 1).otherwise(0)
    placed = train.join(first, "symbol").withColumns({"seq_rows": train_end() - gone, "seq": F.col("seq") - gone}).drop("__first")
    split = time_split(placed)
    return global_split(placed, F.to_date("event_time")) if split.where("is_train").isEmpty() else split


def walk_forward(df: DataFrame) -> DataFrame:
    """LAB-9: rows of each fold, `is_train` or validation; symbols with fewer than 10 rows are left out."""
    bounds = []
    for f in range(FOLDS):
        start = FIRST_TRAIN_SHARE + f * FOLD_SHARE
        bounds.append(
            F.struct(F.lit(f).alias("fold"), F.lit(start).alias("start"), F.lit(start + FOLD_SHARE).alias("end"))
        )
    n = F.col("seq_rows")
    last = F.greatest(F.lit(1), F.least(F.floor(n * F.col("b.start")), n - 1))
    stop = F.least(F.floor(n * F.col("b.end")), n)
    return (
        df.where(n >= 10)
        .withColumn("b", F.explode(F.array(*bounds)))
        .withColumn("__train", last)
        .withColumn("__stop", F.greatest(F.col("__train") + 1, stop))
        .where(F.col("seq") <= F.col("__stop"))
        .withColumn("fold", F.col("b.fold"))
        .withColumn("is_train", F.col("seq") <= F.col("__train"))
        .drop("b", "__train", "__stop")
    )


def sequences(df: DataFrame, window: int, cap: int = 0, features: list[str] | None = None) -> DataFrame:
    """LAB-10: for each row the feature rows of the window that ends there.

    `cap` bounds the training windows of `time_split`: each symbol keeps its newest cap / symbols
    of them, and all windows of its test part.
    """
    names = features or FEATURES
    vector = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in names])
    keep = [c for c in ("symbol", "event_time", "last_price", "next_return", "next_direction", "seq", "seq_rows") if c in df.columns]
    rows = df.select(*keep, vector.alias("__v"))
    if cap > 0:
        symbols = max(df.agg(F.count_distinct("symbol")).first()[0], 1)
        rows = rows.where(F.col("seq") > train_end() - (max(1, cap // symbols) + window - 1))
    size = max(512, window)
    cut = with_segments(rows, size, before=window - 1, pos="seq", size="seq_rows")
    frame = W.partitionBy("symbol", "segment").orderBy("seq").rowsBetween(-(window - 1), 0)
    return (
        cut.withColumn("sequence", F.collect_list("__v").over(frame))
        .where(F.col("is_core") & (F.size("sequence") == window))
        .drop("__v", "segment", "is_core")
    )


def held_rows(windows: DataFrame) -> DataFrame:
    """The rows (`v`) that windows hold, once each, and by how many windows each is held (`held`).

    The windows of a symbol end at rows that follow each other (a gap is an error). So every window brings its last row, and the
    first one of a symbol its earlier rows too; how often a row is held follows from its place. No window is unrolled.
    """
    w, last = F.size("sequence"), F.element_at("sequence", -1)
    ends = windows.groupBy("symbol").agg(F.min("seq").alias("__low"), F.max("seq").alias("__high"), F.count(F.lit(1)).alias("__n"))
    whole = F.when(F.col("__high") - F.col("__low") + 1 != F.col("__n"), F.raise_error(F.lit("windows with gaps"))).otherwise(F.col("__high"))
    placed = windows.join(ends.select("symbol", "__low", whole.alias("__high")), "symbol")
    own = placed.select(last.alias("v"), (F.least(F.col("seq") + w - 1, "__high") - F.col("seq") + 1).alias("held"))
    heads = placed.where(F.col("seq") == F.col("__low")).select("__low", "__high", w.alias("w"), F.posexplode(F.slice("sequence", 1, w - 1)).alias("i", "v"))
    return own.unionByName(heads.select("v", (F.least(F.col("__low") + F.col("i"), "__high") - F.col("__low") + 1).alias("held")))


def fit_scaler(train: DataFrame, features: list[str]) -> DataFrame:
    """LAB-11: mean and population deviation per feature over the training windows, one row each: rows count as often as windows hold them."""
    rows = held_rows(train)
    total, places = F.sum("held"), range(len(features))
    means = rows.agg(*[(F.sum(F.col("v")[i] * F.col("held")) / total).alias(f"m{i}") for i in places]).first()
    center = [F.lit(means[i] if means[i] is not None else 0.0) for i in places]
    spread = rows.agg(*[F.sqrt(F.sum(F.pow(F.col("v")[i] - center[i], F.lit(2.0)) * F.col("held")) / total).alias(f"s{i}") for i in places]).first()
    made = [(i, n, means[i], spread[i] if spread[i] and spread[i] > 0 else 1.0) for i, n in enumerate(features)]
    return train.sparkSession.createDataFrame(made, "place int, feature string, mean double, std double")


def scale_windows(df: DataFrame, rows: list) -> DataFrame:
    """LAB-11: windows scaled by the mean and deviation of each feature, in their order."""
    mean = F.array(*[F.lit(float(r["mean"])) for r in rows])
    std = F.array(*[F.lit(float(r["std"])) for r in rows])
    scaled = F.transform(
        "sequence",
        lambda v: F.zip_with(F.zip_with(v, mean, lambda x, m: x - m), std, lambda x, s: x / s),
    )
    return df.withColumn("sequence", scaled)


def scale_sequences(df: DataFrame, scaler: DataFrame) -> DataFrame:
    """LAB-11: windows scaled by a fitted scaler (one value pair per feature)."""
    return scale_windows(df, scaler.orderBy("place").collect())


def category_encoder(df: DataFrame):
    """LAB-12: one-hot encoder of category and sector, fitted once on all rows, with unseen values kept apart;
    symbols are hashed into a fixed number of slots, so neither the row nor the driver grows with them."""
    index = StringIndexer(
        inputCols=CATEGORIES,
        outputCols=[f"{c}_index" for c in CATEGORIES],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    )
    hot = OneHotEncoder(
        inputCols=[f"{c}_index" for c in CATEGORIES],
        outputCols=[f"{c}_hot" for c in CATEGORIES],
        dropLast=False,
        handleInvalid="keep",
    )
    hashed = FeatureHasher(inputCols=["symbol"], outputCol="symbol_hot", numFeatures=SYMBOL_SLOTS)
    return Pipeline(stages=[index, hot, hashed]).fit(df.select("symbol", *CATEGORIES))


def class_weights(df: DataFrame, risk: bool = True, label: str = "next_direction") -> DataFrame:
    """LAB-13: weight per class: inverse frequency, mean 1 over the classes present, DOWN raised in risk mode."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    every = W.partitionBy()  # at most three rows
    inverse = F.sum("rows").over(every) / (len(LABELS) * F.col("rows"))
    weights = counts.withColumn("w", inverse)
    weight = F.col("w") / F.avg("w").over(every)
    if risk:
        weight = F.when(F.col(label) == DOWN, weight * DOWN_BOOST).otherwise(weight)
    return weights.select(label, weight.alias("weight"))


def with_class_weights(df: DataFrame, risk: bool = True, label: str = "next_direction") -> DataFrame:
    """LAB-13: rows with their class weight; the weights are at most three rows, so they are broadcast."""
    return df.join(F.broadcast(class_weights(df, risk, label)), label)


def label_shares(df: DataFrame, keys: list[str], label: Column) -> DataFrame:
    """Class shares and majority baseline per key: one aggregation."""
    counted = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("symbol").alias("symbols"),
        *[count_where(label == c).alias(f"c{c}") for c in LABELS],
    )
    share = lambda c: ratio(F.col(c), F.col("rows"))
    return counted.select(
        *keys,
        "rows",
        "symbols",
        share(f"c{DOWN}").alias("down_ratio"),
        share(f"c{UP}").alias("up_ratio"),
        share(f"c{FLAT}").alias("watch_ratio"),
        ratio(F.greatest(*[f"c{c}" for c in LABELS]), F.col("rows")).alias("majority_baseline_accuracy"),
    )


def threshold_experiment(df: DataFrame, thresholds: list[float] | None = None) -> DataFrame:
    """LAB-14: direction label shares at several thresholds."""
    values = F.explode(F.array(*[F.lit(float(t)) for t in thresholds or THRESHOLDS]))
    rows = df.where(F.col("next_return").isNotNull()).select("symbol", "next_return", values.alias("threshold"))
    shares = label_shares(rows, ["threshold"], direction_label(F.col("threshold")))
    tag = F.concat(F.lpad(F.round(F.col("threshold") * 10000).cast("int").cast("string"), 4, "0"), F.lit("bp"))
    return shares.withColumn("tag", tag).drop("rows", "symbols")


def horizon_experiment(df: DataFrame, threshold: float, horizons: tuple[int, ...] = (1, 3, 5), risk: bool = True) -> DataFrame:
    """LAB-15: label shares for several horizons over one feature frame."""
    parts = [
        labelled(df, h, threshold, risk).select(F.lit(h).alias("horizon"), "symbol", "next_direction") for h in horizons
    ]
    return label_shares(reduce(DataFrame.unionByName, parts), ["horizon"], F.col("next_direction"))


def label_grid(df: DataFrame, horizons: tuple[int, ...], thresholds: list[float], risk: bool = True) -> DataFrame:
    """LAB-16: label and return statistics for every horizon and threshold."""
    grid = F.explode(F.array(*[F.lit(float(t)) for t in thresholds]))
    parts = [
        with_future(df, h)
        .select("symbol", "next_return", "future_min_return", "future_range_return", F.lit(h).alias("horizon"))
        .withColumn("threshold", grid)
        for h in horizons
    ]
    rows = reduce(DataFrame.unionByName, parts)
    t = F.col("threshold")
    label = risk_label(t) if risk else direction_label(t)
    shares = label_shares(rows, ["horizon", "threshold"], label)
    one = reduce(DataFrame.unionByName, [with_future(df, h).select(F.lit(h).alias("horizon"), "next_return") for h in horizons])
    one = one.withColumn("size", F.abs("next_return")).where(F.col("size") < float("inf"))
    returns = one.groupBy("horizon").agg(
        F.avg("next_return").alias("next_return_mean"),
        F.coalesce(F.stddev_samp("next_return"), F.lit(0.0)).alias("next_return_std"),
    )
    middle = exact_median(one, ["horizon"], "size", F.floor(F.col("size") * 1000), "next_return_abs_median")
    return shares.join(returns, "horizon").join(middle, "horizon")
