"""Ordered operations over groups of any size.

A plain `Window.partitionBy(symbol).orderBy(time)` sorts one symbol in one task.
When a single symbol holds a third of all rows that task never ends. The
operators here give the same results with bounded tasks:

* rows are first cut into (key, bucket) pieces, where `bucket` is any expression
  that never decreases along the order (an hour, a year, a value range); the size
  of the pieces is checked, and pieces that are too large are cut by the data;
* one small row per piece (a count, a last value) is combined over the pieces of
  a key, so the only window over a whole key runs on the piece summaries;
* row-frame features run on segments of a fixed number of rows, each carrying a
  copy of the few rows before / after it (`with_segments`).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tickloom.session import materialize

BUCKET = "__bucket"
MAX_PIECE_ROWS = 5_000_000


def computed_once(df: DataFrame) -> DataFrame:
    """The same rows, with every column computed once per row.

    A filter above a projection is normally pushed below it, and each of its tests
    then repeats the expressions of the columns it reads (a JSON parse, a chain of
    roundings). A generator of one row is not crossed by filters.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest whole row per key (DSH-0), reduced to one row per key and task before the shuffle.

    The order columns must end in a unique one, so that ties cannot flip. The aggregation buffer is a whole row, which
    Spark aggregates after a sort by the keys on either side of the exchange; no key's rows ever meet in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(best).select(*keys, "__row.*").select(*df.columns)


def earliest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First whole row per key in the given order."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(best).select(*keys, "__row.*").select(*df.columns)


def cut(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    bucket: Column,
    extras: list[Column],
    max_rows: int = MAX_PIECE_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Cut rows into ordered (key, bucket) pieces: (rows with BUCKET, one summary row per piece).

    The summaries are written once and their largest row count is checked. Where
    a piece would be too large (a third of all rows within one hour, say), the
    rows are cut by range partitioning on the full order instead, whose bounds
    follow the data; the cut is written, so that all later reads see the same one.
    """
    staged = df.withColumn(BUCKET, bucket)
    pieces = _pieces(staged, keys, extras)
    size = pieces.agg(F.max("__rows").alias("top"), F.sum("__rows").alias("all")).first()
    if size["top"] is None or size["top"] <= max_rows:
        return staged, pieces
    parts = max(2, math.ceil(2 * size["all"] / max_rows))
    ranged = df.repartitionByRange(parts, *keys, *order).withColumn(BUCKET, F.spark_partition_id())
    staged = materialize(ranged, "pieces")
    return staged, _pieces(staged, keys, extras)


def _pieces(staged: DataFrame, keys: list[str], extras: list[Column]) -> DataFrame:
    summary = staged.groupBy(*keys, BUCKET).agg(F.count(F.lit(1)).alias("__rows"), *extras)
    return materialize(summary, "piece_summary")


def _before(keys: list[str]):
    return W.partitionBy(*keys).orderBy(BUCKET).rowsBetween(W.unboundedPreceding, -1)


def _inside(keys: list[str], order: list[str]):
    return W.partitionBy(*keys, BUCKET).orderBy(*order)


def with_position(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    bucket: Column,
    pos: str = "pos",
    size: str = "group_rows",
    max_rows: int = MAX_PIECE_ROWS,
) -> DataFrame:
    """Add the 1-based position of each row in its group, and the group's size.

    The order must end in a unique column. Rows are read twice, so a costly input
    is better written first (`materialize`).
    """
    staged, pieces = cut(df, keys, order, bucket, [], max_rows)
    offsets = pieces.select(
        *keys,
        BUCKET,
        F.coalesce(F.sum("__rows").over(_before(keys)), F.lit(0)).alias("__before"),
        F.sum("__rows").over(W.partitionBy(*keys)).alias(size),
    )
    return (
        staged.withColumn("__local", F.row_number().over(_inside(keys, order)))
        .join(offsets, [*keys, BUCKET])
        .withColumn(pos, F.col("__before") + F.col("__local"))
        .drop("__local", "__before", BUCKET)
    )


def with_previous(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    bucket: Column,
    value: Column,
    name: str,
    max_rows: int = MAX_PIECE_ROWS,
) -> DataFrame:
    """Add the last non-null `value` of the rows strictly before each row."""
    position = F.when(F.col("__value").isNotNull(), F.struct(*order))
    tail = F.max_by("__value", position).alias("__tail")
    staged, pieces = cut(df.withColumn("__value", value), keys, order, bucket, [tail], max_rows)
    carried = pieces.select(
        *keys, BUCKET, F.last("__tail", ignorenulls=True).over(_before(keys)).alias("__carried")
    )
    local = _inside(keys, order).rowsBetween(W.unboundedPreceding, -1)
    return (
        staged.withColumn("__inside", F.last("__value", ignorenulls=True).over(local))
        .join(carried, [*keys, BUCKET])
        .withColumn(name, F.coalesce("__inside", "__carried"))
        .drop("__inside", "__carried", "__value", BUCKET)
    )


def with_running_max(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    bucket: Column,
    value: str,
    name: str,
    max_rows: int = MAX_PIECE_ROWS,
) -> DataFrame:
    """Add the largest `value` of the rows up to and including each row."""
    staged, pieces = cut(df, keys, order, bucket, [F.max(value).alias("__top")], max_rows)
    carried = pieces.select(*keys, BUCKET, F.max("__top").over(_before(keys)).alias("__carried"))
    local = _inside(keys, order).rowsBetween(W.unboundedPreceding, 0)
    return (
        staged.withColumn("__inside", F.max(value).over(local))
        .join(carried, [*keys, BUCKET])
        .withColumn(name, F.greatest("__inside", "__carried"))
        .drop("__inside", "__carried", BUCKET)
    )


def with_following(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    bucket: Column,
    value: Column,
    n: int,
    name: str,
    max_rows: int = MAX_PIECE_ROWS,
) -> DataFrame:
    """Add the `value` of the n-th following row of the group; null where there are fewer.

    Inside a piece that is a look ahead; behind its end the first n values of the following pieces are known to its summary row.
    """
    staged, pieces = cut(df.withColumn("__value", value), keys, order, bucket, [], max_rows)
    inside = _inside(keys, order)
    first = staged.withColumn("__place", F.row_number().over(inside)).where(F.col("__place") <= n)
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("__place", "__value"))), lambda x: x["__value"])
    heads = first.groupBy(*keys, BUCKET).agg(in_order.alias("__heads"))
    ahead = W.partitionBy(*keys).orderBy(BUCKET).rowsBetween(1, n)
    behind = heads.select(*keys, BUCKET, F.slice(F.flatten(F.collect_list("__heads").over(ahead)), 1, n).alias("__behind"))
    sizes = pieces.select(*keys, BUCKET, "__rows").join(behind, [*keys, BUCKET])
    beyond = F.col("__place") + n - F.col("__rows")
    return (
        staged.withColumns({"__place": F.row_number().over(inside), "__inside": F.lead("__value", n).over(inside)})
        .join(sizes, [*keys, BUCKET])
        .withColumn(name, F.when(beyond <= 0, F.col("__inside")).otherwise(F.get("__behind", (beyond - 1).cast("int"))))
        .drop("__place", "__inside", "__rows", "__behind", "__value", BUCKET)
    )


def with_newest(
    df: DataFrame,
    key: str,
    also: str,
    order: list[str],
    bucket: Column,
    value: str,
    names: tuple[str, str],
    max_rows: int = MAX_PIECE_ROWS,
) -> DataFrame:
    """Add the largest `value` of the rows up to and including each row: of its `key`, and of its `key` and `also`.

    Both are carried along one time line: one exchange by key and piece serves both windows, and one summary per piece and
    `also` says what earlier pieces bring.
    """
    staged, _ = cut(df, [key], order, bucket, [], max_rows)
    pieces = materialize(staged.groupBy(key, also, BUCKET).agg(F.max(value).alias("__top")), "piece_tops")
    by_both = pieces.select(key, also, BUCKET, F.max("__top").over(_before([key, also])).alias("__carried_both"))
    tops = pieces.groupBy(key, BUCKET).agg(F.max("__top").alias("__top"))
    by_key = tops.select(key, BUCKET, F.max("__top").over(_before([key])).alias("__carried"))
    upto = lambda keys: _inside(keys, order).rowsBetween(W.unboundedPreceding, 0)
    inside = staged.withColumns({"__inside": F.max(value).over(upto([key])), "__inside_both": F.max(value).over(upto([key, also]))})
    joined = inside.join(by_key, [key, BUCKET]).join(by_both.withColumnRenamed(also, "__also"), [key, BUCKET]).where(F.col(also).eqNullSafe(F.col("__also")))
    both = {names[0]: F.greatest("__inside", "__carried"), names[1]: F.greatest("__inside_both", "__carried_both")}
    return joined.withColumns(both).drop("__inside", "__inside_both", "__carried", "__carried_both", "__also", BUCKET)


def with_segments(
    df: DataFrame,
    rows: int,
    before: int = 0,
    after: int = 0,
    pos: str = "pos",
    size: str = "group_rows",
) -> DataFrame:
    """Cut groups into segments of `rows` rows with copies of their neighbours.

    Input needs the columns of `with_position`. Adds `segment` and `is_core`;
    window over (keys, segment) ordered by `pos`, then keep `is_core` rows.
    Groups of at most `rows` rows are one segment and gain no copies.
    """
    if before > rows or after > rows:
        raise ValueError("a segment must be at least as long as its margins")
    index = F.col(pos) - 1
    home = F.floor(index / F.lit(rows))
    inside = index % F.lit(rows)
    has_next = F.col(size) > (home + 1) * F.lit(rows)
    places = [home]
    if before:
        places.append(F.when((inside >= rows - before) & has_next, home + 1))
    if after:
        places.append(F.when((inside < after) & (home > 0), home - 1))
    return (
        df.withColumn("__home", home)
        .withColumn("segment", F.explode(F.array_compact(F.array(*places))))
        .withColumn("is_core", F.col("segment") == F.col("__home"))
        .drop("__home")
    )


def value_counts(
    df: DataFrame, keys: list[str], value: str, bucket: Column, max_rows: int = MAX_PIECE_ROWS
) -> DataFrame:
    """Distinct values per group with `copies`, `below` (rows with smaller values) and `total`.

    Equal values are counted first, so a group of copies is one row.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("copies"))
    counts = materialize(counts, "value_counts")  # read twice below
    staged, pieces = cut(counts, keys, [value], bucket, [F.sum("copies").alias("__copies")], max_rows)
    starts = pieces.select(
        *keys,
        BUCKET,
        F.coalesce(F.sum("__copies").over(_before(keys)), F.lit(0)).alias("__start"),
        F.sum("__copies").over(W.partitionBy(*keys)).alias("total"),
    )
    upto = F.sum("copies").over(_inside(keys, [value]).rowsBetween(W.unboundedPreceding, 0))
    return (
        staged.withColumn("__upto", upto)
        .join(starts, [*keys, BUCKET])
        .select(*keys, value, "copies", (F.col("__start") + F.col("__upto") - F.col("copies")).alias("below"), "total")
    )


def with_percent_rank(
    df: DataFrame, keys: list[str], value: str, bucket: Column, name: str, max_rows: int = MAX_PIECE_ROWS
) -> DataFrame:
    """Add the percentile rank of `value` in its group, equal values sharing the mean rank."""
    rank = (F.col("below") + (F.col("copies") + 1) / 2) / F.col("total")
    ranked = value_counts(df, keys, value, bucket, max_rows).select(*keys, value, rank.alias(name))
    return df.join(ranked, [*keys, value], "left")


def exact_median(
    df: DataFrame, keys: list[str], value: str, bucket: Column, name: str, max_rows: int = MAX_PIECE_ROWS
) -> DataFrame:
    """Exact median per group: the mean of the one or two middle values, found by their rank."""
    counts = value_counts(df, keys, value, bucket, max_rows)
    low, high = F.floor((F.col("total") + 1) / 2), F.ceil((F.col("total") + 1) / 2)
    covers = lambda place: F.when(
        (F.col("below") < place) & (place <= F.col("below") + F.col("copies")), F.col(value)
    )
    return counts.groupBy(*keys).agg(((F.max(covers(low)) + F.max(covers(high))) / 2).alias(name))
