"""Near-duplicate embeddings by PCA-ordered tiled comparison.

Vectors are compared within their label. They are rotated onto the principal axes of the whole
table, which changes no cosine but puts most of a vector's length into its leading dimensions. Two unit
vectors with cosine c differ by at most sqrt(2 - 2c) in every coordinate, so the leading ones deal
the vectors into cells of that width, and only neighbouring cells are compared, tile by tile. A
tile adds up products of the leading dimensions first; what the others can still add is bounded by
the norms of the suffixes, and a pair is given up once it cannot reach the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import map_batches, ship_package
from tickloom.llm.components import connected_components, spanning_forest
from tickloom.session import materialize

THRESHOLD = 0.98
#: Leading dimensions that make up a cell.
GRID = 2
#: Vectors on one side of a tile, and rows that are compared at a time.
TILE, ROWS = 2048, 256
#: Dimensions after which the bound is tested, as shares of all.
STEPS = (0.125, 0.25, 0.5, 1.0)
#: What rounding may do to a bound.
SLACK = 1e-9


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision; large and small values do not overflow."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each number of dimensions the axes of the unit vectors (`embedding`), longest first, as columns.

    Second moments are summed over all rows; the driver gets dimensions^2 numbers.
    """

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, own in _by_size(batch.column(0)):
                v = unit(own[1])
                sums[size] = sums.get(size, 0.0) + v.T @ v
        for size, m in sums.items():
            cells = pa.array(np.arange(size * size))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(size * size, size)), cells, pa.array(m.ravel())], names=["size", "cell", "value"])

    summed = map_batches(vectors.select("embedding"), moments, "size bigint, cell bigint, value double").groupBy("size", "cell").agg(F.sum("value").alias("value")).collect()
    out: dict[int, np.ndarray] = {}
    for size in {r["size"] for r in summed}:
        m = np.zeros(size * size)
        for r in summed:
            if r["size"] == size:
                m[r["cell"]] = r["value"]
        out[size] = np.linalg.eigh(m.reshape(size, size))[1][:, ::-1]
    return out


def _by_size(column: pa.Array) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray]]]:
    """(dimensions, (positions, matrix)) of the vectors of a list column, for each number of dimensions."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        yield size, (at, flat[offsets[at][:, None] + np.arange(size)])


def linked(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """Which rows of a and b have a cosine of at least `threshold`."""
    ua, ub = unit(a), unit(b)
    ra, rb = ua @ axes, ub @ axes
    size = ra.shape[1]
    cuts = sorted({max(1, int(size * s)) for s in STEPS} | {size})
    tails = [(np.sqrt((ra[:, c:] ** 2).sum(1)), np.sqrt((rb[:, c:] ** 2).sum(1))) for c in cuts]
    out = np.zeros((len(a), len(b)), bool)
    for begin in range(0, len(a), ROWS):
        rows = slice(begin, begin + ROWS)
        partial = ra[rows, : cuts[0]] @ rb[:, : cuts[0]].T
        i, j = np.nonzero(partial + tails[0][0][rows, None] * tails[0][1] >= threshold - SLACK)
        value = partial[i, j]
        i = i + begin
        for low, high, (ta, tb) in zip(cuts, cuts[1:], tails[1:]):
            for part in range(0, len(i), 1 << 17):
                p = slice(part, part + (1 << 17))
                value[p] += np.einsum("ij,ij->i", ra[i[p], low:high], rb[j[p], low:high])
            alive = value + ta[i] * tb[j] >= threshold - SLACK
            i, j, value = i[alive], j[alive], value[alive]
        near = np.abs(value - threshold) < 1e-7
        value[near] = np.einsum("ij,ij->i", ua[i[near]], ub[j[near]])
        out[i, j] = value >= threshold
    return out


def _tile(axes: dict[int, np.ndarray], threshold: float):
    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("right", "ascending"), ("node", "ascending")])
        right = table.column("right").to_numpy()
        node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        ((size, (_, vectors)),) = _by_size(table.column("embedding").combine_chunks())
        split = int(np.searchsorted(right, 1))
        one_side = split == len(right) and bool(table.column("same")[0].as_py())
        if one_side:
            adjacent = linked(vectors, vectors, axes[size], threshold)
            np.fill_diagonal(adjacent, False)
            degree = adjacent @ copies
        else:
            adjacent = np.zeros((len(node), len(node)), bool)
            across = linked(vectors[:split], vectors[split:], axes[size], threshold)
            adjacent[:split, split:], adjacent[split:, :split] = across, across.T
            degree = np.concatenate([across @ copies[split:], across.T @ copies[:split]])
        edges = spanning_forest(adjacent)
        some = np.flatnonzero(degree)
        a = np.concatenate([node[some], node[[u for u, _ in edges]]] if edges else [node[some]])
        b = np.concatenate([np.full(len(some), -1), node[[v for _, v in edges]]] if edges else [np.full(len(some), -1)])
        links = np.concatenate([degree[some], np.zeros(len(edges), np.int64)])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "links": pa.array(links, pa.int64())})

    return compare


def near_duplicates(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = THRESHOLD, grid: int = GRID) -> DataFrame:
    """Links and classes of vectors with the same label and a cosine of at least `threshold` (above 0).

    Returns for every row the key, `n_links` (other rows linked directly), `component_id` (smallest key reachable by
    links, its own included) and `kept` (the key is the component's). Vectors that are null, empty, zero or hold null or
    non-finite components, and rows with a null label, link with nothing; so do vectors of different dimensions. Equal
    vectors are compared once and count as linked with each other. A null key is its own component, or the
    smallest other key of its component. Other columns are left out; no rows give no rows.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(F.col(key).alias("key"), F.col(embedding).alias("embedding"), F.col(label).alias("label"), F.monotonically_increasing_id().alias("row"))
    stored = materialize(rows, "vectors")
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    valid = F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", sound) & F.exists("embedding", lambda x: x != 0)
    distinct = stored.where(valid).groupBy("label", "embedding").agg(F.min("row").alias("node"), F.min("key").alias("least"), F.count("*").alias("copies"))
    distinct = materialize(distinct, "distinct-vectors")
    axes = principal_axes(distinct)
    shared = spark.sparkContext.broadcast(axes)
    width = float(np.sqrt(2 - 2 * threshold)) + SLACK

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [None] * batch.num_rows
            for size, (at, own) in _by_size(batch.column(0)):
                lead = np.floor(unit(own) @ shared.value[size][:, :grid] / width).astype(int)
                for k, cell in zip(at.tolist(), lead.tolist()):
                    out[k] = [size, *cell]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int64()))], names=[*batch.schema.names, "cell"])

    kind, label_kind = vectors.schema[embedding].dataType.simpleString(), vectors.schema[label].dataType.simpleString()
    dealt = materialize(map_batches(distinct.select("embedding", "label", "node", "copies"), cells, f"embedding {kind}, label {label_kind}, node bigint, copies bigint, cell array<bigint>"), "cells")
    tiles = dealt.groupBy("label", "cell").agg(F.ceil(F.count("*") / TILE).cast("int").alias("chunks"))

    # Each vector goes to the pairs of its cell with itself and all neighbours; the smaller cell of a pair is on the left.
    steps = F.array(*[F.array(F.lit(0).cast("bigint"), *[F.lit(x).cast("bigint") for x in s]) for s in product((-1, 0, 1), repeat=grid)])
    # A vector with fewer dimensions than the grid has shorter cells, and takes only steps that end in zeros.
    neighbour = F.transform(F.col("cell"), lambda x, k: x + F.coalesce(F.try_element_at("step", (k + 1).cast("int")), F.lit(0)))
    own = dealt.join(tiles.withColumnRenamed("chunks", "own_chunks"), ["label", "cell"]).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("own_chunks")).cast("int"))
    fits = F.forall(F.slice("step", F.size("cell") + 1, grid + 1), lambda x: x == 0)
    sent = own.withColumn("step", F.explode(steps)).where(fits).withColumn("other", neighbour).drop("step")
    sent = sent.join(tiles.select(F.col("label").alias("l"), F.col("cell").alias("other"), F.col("chunks").alias("other_chunks")).withColumnRenamed("l", "label"), ["label", "other"])
    sent = sent.withColumn("other_chunk", F.explode(F.sequence(F.lit(0), F.col("other_chunks") - 1)))
    me, it = F.struct("cell", "chunk"), F.struct(F.col("other").alias("cell"), F.col("other_chunk").alias("chunk"))
    sent = sent.select("label", F.least(me, it).alias("left_tile"), F.greatest(me, it).alias("right_tile"), (me > it).cast("int").alias("right"), (me == it).alias("same"), "node", "copies", "embedding")
    found = materialize(sent.groupBy("label", "left_tile", "right_tile").applyInArrow(_tile(axes, threshold), "a bigint, b bigint, links bigint"), "links")

    links = found.where("b < 0").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    component = connected_components(found.where("b >= 0").select("a", "b"))
    classed = distinct.join(component, "node", "left").withColumn("component", F.coalesce("component", "node")).join(links, "node", "left")
    least = classed.groupBy("component").agg(F.min("least").alias("component_id"))
    of_vector = classed.join(least, "component").select("label", "embedding", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = stored.withColumn("valid", F.coalesce(valid, F.lit(False))).join(of_vector.withColumn("valid", F.lit(True)), ["valid", "label", "embedding"], "left")
    component_id = F.coalesce("component_id", "key")
    return out.select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component_id.cast("long").alias("component_id"), F.coalesce(component_id == F.col("key"), F.lit(True)).alias("kept"))
