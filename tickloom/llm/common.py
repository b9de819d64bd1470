"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tickloom.session import materialize, ship_package

#: Rows that a function gets at a time. Spark bounds its Arrow batches by bytes; they are cut further in the worker.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str, n: int) -> Column:
    """Remainder of the CRC-32 of an id's decimal text; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """`mapInArrow` with batches of few rows, so that memory is bounded by long texts, not by 10,000 of them."""
    ship_package(df.sparkSession)

    def in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return fn(batch.slice(at, BATCH_ROWS) for batch in batches for at in range(0, batch.num_rows, BATCH_ROWS))

    return df.mapInArrow(in_parts, schema)


def numbered_columns(df: DataFrame) -> tuple[DataFrame, list[Column]]:
    """The table with columns named by their number, which clash with nothing, and the columns that bring the names back."""
    plain = df.select(*[F.col(f"`{c}`").alias(f"__{k}") for k, c in enumerate(df.columns)])
    return plain, [F.col(f"__{k}").alias(c) for k, c in enumerate(df.columns)]


#: Rows of a narrow table (ids and numbers) that are broadcast at most.
BROADCAST_ROWS = 2_000_000


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The table with a broadcast hint if it has at most so many rows, which are counted; else as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def with_positions(rows: DataFrame, group: list[str], order: list[str], size: str = "n") -> DataFrame:
    """The rows with `pos` (from 0, in the group) and `size` (rows of the group), from one range exchange over group and order.

    A task numbers its own range, and one small row per range and group says where it begins; no group meets in one
    task. Nulls come first. Rows equal in group and order are numbered in any order.
    """
    ranged = rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    stored = materialize(ranged.withColumn("__at", F.monotonically_increasing_id()), "ranges").withColumn("__part", F.shiftright("__at", 33))
    pieces = stored.groupBy(*group, "__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__rows"))
    whole = W.partitionBy(*group)
    before = F.sum("__rows").over(whole.orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    places = pieces.select(*[F.col(c).alias(f"__{c}") for c in group], F.col("__part").alias("__piece"), (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"), F.sum("__rows").over(whole).alias(f"__{size}"))
    same = F.col("__part") == F.col("__piece")
    for c in group:
        same &= F.col(c).eqNullSafe(F.col(f"__{c}"))
    return stored.join(places, same).withColumn("pos", F.col("__at") + F.col("__shift")).select(*rows.columns, "pos", F.col(f"__{size}").alias(size))


def by_bytes(batch: pa.RecordBatch, column: int, limit: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The batch in parts whose texts in `column` have about `limit` bytes, and one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + limit, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def strings(column: pa.Array) -> list[str]:
    """Python strings of a column; null counts as empty."""
    return [x if x is not None else "" for x in column.to_pylist()]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows after each other, and where each row begins (one more than rows). Null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, offsets - offsets[0]
