"""The quote stream with its state in Spark's state store: ids seen (STR-1) and the latest quote per symbol and source (STR-3, STR-4)."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.schema import QUOTE_COLUMNS
from tickloom.streaming.batch import STATE_KEYS, STATE_VALUES

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LATEST = "last_price double, change_pct double, volume long, event_time long, event_id string"
MARKED = Row(*QUOTE_COLUMNS, "changed")


@contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside keep their state in RocksDB, which keyed values need; the session's own choice comes back."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def new_events(quotes: DataFrame, delay: str) -> DataFrame:
    """STR-1 across batches: the first quote of every event id; ids are forgotten once the watermark is past them by `delay`.

    A copy that comes within `delay` (in event time) of the first is dropped; what comes later than the watermark is dropped too.
    """
    return quotes.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["event_id"])


class ChangeMarker(StatefulProcessor):
    """One value per (symbol, source): the newest quote, in event order. Marks what differs from it as the batch began."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", LATEST)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.latest.get() if self.latest.exists() else None
        known = None if before is None or before[0] is None else tuple(before[:3])
        newest = None if before is None else (_order(before[3], before[4]), tuple(before))
        first: dict[tuple, tuple] = {}
        for row in rows:
            values, order = tuple(row[c] for c in STATE_VALUES), _order(row["event_time"], row["event_id"])
            if newest is None or order > newest[0]:
                newest = (order, (*values, row["event_time"], row["event_id"]))
            if values == known:
                yield _marked(row, False)
            elif values not in first or order < first[values][0]:
                if values in first:
                    yield _marked(first[values][1], False)
                first[values] = (order, row)
            else:
                yield _marked(row, False)
        for _, row in first.values():
            yield _marked(row, True)
        if before is None or newest[1] != tuple(before):
            self.latest.update(newest[1])

    def close(self) -> None:
        pass


def _order(event_time: int, event_id: str | None) -> tuple[int, int, str]:
    """The order of `batch.event_order`."""
    return event_time, len(event_id or ""), event_id or ""


def _marked(row: Row, changed: bool) -> Row:
    return MARKED(*(row[c] for c in QUOTE_COLUMNS), changed)


def mark_changes(quotes: DataFrame) -> DataFrame:
    """STR-3 / STR-4: the quotes with `changed`: price, change or volume differ from the latest quote of the batches before.

    Of quotes of a batch with the same values the first in event order is marked. A late quote does not replace a newer
    one. The state is one value per symbol and source; it is read and written by key and kept by the checkpoint, so a batch costs
    what its own quotes cost, and a restart goes on where the last batch ended. Null sources are a source.
    """
    # Times go through Python as numbers, which no time zone touches.
    typed = quotes.select(*QUOTE_COLUMNS).withColumn("event_time", F.unix_micros("event_time"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in typed.schema.fields)
    marked = typed.groupBy(*STATE_KEYS).transformWithState(ChangeMarker(), f"{schema}, changed boolean", "Append", "None")
    return marked.withColumn("event_time", F.timestamp_micros("event_time"))


def latest_quotes(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """The state as a table, as of the last finished batch of a stream: STATE_KEYS and STATE_VALUES."""
    stored = spark.read.format("statestore").option("operatorId", operator).option("stateVarName", "latest").load(checkpoint)
    return stored.select(*[F.col(f"key.{c}") for c in STATE_KEYS], *[F.col(f"value.{c}") for c in STATE_VALUES])
