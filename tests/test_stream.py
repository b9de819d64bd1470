"""Streaming against batch, replays, and the watermarked window."""

from __future__ import annotations

import time
from datetime import date, timedelta

from pyspark.sql import functions as F

from tickloom.functions.quotes import passes_stream_filter
from tickloom.plans import fixtures as fx
from tickloom.schema import QUOTE_COLUMNS
from tickloom.streaming import batch as sb, jobs


def split_events(spark, sf_dir, folder, files=3):
    """The events in order, in files written one after the other: the source reads files by their time."""
    events = fx.table(spark, sf_dir, "events")
    cuts = [-1, *[int(x) for x in events.approxQuantile("event_id", [k / files for k in range(1, files)], 0.0)], 1 << 62]
    for low, high in zip(cuts, cuts[1:]):
        events.where(f"event_id > {low} AND event_id <= {high}").coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)
    return events.schema


def newest_state(spark, writer):
    state = writer.read(spark, "quote_state")
    newest = state.agg(F.max(F.struct("as_of_batch", "slot")).alias("m")).first()["m"]["slot"]
    return state.where(F.col("slot") == newest).select("symbol", "source", "last_price", "change_pct", "volume")


def run(spark, folder, schema, root, checkpoint):
    writer = jobs.QuoteBatchWriter(root)
    raw = fx.ticks_from_events(jobs.file_source(spark, folder, schema, "*.parquet"))
    quotes = raw.where(passes_stream_filter()).select(*QUOTE_COLUMNS)
    jobs.start(quotes, writer, checkpoint, available_now=True).awaitTermination()
    return writer


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    schema = split_events(spark, sf_dir, str(tmp_path / "in"))
    writer = run(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), str(tmp_path / "cp"))
    ticks = fx.ticks(spark, sf_dir)
    assert writer.read(spark, "quotes").count() == ticks.count()
    assert writer.read(spark, "quotes").select("batch_id").distinct().count() == 3
    merged = writer.read(spark, "metric_snapshots").groupBy("window_bucket").agg(F.sum("total_volume").alias("v"))
    batch = sb.minute_snapshot(ticks).select("window_bucket", F.col("total_volume").alias("v"))
    assert merged.exceptAll(batch).isEmpty() and batch.exceptAll(merged).isEmpty()
    kept = newest_state(spark, writer)
    want = sb.latest_state(ticks, fx.TICK_ORDER)
    assert kept.exceptAll(want).isEmpty() and want.exceptAll(kept).isEmpty()


def test_late_batches_do_not_replace_newer_state(spark, sf_dir, tmp_path):
    writer = jobs.QuoteBatchWriter(str(tmp_path / "out"))
    rows = fx.ticks(spark, sf_dir)
    cuts = rows.approxQuantile("id", [1 / 3, 2 / 3], 0.0)
    parts = [rows.where(F.col("id") > cuts[1]), rows.where((F.col("id") > cuts[0]) & (F.col("id") <= cuts[1])), rows.where(F.col("id") <= cuts[0])]
    for k, part in enumerate(parts):
        writer(part.select(*QUOTE_COLUMNS), k)
    kept, want = newest_state(spark, writer), sb.latest_state(rows, fx.TICK_ORDER)
    assert kept.exceptAll(want).isEmpty() and want.exceptAll(kept).isEmpty()


def test_price_that_comes_back_within_a_batch(spark, sf_dir, tmp_path):
    writer = jobs.QuoteBatchWriter(str(tmp_path / "out"))
    one = fx.ticks(spark, sf_dir).select(*QUOTE_COLUMNS).limit(1).collect()[0].asDict()

    def quotes(*changes):
        rows = [one | {"event_id": f"e{n}", "event_time": one["event_time"] + timedelta(seconds=n), "last_price": p} for n, p in changes]
        return spark.createDataFrame([tuple(r[c] for c in QUOTE_COLUMNS) for r in rows], fx.ticks(spark, sf_dir).select(*QUOTE_COLUMNS).schema)

    writer(quotes((1, 10.0)), 0)
    writer(quotes((9, 11.0), (10, 10.0)), 1)
    assert [r["last_price"] for r in newest_state(spark, writer).collect()] == [10.0]
    before = writer.read(spark, "price_ticks").count()
    writer(quotes((11, 10.0)), 2)
    assert writer.read(spark, "price_ticks").count() == before == 2


def test_look_ups_list_only_their_days(spark, sf_dir, tmp_path):
    writer = jobs.QuoteBatchWriter(str(tmp_path / "out"))
    rows = fx.ticks(spark, sf_dir).select(*QUOTE_COLUMNS).limit(20)
    now = fx.as_of(spark, sf_dir)
    read = []
    for k in range(40):
        writer.append(rows, "price_ticks", k, now + timedelta(days=k))
        read.append(len(writer._since(spark, "price_ticks", now + timedelta(days=k - 1), now + timedelta(days=k), k + 1).inputFiles()))
    assert max(read[2:]) == read[2] and writer.read(spark, "price_ticks", date(1990, 1, 1)) is None


def test_replayed_batch_changes_nothing(spark, sf_dir, tmp_path):
    writer = jobs.QuoteBatchWriter(str(tmp_path / "out"))
    rows = fx.ticks(spark, sf_dir).select(*QUOTE_COLUMNS)
    first, second = rows.where("event_id <= 'e5'"), rows.where("event_id > 'e5'")
    names = ["quotes", "metric_snapshots", "symbol_stats", "sector_stats", "category_stats", "alert_events", "price_ticks", "quote_state"]
    writer(first, 0)
    writer(second, 1)
    before = {n: sorted(map(str, writer.read(spark, n).collect())) for n in names}
    writer(second, 1)
    assert before == {n: sorted(map(str, writer.read(spark, n).collect())) for n in names}


def test_unchanged_batch_writes_heartbeat_only(spark, sf_dir, tmp_path):
    writer = jobs.QuoteBatchWriter(str(tmp_path / "out"))
    rows = sb.latest_state(fx.ticks(spark, sf_dir), fx.TICK_ORDER)
    full = fx.ticks(spark, sf_dir).join(rows, ["symbol", "source", "last_price", "change_pct", "volume"], "left_semi")
    batch = full.dropDuplicates(["symbol", "source"]).select(*QUOTE_COLUMNS)
    writer(batch, 0)
    ticks = writer.read(spark, "price_ticks").count()
    writer(batch, 1)
    assert writer.read(spark, "price_ticks").count() == ticks
    assert writer.read(spark, "metric_snapshots").select("batch_id").distinct().count() == 2


def test_failed_archive_is_noted(spark, sf_dir, tmp_path):
    class Broken(jobs.QuoteBatchWriter):
        def append(self, df, table, batch_id, as_of):
            if table == "quotes":
                raise OSError("disk")
            super().append(df, table, batch_id, as_of)

    writer = Broken(str(tmp_path / "out"))
    writer(fx.ticks(spark, sf_dir).select(*QUOTE_COLUMNS), 0)
    assert "disk" in writer.read(spark, "job_events").first()["message"]
    assert writer.read(spark, "price_ticks").count() > 0


def test_cooldown(spark, sf_dir):
    now = fx.as_of(spark, sf_dir)
    alerts = fx.alerts(spark, sf_dir, now)
    twice = alerts.unionByName(alerts)
    assert sb.suppress_recent(twice, alerts, now, 0).count() == twice.count()
    assert sb.suppress_recent(twice, alerts, now, 60 * 24 * 365).count() == 0
    once = sb.suppress_recent(twice, alerts, now, 0, within_batch=True)
    assert once.count() == alerts.select("symbol", "alert_type").distinct().count()


def test_watermarked_window(spark, sf_dir, tmp_path):
    schema = split_events(spark, sf_dir, str(tmp_path / "in"))
    raw = fx.ticks_from_events(jobs.file_source(spark, str(tmp_path / "in"), schema, "*.parquet"))
    out = str(tmp_path / "out")
    job = (
        jobs.minute_window(raw.where(passes_stream_filter()))
        .writeStream.outputMode("append").format("parquet").option("path", out)
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    job.awaitTermination()
    got = spark.read.parquet(out)
    want = jobs.minute_window(fx.ticks(spark, sf_dir))
    assert got.count() == got.select("window_bucket").distinct().count() > 0
    assert got.exceptAll(want).isEmpty()
