"""State in the state store, hourly sums of the baseline, and packed days."""

from __future__ import annotations

import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tickloom.plans import fixtures as fx
from tickloom.schema import QUOTE_COLUMNS
from tickloom.streaming import batch as sb, jobs, state

START = datetime(2026, 3, 1, 9, 30)


def quotes(spark, sf_dir, rows):
    """Quotes from (event id, symbol, source, seconds after START, price); all else is equal."""
    sample = fx.ticks(spark, sf_dir).select(*QUOTE_COLUMNS)
    one = sample.limit(1).collect()[0].asDict()
    made = [one | {"event_id": e, "symbol": s, "source": q, "event_time": START + timedelta(seconds=t), "last_price": p} for e, s, q, t, p in rows]
    return spark.createDataFrame([tuple(r[c] for c in QUOTE_COLUMNS) for r in made], sample.schema)


def run(spark, folder, sink, checkpoint, schema, make):
    with state.state_in_rocksdb(spark):
        job = make(jobs.file_source(spark, folder, schema, "*.parquet")).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        job.awaitTermination()
    return job


def test_marks_equal_the_batch_rule(spark, sf_dir, tmp_path):
    """A hot key over many Arrow batches, prices that come back, a late batch and a null source."""
    hot = [(f"h{k}", "HOT", "s", k % 5000, float(k % 97)) for k in range(25_000)]
    batches = [
        [("a1", "A", "s", 1, 10.0), ("n1", "N", None, 1, 5.0), *hot],
        [("a2", "A", "s", 9, 11.0), ("a3", "A", "s", 10, 10.0), ("h9", "HOT", "s", 6000, 3.0), ("h8", "HOT", "s", 6000, 200.0)],
        [("a0", "A", "s", 0, 7.0), ("a4", "A", "s", 5, 10.0), ("n2", "N", None, 2, 5.0), ("hx", "HOT", "s", 6001, 3.0)],
    ]
    provider = spark.conf.get(state.PROVIDER, None)
    for rows in batches:
        table = quotes(spark, sf_dir, rows)
        table.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.05)
        run(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), table.schema, state.mark_changes)
    assert spark.conf.get(state.PROVIDER, None) == provider
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == sum(map(len, batches))
    got = {r["event_id"] for r in out.where("changed").select("event_id").collect()}
    first = {min((t, len(e), e) for e, _, _, t, p in hot if p == price)[2] for price in range(97)}
    newest = max(hot, key=lambda r: (r[3], len(r[0]), r[0]))[4]
    assert got == first | {"a1", "n1", "a2", "h8", "a0"} | ({"h9"} if newest != 3.0 else set())
    held = {(r["symbol"], r["source"]): r["last_price"] for r in state.latest_quotes(spark, str(tmp_path / "cp")).collect()}
    assert held == {("A", "s"): 10.0, ("N", None): 5.0, ("HOT", "s"): 3.0}


def test_ids_are_forgotten_behind_the_watermark(spark, sf_dir, tmp_path):
    sizes = []
    for b in range(4):
        rows = [(f"e{b}-{k}", "A", "s", b * 3600 + k, 1.0) for k in range(50)] + ([(f"e{b - 1}-{k}", "A", "s", (b - 1) * 3600 + k, 1.0) for k in range(40, 50)] if b else [])
        table = quotes(spark, sf_dir, rows)
        table.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.05)
        job = run(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), table.schema, lambda q: state.new_events(q, "90 minutes"))
        sizes.append(job.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 200
    assert max(sizes) <= 150


def test_baseline_reads_few_rows_a_symbol(spark, sf_dir, tmp_path, monkeypatch):
    """Batches over 30 hours: the sums of hours give what all stored quotes of the last day give."""
    writer = jobs.QuoteBatchWriter(str(tmp_path / "out"))
    read = []
    original = jobs.baseline_of_hours
    monkeypatch.setattr(jobs, "baseline_of_hours", lambda hours, edge, since: (read.append(hours.unionByName(edge).groupBy("symbol").count().agg(F.max("count")).first()[0]), original(hours, edge, since))[1])
    for k in range(20):
        table = quotes(spark, sf_dir, [(f"{k}-{j}", f"S{j % 3}", "s", k * 5700 + j, 1.0 + k + j) for j in range(4)])
        table = table.withColumn("change_pct", F.when(F.col("last_price") % 3 != 0, F.col("last_price") / 7))
        now = START + timedelta(seconds=k * 5700 + 3)
        for _ in range(2 if k % 7 == 3 else 1):  # some are replayed
            if k % 9 == 8:
                writer.baseline(spark, now, k)
            writer.append(table, "price_ticks", k, now)
            writer._add_hour(table, now, k)
    got = writer.baseline(spark, now, 20)
    want = sb.history_baseline(writer.read(spark, "price_ticks"), now)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and want.count() == 3
    assert max(read) <= 25
    assert sb.history_baseline(writer.read(spark, "price_ticks"), now, days=3).exceptAll(want).count()


def test_packed_days_stay_few_files(spark, sf_dir, tmp_path):
    writer = jobs.QuoteBatchWriter(str(tmp_path / "out"))
    rows = quotes(spark, sf_dir, [(f"e{j}", "A", "s", j, 1.0) for j in range(3)]).coalesce(1)
    day, files = START.date(), []
    for k in range(12):
        writer.append(rows, "quotes", k, START)
        if k % 4 == 3:
            before = sorted(map(str, writer.read(spark, "quotes").select("batch_id", "event_id", "created_at", "created_date").collect()))
            writer.compact(spark, "quotes", day, k - 1)
            assert sorted(map(str, writer.read(spark, "quotes").select("batch_id", "event_id", "created_at", "created_date").collect())) == before
            files.append(len(writer.read(spark, "quotes").inputFiles()))
    assert files == [2, 2, 2]
    writer.append(rows, "quotes", 5, START)  # a folder that a broken run left behind is not read again
    assert writer.read(spark, "quotes", day).count() == 36
    since = writer._since(spark, "quotes", START - timedelta(days=1), START, 11)
    assert since.count() == 33
    writer.append(rows.limit(1), "quotes", 11, START)
    assert writer.read(spark, "quotes").count() == 34
    writer.compact(spark, "nothing", day, 1)
    assert writer.read(spark, "nothing") is None


def test_minutes_merge_exactly(spark, sf_dir):
    rows = quotes(spark, sf_dir, [(f"e{k}", f"S{k % 7}" if k % 5 else None, "s", k * 7 % 200, 1.0 + k / 3) for k in range(60)])
    rows = rows.withColumn("change_pct", F.when(F.length("event_id") > 2, F.col("last_price") - 9))
    numbers, parts = None, None
    for k in range(60):
        if k % 20 == 0 or k == 1:  # the second batch has one symbol, so that numbers go on behind a single one
            batch = rows.where(F.col("event_id").isin([f"e{j}" for j in ([0, 1] if k == 0 else range(2, 20) if k == 1 else range(k, k + 20))]))
            numbers = sb.symbol_numbers(batch, numbers)
            part = sb.minute_parts(batch, numbers)
            parts = part if parts is None else parts.unionByName(part)
    assert numbers.select("number").distinct().count() == numbers.count() == 7
    got, want = sb.merge_minute_parts(parts), sb.minute_snapshot(rows)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and want.count() == 4
