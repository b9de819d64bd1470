"""Registered queries for sources, sinks and stream operators (SRC, SNK, STR)."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from tickloom.functions.quotes import passes_stream_filter
from tickloom.operators import cleaning, dashboard as dash
from tickloom.operators.ordered import with_position
from tickloom.plans import fixtures as fx
from tickloom.plans.oracle import ANY_FAULT, FAULT_SQL, alert_sql, money, rnd, with_ctes
from tickloom.plans.registry import query
from tickloom.schema import QUOTE_COLUMNS, time_text
from tickloom.session import materialize, scratch_path
from tickloom.sources import captures, stored, tables
from tickloom.streaming import batch as sb, jobs, state


def quote_json(ticks: DataFrame) -> DataFrame:
    """Ticks as the JSON messages a producer sends; every 17th has an unreadable time."""
    fields = ticks.withColumn(
        "event_time", F.when(F.col("id") % 17 == 0, "n/a").otherwise(time_text("event_time"))
    ).withColumn("symbol", F.concat(F.lit(" "), F.lower("symbol")))
    return fields.select(F.to_json(F.struct(*QUOTE_COLUMNS)).alias("value"))


TYPED = """SELECT event_id, symbol, market, last_price, change_pct, volume,
  CASE WHEN id%17<>0 THEN strftime(event_time,'%Y-%m-%d %H:%M:%S') END AS event_time FROM ticks_raw"""


@query("src_02_parse_quotes", with_ctes(["ticks_raw"], TYPED))
def _(spark, d):
    return jobs.parse_quotes(quote_json(fx.ticks_raw(spark, d))).select(
        "event_id", "symbol", "market", "last_price", "change_pct", "volume", time_text("event_time").alias("event_time")
    )


@query(
    "src_01_file_stream",
    with_ctes(
        ["ticks"],
        """SELECT event_id, symbol, company_name, category, sector, market, open_price, high_price, low_price, last_price, previous_close, change_pct,
        volume, turnover, strftime(event_time,'%Y-%m-%d %H:%M:%S') AS event_time, source FROM ticks WHERE id%17<>0""",
    ),
)
def _(spark, d):
    """The quote stream read from files: JSON text in, cleaned typed quotes out."""
    folder, out = scratch_path(spark, "quotes-json"), scratch_path(spark, "stream-out")
    quote_json(fx.ticks_raw(spark, d)).write.text(folder)
    raw = jobs.file_source(spark, folder, "value string", "*.txt", "text", 4)
    job = (
        jobs.clean_stream(raw)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", scratch_path(spark, "stream-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    job.awaitTermination()
    return spark.read.parquet(out).select(*QUOTE_COLUMNS).withColumn("event_time", time_text("event_time"))


@query(
    "src_03_recent_rows",
    with_ctes(
        ["ticks", "clock", "alerts"],
        """SELECT 'price_ticks' AS table_name, event_id FROM ticks, clock WHERE created_at >= now - INTERVAL 1440 MINUTE
        UNION ALL SELECT 'alert_events', event_id FROM alerts, clock WHERE created_at >= now - INTERVAL 10 MINUTE""",
    ),
)
def _(spark, d):
    now = fx.as_of(spark, d)
    one = lambda name, df, n: tables.recent_rows(df, now, n).select(F.lit(name).alias("table_name"), "event_id")
    return one("price_ticks", fx.ticks(spark, d), 1440).unionByName(one("alert_events", fx.alerts(spark, d, now), 10))


@query(
    "src_04_training_rows",
    with_ctes(
        ["bars", "ticks"],
        """SELECT 'daily' AS route, symbol, strftime(event_time,'%Y-%m-%d') AS day, last_price FROM bars
          WHERE event_time >= (SELECT date_trunc('day', max(event_time)) FROM bars) - INTERVAL 1500 DAY
        UNION ALL SELECT 'live', symbol, strftime(event_time,'%Y-%m-%d'), last_price FROM ticks WHERE source NOT LIKE 'replay%'
        UNION ALL SELECT 'fallback', symbol, strftime(event_time,'%Y-%m-%d'), last_price FROM ticks WHERE source='view'""",
    ),
)
def _(spark, d):
    bars, ticks = fx.bars(spark, d), fx.ticks(spark, d)
    newest = bars.agg(F.max("event_time")).first()[0]
    cases = {
        "daily": tables.training_rows(ticks, {"stock": bars}, "akshare_cold_start", newest),
        "live": tables.training_rows(ticks, {"stock": bars}),
        "fallback": tables.training_rows(ticks, {"stock": bars}, "view"),
    }
    out = None
    for name, df in cases.items():
        part = df.select(F.lit(name).alias("route"), "symbol", F.date_format("event_time", "yyyy-MM-dd").alias("day"), "last_price")
        out = part if out is None else out.unionByName(part)
    return out


def catalogue(ticks: DataFrame) -> DataFrame:
    return ticks.select(
        "symbol",
        F.concat(F.lit("Name "), "symbol").alias("company_name"),
        F.lit("Listed").alias("category"),
        "sector",
        "market",
    ).distinct()


@query(
    "src_05_symbol_catalogue",
    with_ctes(
        ["ticks"],
        """SELECT DISTINCT symbol, 'Name '||symbol AS company_name, 'Listed' AS category, sector, market FROM ticks
        UNION ALL SELECT s, s, 'Custom Watchlist', 'Other', '' FROM (VALUES ('600000'),('000001')) AS v(s)""",
    ),
)
def _(spark, d):
    """The catalogue written as JSON lines and read back; a missing folder gives the fallback list."""
    path = scratch_path(spark, "catalogue")
    catalogue(fx.ticks(spark, d)).write.json(path)
    known = tables.read_catalogue(spark, path, ["600000"])
    missing = tables.read_catalogue(spark, path + "-missing", ["600000", "000001"])
    return known.unionByName(missing)


@query(
    "src_06_captured_quotes",
    with_ctes(
        ["ticks"],
        """SELECT event_id, symbol, 'Name '||symbol AS company_name, 'Listed' AS category, sector, market, open_price, high_price, low_price, last_price,
        previous_close, change_pct, volume, turnover, strftime(event_time,'%Y-%m-%d %H:%M:%S') AS event_time, source FROM ticks""",
    ),
)
def _(spark, d):
    """Captures `{"quotes": [...]}` of at most 500 quotes, one per line, overlaid with the catalogue."""
    path = scratch_path(spark, "captures")
    ticks = fx.ticks(spark, d)
    placed = with_position(ticks, ["source"], ["event_time", "id"], fx.by_hour())
    quotes = placed.withColumns({"part": F.floor((F.col("pos") - 1) / 500), "event_time": time_text("event_time")})
    files = quotes.groupBy("source", "part").agg(F.collect_list(F.struct(*QUOTE_COLUMNS)).alias("quotes"))
    files.select(F.to_json(F.struct("quotes")).alias("value")).write.text(path)
    return captures.read_captured_quotes(spark, path, catalogue(ticks), per_line=True)


@query("src_07_newest_capture", with_ctes(["ticks"], "SELECT 'newer' AS kind, count(*) AS quotes, source FROM ticks GROUP BY source"))
def _(spark, d):
    """The newest of several capture folders' files, read back."""
    path = scratch_path(spark, "captures")
    for kind in ("older", "newer"):
        rows = fx.ticks(spark, d).withColumn("event_time", time_text("event_time"))
        rows.groupBy("source").agg(F.count(F.lit(1)).alias("quotes")).withColumn("kind", F.lit(kind)).coalesce(1).write.mode(
            "append"
        ).json(path)
    return spark.read.json(captures.newest_file(spark, path))


@query(
    "snk_01_append_idempotent",
    with_ctes(
        ["ticks"],
        """SELECT 0 AS batch_id, count(*) AS rows, count(DISTINCT symbol) AS symbols
        FROM (SELECT DISTINCT symbol, company_name, category, sector FROM ticks)""",
    ),
)
def _(spark, d):
    """One batch appended twice: the replay leaves the table as it was."""
    now = fx.as_of(spark, d)
    writer = jobs.QuoteBatchWriter(scratch_path(spark, "append"))
    rows = sb.symbol_stats(fx.ticks(spark, d))
    for _ in range(2):
        writer.append(rows, "symbol_stats", 0, now)
    return writer.read(spark, "symbol_stats").groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("symbol").alias("symbols")
    )


def run_stream(spark, d) -> jobs.QuoteBatchWriter:
    """The streaming job over the `events` file."""
    writer = jobs.QuoteBatchWriter(scratch_path(spark, "stream"))
    schema = fx.table(spark, d, "events").schema
    raw = fx.ticks_from_events(jobs.file_source(spark, d, schema, "events.parquet"))
    quotes = raw.where(passes_stream_filter()).select(*QUOTE_COLUMNS)
    jobs.start(quotes, writer, scratch_path(spark, "checkpoint"), available_now=True).awaitTermination()
    return writer


@query("snk_02_quote_archive", with_ctes(["ticks"], "SELECT event_id, symbol, last_price FROM ticks"))
def _(spark, d):
    return run_stream(spark, d).read(spark, "quotes").select("event_id", "symbol", "last_price")


SNAPSHOT_SQL = with_ctes(
    ["ticks"],
    f"""SELECT strftime(event_time,'%Y-%m-%d %H:%M:00') AS window_bucket, count(DISTINCT symbol) AS symbol_count,
    {rnd('avg(last_price)', 2)} AS avg_price, {rnd('avg(change_pct)', 4)} AS avg_change_pct,
    CAST(sum(volume) AS BIGINT) AS total_volume, {money('turnover')} AS total_turnover FROM ticks GROUP BY 1""",
)


@query("snk_03_streaming_writer", SNAPSHOT_SQL)
def _(spark, d):
    return run_stream(spark, d).read(spark, "metric_snapshots").drop(
        "latest_event_time", "created_at", "created_date", "batch_id"
    )


@query(
    "str_12_stream_state",
    with_ctes(
        ["ticks"],
        """SELECT symbol, source, last_price, change_pct, volume FROM ticks
        QUALIFY row_number() OVER (PARTITION BY symbol, source ORDER BY created_at DESC, id DESC)=1""",
    ),
)
def _(spark, d):
    """The state the streaming job keeps, over two batches that come in the wrong order."""
    writer = jobs.QuoteBatchWriter(scratch_path(spark, "stream"))
    rows = fx.ticks(spark, d)
    middle = rows.agg(F.expr("percentile_approx(id, 0.5)")).first()[0]
    for batch, part in enumerate([rows.where(F.col("id") > middle), rows.where(F.col("id") <= middle)]):
        writer(part.select(*QUOTE_COLUMNS), batch)
    state = writer.read(spark, "quote_state")
    return state.where("as_of_batch = 1").select("symbol", "source", "last_price", "change_pct", "volume")


@query(
    "str_12_stream_tables",
    with_ctes(
        ["ticks"],
        """, compact AS (SELECT DISTINCT symbol, source, last_price, change_pct, volume, market FROM ticks)
        SELECT 'quotes' AS table_name, count(*) AS row_count FROM ticks
        UNION ALL SELECT 'metric_snapshots', count(DISTINCT strftime(event_time,'%Y-%m-%d %H:%M')) FROM ticks
        UNION ALL SELECT 'symbol_stats', count(*) FROM (SELECT DISTINCT symbol, company_name, category, sector FROM ticks)
        UNION ALL SELECT 'sector_stats', count(DISTINCT sector) FROM ticks
        UNION ALL SELECT 'category_stats', count(DISTINCT category) FROM ticks
        UNION ALL SELECT 'alert_events', count(*) FROM compact WHERE abs(change_pct)>=2 OR volume>=CASE WHEN market IN ('SH','SZ','BJ') THEN 5000000 ELSE 1000000 END
        UNION ALL SELECT 'price_ticks', count(*) FROM compact
        UNION ALL SELECT 'quote_state', count(*) FROM (SELECT DISTINCT symbol, source FROM ticks)""",
    ).replace(")\n, compact AS", "),\ncompact AS"),
)
def _(spark, d):
    """Row counts of all tables the streaming job writes."""
    writer = run_stream(spark, d)
    names = ["quotes", "metric_snapshots", "symbol_stats", "sector_stats", "category_stats", "alert_events", "price_ticks", "quote_state"]
    return dash.reconciliation({n: writer.read(spark, n) for n in names})


def in_three_batches(spark, d) -> tuple[list[DataFrame], DataFrame]:
    """The quotes as three batches: the first, the last and, late, the middle third of the ids.

    After every 40th quote its price moves by one and comes back, and every 10th quote is sent again in the batch after.
    """
    ticks, top = fx.ticks(spark, d), fx.table(spark, d, "events").agg(F.max("event_id")).first()[0]
    back = ticks.where("id % 40 = 0").withColumn("k", F.explode(F.array(F.lit(1), F.lit(2))))
    back = back.withColumns({"event_id": F.concat("event_id", F.lit("-"), "k"), "event_time": F.expr("event_time + make_interval(0, 0, 0, 0, 0, 0, k)"), "last_price": F.expr("last_price + 2 - k")}).drop("k")
    rows = ticks.unionByName(back).withColumn("b", F.when(F.col("id") * 3 <= top, 0).when(F.col("id") * 3 > 2 * top, 1).otherwise(2))
    again = rows.where("id % 10 = 0 AND b < 2").withColumn("b", F.col("b") + 1)
    every = rows.unionByName(again)
    return [every.where(F.col("b") == k).select(*QUOTE_COLUMNS) for k in range(3)], every


BATCHES_SQL = """, every AS (SELECT id, event_id, symbol, source, last_price, change_pct, volume, event_time, CASE WHEN id*3<=(SELECT max(event_id) FROM events) THEN 0
    WHEN id*3>2*(SELECT max(event_id) FROM events) THEN 1 ELSE 2 END AS b FROM (
    SELECT * FROM ticks UNION ALL BY NAME SELECT * REPLACE (event_id||'-'||k AS event_id, event_time + to_seconds(k) AS event_time, last_price+2-k AS last_price)
    FROM ticks, (VALUES (1), (2)) t(k) WHERE id%40=0))"""


def run_tracked(spark, d, start) -> tuple[str, str]:
    """Runs a stream over the three batches, the first two in one run and the last after a restart; returns folders of output and checkpoint."""
    folder, out, checkpoint = (scratch_path(spark, name) for name in ("batches", "tracked", "checkpoint"))
    batches, _ = in_three_batches(spark, d)
    for k, batch in enumerate(batches):
        batch.coalesce(1).write.mode("append").parquet(folder)
        if k:
            quotes = jobs.file_source(spark, folder, batch.schema, "*.parquet")
            with state.state_in_rocksdb(spark):
                start(state.new_events(quotes, "3650 days"), out, checkpoint).awaitTermination()
    return out, checkpoint


def to_files(df: DataFrame, out: str, checkpoint: str):
    return df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


@query(
    "str_01_dedup_across_batches",
    with_ctes(["ticks"], f"{BATCHES_SQL} SELECT event_id, symbol, last_price FROM every").replace(")\n, every AS", "),\nevery AS"),
)
def _(spark, d):
    """Quotes that are sent again in a later batch come out once."""
    out, _ = run_tracked(spark, d, to_files)
    return spark.read.parquet(out).select("event_id", "symbol", "last_price")


CHANGES_SQL = with_ctes(
    ["ticks"],
    f"""{BATCHES_SQL}, compact AS (SELECT b, symbol, source, last_price, change_pct, volume, arg_min(event_id, (event_time, length(event_id), event_id)) AS event_id FROM every GROUP BY ALL),
    held AS (SELECT n.b, e.symbol, e.source, arg_max((e.last_price, e.change_pct, e.volume), (event_time, length(event_id), event_id)) AS v
      FROM (VALUES (1), (2)) n(b) JOIN every e ON e.b < n.b GROUP BY ALL)
    SELECT event_id, symbol, source, last_price, change_pct, volume FROM compact LEFT JOIN held USING (b, symbol, source) WHERE v IS NULL OR v<>(last_price, change_pct, volume)""",
).replace(")\n, every AS", "),\nevery AS")


@query("str_04_changed_stream", CHANGES_SQL)
def _(spark, d):
    """Changed quotes of a stream whose latest quotes are in the state store: late batch, prices that come back, restart."""
    out, _ = run_tracked(spark, d, lambda quotes, *where: to_files(state.mark_changes(quotes), *where))
    return spark.read.parquet(out).where("changed").select("event_id", *sb.STATE_KEYS, *sb.STATE_VALUES)


@query(
    "str_03_state_store",
    with_ctes(
        ["ticks"],
        f"""{BATCHES_SQL} SELECT symbol, source, last_price, change_pct, volume FROM every
        QUALIFY row_number() OVER (PARTITION BY symbol, source ORDER BY event_time DESC, length(event_id) DESC, event_id DESC)=1""",
    ).replace(")\n, every AS", "),\nevery AS"),
)
def _(spark, d):
    """The latest quotes as the state store holds them after the last batch."""
    _, checkpoint = run_tracked(spark, d, lambda quotes, *where: to_files(state.mark_changes(quotes), *where))
    return state.latest_quotes(spark, checkpoint)


@query(
    "str_12_tracked_tables",
    CHANGES_SQL.replace(
        "SELECT event_id, symbol, source, last_price, change_pct, volume FROM compact LEFT JOIN held USING (b, symbol, source) WHERE v IS NULL OR v<>(last_price, change_pct, volume)",
        """SELECT 'quotes' AS table_name, count(*) AS row_count FROM every
        UNION ALL SELECT 'price_ticks', count(*) FROM compact LEFT JOIN held USING (b, symbol, source) WHERE v IS NULL OR v<>(last_price, change_pct, volume)
        UNION ALL SELECT 'sector_stats', count(*) FROM (SELECT DISTINCT b, sector FROM every JOIN (SELECT DISTINCT symbol, sector FROM ticks) USING (symbol))""",
    ),
)
def _(spark, d):
    """Row counts of tables that the streaming job writes when the state store tracks ids and quotes; the first two batches are then packed."""
    made: list[jobs.QuoteBatchWriter] = []

    def begin(quotes, out, checkpoint):
        made[:] = [jobs.QuoteBatchWriter(out)]
        return jobs.start(state.mark_changes(quotes), made[0], checkpoint, available_now=True)

    run_tracked(spark, d, begin)
    names = ["quotes", "price_ticks", "sector_stats"]
    for name in names:
        for day in made[0].read(spark, name).select("created_date").distinct().collect():
            made[0].compact(spark, name, day[0], 1)
    return dash.reconciliation({n: made[0].read(spark, n) for n in names})


def renamed_bars(spark, d) -> DataFrame:
    bars = fx.bars(spark, d)
    return bars.withColumn("event_id", F.when(F.col("k") % 3 == 0, F.concat(F.lit("x-"), "event_id")).otherwise(F.col("event_id")))


@query(
    "snk_04_insert_if_absent",
    with_ctes(
        ["bars"],
        "SELECT CASE WHEN k%3=0 THEN 'x-'||event_id ELSE event_id END AS event_id, symbol, last_price FROM bars WHERE k%2=1",
    ),
)
def _(spark, d):
    new = renamed_bars(spark, d)
    target = fx.bars(spark, d).where(F.col("k") % 2 == 0)
    return tables.rows_to_insert(new.unionByName(new), target, ["created_at", "event_id"]).select(
        "event_id", "symbol", "last_price"
    )


@query(
    "snk_04_insert_by_period",
    with_ctes(
        ["bars"],
        """SELECT 'table' AS part, event_id, symbol, last_price FROM bars WHERE k%2=0 UNION ALL SELECT part, CASE WHEN k%3=0 THEN 'x-'||event_id ELSE event_id END, symbol, last_price
        FROM bars, (VALUES ('table'), ('fresh')) p(part) WHERE k%2=1""",
    ),
)
def _(spark, d):
    """Bars inserted into a table by months: what was new, and the table after the same insert has run twice."""
    store, order = stored.PeriodTable(scratch_path(spark, "bars-by-period")), ["created_at", "event_id"]
    store.insert(fx.bars(spark, d).where(F.col("k") % 2 == 0), order)
    new = renamed_bars(spark, d)
    fresh = store.insert(new.unionByName(new), order)
    again = store.insert(new, order)
    rows = store.read(spark).select(F.lit("table").alias("part"), "event_id", "symbol", "last_price")
    for name, df in (("fresh", fresh), ("again", again)):
        rows = rows.unionByName(df.select(F.lit(name).alias("part"), "event_id", "symbol", "last_price"))
    return rows


SPLIT_SQL = with_ctes(
    ["bars_raw", "index_raw"],
    """SELECT 'stock' AS kind, event_id, strftime(trade_date,'%Y-%m-%d') AS trade_date FROM bars_raw WHERE k%2=1
    UNION ALL SELECT 'index', event_id, strftime(trade_date,'%Y-%m-%d') FROM index_raw""",
)


@query("snk_05_split_by_period", SPLIT_SQL)
def _(spark, d):
    """The same split into tables by months."""
    cols, order = [*QUOTE_COLUMNS, "created_at"], ["created_at", "event_id"]
    stock, index, ticks = fx.bars_raw(spark, d), fx.index_raw(spark, d), fx.ticks(spark, d)
    mixed = stock.select(*cols).unionByName(index.select(*cols)).unionByName(ticks.select(*cols))
    kept = {kind: stored.PeriodTable(scratch_path(spark, f"{kind}-by-period")) for kind in ("stock", "index")}
    kept["stock"].insert(stock.where(F.col("k") % 2 == 0).select(*cols), order)
    parts = stored.split_into(mixed, kept, order, tables.DAILY_SOURCES)
    rows = [df.select(F.lit(kind).alias("kind"), "event_id", F.date_format("event_time", "yyyy-MM-dd").alias("trade_date")) for kind, df in parts.items()]
    return rows[0].unionByName(rows[1])


@query("snk_05_split_daily_bars", SPLIT_SQL)
def _(spark, d):
    cols = [*QUOTE_COLUMNS, "created_at"]
    stock, index, ticks = fx.bars_raw(spark, d), fx.index_raw(spark, d), fx.ticks(spark, d)
    mixed = stock.select(*cols).unionByName(index.select(*cols)).unionByName(ticks.select(*cols))
    targets = {"stock": stock.where(F.col("k") % 2 == 0), "index": index.limit(0)}
    parts = tables.split_daily_bars(mixed, targets, ["created_at", "event_id"])
    rows = [
        df.select(F.lit(kind).alias("kind"), "event_id", F.date_format("trade_date", "yyyy-MM-dd").alias("trade_date"))
        for kind, df in parts.items()
    ]
    return rows[0].unionByName(rows[1])


ACTIONS_SQL = with_ctes(
    ["alerts", "actions"],
    """, updates AS (SELECT id AS alert_id, CASE id%6 WHEN 0 THEN 'RESOLVED' WHEN 2 THEN 'ACKED' ELSE 'IGNORED' END AS status,
      CASE WHEN id%6=2 THEN '' ELSE 'second' END AS note, 'ops' AS handled_by, created_at + INTERVAL 9 MINUTE AS handled_at FROM alerts WHERE id%2=0)
    SELECT alert_id, status, note, handled_by, strftime(handled_at,'%Y-%m-%d %H:%M:%S') AS handled_at FROM updates
    UNION ALL SELECT alert_id, status, note, handled_by, strftime(handled_at,'%Y-%m-%d %H:%M:%S') FROM actions WHERE alert_id%2=1""",
).replace(")\n, updates", "),\nupdates")


def action_updates(spark, d) -> DataFrame:
    """Updates of half of the alerts, some with unknown states, each with an earlier one that they replace."""
    alerts = fx.alerts(spark, d, fx.as_of(spark, d))
    k = F.col("id") % 6
    updates = alerts.where(F.col("id") % 2 == 0).select(
        F.col("id").alias("alert_id"),
        F.when(k == 0, " resolved ").when(k == 2, "bogus").otherwise("Ignored").alias("status"),
        F.when(k != 2, "second").alias("note"),
        F.lit("ops").alias("handled_by"),
        (F.col("created_at") + F.expr("INTERVAL 9 MINUTES")).alias("handled_at"),
    )
    earlier = updates.withColumns({"status": F.lit("OPEN"), "handled_at": F.col("handled_at") - F.expr("INTERVAL 2 MINUTES")})
    return updates.unionByName(earlier)


@query("snk_06_upsert_actions", ACTIONS_SQL)
def _(spark, d):
    done = tables.upsert_actions(fx.alert_actions(spark, d, fx.as_of(spark, d)), action_updates(spark, d))
    return done.withColumn("handled_at", time_text("handled_at"))


@query("snk_06_upsert_by_bucket", ACTIONS_SQL)
def _(spark, d):
    """The same updates on a stored table; they run twice."""
    store = stored.ActionTable(scratch_path(spark, "actions"))
    store.upsert(fx.alert_actions(spark, d, fx.as_of(spark, d)))
    for _ in range(2):
        store.upsert(action_updates(spark, d))
    return store.read(spark).withColumn("handled_at", time_text("handled_at"))


@query(
    "snk_07_result_store",
    with_ctes(
        ["ticks", "metrics"],
        """SELECT 'current_predictions' AS table_name, count(DISTINCT symbol) AS row_count FROM ticks
        UNION ALL SELECT 'current_metrics', count(*) FROM metrics UNION ALL SELECT 'prediction_history', 2*count(DISTINCT symbol) FROM ticks""",
    ),
)
def _(spark, d):
    """Two runs written; the second without metrics keeps the first run's metrics current."""
    now = fx.as_of(spark, d)
    store = tables.ResultStore(scratch_path(spark, "results"))
    predictions, metrics = fx.predictions(spark, d), fx.model_metrics(spark, d).drop("model_version")
    store.write(predictions, metrics, "daily-1", now)
    store.write(predictions, None, "daily-2", now + timedelta(days=1))
    return dash.reconciliation(
        {
            "current_predictions": store.current(spark, "predictions"),
            "current_metrics": store.current(spark, "metrics"),
            "prediction_history": store.history(spark),
        }
    )


CSV_SQL = """ SELECT row_number() OVER (ORDER BY event_time DESC, id DESC) AS seq,
  '"'||symbol||'","'||company_name||'","'||category||'","'||sector||'","'||market||'","'||CAST(CAST(last_price AS DECIMAL(20,2)) AS VARCHAR)
  ||'","'||CAST(round(CAST(change_pct AS DECIMAL(28,9)),2)::DECIMAL(20,2) AS VARCHAR)||'","'||volume||'","'||CAST(CAST(turnover AS DECIMAL(20,2)) AS VARCHAR)||'","'||strftime(event_time,'%Y-%m-%d %H:%M:%S')||'","'||source||'"' AS line
  FROM ticks, clock WHERE created_at >= now - INTERVAL 1440 MINUTE ORDER BY event_time DESC, id DESC LIMIT 5000"""


@query(
    "snk_08_history_csv",
    with_ctes(
        ["ticks", "clock"],
        f"""SELECT * FROM ({CSV_SQL}) UNION ALL
        SELECT 0, '{chr(0xFEFF)}symbol,company_name,category,sector,market,last_price,change_pct,volume,turnover,event_time,source'""",
    ),
)
def _(spark, d):
    m = dash.Market(fx.as_of(spark, d), fx.ticks(spark, d))
    return tables.history_csv(dash.history(m, minutes=1440, limit=5000))


@query(
    "snk_09_csv_report",
    with_ctes(
        ["bars_raw"],
        f"""SELECT CAST(COLUMNS(*) AS VARCHAR) FROM (SELECT count(*) AS input_rows, count(*) FILTER (NOT ({ANY_FAULT})) AS output_rows,
        count(*) FILTER ({ANY_FAULT}) AS dropped_rows, {', '.join(f'count(*) FILTER ({v}) AS invalid_{k}_rows' for k, v in FAULT_SQL.items())}, 0 AS duplicate_rows FROM bars_raw)""",
    ),
)
def _(spark, d):
    """The cleaning report written as CSV and read back."""
    path = scratch_path(spark, "report")
    tables.write_csv_report(cleaning.quality_report(fx.bars_raw(spark, d)), path)
    return spark.read.option("header", True).csv(path)


@query("str_01_dedup_events", with_ctes(["ticks"], "SELECT event_id, symbol, last_price FROM ticks"))
def _(spark, d):
    rows = fx.ticks(spark, d)
    return sb.dedup_events(rows.unionByName(rows)).select("event_id", "symbol", "last_price")


@query(
    "str_02_compact_snapshots",
    with_ctes(["ticks"], "SELECT DISTINCT symbol, source, last_price, change_pct, volume FROM ticks"),
)
def _(spark, d):
    rows = fx.ticks(spark, d)
    return sb.compact_snapshots(rows.unionByName(rows)).select("symbol", "source", "last_price", "change_pct", "volume")


STATE_SQL = """SELECT symbol, source, last_price, change_pct, volume FROM ticks {where}
  QUALIFY row_number() OVER (PARTITION BY symbol, source ORDER BY created_at DESC, id DESC)=1"""


@query("str_03_latest_state", with_ctes(["ticks"], STATE_SQL.format(where="")))
def _(spark, d):
    return sb.latest_state(fx.ticks(spark, d), fx.TICK_ORDER)


@query(
    "str_04_keep_changed",
    with_ctes(
        ["ticks"],
        f"""SELECT DISTINCT t.symbol, t.source, t.last_price, t.change_pct, t.volume FROM ticks t
        LEFT JOIN ({STATE_SQL.format(where='WHERE id%2=0')}) s ON t.symbol=s.symbol AND t.source=s.source
        WHERE s.last_price IS NULL OR t.last_price<>s.last_price OR t.change_pct<>s.change_pct OR t.volume<>s.volume""",
    ),
)
def _(spark, d):
    rows = fx.ticks(spark, d)
    state = sb.latest_state(rows.where(F.col("id") % 2 == 0), fx.TICK_ORDER)
    return sb.keep_changed(rows, state).select("symbol", "source", "last_price", "change_pct", "volume")


@query(
    "str_05_minute_bucket",
    with_ctes(["ticks"], "SELECT event_id, strftime(event_time,'%Y-%m-%d %H:%M:00') AS window_bucket FROM ticks"),
)
def _(spark, d):
    return fx.ticks(spark, d).select("event_id", sb.minute_bucket().alias("window_bucket"))


@query("str_06_minute_snapshot", SNAPSHOT_SQL)
def _(spark, d):
    return sb.minute_snapshot(sb.dedup_events(fx.ticks(spark, d))).drop("latest_event_time")


@query("str_06_merged_snapshot", SNAPSHOT_SQL)
def _(spark, d):
    """The snapshot out of parts of three batches that share minutes and symbols; symbols are numbered as they come."""
    rows, numbers, parts = fx.ticks(spark, d), None, None
    for k in range(3):
        batch = rows.where(F.col("id") % 3 == k)
        numbers = materialize(sb.symbol_numbers(batch, numbers), "symbol-numbers")
        part = sb.minute_parts(batch, numbers)
        parts = part if parts is None else parts.unionByName(part)
    return sb.merge_minute_parts(parts).drop("latest_event_time")


@query(
    "str_07_symbol_stats",
    with_ctes(
        ["ticks"],
        f"""SELECT symbol, company_name, category, sector, max(last_price) AS last_price,
        arg_max(last_price, (event_time, event_id)) AS latest_price, {rnd('avg(change_pct)', 4)} AS change_pct,
        CAST(sum(volume) AS BIGINT) AS volume, {money('turnover')} AS turnover FROM ticks GROUP BY ALL""",
    ),
)
def _(spark, d):
    return sb.symbol_stats(fx.ticks(spark, d))


def _dimension_sql(dim: str) -> str:
    return with_ctes(
        ["ticks"],
        f"""SELECT {dim}, count(DISTINCT symbol) AS symbol_count, {rnd('avg(change_pct)', 4)} AS avg_change_pct,
        {money('turnover')} AS turnover FROM ticks GROUP BY ALL""",
    )


@query("str_08_sector_stats", _dimension_sql("sector"))
def _(spark, d):
    return sb.dimension_stats(fx.ticks(spark, d), "sector")


@query("str_08_category_stats", _dimension_sql("category"))
def _(spark, d):
    return sb.dimension_stats(fx.ticks(spark, d), "category")


@query("str_09_history_baseline", with_ctes(["baseline"], "SELECT * FROM baseline"))
def _(spark, d):
    return sb.history_baseline(fx.ticks(spark, d), fx.as_of(spark, d))


@query("str_09_baseline_of_hours", with_ctes(["baseline"], "SELECT * FROM baseline"))
def _(spark, d):
    """The same means out of merged sums per symbol and hour of quotes that come in two batches."""
    now = fx.as_of(spark, d)
    since = now - timedelta(days=1)
    rows = fx.ticks(spark, d).withColumns({"batch_id": F.col("id") % 2, "at": F.col("created_at")})
    sums = sb.hour_sums(rows, ["batch_id", "at"])
    parts = [sb.as_parts(sums.where(F.col("batch_id") == k)).withColumn("hour", F.date_trunc("hour", F.get("parts", F.lit(0))["at"])) for k in (0, 1)]
    merged = parts[0].unionByName(parts[1]).groupBy("symbol", "hour").agg(F.flatten(F.collect_list("parts")).alias("parts"))
    hours = sb.with_sums(merged.where(F.col("hour") >= F.date_trunc("hour", F.lit(since))))
    edge = F.col("hour") == F.date_trunc("hour", F.lit(since))
    return sb.baseline_of_hours(hours.where(~edge), hours.where(edge), since)


ALERT_COLUMNS = "id, symbol, alert_type, alert_level, price_threshold, volume_threshold, change_pct, volume"


@query("str_10_alerts", with_ctes(["alerts"], f"SELECT {ALERT_COLUMNS} FROM alerts"))
def _(spark, d):
    return fx.alerts(spark, d).select(*ALERT_COLUMNS.split(", "))


@query(
    "str_10_alerts_without_history",
    with_ctes(
        ["ticks"],
        f"SELECT {ALERT_COLUMNS} FROM ({alert_sql('ticks', '(SELECT 1 AS symbol, 0 AS avg_abs_change_pct, 0 AS avg_volume WHERE false)').replace('t.symbol = b.symbol', 'false')})",
    ),
)
def _(spark, d):
    rows = fx.ticks(spark, d)
    return sb.build_alerts(rows, sb.empty_baseline(rows), keep=["id"]).select(*ALERT_COLUMNS.split(", "))


@query(
    "str_11_alert_cooldown",
    with_ctes(
        ["alerts", "clock"],
        """SELECT id, symbol, alert_type FROM alerts ANTI JOIN
        (SELECT DISTINCT symbol, alert_type FROM alerts, clock WHERE created_at >= now - INTERVAL 600 MINUTE) USING (symbol, alert_type)""",
    ),
)
def _(spark, d):
    now = fx.as_of(spark, d)
    alerts = fx.alerts(spark, d, now)
    return sb.suppress_recent(alerts, alerts, now, 600).select("id", "symbol", "alert_type")


HEALTH_SQL = with_ctes(
    ["ticks", "clock", "snapshots"],
    """SELECT p.n AS total_events, p1+m1 AS events_last_minute, p5+m5 AS events_last_5_minutes, total_symbols, source_count,
     strftime(event_at,'%Y-%m-%d %H:%M:%S') AS latest_event_time, strftime(price_at,'%Y-%m-%d %H:%M:%S') AS latest_price_created_at,
     strftime(metric_at,'%Y-%m-%d %H:%M:%S') AS latest_metric_created_at,
     CAST(floor(epoch(now-greatest(price_at,metric_at))) AS BIGINT) AS seconds_since_last_event,
     CASE WHEN greatest(price_at,metric_at) < now - INTERVAL 10 MINUTE THEN 'OFFLINE'
       WHEN latest_source LIKE 'replay%' AND price_at>=metric_at THEN 'REPLAY' ELSE 'LIVE' END AS current_mode,
     CASE WHEN greatest(price_at,metric_at) >= now - INTERVAL 30 SECOND THEN 'FLOWING'
       WHEN greatest(price_at,metric_at) >= now - INTERVAL 5 MINUTE THEN 'DELAYED' ELSE 'STOPPED' END AS stream_state
    FROM clock, (SELECT count(*) AS n, count(*) FILTER (created_at >= now - INTERVAL 1 MINUTE) AS p1,
       count(*) FILTER (created_at >= now - INTERVAL 5 MINUTE) AS p5, count(DISTINCT symbol) AS total_symbols,
       count(DISTINCT source) AS source_count, max(event_time) AS event_at, max(created_at) AS price_at,
       arg_max(source, (created_at, id)) AS latest_source FROM ticks, clock) p,
     (SELECT count(*) FILTER (latest_event_time >= now - INTERVAL 1 MINUTE) AS m1,
       count(*) FILTER (latest_event_time >= now - INTERVAL 5 MINUTE) AS m5, max(latest_event_time) AS metric_at FROM snapshots, clock) m""",
)


@query("str_13_stream_health", HEALTH_SQL)
def _(spark, d):
    return dash.stream_health(dash.Market(fx.as_of(spark, d), fx.ticks(spark, d), snapshots=fx.snapshots(spark, d)))


@query(
    "str_14_source_status",
    with_ctes(
        ["ticks", "clock"],
        """SELECT source, count(*) AS success_count, count(DISTINCT symbol) AS symbol_count,
        strftime(max(event_time),'%Y-%m-%d %H:%M:%S') AS latest_event_time,
        CAST(floor(epoch(any_value(now)-max(created_at))) AS BIGINT) AS seconds_since_last_event,
        CASE WHEN max(created_at) >= any_value(now) - INTERVAL 10 MINUTE THEN 'OK'
          WHEN max(created_at) >= any_value(now) - INTERVAL 60 MINUTE THEN 'DELAYED' ELSE 'OFFLINE' END AS status
        FROM ticks, clock GROUP BY source""",
    ),
)
def _(spark, d):
    return dash.source_status(dash.Market(fx.as_of(spark, d), fx.ticks(spark, d)))


@query(
    "str_15_minute_window",
    with_ctes(
        ["ticks"],
        f"""SELECT strftime(event_time,'%Y-%m-%d %H:%M:00') AS window_bucket, count(*) AS quotes, {rnd('avg(last_price)', 2)} AS avg_price,
        CAST(sum(volume) AS BIGINT) AS total_volume, {money('turnover')} AS total_turnover FROM ticks GROUP BY 1""",
    ),
)
def _(spark, d):
    return jobs.minute_window(fx.ticks(spark, d))


@query(
    "str_15_minute_window_stream",
    with_ctes(
        ["ticks"],
        f"""SELECT strftime(event_time,'%Y-%m-%d %H:%M:00') AS window_bucket, count(*) AS quotes, {rnd('avg(last_price)', 2)} AS avg_price,
        CAST(sum(volume) AS BIGINT) AS total_volume, {money('turnover')} AS total_turnover FROM ticks
        GROUP BY 1 HAVING date_trunc('minute', max(event_time)) + INTERVAL 1 MINUTE <= (SELECT max(event_time) FROM ticks) - INTERVAL 10 MINUTE""",
    ),
)
def _(spark, d):
    """The same as a stream: minutes come out once the watermark has passed them."""
    schema, out = fx.table(spark, d, "events").schema, scratch_path(spark, "minutes")
    raw = fx.ticks_from_events(jobs.file_source(spark, d, schema, "events.parquet"))
    minutes = jobs.minute_window(raw.where(passes_stream_filter())).writeStream.outputMode("append").format("parquet")
    job = minutes.option("path", out).option("checkpointLocation", scratch_path(spark, "checkpoint")).trigger(availableNow=True).start()
    job.awaitTermination()
    return spark.read.parquet(out)
