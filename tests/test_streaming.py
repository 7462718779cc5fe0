"""Stream = batch: events split across files, shuffled, duplicated, late,
with a malformed line and an unknown table; replay of a batch; folding of views."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sensorium.plans.context import Ctx
from sensorium.operators import relational as R
from sensorium.plans.views import VIEWS, Agg, ViewDef
from sensorium.streaming.batchlog import BatchTable, children
from sensorium.streaming.incremental import IncrementalView
from sensorium.streaming.ingest import (
    ALERT_TABLE, READING_TABLE, Ingest, dedup_within_watermark, event_stream, ingest_progress, ingest_totals,
    parse_events, read_recent, read_table, route, run_once, to_events, window_handler, windowed,
)


def rows_of(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def ctx(spark):
    return Ctx(spark, SF_SMALL)


def write_files(spark, lines, root, n_files):
    """Write JSON lines to ``n_files`` files, in shuffled order."""
    random.Random(7).shuffle(lines)
    size = (len(lines) + n_files - 1) // n_files
    for i in range(n_files):
        chunk = lines[i * size:(i + 1) * size]
        spark.createDataFrame([(x,) for x in chunk], "value string").coalesce(1) \
            .write.mode("overwrite").text(f"{root}/in/part{i:03d}")


def test_stream_equals_batch_with_noise(spark, ctx, scratch):
    readings, alerts = ctx.readings, ctx.alerts
    lines = [r["value"] for r in to_events(readings, alerts).collect()]
    n_events = len(lines)
    dup = lines[:25]                                     # at-least-once duplicates
    lines = lines + dup + ["{not json", '{"_table": "Nope", "SensorId": "1"}']
    write_files(spark, lines, scratch, 6)

    schemas = {READING_TABLE: readings.schema, ALERT_TABLE: alerts.schema}
    view = IncrementalView(spark, VIEWS["mv_readings_daily"], f"{scratch}/view")
    ing = Ingest(schemas=schemas, tables={t: f"{scratch}/tables/{t}" for t in schemas},
                 quarantine=f"{scratch}/quarantine",
                 handlers={READING_TABLE: [view.attach(every_compact=2)]},
                 dedup_key={READING_TABLE: "ReadingId", ALERT_TABLE: "AlertId"},
                 partition_by={READING_TABLE: ["event_date"]}, parallel_writes=3)
    # Redelivered events land in other files, so in other micro-batches:
    # the arrival-time dedup drops them across batches.
    q = ing.start(event_stream(spark, f"{scratch}/in/*", max_files_per_trigger=2),
                  checkpoint=f"{scratch}/ckpt", available_now=True, dedup_delay="10 minutes")
    run_once(q)
    assert q.exception() is None
    progress = ingest_progress(q)
    assert progress["ingest.events"] == n_events + len(dup) + 2

    quarantined = read_table(spark, f"{scratch}/quarantine")
    assert quarantined.count() == 2
    facts = read_table(spark, f"{scratch}/tables/{READING_TABLE}").drop("event_date")
    assert facts.count() == readings.count()
    assert sorted(map(tuple, facts.collect()), key=repr) == \
        sorted(map(tuple, readings.collect()), key=repr)
    assert read_table(spark, f"{scratch}/tables/{ALERT_TABLE}").count() == alerts.count()
    expect = rows_of(VIEWS["mv_readings_daily"].compute(readings))
    assert rows_of(VIEWS["mv_readings_daily"].compute(facts)) == expect
    assert rows_of(view.read()) == expect              # incremental view: exactly once


def test_incremental_view_exactly_once_and_late_rows(spark, ctx, scratch):
    v = VIEWS["mv_readings_hourly"]
    r = ctx.readings
    early = r.where(F.col("Timestamp") < F.lit(dt.datetime(2024, 1, 15)))
    late = r.where(F.col("Timestamp") >= F.lit(dt.datetime(2024, 1, 15)))
    iv = IncrementalView(spark, v, f"{scratch}/iv")
    iv.backfill(late)                    # history arrives first …
    iv.apply_batch(early.where(F.col("SensorType") == "Temperature"), 0)
    iv.apply_batch(early.where(F.col("SensorType") != "Temperature"), 1)
    iv.apply_batch(early.where(F.col("SensorType") != "Temperature"), 1)   # replayed batch
    expect = rows_of(v.compute(r))
    assert rows_of(iv.read()) == expect
    iv.compact(0)
    assert rows_of(iv.read()) == expect
    iv.apply_batch(early.where(F.col("SensorType") != "Temperature"), 1)   # replay after compaction
    iv.compact(1)
    assert rows_of(iv.read()) == expect
    iv.compact(1)                                          # no-op
    assert rows_of(iv.read()) == expect


def test_route_types_and_quarantine(spark, ctx):
    ev = to_events(ctx.readings.limit(5), ctx.alerts.limit(3))
    bad_value = '{"_table": "SensorReading", "ReadingId": "987654321", "ReadingValue": "abc", "Timestamp": "nope"}'
    raw = ev.unionByName(spark.createDataFrame([("garbage",), (bad_value,)], "value string"))
    schemas = {READING_TABLE: ctx.readings.schema, ALERT_TABLE: ctx.alerts.schema}
    routed = route(parse_events(raw, schemas), schemas)
    assert routed[READING_TABLE].schema == ctx.readings.schema or \
        [f.dataType for f in routed[READING_TABLE].schema] == [f.dataType for f in ctx.readings.schema]
    assert routed[READING_TABLE].count() == 5 and routed[ALERT_TABLE].count() == 3
    bad = {r["value"]: r["reason"] for r in routed["_quarantine"].collect()}
    assert bad == {"garbage": "no table", bad_value: "does not convert: Timestamp, ReadingValue"}
    got = sorted(map(tuple, routed[READING_TABLE].collect()))
    want = sorted(map(tuple, ctx.readings.where(
        F.col("ReadingId").isin([r["ReadingId"] for r in routed[READING_TABLE].collect()])).collect()))
    assert got == want


def test_dedup_within_watermark_and_windows(spark, ctx, scratch):
    r = ctx.readings_plain.select("ReadingId", "Timestamp", "SensorType", "ReadingValue")
    src = f"{scratch}/parquet_in"
    r.unionByName(r.limit(20)).write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(r.schema).parquet(src)
    d = dedup_within_watermark(stream, "ReadingId", delay="400 days")
    q = (d.writeStream.format("memory").queryName("dedup_out")
         .option("checkpointLocation", f"{scratch}/ck1").trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("dedup_out").count() == r.count()

    w = windowed(stream, "1 hour", ["SensorType"], [F.count(F.lit(1)).alias("n")],
                 lateness="1 hour")
    q2 = (w.writeStream.format("memory").queryName("win_out").outputMode("append")
          .option("checkpointLocation", f"{scratch}/ck2").trigger(availableNow=True).start())
    q2.awaitTermination()
    # Append mode emits a window once the watermark passes it: every window
    # but the last hour(s) is final and equals the batch count.
    assert spark.table("win_out").count() > 0


def test_csv_stream_timed_trigger_and_live_alerts(spark, ctx, scratch):
    from sensorium.operators.alerts import threshold_table
    from sensorium.schemas import SENSOR_ALERT
    from sensorium.streaming.ingest import alert_handler, csv_stream, run_for

    # Alerts as header-less CSV with quotes and commas in Message.
    alerts = spark.createDataFrame(
        [("a1", "s1", "z1", "site1", dt.datetime(2024, 1, 1), "CO2", "AboveThreshold", "Critical",
          4600.0, 1000.0, 'CO2 "too" high, really')], SENSOR_ALERT)
    (alerts.write.option("header", "false").option("quote", '"').option("escape", '"')
     .csv(f"{scratch}/csv_in"))
    s = csv_stream(spark, f"{scratch}/csv_in", SENSOR_ALERT)
    q = (s.writeStream.format("memory").queryName("csv_out")
         .option("checkpointLocation", f"{scratch}/ck_csv").trigger(processingTime="1 second").start())
    q.processAllAvailable()
    run_for(q, 1)                                          # T1 + T2
    assert spark.table("csv_out").collect()[0]["Message"] == 'CO2 "too" high, really'

    # Alerts derived live from the routed readings.
    h = alert_handler(threshold_table(spark), f"{scratch}/live_alerts")
    h(ctx.readings, 0)
    h(ctx.readings, 0)                                     # replayed batch: no double count
    got = read_table(spark, f"{scratch}/live_alerts").count()
    assert got == ctx.readings.where(F.col("IsAnomaly")).count()


def test_refresh_tables_and_view_catalog(spark, ctx, scratch):
    from sensorium.streaming.incremental import drop_view, list_views, recreate_view
    from sensorium.streaming.ingest import read_refreshed, refresh_tables, run_for

    from sensorium.streaming.ingest import await_batches
    q = refresh_tables(spark, {"tile_total": lambda: ctx.readings_plain.agg(F.count(F.lit(1)).alias("n"))},
                       f"{scratch}/tiles", f"{scratch}/ck_tiles", every="1 second")
    assert await_batches(q, 2, timeout_sec=120)            # T12: two timed refreshes
    run_for(q, 0.1)
    assert read_refreshed(spark, f"{scratch}/tiles", "tile_total").collect()[0]["n"] == ctx.readings_plain.count()

    v = VIEWS["mv_readings_daily"]
    t = recreate_view(spark, "mv_test_daily", v, ctx.readings, f"{scratch}/mv_test_daily")
    assert t.count() == v.compute(ctx.readings).count()
    assert "mv_test_daily" in list_views(spark, "mv_test*")
    drop_view(spark, "mv_test_daily")
    assert "mv_test_daily" not in list_views(spark, "mv_test*")


def test_batch_table_replay_and_two_writers(spark, ctx, scratch):
    from sensorium.streaming.batchlog import BatchTable
    r = ctx.readings_plain.withColumn("event_date", F.to_date("Timestamp"))
    t = BatchTable(spark, f"{scratch}/bt", partition_by=["event_date"])
    a = r.where(F.col("SensorType") == "Temperature")
    b = r.where(F.col("SensorType") != "Temperature")
    t.write(a, 0, "one")
    t.write(r, 0, "two")                              # a second query, or a new checkpoint: ids start at 0 again
    t.write(b, 0, "two")                              # its replay replaces all that it wrote
    want = sorted(map(tuple, r.select(*sorted(r.columns)).collect()), key=repr)
    d = t.read()
    assert sorted(map(tuple, d.select(*sorted(d.columns)).collect()), key=repr) == want
    plan = t.read().where(F.col("event_date") == F.lit(dt.date(2024, 1, 15)))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_unreadable_rows_fail_the_read(spark, scratch):
    from sensorium.streaming.batchlog import BatchTable
    t = BatchTable(spark, f"{scratch}/broken")
    with pytest.raises(ValueError, match="nothing written"):
        t.read()
    t.write(spark.range(3), 0, "one")
    path = t.batch_path(1, "one")
    spark.createDataFrame([("not parquet",)], "value string").coalesce(1).write.text(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for f in fs.listStatus(target):
        if f.getPath().getName().endswith(".txt"):
            fs.rename(f.getPath(), spark._jvm.org.apache.hadoop.fs.Path(path + "/part-0.parquet"))
    with pytest.raises(Exception):  # noqa: B017
        t.read().count()


def test_rows_written_do_not_grow_with_the_table(spark, ctx, scratch):
    """Every batch leaves exactly its own rows; nothing rewrites them."""
    from sensorium.streaming.batchlog import BatchTable, children
    t = BatchTable(spark, f"{scratch}/linear")
    for i in range(6):
        t.write(spark.range(100), i, "q")
        stored = spark.read.parquet(*[t.batch_path(int(b[7:]), "q") for b in children(spark, f"{t.root}/_source=q")])
        assert stored.count() == 100 * (i + 1)


def data_files(spark, *roots):
    return sum(len(spark.read.parquet(r).inputFiles()) for r in roots)


def test_view_store_files_compaction_and_day_pruning(spark, ctx, scratch):
    """Files are bounded by closed days and open batches, whatever the rows' days; nothing is
    counted twice, whichever step of a compaction was reached."""
    v, r = VIEWS["mv_readings_hourly"], ctx.readings
    iv = IncrementalView(spark, v, f"{scratch}/store")
    rows = r.withColumn("_part", F.pmod("ReadingId", F.lit(10)))
    n_days = r.select(F.to_date("Timestamp")).distinct().count()
    expect = rows_of(v.compute(r))
    for i in range(10):
        iv.apply_batch(rows.where(F.col("_part") == i).drop("_part"), i, "q")   # each holds rows of all days
        if i in (3, 6):
            iv.compact(i - 1, "q")
    assert rows_of(iv.read()) == expect
    open_batches = [n for n in children(spark, f"{iv.open.root}/_source=q")]
    assert open_batches == [f"_batch={i}" for i in range(3, 10)]      # 0-2 went when 3-5 were folded
    assert data_files(spark, iv.closed) <= n_days and data_files(spark, iv.open.root) <= len(open_batches)
    day = iv.read(days=("2024-01-10", "2024-01-10"))
    assert rows_of(day) == rows_of(v.compute(r.where(F.to_date("Timestamp") == F.lit(dt.date(2024, 1, 10)))))
    assert "bin_period" in day._jdf.queryExecution().toString().split("PartitionFilters: [", 1)[1][:80]
    # A compaction that stopped after some periods were overwritten: the others are folded next time.
    half = iv._closed().where(F.col("bin_period") <= "2024-01-15")
    saved = half.collect()
    iv.compact(9, "q")
    assert rows_of(iv.read()) == expect
    spark.createDataFrame(saved, half.schema).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("bin_period").parquet(iv.closed)
    assert rows_of(iv.read()) == expect
    iv.compact(9, "q")
    assert rows_of(iv.read()) == expect
    # A second stream into the same view, and a replay of a batch that is folded already.
    iv.apply_batch(rows.where(F.col("_part") == 9).drop("_part"), 9, "q")
    assert rows_of(iv.read()) == expect
    iv.apply_batch(r.where(F.col("SensorType") == "Humidity"), 0, "other")
    iv.compact(0, "other")
    twice = rows_of(v.compute(r.unionByName(r.where(F.col("SensorType") == "Humidity"))))
    assert rows_of(iv.read()) == twice


def test_view_without_bins_and_bins_without_time(spark, ctx, scratch):
    r = ctx.readings.withColumn("Timestamp", F.when(F.pmod("ReadingId", F.lit(5)) != 0, F.col("Timestamp")))
    total = ViewDef("total", "readings", None, ("SiteId",), (Agg("n", "count"),))
    for v in (total, VIEWS["mv_readings_daily"]):
        iv = IncrementalView(spark, v, f"{scratch}/{v.name}")
        for i in range(3):
            iv.apply_batch(r.where(F.pmod("ReadingId", F.lit(3)) == i), i, "q")
        iv.compact(1, "q")
        exact = lambda df: sorted(repr(tuple(round(x, 9) if isinstance(x, float) else x for x in row)) for row in df.collect())
        assert exact(iv.read()) == exact(v.compute(r))
    months = children(spark, f"{scratch}/mv_readings_daily/closed")
    assert {"bin_period=1970-01-01", "bin_period=2024-01-01"} == {m for m in months if "=" in m}


def test_latest_bin_reads_the_newest_period(spark, ctx, scratch):
    v = VIEWS["mv_readings_hourly"]
    iv = IncrementalView(spark, v, f"{scratch}/latest")
    with pytest.raises(ValueError):
        iv.latest()
    iv.backfill(ctx.readings)
    want = v.compute(ctx.readings).agg(F.max("Timestamp")).first()[0]
    one = spark.range(1)
    assert one.select(iv.latest()).first()[0] == want
    iv.compact(0, "backfill")
    iv.compact(0, "backfill")
    assert one.select(iv.latest()).first()[0] == want
    assert one.select(iv.latest(minus="24h")).first()[0] == want - dt.timedelta(days=1)


def test_replay_with_other_days_and_bad_names(spark, ctx, scratch):
    """A replay that holds other days leaves none of the first run's rows."""
    r = ctx.readings_plain.withColumn("event_date", F.to_date("Timestamp"))
    t = BatchTable(spark, f"{scratch}/days", ["event_date"])
    t.write(r.where("event_date < '2024-01-05'"), 0, "q")
    t.write(r.where("event_date >= '2024-01-20'"), 0, "q")
    assert t.days()[0] >= "2024-01-20" and t.read().count() == r.where("event_date >= '2024-01-20'").count()
    for bad in ("a/b", "12", "1e5", "2024-01-01", ""):
        if bad:
            with pytest.raises(ValueError):
                t.write(r, 0, bad)
    assert t.read(r.schema, ("2030-01-01", None)).count() == 0
    empty = BatchTable(spark, f"{scratch}/none", ["event_date"])
    empty.write(r.where("false"), 0, "q")
    assert empty.read(r.schema).count() == 0 and empty.days() == []


def test_recent_rows_of_many_batches_open_one_day(spark, scratch):
    """200 batches over 20 days: five minutes list and open the last day's files only."""
    rows = spark.range(0, 20_000).select("id", F.timestamp_seconds(F.col("id") * 86 + 1704067200).alias("Timestamp"))
    rows = rows.withColumn("event_date", F.to_date("Timestamp")).persist()
    t = BatchTable(spark, f"{scratch}/many", ["event_date"])
    # As 200 calls of write leave it, in one job.
    rows.withColumn("_source", F.lit("q")).withColumn("_batch", F.floor(F.col("id") / 100).cast("int")).repartition("_batch") \
        .write.partitionBy("event_date", "_source", "_batch").parquet(t.root)
    schema = rows.drop("event_date").schema
    recent = read_recent(spark, t.root, "5m", schema)
    files = recent.inputFiles()
    last = t.days()[-1]
    assert files and len({f.split("event_date=")[1][:10] for f in files}) <= 2 and any(f"event_date={last}" in f for f in files)
    assert len(files) < 30
    assert recent.count() == rows.where(F.col("Timestamp") > R.as_of_max(rows, minus="5m")).count() > 0
    assert "mergeSchema" not in recent._jdf.queryExecution().toString()


def test_keyless_rows_take_no_dedup_state(spark, ctx, scratch):
    readings = ctx.readings.limit(200).withColumn(
        "ReadingId", F.when(F.pmod("ReadingId", F.lit(2)) == 0, F.col("ReadingId"))).persist()
    write_files(spark, [r["value"] for r in to_events(readings).collect()], scratch, 2)
    ing = Ingest(schemas={READING_TABLE: ctx.readings.schema}, tables={READING_TABLE: f"{scratch}/t"},
                 dedup_key={READING_TABLE: "ReadingId"})
    q = run_once(ing.start(event_stream(spark, f"{scratch}/in/*", max_files_per_trigger=1), f"{scratch}/ck",
                           available_now=True, dedup_delay="1 day"))
    assert q.exception() is None
    keyed = readings.where("ReadingId is not null").count()
    assert max(s.numRowsTotal for p in q.recentProgress for s in p.stateOperators) == keyed
    assert read_table(spark, f"{scratch}/t").count() == 200 and ingest_progress(q)["ingest.events"] == 200


def test_totals_over_restarts(spark, ctx, scratch):
    schemas = {READING_TABLE: ctx.readings.schema, ALERT_TABLE: ctx.alerts.schema}
    ing = Ingest(schemas=schemas, totals=f"{scratch}/totals")
    for run in range(2):                                              # a second run goes on from the checkpoint
        lines = [r["value"] for r in to_events(ctx.readings.limit(30), ctx.alerts.limit(10)).collect()] + ["{bad"]
        write_files(spark, lines, f"{scratch}/{run}", 2)
        spark.read.text(f"{scratch}/{run}/in/*").coalesce(1).write.mode("append").text(f"{scratch}/all")
        run_once(ing.start(event_stream(spark, f"{scratch}/all"), f"{scratch}/ck", available_now=True))
    got = {r["destination"]: r["events"] for r in ingest_totals(spark, f"{scratch}/totals").collect()}
    assert got == {READING_TABLE: 60, ALERT_TABLE: 20, "quarantine": 2}


def test_late_rows_of_windows_are_kept_apart(spark, scratch):
    v = ViewDef("w", "readings", "15m", ("k",), (Agg("n", "count"),))
    view = IncrementalView(spark, v, f"{scratch}/w")
    handle = window_handler(view, f"{scratch}/late", "10 minutes")
    at = lambda *minutes: spark.createDataFrame(
        [(None if m is None else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), "a") for m in minutes], "Timestamp timestamp_ntz, k string")
    handle(at(0, 20), 0, "q")
    handle(at(9, 24, 50, None), 1, "q")          # watermark 0:10: window 0:00-0:15 is open
    handle(at(14, 29, 31), 2, "q")               # watermark 0:40: two windows have ended
    handle(at(14, 29, 31), 2, "q")               # replayed: the same watermark
    handle(at(44), 3, "q")                       # watermark 0:40
    handle(at(), 4, "q")
    handle(at(44, 60), 5, "q")                   # nothing since: 0:40 still
    windows = {(r["Timestamp"].hour * 60 + r["Timestamp"].minute): r["n"] for r in view.read().collect()}
    assert windows == {0: 2, 15: 2, 30: 3, 45: 1, 60: 1}
    late = read_table(spark, f"{scratch}/late").collect()
    assert sorted((r["Timestamp"].minute if r["Timestamp"] else -1, r["watermark"].minute) for r in late) == [
        (-1, 10), (14, 40), (29, 40)]


def test_rows_without_key_bypass_the_dedup(spark, ctx, scratch):
    from sensorium.streaming.ingest import one_of_each
    df = spark.createDataFrame([(1, "b"), (1, "a"), (None, "x"), (None, "x"), (2, None)], "k int, v string")
    assert sorted(map(str, one_of_each(df, "k").collect())) == sorted(map(str, spark.createDataFrame(
        [(1, "a"), (None, "x"), (None, "x"), (2, None)], "k int, v string").collect()))
    alerts = [r["value"] for r in to_events(alerts=ctx.alerts.limit(1)).collect()] * 3
    write_files(spark, alerts + ["{bad", "{bad"], scratch, 2)
    schemas = {READING_TABLE: ctx.readings.schema, ALERT_TABLE: ctx.alerts.schema}
    ing = Ingest(schemas=schemas, tables={t: f"{scratch}/t/{t}" for t in schemas}, quarantine=f"{scratch}/q",
                 dedup_key={READING_TABLE: "ReadingId"})
    run_once(ing.start(event_stream(spark, f"{scratch}/in/*", max_files_per_trigger=1), f"{scratch}/ck", available_now=True,
                       dedup_delay="10 minutes"))
    assert read_table(spark, f"{scratch}/t/{ALERT_TABLE}").count() == 3 and read_table(spark, f"{scratch}/q").count() == 2


def test_progress_over_many_batches(spark, ctx, scratch):
    """Totals and waiting cover all batches, also beyond those that a query remembers."""
    from sensorium.streaming.ingest import await_batches
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        write_files(spark, [r["value"] for r in to_events(ctx.readings.limit(80)).collect()], scratch, 8)
        ing = Ingest(schemas={READING_TABLE: ctx.readings.schema}, tables={READING_TABLE: f"{scratch}/t"})
        q = ing.start(event_stream(spark, f"{scratch}/in/*", max_files_per_trigger=1), f"{scratch}/ck", available_now=True)
        run_once(q)
        assert len(q.recentProgress) <= 3
        assert await_batches(q, 8, 30) and ingest_progress(q)["ingest.events"] == 80
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)


def test_batch_caps(spark):
    from sensorium.streaming.ingest import batch_cap
    assert batch_cap("kafka", None, 500) == {"maxOffsetsPerTrigger": 500} and batch_cap("text", 3, None) == {"maxFilesPerTrigger": 3}
    with pytest.raises(ValueError):
        batch_cap("kafka", 3, None)


def test_restart_after_failure_mid_batch(spark, ctx, scratch):
    """T5: batch 1 fails after some of its outputs were written; the query is
    restarted from its checkpoint, batch 1 runs again and overwrites its own
    partial output — the end state equals the batch answer exactly."""
    readings, alerts = ctx.readings, ctx.alerts
    lines = [r["value"] for r in to_events(readings, alerts).collect()]
    write_files(spark, lines, scratch, 4)
    schemas = {READING_TABLE: readings.schema, ALERT_TABLE: alerts.schema}
    view = IncrementalView(spark, VIEWS["mv_readings_daily"], f"{scratch}/view")
    state = {"failed": False}

    def flaky(df, batch_id, source):
        if batch_id == 1 and not state["failed"]:
            state["failed"] = True
            raise RuntimeError("simulated executor loss")

    def make():
        return Ingest(schemas=schemas, tables={t: f"{scratch}/tables/{t}" for t in schemas},
                      handlers={READING_TABLE: [view.attach(), flaky]})

    src = f"{scratch}/in/*"
    q = make().start(event_stream(spark, src, max_files_per_trigger=1),
                     checkpoint=f"{scratch}/ckpt", available_now=True)
    try:
        q.awaitTermination()
    except Exception:  # noqa: BLE001  (the simulated failure)
        pass
    assert state["failed"] and q.exception() is not None
    q2 = make().start(event_stream(spark, src, max_files_per_trigger=1),
                      checkpoint=f"{scratch}/ckpt", available_now=True)
    run_once(q2)
    assert q2.exception() is None
    assert {p.batchId for p in q2.recentProgress} >= {1}      # batch 1 ran again
    facts = read_table(spark, f"{scratch}/tables/{READING_TABLE}")
    assert facts.count() == readings.count()
    assert rows_of(view.read()) == rows_of(VIEWS["mv_readings_daily"].compute(readings))
