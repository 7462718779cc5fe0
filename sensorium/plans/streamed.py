"""Streaming end states as named queries: the test tables are encoded as a
JSON event stream (or CSV files), ingested by ``availableNow`` queries in several
micro-batches, routed, and folded into incremental views.  The result must
equal the batch answer (stream = batch)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorium.plans.context import Ctx
from sensorium.plans.derived import ALERTS_SQL
from sensorium.functions.scalar import pct, round_stable
from sensorium.operators import relational as R
from sensorium.operators.model import ALL_MEASURES
from sensorium.plans.oracle import ORACLE, VIEW_SQL, with_base
from sensorium.plans.queries import alert_tile, query
from sensorium.plans.semantic import SITE, fs_temp_by_site
from sensorium.plans.views import VIEWS, Agg, ViewDef
from sensorium.session import remove_path, scratch_path
from sensorium.sources.dimensions import VersionedDimension, join_bucketed
from sensorium.sources.stored import latest_stored
from sensorium.sources import tables as TB
from sensorium.streaming.batchlog import BatchTable, children
from sensorium.streaming.incremental import PERIOD, IncrementalView
from sensorium.streaming.ingest import (
    ALERT_TABLE, READING_TABLE, Ingest, alert_handler, append_history, await_batches, csv_stream, event_stream,
    ingest_totals, locate_handler, read_recent, read_refreshed, read_table, refresh_tables, run_for, run_once,
    to_events, window_handler,
)

BATCHES = 3
WINDOWS_15M = ViewDef("windows_15m", "readings", "15m", ("SensorType",), (
    Agg("Readings", "count"), Agg("MaxValue", "max", lambda: F.col("ReadingValue"))))


def files_per_trigger(ctx: Ctx, path: str, batches: int = BATCHES) -> int:
    """Files per micro-batch, so that the input makes about ``batches`` of any size."""
    files = [n for n in children(ctx.spark, path) if not n.startswith(("_", "."))]
    return max(1, -(-len(files) // batches))


def drained(q: StreamingQuery) -> None:
    run_once(q)
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def run_events(ctx: Ctx, events: DataFrame, ingest: Ingest, root: str, name: str = "in", **start) -> None:
    """Write ``events`` as files and stream them through ``ingest``; the files and the
    checkpoint go when it is done."""
    events.write.mode("overwrite").text(f"{root}/{name}")
    stream = event_stream(ctx.spark, f"{root}/{name}", max_files_per_trigger=files_per_trigger(ctx, f"{root}/{name}"))
    drained(ingest.start(stream, checkpoint=f"{root}/checkpoint-{name}", available_now=True, **start))
    for path in (f"{root}/{name}", f"{root}/checkpoint-{name}"):
        remove_path(ctx.spark, path)


def model_ingest(ctx: Ctx, root: str, **options) -> Ingest:
    schemas = {READING_TABLE: ctx.readings.schema, ALERT_TABLE: ctx.alerts.schema}
    return Ingest(schemas=schemas, tables={t: f"{root}/tables/{t}" for t in schemas}, quarantine=f"{root}/quarantine",
                  partition_by={READING_TABLE: ["event_date"]}, parallel_writes=4, **options)


def run_ingest(ctx: Ctx, views: dict[str, str]) -> dict:
    """Stream readings and alerts as events into fact tables and the given
    incremental views ({view name: fact table})."""
    root = scratch_path(ctx.spark, "ingest")
    inc = {v: IncrementalView(ctx.spark, VIEWS[v], f"{root}/views/{v}") for v in views}
    handlers: dict = {}
    for v, table in views.items():
        handlers.setdefault(table, []).append(inc[v].attach(every_compact=2))
    run_events(ctx, to_events(ctx.readings, ctx.alerts), model_ingest(ctx, root, handlers=handlers), root)
    return {"root": root, "views": inc}


@query("stream_views_daily")
def stream_views_daily(ctx: Ctx) -> DataFrame:
    return run_ingest(ctx, {"mv_readings_daily": READING_TABLE})["views"]["mv_readings_daily"].read()


@query("stream_alerts_daily")
def stream_alerts_daily(ctx: Ctx) -> DataFrame:
    return run_ingest(ctx, {"mv_alerts_daily": ALERT_TABLE})["views"]["mv_alerts_daily"].read()


@query("stream_route_counts")
def stream_route_counts(ctx: Ctx) -> DataFrame:
    root = run_ingest(ctx, {})["root"]
    parts = [read_table(ctx.spark, f"{root}/tables/{t}")
             .agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "*")
             for t in (READING_TABLE, ALERT_TABLE)]
    return parts[0].unionByName(parts[1])


@query("stream_live_alerts")
def stream_live_alerts(ctx: Ctx) -> DataFrame:
    """Alerts derived from each micro-batch of readings."""
    root = scratch_path(ctx.spark, "live")
    ingest = Ingest(schemas={READING_TABLE: ctx.readings.schema},
                    handlers={READING_TABLE: [alert_handler(ctx.thresholds, f"{root}/alerts", by="type")]})
    run_events(ctx, to_events(ctx.readings), ingest, root)
    return read_table(ctx.spark, f"{root}/alerts")


@query("stream_quarantine")
def stream_quarantine(ctx: Ctx) -> DataFrame:
    """S13 with bad input: of ten events one has a bad timestamp and value, one an
    unknown table and one is cut off; each row says where events went and why."""
    root = scratch_path(ctx.spark, "quarantine")
    events = to_events(ctx.readings).withColumn("n", F.get_json_object("value", "$.ReadingId").cast("long"))
    kind = F.pmod("n", F.lit(10))
    stamp = F.regexp_replace("value", '"Timestamp":"[^"]*"', '"Timestamp":"garbage"')
    value = F.when(kind == 3, F.regexp_replace(stamp, '"ReadingValue":[^,]*', '"ReadingValue":"x"')) \
        .when(kind == 5, F.replace("value", F.lit('"SensorReading"'), F.lit('"Unheard"'))) \
        .when(kind == 7, F.substring("value", 1, 12)).otherwise(F.col("value"))
    ingest = model_ingest(ctx, root)
    run_events(ctx, events.select(value.alias("value")), ingest, root)
    kept = read_table(ctx.spark, f"{root}/tables/{READING_TABLE}").select(F.lit(READING_TABLE).alias("destination"),
                                                                         F.lit("").alias("reason"))
    bad = read_table(ctx.spark, f"{root}/quarantine").select(F.lit("quarantine").alias("destination"), "reason")
    return kept.unionByName(bad).groupBy("destination", "reason").agg(F.count(F.lit(1)).alias("row_count"))


@query("stream_dedup_replay")
def stream_dedup_replay(ctx: Ctx) -> DataFrame:
    """Redelivered events: a quarter comes twice, and a ninth has no id, of which
    all must stay."""
    root = scratch_path(ctx.spark, "dedup")
    readings = ctx.readings.withColumn("ReadingId", F.when(F.pmod("ReadingId", F.lit(9)) != 0, F.col("ReadingId")))
    again = ctx.readings.where(F.pmod("ReadingId", F.lit(4)) == 0).withColumn(
        "ReadingId", F.when(F.pmod("ReadingId", F.lit(9)) != 0, F.col("ReadingId")))
    ingest = model_ingest(ctx, root, dedup_key={READING_TABLE: "ReadingId"})
    run_events(ctx, to_events(readings.unionByName(again)), ingest, root, dedup_delay="1 day")
    return read_table(ctx.spark, f"{root}/tables/{READING_TABLE}").groupBy(
        F.col("ReadingId").isNotNull().alias("has_id")).agg(F.count(F.lit(1)).alias("row_count"))


@query("stream_restart_new_checkpoint")
def stream_restart_new_checkpoint(ctx: Ctx) -> DataFrame:
    """One table written by a stream, by a second stream with a checkpoint of its own
    (whose batch ids start at 0 again), and by a batch of history (S11, S15)."""
    root = scratch_path(ctx.spark, "restart")
    ingest, table = model_ingest(ctx, root), f"{root}/tables/{READING_TABLE}"
    third = F.pmod("ReadingId", F.lit(3))
    run_events(ctx, to_events(ctx.readings.where(third == 0)), ingest, root, "first")
    run_events(ctx, to_events(ctx.readings.where(third == 1)), ingest, root, "second")
    append_history(ctx.readings.where(third == 2), table, "third", ["event_date"])
    return read_table(ctx.spark, table).groupBy("SensorType").agg(
        F.count(F.lit(1)).alias("Readings"), F.count_distinct("ReadingId").alias("Ids"),
        F.max("ReadingValue").alias("MaxValue"))


@query("csv_stream_readings")
def csv_stream_readings(ctx: Ctx) -> DataFrame:
    """Readings as CSV files (with quotes in a text), streamed into a table."""
    root = scratch_path(ctx.spark, "csv")
    rows = ctx.readings_plain.withColumn("Note", F.concat(F.lit('a "'), "SensorType", F.lit('", b')))
    rows.withColumn("Timestamp", F.date_format("Timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")).write.option(
        "quote", '"').option("escape", '"').csv(f"{root}/in")
    stream = csv_stream(ctx.spark, f"{root}/in", rows.schema, files_per_trigger(ctx, f"{root}/in"))
    q = stream.writeStream.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True) \
        .format("parquet").start(f"{root}/table")
    drained(q)
    return ctx.spark.read.parquet(f"{root}/table").select("ReadingId", "SensorId", "Timestamp", "SensorType",
                                                          "ReadingValue", "IsAnomaly", "QualityFlag", "Note")


@query("append_batch_readings")
def append_batch_readings(ctx: Ctx) -> DataFrame:
    """A table appended to in two batches."""
    root = scratch_path(ctx.spark, "append")
    good = F.col("QualityFlag").eqNullSafe("Good")
    for part in (ctx.readings_plain.where(good), ctx.readings_plain.where(~good)):
        TB.append_batch(part, f"{root}/table", chunk_rows=5000)
    return ctx.spark.read.parquet(f"{root}/table").groupBy("QualityFlag", "SensorType").agg(
        F.count(F.lit(1)).alias("Readings"))


@query("stream_windowed_15m")
def stream_windowed_15m(ctx: Ctx) -> DataFrame:
    """Tumbling windows with a watermark.  Files come in any order, so many rows are late;
    on-time rows are in the windows and late ones in a table of their own, each row in one."""
    root = scratch_path(ctx.spark, "windowed")
    view = IncrementalView(ctx.spark, WINDOWS_15M, f"{root}/windows")
    ingest = Ingest(schemas={READING_TABLE: ctx.readings_plain.schema},
                    handlers={READING_TABLE: [window_handler(view, f"{root}/late", "10 minutes")]})
    run_events(ctx, to_events(ctx.readings_plain), ingest, root)
    late = read_table(ctx.spark, f"{root}/late", ctx.readings_plain.schema)
    return WINDOWS_15M.merge(view.partials().drop(PERIOD).unionByName(WINDOWS_15M.partial(late)))


@query("stream_totals_restart")
def stream_totals_restart(ctx: Ctx) -> DataFrame:
    """A stream fails in its second batch and is started again; totals per destination
    are those of all batches, each counted once."""
    root = scratch_path(ctx.spark, "totals")
    failed = []

    def fail_once(rows: DataFrame, batch_id: int, source: str) -> None:
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("a failure on purpose")

    ingest = model_ingest(ctx, root, totals=f"{root}/totals", handlers={READING_TABLE: [fail_once]})
    to_events(ctx.readings, ctx.alerts).write.mode("overwrite").text(f"{root}/in")
    for _ in range(2):
        stream = event_stream(ctx.spark, f"{root}/in", max_files_per_trigger=files_per_trigger(ctx, f"{root}/in"))
        q = ingest.start(stream, checkpoint=f"{root}/checkpoint", available_now=True)
        try:
            drained(q)
        except Exception:
            if "a failure on purpose" not in str(q.exception()):
                raise
    return ingest_totals(ctx.spark, f"{root}/totals").select("destination", "events")


@query("stream_timed_then_drained")
def stream_timed_then_drained(ctx: Ctx) -> DataFrame:
    """A query with a micro-batch each second runs for three seconds and is stopped, wherever it
    is; a second one goes on from its checkpoint and takes the rest.  Nothing is lost or twice."""
    root = scratch_path(ctx.spark, "timed")
    ingest = model_ingest(ctx, root)
    to_events(ctx.readings, ctx.alerts).write.mode("overwrite").text(f"{root}/in")
    stream = lambda: event_stream(ctx.spark, f"{root}/in", max_files_per_trigger=files_per_trigger(ctx, f"{root}/in"))
    run_for(ingest.start(stream(), f"{root}/checkpoint", trigger="1 second"), 3)
    drained(ingest.start(stream(), f"{root}/checkpoint", available_now=True))
    return TB.table_counts({t: read_table(ctx.spark, f"{root}/tables/{t}", ingest.schemas[t]) for t in ingest.tables})


@query("refreshed_tiles")
def refreshed_tiles(ctx: Ctx) -> DataFrame:
    """Tile results kept in tables by a timer, each computed from the stored partials.  The timer is
    stopped after its first round."""
    root = scratch_path(ctx.spark, "tiles")
    total = ViewDef("total", "readings", None, ("SiteId",), (_COUNT,))
    tiles = {"anomaly_rate": lambda: lattice_tile_anomaly_rate_by_site(ctx), "readings": lambda: ctx.lattice.answer(total)}
    q = refresh_tables(ctx.spark, tiles, f"{root}/out", f"{root}/checkpoint", every="1 minute")
    try:
        if not await_batches(q, 1):
            raise RuntimeError(str(q.exception()))
    finally:
        q.stop()
    rate, readings = (read_refreshed(ctx.spark, f"{root}/out", name) for name in tiles)
    return rate.join(readings.withColumnsRenamed({"SiteId": "_site", "n": "Readings"}),
                     F.col("SiteId").eqNullSafe(F.col("_site"))).drop("_site")


@query("retention_stream_table")
def retention_stream_table(ctx: Ctx) -> DataFrame:
    """S20 as storage: a table that ingest wrote, after its days of more than a week before
    the last one were dropped."""
    root = scratch_path(ctx.spark, "retention")
    run_events(ctx, to_events(ctx.readings), model_ingest(ctx, root), root)
    table = f"{root}/tables/{READING_TABLE}"
    TB.drop_expired(ctx.spark, table, 7, BatchTable(ctx.spark, table).days()[-1])
    return read_table(ctx.spark, table, ctx.readings.schema).groupBy(F.to_date("Timestamp").alias("Day")).agg(
        F.count(F.lit(1)).alias("Readings"))


@query("stream_changing_sensors")
def stream_changing_sensors(ctx: Ctx) -> DataFrame:
    """J2 with a dimension that is replaced between two runs of a stream: the second half of the
    readings finds each sensor in the next zone."""
    root = scratch_path(ctx.spark, "changing")
    dimension = VersionedDimension(ctx.spark, f"{root}/sensors")
    sensors = ctx.sensors.select("sensor_id", F.col("zone_id").alias("ZoneId"))
    readings, odd = ctx.readings_plain, F.pmod("ReadingId", F.lit(2))
    ingest = Ingest(schemas={READING_TABLE: readings.schema},
                    handlers={READING_TABLE: [locate_handler(dimension, f"{root}/located")]})
    for half, zone in enumerate((F.col("ZoneId"), F.pmod(F.col("ZoneId") + 1, F.lit(25)))):
        dimension.write(sensors.withColumn("ZoneId", zone))
        run_events(ctx, to_events(readings.where(odd == half)), ingest, root, f"half{half}")
    return read_table(ctx.spark, f"{root}/located").groupBy("ZoneId").agg(F.count(F.lit(1)).alias("Readings"))


@query("bucketed_readings_by_zone")
def bucketed_readings_by_zone(ctx: Ctx) -> DataFrame:
    """J1 and J2 beyond the broadcast bound: readings and sensors stored by buckets of the sensor."""
    readings, sensors = ctx.bucketed()
    located = join_bucketed(readings, sensors, "SensorId", "sensor_id")
    return located.groupBy("zone_id", "SensorType").agg(F.count(F.lit(1)).alias("Readings"), F.max("ReadingValue").alias("MaxValue"))


# ------------------------------------------------- serving a stored view ----
@query("mv_served_hourly_recent")
def mv_served_hourly_recent(ctx: Ctx) -> DataFrame:
    """The "last 24 h, newest first" query over the stored hourly view.  Bins after the latest
    bin less a day are those after the latest reading less a day: the view alone is read."""
    store = ctx.stored_view("mv_readings_hourly")
    lower = store.latest(minus="24h")
    recent = store.read(days=(lower, None))
    return recent.where(F.col("Timestamp") > lower).orderBy(F.col("Timestamp").desc())


@query("mv_served_anomaly_over_5")
def mv_served_anomaly_over_5(ctx: Ctx) -> DataFrame:
    rate = F.try_divide(F.col("AnomalyCount") * 100.0, F.col("TotalReadings").cast("double"))
    return (ctx.stored_view("mv_anomaly_rate_hourly").read().withColumn("AnomalyRate", rate)
            .where(F.col("AnomalyRate") > 5).orderBy(F.col("Timestamp").desc()))


@query("mv_served_alerts_by_site")
def mv_served_alerts_by_site(ctx: Ctx) -> DataFrame:
    return ctx.stored_view("mv_alerts_daily").read().groupBy("SiteId").agg(F.sum("AlertCount").alias("TotalAlerts"))


# ---------------------------------------- one store of hourly partials ------
_FOLDED = ("mv_readings_hourly", "mv_readings_daily", "mv_quality_daily", "mv_anomaly_rate_hourly")
for _name in _FOLDED:
    query(f"lattice_{_name}")(lambda ctx, _n=_name: ctx.lattice.answer(VIEWS[_n]))

_COUNT = Agg("n", "count")
_ANOMALIES = Agg("a", "countif", VIEWS["mv_anomaly_rate_hourly"].aggs[1].expr)
_VALUE = Agg("v", "avg", VIEWS["mv_readings_hourly"].aggs[1].expr)


@query("lattice_tile_anomaly_rate_by_site")
def lattice_tile_anomaly_rate_by_site(ctx: Ctx) -> DataFrame:
    g = ctx.lattice.answer(ViewDef("by_site", "readings", None, ("SiteId",), (_COUNT, _ANOMALIES)))
    return g.select("SiteId", pct("a", "n", 2, scale_first=False).alias("AnomalyRate")).orderBy(F.col("AnomalyRate").desc())


@query("lattice_tile_readings_by_type_site")
def lattice_tile_readings_by_type_site(ctx: Ctx) -> DataFrame:
    g = ctx.lattice.answer(ViewDef("by_type_site", "readings", None, ("SiteId", "SensorType"), (_COUNT,)))
    return g.withColumnRenamed("n", "Count").orderBy(F.col("SiteId").asc(), F.col("SensorType").asc())


@query("lattice_tile_avg_temperature")
def lattice_tile_avg_temperature(ctx: Ctx) -> DataFrame:
    g = ctx.lattice.answer(ViewDef("avg", "readings", None, (), (_VALUE,)), filters={"SensorType": "Temperature"})
    return g.select(round_stable("v", 1).alias("AvgTemp"))


# ------------------------------- measures from partials by sensor and day ----
@query("stored_fs_rate_by_site")
def stored_fs_rate_by_site(ctx: Ctx) -> DataFrame:
    return ctx.stored_model.query([SITE], ["Total Readings", "Anomaly Rate", "Total Alerts", "Alert Rate"])


@query("stored_measures_overview")
def stored_measures_overview(ctx: Ctx) -> DataFrame:
    return ctx.stored_model.query([], ALL_MEASURES)


@query("clustered_fs_temp_by_site")
def clustered_fs_temp_by_site(ctx: Ctx) -> DataFrame:
    """P10 over readings clustered by sensor: the filter on the sensors' type reaches the scan as
    ranges of sensor ids."""
    return fs_temp_by_site(ctx, ctx.clustered_model)


# --------------------------------------------- tables stored by day folders ----
@query("stored_latest5_readings")
def stored_latest5_readings(ctx: Ctx) -> DataFrame:
    """The five latest readings of a stored table: the newest day alone is read."""
    newest = latest_stored(ctx.stored_facts("readings"), 5, tie_break=["ReadingId"], schema=ctx.readings_plain.schema)
    cols = ["ReadingId", "SensorId", "ZoneId", "SiteId", "Timestamp", "SensorType",
            "ReadingValue", "Unit", "IsAnomaly", "QualityFlag"]
    return R.latest(ctx.locate(newest).select(*cols), 5, tie_break=["ReadingId"])


@query("stored_latest50_alerts")
def stored_latest50_alerts(ctx: Ctx) -> DataFrame:
    newest = latest_stored(ctx.stored_facts("alerts"), 50, tie_break=["AlertId"], schema=ctx.alerts_plain.schema)
    return alert_tile(ctx, newest.drop("event_month"))


@query("stored_live_count_5m")
def stored_live_count_5m(ctx: Ctx) -> DataFrame:
    """The last five minutes of a stored table: its newest days are listed and opened."""
    return R.row_count(read_recent(ctx.spark, ctx.stored_facts("readings").root, "5m", ctx.readings_plain.schema))


ORACLE.update({
    "mv_served_hourly_recent": ORACLE["mv_hourly_recent"],
    "mv_served_anomaly_over_5": ORACLE["mv_anomaly_over_5"],
    "mv_served_alerts_by_site": ORACLE["mv_alerts_by_site"],
    **{f"lattice_{n}": ORACLE[n] for n in _FOLDED},
    "lattice_tile_anomaly_rate_by_site": ORACLE["tile_anomaly_rate_by_site"],
    "lattice_tile_readings_by_type_site": ORACLE["tile_readings_by_type_site"],
    "lattice_tile_avg_temperature": ORACLE["tile_avg_temperature"],
    "stored_fs_rate_by_site": ORACLE["fs_rate_by_site"],
    "stored_measures_overview": ORACLE["measures_overview"],
    "clustered_fs_temp_by_site": ORACLE["fs_temp_by_site"],
    "stored_latest5_readings": ORACLE["check_latest5"],
    "stored_latest50_alerts": ORACLE["tile_latest50_alerts"],
    "stored_live_count_5m": ORACLE["live_count_5m"],
    "stream_changing_sensors": with_base(
        """SELECT CASE WHEN ReadingId % 2 = 0 THEN ZoneId ELSE (ZoneId + 1) % 25 END AS ZoneId, count(*) AS Readings
           FROM readings GROUP BY 1"""),
    "bucketed_readings_by_zone": with_base(
        """SELECT ZoneId AS zone_id, SensorType, count(*) AS Readings, max(ReadingValue) AS MaxValue
           FROM readings GROUP BY 1, 2"""),
    "stream_windowed_15m": with_base(
        """SELECT time_bucket(INTERVAL '15 minutes', "Timestamp") AS "Timestamp", SensorType, count(*) AS Readings,
                  max(ReadingValue) AS MaxValue FROM readings GROUP BY 1, 2"""),
    "stream_timed_then_drained": with_base(
        """SELECT 'SensorReading' AS table_name, count(*) AS row_count FROM readings
           UNION ALL SELECT 'SensorAlert', count(*) FROM alerts"""),
    "refreshed_tiles": f"""SELECT t.*, n."Readings" FROM ({ORACLE["tile_anomaly_rate_by_site"]}) t
        JOIN ({with_base('SELECT SiteId, count(*) AS "Readings" FROM readings GROUP BY SiteId')}) n
        ON t.SiteId IS NOT DISTINCT FROM n.SiteId""",
    "stream_totals_restart": with_base(
        """SELECT 'SensorReading' AS destination, count(*) AS events FROM readings
           UNION ALL SELECT 'SensorAlert', count(*) FROM alerts UNION ALL SELECT 'quarantine', 0"""),
    "retention_stream_table": with_base(
        """SELECT CAST("Timestamp" AS DATE) AS Day, count(*) AS Readings FROM readings
           WHERE CAST("Timestamp" AS DATE) >= (SELECT CAST(max("Timestamp") AS DATE) - 7 FROM readings) GROUP BY 1"""),
    "stream_views_daily": with_base(VIEW_SQL["mv_readings_daily"]),
    "stream_alerts_daily": with_base(VIEW_SQL["mv_alerts_daily"]),
    "stream_live_alerts": with_base(ALERTS_SQL),
    "stream_route_counts": with_base(
        """SELECT 'SensorReading' AS table_name, count(*) AS row_count FROM readings
           UNION ALL SELECT 'SensorAlert', count(*) FROM alerts"""),
    "stream_quarantine": with_base(
        """SELECT CASE WHEN ReadingId % 10 IN (3, 5, 7) THEN 'quarantine' ELSE 'SensorReading' END AS destination,
                  CASE ReadingId % 10 WHEN 3 THEN 'does not convert: Timestamp, ReadingValue'
                       WHEN 5 THEN 'unknown table' WHEN 7 THEN 'no table' ELSE '' END AS reason,
                  count(*) AS row_count
           FROM readings GROUP BY 1, 2"""),
    "stream_dedup_replay": with_base(
        """SELECT ReadingId % 9 <> 0 AS has_id,
                  CAST(sum(CASE WHEN ReadingId % 9 = 0 AND ReadingId % 4 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS row_count
           FROM readings GROUP BY 1"""),
    "stream_restart_new_checkpoint": with_base(
        """SELECT SensorType, count(*) AS Readings, count(DISTINCT ReadingId) AS Ids, max(ReadingValue) AS MaxValue
           FROM readings GROUP BY SensorType"""),
    "csv_stream_readings": with_base(
        """SELECT ReadingId, SensorId, "Timestamp", SensorType, ReadingValue, IsAnomaly, QualityFlag,
                  'a "' || SensorType || '", b' AS Note FROM readings"""),
    "append_batch_readings": with_base(
        "SELECT QualityFlag, SensorType, count(*) AS Readings FROM readings GROUP BY 1, 2"),
})
