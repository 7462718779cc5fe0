"""The named queries of the survey (2.8), each ``(spark, sf_dir) -> DataFrame``.

Relative-time queries anchor "now" at their own table's latest timestamp
(a scalar subquery), so results are repeatable (N19).  ``top`` / ``take``
queries carry a tie-break key so the chosen row set is unique.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorium.functions.scalar import bin_time, pct, round_stable
from sensorium.operators import relational as R
from sensorium.plans.context import Ctx
from sensorium.operators.joins import MAX_SOURCE_BYTES, source_bytes
from sensorium.plans.views import VIEWS, Agg, ViewDef
from sensorium.sources import testdata as td
from sensorium.sources.stored import footer_time_range

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


_CONTEXTS: dict = {}


def context(spark: SparkSession, sf_dir: str) -> Ctx:
    """One context per (session, directory): its base DataFrames are lazy,
    immutable plans, so every query of the directory can share them."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _CONTEXTS:
        _CONTEXTS[key] = Ctx(spark, sf_dir)
    ctx = _CONTEXTS[key]
    ctx.pin_utc()
    return ctx


def query(name: str):
    def deco(fn: Callable[[Ctx], DataFrame]) -> Callable[[Ctx], DataFrame]:
        REGISTRY[name] = lambda spark, sf_dir, _fn=fn: _fn(context(spark, sf_dir))
        return fn
    return deco


# ---------------------------------------------------------------- views ----
LOCATION_KEYS = ("SiteId", "ZoneId")


def view(ctx: Ctx, name: str) -> DataFrame:
    """A view over its whole source.  The alert view needs each row's own
    threshold, so alerts are located row by row."""
    v = VIEWS[name]
    if v.source == "readings":
        return located(ctx, v)
    return v.compute(ctx.alerts)


def located(ctx: Ctx, v: ViewDef, readings: DataFrame | None = None) -> DataFrame:
    """A view of the readings by site or zone.  While the sensors' locations are
    broadcast, rows are located first and aggregated once: one shuffle, of bins
    by sites.  Else the rows are aggregated per sensor first, so that partial
    rows meet the dimension."""
    readings = ctx.readings_plain if readings is None else readings
    if source_bytes(td.sensor_locations(ctx.spark, ctx.sf_dir)) <= MAX_SOURCE_BYTES:
        return v.compute(ctx.locate(readings))
    return v.compute_located(readings, ctx.locate, LOCATION_KEYS)


_COUNT = Agg("n", "count")
_ANOM = Agg("a", "countif", lambda: F.col("IsAnomaly"))


for _name in VIEWS:
    query(_name)(lambda ctx, _n=_name: view(ctx, _n))


@query("mv_hourly_recent")
def mv_hourly_recent(ctx: Ctx) -> DataFrame:
    """Hourly view rows of the last 24 h, newest first."""
    lower = R.as_of_max(ctx.readings_plain, minus="24h")
    # A bin is never later than its rows, so rows up to the bound can't matter.
    hourly = located(ctx, VIEWS["mv_readings_hourly"], ctx.readings_plain.where(F.col("Timestamp") > lower))
    return hourly.where(F.col("Timestamp") > lower).orderBy(F.col("Timestamp").desc())


@query("mv_anomaly_over_5")
def mv_anomaly_over_5(ctx: Ctx) -> DataFrame:
    """Hours whose anomaly rate (added at read time, N4) is above 5 %."""
    v = view(ctx, "mv_anomaly_rate_hourly")
    rate = F.try_divide(F.col("AnomalyCount") * 100.0, F.col("TotalReadings").cast("double"))
    return (v.withColumn("AnomalyRate", rate).where(F.col("AnomalyRate") > 5)
            .orderBy(F.col("Timestamp").desc()))


@query("mv_alerts_by_site")
def mv_alerts_by_site(ctx: Ctx) -> DataFrame:
    """Rollup of a rollup: sum of AlertCount by SiteId."""
    return view(ctx, "mv_alerts_daily").groupBy("SiteId").agg(F.sum("AlertCount").alias("TotalAlerts"))


@query("view_lineitem_daily")
def view_lineitem_daily(ctx: Ctx) -> DataFrame:
    """The daily readings view over the largest table: line items as readings, by
    their shipping day and return flag, through mergeable partials."""
    rows = ctx.table("lineitem").select(
        F.col("l_shipdate").cast("timestamp_ntz").alias("Timestamp"), F.col("l_returnflag").alias("SensorType"),
        F.col("l_linestatus").alias("SiteId"), F.col("l_quantity").cast("double").alias("ReadingValue"),
        (F.col("l_quantity") > 45).alias("IsAnomaly"),
        F.when(F.col("l_quantity") > 25, F.lit("Good")).otherwise(F.lit("Suspect")).alias("QualityFlag"))
    v = VIEWS["mv_readings_daily"]
    return v.merge(v.partial(rows))


# ---------------------------------------------------------------- tiles ----
@query("tile_total_readings")
def tile_total_readings(ctx: Ctx) -> DataFrame:
    # One reading per stored row: footers know their number.
    return R.row_count(ctx.footers("events"))


@query("tile_anomaly_rate")
def tile_anomaly_rate(ctx: Ctx) -> DataFrame:
    agg = ctx.readings_plain.agg(F.count(F.lit(1)).alias("Total"),
                                 F.count_if(F.col("IsAnomaly")).alias("Anomalies"))
    return agg.select(pct("Anomalies", "Total", 2, scale_first=False).alias("AnomalyRate"))


@query("tile_total_alerts")
def tile_total_alerts(ctx: Ctx) -> DataFrame:
    return R.row_count(ctx.footers("orders"))


@query("tile_readings_15m")
def tile_readings_15m(ctx: Ctx) -> DataFrame:
    return (ctx.readings_plain
            .groupBy(bin_time("Timestamp", "15m").alias("Timestamp"), "SensorType")
            .agg(round_stable(F.avg("ReadingValue"), 2).alias("AvgValue"))
            .orderBy(F.col("Timestamp").asc()))


@query("tile_alerts_by_severity")
def tile_alerts_by_severity(ctx: Ctx) -> DataFrame:
    return R.count_by(ctx.alerts_plain, "Severity", name="Count").orderBy(F.col("Count").desc())


def _per_sensor_alerts(ctx: Ctx, alerts: DataFrame) -> DataFrame:
    """Alert count and value sum per sensor, then the sensor's type: the
    dimension lookup sees one row per sensor, not one per alert."""
    g = alerts.groupBy("SensorId").agg(F.count(F.lit(1)).alias("AlertCount"),
                                       F.sum("ReadingValue").alias("_s"),
                                       F.count("ReadingValue").alias("_c"))
    from sensorium.sources.testdata import locate
    return locate(g, ctx.spark, ctx.sf_dir, with_type=True).withColumnRenamed("_stype", "SensorType")


@query("tile_top10_sensors")
def tile_top10_sensors(ctx: Ctx) -> DataFrame:
    g = _per_sensor_alerts(ctx, ctx.alerts_plain).select(
        "SensorId", "SensorType", "AlertCount",
        round_stable(F.try_divide(F.col("_s"), F.col("_c").cast("double")), 2).alias("AvgReading"))
    return R.top_n(g, 10, "AlertCount", tie_break=["SensorId", "SensorType"])


@query("tile_anomaly_rate_by_site")
def tile_anomaly_rate_by_site(ctx: Ctx) -> DataFrame:
    g = located(ctx, ViewDef("by_site", "readings", None, ("SiteId",), (_COUNT, _ANOM)))
    return (g.select("SiteId", pct("a", "n", 2, scale_first=False).alias("AnomalyRate"))
            .orderBy(F.col("AnomalyRate").desc()))


@query("tile_readings_by_type_site")
def tile_readings_by_type_site(ctx: Ctx) -> DataFrame:
    g = located(ctx, ViewDef("by_type_site", "readings", None, ("SiteId", "SensorType"),
                             (Agg("Count", "count"),)))
    return g.orderBy(F.col("SiteId").asc(), F.col("SensorType").asc())


def alert_tile(ctx: Ctx, newest: DataFrame) -> DataFrame:
    """The tile of the 50 newest alerts; only these are looked up in the dimensions."""
    cols = ["Timestamp", "SiteId", "SensorType", "Severity", "AlertType", "ReadingValue",
            "ThresholdValue", "Message", "AlertId"]
    return R.latest(td.enrich_alerts(newest, ctx.spark, ctx.sf_dir).select(*cols), 50, tie_break=["AlertId"])


@query("tile_latest50_alerts")
def tile_latest50_alerts(ctx: Ctx) -> DataFrame:
    return alert_tile(ctx, R.latest(ctx.alerts_plain, 50, tie_break=["AlertId"]))


_AVG_TILES = [("Temperature", "AvgTemp", 1), ("Humidity", "AvgHumidity", 1),
              ("Pressure", "AvgPressure", 1), ("CO2", "AvgCO2", 1),
              ("Vibration", "AvgVibration", 2)]


def _avg_tile(ctx: Ctx, stype: str, name: str, digits: int) -> DataFrame:
    return (ctx.readings_plain.where(F.col("SensorType") == stype)
            .agg(round_stable(F.avg("ReadingValue"), digits).alias(name)))


for _t, _n, _d in _AVG_TILES:
    query(f"tile_avg_{_t.lower()}")(lambda ctx, _t=_t, _n=_n, _d=_d: _avg_tile(ctx, _t, _n, _d))


# ------------------------------------------------------------- ad-hoc ------
@query("live_count_5m")
def live_count_5m(ctx: Ctx) -> DataFrame:
    r = ctx.readings_plain
    return R.row_count(R.since(r, "5m", as_of="max"))


@query("anomaly_rate_1h")
def anomaly_rate_1h(ctx: Ctx) -> DataFrame:
    r = ctx.readings_plain
    g = R.since(r, "1h", as_of="max").agg(
        F.count(F.lit(1)).alias("TotalReadings"), F.count_if(F.col("IsAnomaly")).alias("Anomalies"))
    return g.withColumn("AnomalyRate", pct("Anomalies", "TotalReadings", 2))


@query("temp_by_site_1m")
def temp_by_site_1m(ctx: Ctx) -> DataFrame:
    r = ctx.readings_plain
    # The hour ends with the latest reading of any type.
    recent = r.where((F.col("Timestamp") > R.as_of_max(r, minus="1h")) & (F.col("SensorType") == "Temperature"))
    v = ViewDef("temp_1m", "readings", "1m", ("SiteId",),
                (Agg("AvgTemp", "avg", lambda: F.col("ReadingValue")),))
    return located(ctx, v, recent)


@query("alerts_severity_30m")
def alerts_severity_30m(ctx: Ctx) -> DataFrame:
    a = ctx.alerts_plain
    return R.count_by(R.since(a, "30m", as_of="max"), "Severity", name="AlertCount")


@query("top_sensors_1h")
def top_sensors_1h(ctx: Ctx) -> DataFrame:
    a = ctx.alerts_plain
    g = _per_sensor_alerts(ctx, R.since(a, "1h", as_of="max")).select(
        "SensorId", "SensorType", "AlertCount")
    return R.top_n(g, 10, "AlertCount", tie_break=["SensorId", "SensorType"])


@query("temp_by_zone_1h")
def temp_by_zone_1h(ctx: Ctx) -> DataFrame:
    r = ctx.readings_plain
    recent = R.since(r, "1h", as_of="max").where(F.col("SensorType") == "Temperature")
    v = ViewDef("temp_zone", "readings", None, ("ZoneId",),
                (Agg("AvgValue", "avg", lambda: F.col("ReadingValue")),))
    return located(ctx, v, recent)


@query("diag_time_range")
def diag_time_range(ctx: Ctx) -> DataFrame:
    return footer_time_range(ctx.spark, f"{ctx.sf_dir}/events.parquet", "ts", "Timestamp")


@query("diag_by_site")
def diag_by_site(ctx: Ctx) -> DataFrame:
    g = located(ctx, ViewDef("diag_site", "readings", None, ("SiteId",), (Agg("count_", "count"),)))
    return g.orderBy(F.col("count_").desc())


@query("diag_by_type")
def diag_by_type(ctx: Ctx) -> DataFrame:
    return R.count_by(ctx.readings_plain, "SensorType").orderBy(F.col("count_").desc())


@query("diag_alerts_severity")
def diag_alerts_severity(ctx: Ctx) -> DataFrame:
    return R.count_by(ctx.alerts_plain, "Severity")


@query("check_anomaly_overall")
def check_anomaly_overall(ctx: Ctx) -> DataFrame:
    g = ctx.readings_plain.agg(F.count(F.lit(1)).alias("total"),
                               F.count_if(F.col("IsAnomaly")).alias("anomalies"))
    return g.withColumn("rate", pct("anomalies", "total", 1))


@query("check_anomaly_by_type")
def check_anomaly_by_type(ctx: Ctx) -> DataFrame:
    g = ctx.readings_plain.groupBy("SensorType").agg(
        F.count(F.lit(1)).alias("Total"), F.count_if(F.col("IsAnomaly")).alias("Anomalies"))
    return g.withColumn("AnomalyPct", pct("Anomalies", "Total", 1)).orderBy(F.col("AnomalyPct").desc())


@query("check_latest5")
def check_latest5(ctx: Ctx) -> DataFrame:
    newest = R.latest(ctx.readings_plain, 5, tie_break=["ReadingId"])
    cols = ["ReadingId", "SensorId", "ZoneId", "SiteId", "Timestamp", "SensorType",
            "ReadingValue", "Unit", "IsAnomaly", "QualityFlag"]
    return R.latest(ctx.locate(newest).select(*cols), 5, tie_break=["ReadingId"])
