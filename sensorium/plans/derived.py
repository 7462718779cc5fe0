"""Derived-data queries: alert rules over the readings, expected values,
quality and range bands, hierarchy build, table management checks."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorium.functions.scalar import round_stable
from sensorium.operators import alerts as A
from sensorium.operators import relational as R
from sensorium.operators.hierarchy import build_hierarchy, count_ids, deal_sites, hierarchy_tasks
from sensorium.plans.context import Ctx
from sensorium.plans.oracle import ORACLE, rnd, thr, with_base
from sensorium.plans.queries import query
from sensorium.schemas import ZONE_TYPES
from sensorium.sources import tables as TB


@query("alerts_derived")
def alerts_derived(ctx: Ctx) -> DataFrame:
    """A1–A6 over every reading, thresholds by the reading's sensor type."""
    return A.derive_alerts(ctx.readings, ctx.thresholds, by="type")


@query("alerts_derived_by_sensor")
def alerts_derived_by_sensor(ctx: Ctx) -> DataFrame:
    """J3 as written: each anomalous reading judged by its own sensor's
    thresholds (dim_sensors on SensorId); the message names the sensor's type."""
    return A.derive_alerts(ctx.readings, ctx.sensors, by="sensor")


@query("alerts_derived_summary")
def alerts_derived_summary(ctx: Ctx) -> DataFrame:
    d = A.derive_alerts(ctx.readings_plain.withColumn("ZoneId", F.lit(None).cast("int"))
                        .withColumn("SiteId", F.lit(None).cast("int")),
                        ctx.thresholds, by="type")
    return d.groupBy("SensorType", "AlertType", "Severity").agg(
        F.count(F.lit(1)).alias("AlertCount"),
        round_stable(F.avg("ReadingValue"), 2).alias("AvgReading"))


@query("readings_expected")
def readings_expected(ctx: Ctx) -> DataFrame:
    """A8/A9 per reading: expected value and residual score (6 decimals)."""
    r = A.residual_score(ctx.readings_plain.select("ReadingId", "SensorType", "Timestamp",
                                                   "ReadingValue"),
                         ctx.thresholds, by="type")
    return r.select("ReadingId", "SensorType",
                    round_stable("ExpectedValue", 6).alias("ExpectedValue"),
                    round_stable("ResidualScore", 6).alias("ResidualScore"))


@query("readings_quality_flags")
def readings_quality_flags(ctx: Ctx) -> DataFrame:
    """A10: out-of-range and derived quality, counted per sensor type."""
    f = A.flag_quality(ctx.readings_plain, ctx.thresholds, by="type")
    return f.groupBy("SensorType", "OutOfRange", "DerivedQuality").agg(
        F.count(F.lit(1)).alias("Readings"),
        F.count_if(F.col("IsAnomaly")).alias("Anomalies"))


@query("readings_range_band")
def readings_range_band(ctx: Ctx) -> DataFrame:
    """Normal / warning / critical band counts per sensor type."""
    b = A.range_band(ctx.readings_plain, ctx.thresholds, by="type")
    return R.count_by(b, "SensorType", "RangeBand", name="Readings")


def _hierarchy(ctx: Ctx):
    return build_hierarchy(ctx.table("region"), ordinal="r_regionkey", name="r_name")


@query("dims_csv_roundtrip")
def dims_csv_roundtrip(ctx: Ctx) -> DataFrame:
    """The dimension setup flow end to end (S7 → S1 → S3 → S4): the hierarchy
    built from the sites table is written as CSV, read back with the declared
    schemas, written as tables, and verified by row and column counts."""
    from sensorium.schemas import DIM_SCHEMAS
    from sensorium.session import scratch_path
    root = scratch_path(ctx.spark, "dims")
    built = dict(zip(["dim_sites", "dim_zones", "dim_sensors"], _hierarchy(ctx)))
    tables = {}
    for name, df in built.items():
        TB.write_csv(df.select(*DIM_SCHEMAS[name].fieldNames()), f"{root}/csv/{name}")
        typed = TB.read_csv(ctx.spark, f"{root}/csv/{name}", DIM_SCHEMAS[name])
        TB.write_table(typed, f"{root}/tables/{name}")
        tables[name] = ctx.spark.read.parquet(f"{root}/tables/{name}")
    return TB.verify_tables(tables)


query("hierarchy_sites")(lambda ctx: _hierarchy(ctx)[0])
query("hierarchy_zones")(lambda ctx: _hierarchy(ctx)[1])
query("hierarchy_sensors")(lambda ctx: _hierarchy(ctx)[2])


@query("hierarchy_sensors_large")
def hierarchy_sensors_large(ctx: Ctx) -> DataFrame:
    """S8 with as many sites as there are customers, whose numbers outgrow the ids' width."""
    tasks = hierarchy_tasks(ctx.footers("customer").count())
    sites = deal_sites(ctx.table("customer"), tasks)
    return count_ids(build_hierarchy(sites, ordinal="c_custkey", name="c_name")[2], tasks)


def _model_tables(ctx: Ctx) -> dict[str, DataFrame]:
    return {"SensorReading": ctx.readings_plain, "SensorAlert": ctx.alerts_plain,
            "dim_sites": ctx.sites, "dim_zones": ctx.zones, "dim_sensors": ctx.sensors}


#: Each table of the model has a row for each row of one test table, so footers know its number.
_STORED_AS = {"SensorReading": "events", "SensorAlert": "orders", "dim_sites": "region", "dim_zones": "nation",
              "dim_sensors": "customer"}
query("table_counts")(lambda ctx: TB.table_counts({n: ctx.footers(t) for n, t in _STORED_AS.items()}))
query("verify_tables")(lambda ctx: TB.verify_tables(
    {**_model_tables(ctx), "SensorReading": ctx.readings, "SensorAlert": ctx.alerts}))
query("diag_file_stats")(lambda ctx: TB.file_stats(ctx.table("events")))


@query("retention_readings_7d")
def retention_readings_7d(ctx: Ctx) -> DataFrame:
    """Readings kept by a 7-day retention as of the latest reading, per day."""
    r = ctx.readings_plain
    kept = TB.apply_retention(r, 7, as_of="max")
    return kept.groupBy(F.to_date("Timestamp").alias("Day")).agg(F.count(F.lit(1)).alias("Readings"))


@query("sample_sensors")
def sample_sensors(ctx: Ctx) -> DataFrame:
    """Ten sensors drawn without replacement (seeded)."""
    return R.sample_n(ctx.sensors, 10, "sensor_id", seed=7)


@query("thin_anomalies")
def thin_anomalies(ctx: Ctx) -> DataFrame:
    """Deterministic 5 % thinning of the anomalous readings."""
    return R.thin(ctx.readings_plain.where(F.col("IsAnomaly")), 0.05, "ReadingId")


@query("alerts_derived_fraction")
def alerts_derived_fraction(ctx: Ctx) -> DataFrame:
    """Alerts of a fixed fraction of the anomalies."""
    return A.derive_alerts(ctx.readings, ctx.thresholds, by="type", keep_p=0.25)


@query("diag_file_counts")
def diag_file_counts(ctx: Ctx) -> DataFrame:
    """S21 without the times: files and rows of the readings, stored in seven files."""
    from sensorium.session import scratch_path
    path = f"{scratch_path(ctx.spark, 'files')}/readings"
    TB.write_table(ctx.readings_plain.repartition(7), path)
    return TB.file_stats(ctx.spark.read.parquet(path)).select("file_count", "row_count")


@query("load_sensors_typed")
def load_sensors_typed(ctx: Ctx) -> DataFrame:
    """The projecting scan of the sensors, thresholds as doubles."""
    return TB.load_sensors(ctx.sensors)


@query("csv_inferred_sensors")
def csv_inferred_sensors(ctx: Ctx) -> DataFrame:
    """The sensors through CSV without a schema."""
    from sensorium.session import scratch_path
    root = scratch_path(ctx.spark, "inferred")
    TB.write_csv(ctx.sensors.select("sensor_id", "sensor_name", "sensor_type", "min_normal", "max_critical"), f"{root}/csv")
    return TB.read_csv(ctx.spark, f"{root}/csv")


@query("merged_table_readings")
def merged_table_readings(ctx: Ctx) -> DataFrame:
    """A catalog table that gains a column by create-merge, a
    shortcut to its files, and a view table rebuilt from it by name."""
    from sensorium.plans.views import VIEWS
    from sensorium.session import scratch_path
    from sensorium.streaming.incremental import drop_view, list_views, recreate_view
    root, spark = scratch_path(ctx.spark, "catalog"), ctx.spark
    rows = ctx.readings
    name, link, view = (f"{x}_{root.rsplit('-', 1)[1]}" for x in ("merged", "linked", "mv_quality_daily"))
    narrow = T.StructType([f for f in rows.schema.fields if f.name != "QualityFlag"])
    TB.create_merge_table(spark, name, narrow, f"{root}/table")
    rows.where("IsAnomaly").drop("QualityFlag").write.mode("append").parquet(f"{root}/table")
    TB.create_merge_table(spark, name, rows.schema, f"{root}/table")
    rows.where("NOT IsAnomaly").write.mode("append").parquet(f"{root}/table")
    spark.catalog.refreshTable(name)
    TB.shortcut(spark, link, f"{root}/table", schema=rows.schema)
    built = recreate_view(spark, view, VIEWS["mv_quality_daily"], TB.load_dim(spark, link), f"{root}/view")
    if view not in list_views(spark, "mv_quality_daily_*"):
        raise RuntimeError("the rebuilt view is not in the catalog")
    out = spark.read.schema(built.schema).parquet(f"{root}/view")
    for x in (name, link, view):
        drop_view(spark, x)  # the files stay: external tables
    return out


@query("fetch_preview")
def fetch_preview(ctx: Ctx) -> DataFrame:
    """A preview as large as the sites' table, fetched and given back as rows."""
    columns, rows = TB.fetch(R.preview(ctx.sites, 100))
    return ctx.spark.createDataFrame(rows, ctx.sites.schema).select(*columns)


# ------------------------------------------------------------- oracle -----
_RT = "r.SensorType"
_BELOW_R = f"(r.ReadingValue < {thr(_RT, 'min_normal')})"
_THR_R = f"CASE WHEN {_BELOW_R} THEN {thr(_RT, 'min_normal')} ELSE {thr(_RT, 'max_normal')} END"
_CRIT_R = (f"CASE WHEN {_BELOW_R} THEN r.ReadingValue < {thr(_RT, 'min_critical')} * 1.1 "
           f"ELSE r.ReadingValue > {thr(_RT, 'max_critical')} * 0.9 END")
ALERTS_SQL = f"""
  SELECT 'AL-' || CAST(r.ReadingId AS VARCHAR) AS AlertId, r.SensorId, r.ZoneId, r.SiteId,
         r."Timestamp", r.SensorType,
         CASE WHEN {_BELOW_R} THEN 'BelowThreshold' ELSE 'AboveThreshold' END AS AlertType,
         CASE WHEN {_CRIT_R} THEN 'Critical' ELSE 'Warning' END AS Severity,
         r.ReadingValue,
         {rnd(_THR_R, 2)} AS ThresholdValue,
         r.SensorType || CASE WHEN {_BELOW_R} THEN ' too low: ' ELSE ' too high: ' END
           || CAST(r.ReadingValue AS VARCHAR) || ' ' || {thr(_RT, 'unit')}
           || CASE WHEN {_BELOW_R} THEN ' (min: ' ELSE ' (max: ' END
           || CAST({rnd(_THR_R, 2)} AS VARCHAR) || ')' AS Message
  FROM readings r
  WHERE r.IsAnomaly AND r.SensorType IS NOT NULL"""

_EXPECTED = f"""
  SELECT ReadingId, SensorType, ev,
         (ReadingValue - ev) / NULLIF(spread * 0.15, 0) AS rs
  FROM (
    SELECT ReadingId, SensorType, ReadingValue, spread,
           greatest(mn * 0.98, least(mx * 1.02,
             mid + sin({2.0 * math.pi} * (((epoch_us("Timestamp") % 86400000000) / 1e6) % 86400.0)
                        / 86400.0) * spread * 0.4)) AS ev
    FROM (SELECT *, {thr('SensorType', 'min_normal')} AS mn, {thr('SensorType', 'max_normal')} AS mx,
                 ({thr('SensorType', 'min_normal')} + {thr('SensorType', 'max_normal')}) / 2.0 AS mid,
                 ({thr('SensorType', 'max_normal')} - {thr('SensorType', 'min_normal')}) / 2.0 AS spread
          FROM readings))"""

def _pad(n: str, width: int) -> str:
    return f"CASE WHEN length({n}) < {width} THEN lpad({n}, {width}, '0') ELSE {n} END"


_OUT = (f"(ReadingValue < {thr('SensorType', 'min_normal')} "
        f"OR ReadingValue > {thr('SensorType', 'max_normal')})")
_BAND = f"""CASE WHEN ReadingValue IS NULL OR SensorType IS NULL THEN NULL
     WHEN ReadingValue >= {thr('SensorType', 'min_normal')}
      AND ReadingValue <= {thr('SensorType', 'max_normal')} THEN 'normal'
     WHEN ReadingValue < {thr('SensorType', 'min_critical')}
       OR ReadingValue > {thr('SensorType', 'max_critical')} THEN 'critical'
     ELSE 'warning' END"""

_ZT = "CASE j % 4 " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(ZONE_TYPES)) + " END"
_HIER = f""",
hs AS (SELECT r_regionkey AS i, r_name AS site_name,
              'SITE_' || {_pad('CAST(r_regionkey + 1 AS VARCHAR)', 3)} AS site_id FROM region),
hz AS (SELECT hs.*, g.j, {_ZT} AS zone_type,
              hs.site_id || '_Z' || {_pad('CAST(g.j + 1 AS VARCHAR)', 2)} AS zone_id
       FROM hs, (SELECT range AS j FROM range(4)) g),
hn AS (SELECT hz.*, k.k, hz.i * 4 + hz.j AS zone_ord, (hz.i * 4 + hz.j) * 5 + k.k + 1 AS num,
              CASE k.k % 5 WHEN 0 THEN 'Temperature' WHEN 1 THEN 'Humidity' WHEN 2 THEN 'Pressure'
                           WHEN 3 THEN 'CO2' ELSE 'Vibration' END AS sensor_type
       FROM hz, (SELECT range AS k FROM range(5)) k)
"""

_SENS = ",\nsth AS (SELECT sensor_id, sensor_type AS st FROM sensors)\n"
_ST = "t.st"
_BELOW_S = f"(r.ReadingValue < {thr(_ST, 'min_normal')})"
_THR_S = f"CASE WHEN {_BELOW_S} THEN {thr(_ST, 'min_normal')} ELSE {thr(_ST, 'max_normal')} END"
_CRIT_S = (f"CASE WHEN {_BELOW_S} THEN r.ReadingValue < {thr(_ST, 'min_critical')} * 1.1 "
           f"ELSE r.ReadingValue > {thr(_ST, 'max_critical')} * 0.9 END")
_ALERTS_BY_SENSOR_SQL = f"""
  SELECT 'AL-' || CAST(r.ReadingId AS VARCHAR) AS AlertId, r.SensorId, r.ZoneId, r.SiteId,
         r."Timestamp", t.st AS SensorType,
         CASE WHEN {_BELOW_S} THEN 'BelowThreshold' ELSE 'AboveThreshold' END AS AlertType,
         CASE WHEN {_CRIT_S} THEN 'Critical' ELSE 'Warning' END AS Severity,
         r.ReadingValue,
         {rnd(_THR_S, 2)} AS ThresholdValue,
         t.st || CASE WHEN {_BELOW_S} THEN ' too low: ' ELSE ' too high: ' END
           || CAST(r.ReadingValue AS VARCHAR) || ' ' || {thr(_ST, 'unit')}
           || CASE WHEN {_BELOW_S} THEN ' (min: ' ELSE ' (max: ' END
           || CAST({rnd(_THR_S, 2)} AS VARCHAR) || ')' AS Message
  FROM readings r JOIN sth t ON r.SensorId = t.sensor_id
  WHERE r.IsAnomaly"""

ORACLE.update({
    "alerts_derived": with_base(ALERTS_SQL),
    "alerts_derived_by_sensor": with_base(_ALERTS_BY_SENSOR_SQL, _SENS),
    "alerts_derived_summary": with_base(
        f"""SELECT SensorType, AlertType, Severity, count(*) AS AlertCount,
                   {rnd('avg(ReadingValue)', 2)} AS AvgReading
            FROM ({ALERTS_SQL}) GROUP BY SensorType, AlertType, Severity"""),
    "readings_expected": with_base(
        f"""SELECT ReadingId, SensorType, {rnd('ev', 6)} AS ExpectedValue,
                   {rnd('rs', 6)} AS ResidualScore FROM ({_EXPECTED})"""),
    "readings_quality_flags": with_base(
        f"""SELECT SensorType, {_OUT} AS OutOfRange,
                   CASE WHEN {_OUT} THEN 'Suspect' WHEN NOT {_OUT} THEN 'Good' END AS DerivedQuality,
                   count(*) AS Readings, count(*) FILTER (WHERE IsAnomaly) AS Anomalies
            FROM readings GROUP BY 1, 2, 3"""),
    "readings_range_band": with_base(
        f"""SELECT SensorType, {_BAND} AS RangeBand, count(*) AS Readings
            FROM readings GROUP BY 1, 2"""),
    "hierarchy_sensors_large": """SELECT count(*) AS sensors, count(*) AS sensor_ids, count(DISTINCT (c_custkey, j)) AS zone_ids,
           count(DISTINCT c_custkey) AS site_ids,
           max(3 + greatest(4, length(CAST((c_custkey * 4 + j) * 5 + k + 1 AS VARCHAR)))) AS longest
           FROM customer, (SELECT range AS j FROM range(4)), (SELECT range AS k FROM range(5))""",
    "alerts_derived_fraction": with_base(
        f"{ALERTS_SQL} AND substr(md5(CAST(r.ReadingId AS VARCHAR) || ':42'), 1, 13) < '4000000000000'"),
    "sample_sensors": with_base(
        f"""SELECT s.sensor_id, s.sensor_name, s.sensor_type, s.zone_id, {thr('s.sensor_type', 'unit')} AS unit,
                   {thr('s.sensor_type', 'min_normal')} AS min_normal, {thr('s.sensor_type', 'max_normal')} AS max_normal,
                   {thr('s.sensor_type', 'min_critical')} AS min_critical,
                   {thr('s.sensor_type', 'max_critical')} AS max_critical, z.site_id
            FROM sensors s LEFT JOIN zones z ON s.zone_id = z.zone_id
            ORDER BY md5(CAST(s.sensor_id AS VARCHAR) || ':7'), s.sensor_id LIMIT 10"""),
    "thin_anomalies": with_base(
        """SELECT ReadingId, SensorId, "Timestamp", SensorType, ReadingValue, Unit, IsAnomaly, QualityFlag
           FROM readings r
           WHERE IsAnomaly AND substr(md5(CAST(ReadingId AS VARCHAR) || ':42'), 1, 13) < '0cccccccccccc'"""),
    "diag_file_counts": "SELECT 7 AS file_count, count(*) AS row_count FROM events",
    "load_sensors_typed": with_base(
        f"""SELECT s.sensor_id, s.sensor_type, {thr('s.sensor_type', 'unit')} AS unit, s.zone_id, z.site_id,
                   {thr('s.sensor_type', 'min_normal')} AS min_normal, {thr('s.sensor_type', 'max_normal')} AS max_normal,
                   {thr('s.sensor_type', 'min_critical')} AS min_critical,
                   {thr('s.sensor_type', 'max_critical')} AS max_critical
            FROM sensors s LEFT JOIN zones z ON s.zone_id = z.zone_id"""),
    "csv_inferred_sensors": with_base(
        f"""SELECT sensor_id, sensor_name, sensor_type, {thr('sensor_type', 'min_normal')} AS min_normal,
                   {thr('sensor_type', 'max_critical')} AS max_critical FROM sensors"""),
    "merged_table_readings": with_base(
        """SELECT time_bucket(INTERVAL '1 day', "Timestamp") AS "Timestamp", SensorType, SiteId, count(*) AS TotalReadings,
                  count(*) FILTER (WHERE QualityFlag = 'Good' AND NOT IsAnomaly) AS GoodCount,
                  count(*) FILTER (WHERE QualityFlag IS DISTINCT FROM 'Good' OR IsAnomaly) AS DegradedCount
           FROM readings GROUP BY 1, 2, 3"""),
    "fetch_preview": with_base("SELECT site_id, site_name FROM sites"),
    "hierarchy_sites": with_base(
        """SELECT site_id, site_name, CAST(NULL AS VARCHAR) AS region, CAST(NULL AS VARCHAR) AS country,
                  CAST(round(43.3 + i * 2.0, 4) AS DOUBLE) AS latitude, CAST(round(2.3 + i * 1.5, 4) AS DOUBLE) AS longitude,
                  TRUE AS is_active FROM hs""", _HIER),
    "hierarchy_zones": with_base(
        """SELECT zone_id, zone_type || ' - ' || site_name AS zone_name, zone_type, site_id,
                  CAST(j // 2 + 1 AS INTEGER) AS floor,
                  CAST(round(100.0 + j * 50 + length(site_name) * 3, 1) AS DOUBLE) AS area_sqm, TRUE AS is_active
           FROM hz""", _HIER),
    "hierarchy_sensors": with_base(
        f"""SELECT 'SN_' || {_pad('CAST(num AS VARCHAR)', 4)} AS sensor_id,
                  sensor_type || ' Sensor ' || CAST(num AS VARCHAR) AS sensor_name, sensor_type,
                  {thr('sensor_type', 'unit')} AS unit, zone_id, site_id,
                  {thr('sensor_type', 'min_normal')} AS min_normal,
                  {thr('sensor_type', 'max_normal')} AS max_normal,
                  {thr('sensor_type', 'min_critical')} AS min_critical,
                  {thr('sensor_type', 'max_critical')} AS max_critical,
                  DATE '2024-06-15' AS install_date, TRUE AS is_active
           FROM hn""", _HIER),
    "dims_csv_roundtrip": with_base(
        """SELECT 'dim_sites' AS table_name, count(*) AS row_count, 7 AS column_count FROM hs
           UNION ALL SELECT 'dim_zones', count(*), 7 FROM hz
           UNION ALL SELECT 'dim_sensors', count(*), 12 FROM hn""", _HIER),
    "table_counts": with_base(
        """SELECT 'SensorReading' AS table_name, count(*) AS row_count FROM readings
           UNION ALL SELECT 'SensorAlert', count(*) FROM alerts
           UNION ALL SELECT 'dim_sites', count(*) FROM sites
           UNION ALL SELECT 'dim_zones', count(*) FROM zones
           UNION ALL SELECT 'dim_sensors', count(*) FROM sensors"""),
    "verify_tables": with_base(
        """SELECT 'SensorReading' AS table_name, count(*) AS row_count, 10 AS column_count FROM readings
           UNION ALL SELECT 'SensorAlert', count(*), 11 FROM alerts
           UNION ALL SELECT 'dim_sites', count(*), 2 FROM sites
           UNION ALL SELECT 'dim_zones', count(*), 4 FROM zones
           UNION ALL SELECT 'dim_sensors', count(*), 10 FROM sensors"""),
    "retention_readings_7d": with_base(
        """SELECT CAST("Timestamp" AS DATE) AS Day, count(*) AS Readings FROM readings
           WHERE "Timestamp" >= (SELECT max("Timestamp") FROM readings) - INTERVAL '7 days'
           GROUP BY 1"""),
})
