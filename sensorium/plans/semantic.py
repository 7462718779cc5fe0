"""Measure queries: the few-shot questions (``fs_*``), the report visuals
(``rpt_*``), and measure overviews — all through :class:`SensorModel`.

Output names are the DAX display names without spaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorium.operators import relational as R
from sensorium.operators.model import ALL_MEASURES, SensorModel
from sensorium.plans.context import Ctx
from sensorium.plans.oracle import ORACLE, with_base
from sensorium.plans.queries import query

SITE = "dim_sites.site_name"
ZONE_TYPE = "dim_zones.zone_type"
SENSOR_TYPE = "dim_sensors.sensor_type"
SENSOR_NAME = "dim_sensors.sensor_name"


def _rename(df: DataFrame, mapping: dict) -> DataFrame:
    for a, b in mapping.items():
        df = df.withColumnRenamed(a, b)
    return df


@query("fs_total_readings")
def fs_total_readings(ctx: Ctx) -> DataFrame:
    return ctx.model.query([], ["Total Readings"])


@query("fs_anomaly_rate")
def fs_anomaly_rate(ctx: Ctx) -> DataFrame:
    return ctx.model.query([], ["Anomaly Rate", "Anomaly Count", "Total Readings"])


@query("fs_readings_by_site")
def fs_readings_by_site(ctx: Ctx) -> DataFrame:
    df = ctx.model.query([SITE], ["Total Readings", "Avg Reading Value"])
    return _rename(df, {"AvgReadingValue": "AvgValue"})


@query("fs_alerts_by_severity")
def fs_alerts_by_severity(ctx: Ctx) -> DataFrame:
    return ctx.model.query([], ["Critical Alerts", "Warning Alerts", "Total Alerts"])


@query("fs_top5_anomaly_sensors")
def fs_top5_anomaly_sensors(ctx: Ctx) -> DataFrame:
    g = ctx.model.query([SENSOR_NAME, SENSOR_TYPE], ["Anomaly Count"], base="readings")
    return R.top_n_ties(_rename(g, {"AnomalyCount": "Anomalies"}), 5, "Anomalies")


@query("fs_anomaly_by_zone_type")
def fs_anomaly_by_zone_type(ctx: Ctx) -> DataFrame:
    return ctx.model.query([ZONE_TYPE], ["Anomaly Rate", "Total Readings", "Anomaly Count"])


@query("fs_temp_by_site")
def fs_temp_by_site(ctx: Ctx, model: SensorModel | None = None) -> DataFrame:
    df = (model or ctx.model).query([SITE], ["Avg Reading Value"], filters={SENSOR_TYPE: "Temperature"})
    return _rename(df, {"AvgReadingValue": "AvgTemperature"})


@query("fs_top_alert_site")
def fs_top_alert_site(ctx: Ctx) -> DataFrame:
    g = ctx.model.query([SITE], ["Total Alerts"], base="alerts")
    return R.top_n_ties(g, 1, "TotalAlerts")


@query("fs_quality_by_type")
def fs_quality_by_type(ctx: Ctx) -> DataFrame:
    return ctx.model.query([SENSOR_TYPE], ["Good Quality Rate", "Total Readings"])


@query("fs_critical_in_production")
def fs_critical_in_production(ctx: Ctx) -> DataFrame:
    df = ctx.model.query([], ["Critical Alerts"], filters={ZONE_TYPE: "Production"})
    return _rename(df, {"CriticalAlerts": "CriticalAlertsInProduction"})


@query("rpt_cards")
def rpt_cards(ctx: Ctx) -> DataFrame:
    return ctx.model.query([], ["Total Readings", "Anomaly Rate", "Total Alerts",
                                "Critical Alerts", "Warning Alerts", "Alert Rate"])


def _bar(ctx: Ctx, attr: str, measure: str) -> DataFrame:
    df = ctx.model.query([attr], [measure])
    col = df.columns[-1]
    return df.orderBy(F.col(col).desc())


query("rpt_anomaly_by_zone")(lambda ctx: _bar(ctx, ZONE_TYPE, "Anomaly Rate"))
query("rpt_readings_by_site")(lambda ctx: _bar(ctx, SITE, "Total Readings"))
query("rpt_quality_by_type")(lambda ctx: _bar(ctx, SENSOR_TYPE, "Good Quality Rate"))
query("rpt_alerts_by_site")(lambda ctx: _bar(ctx, SITE, "Total Alerts"))
query("rpt_avg_by_site")(lambda ctx: _bar(ctx, SITE, "Avg Reading Value"))


@query("measure_worst_zone_quality")
def measure_worst_zone_quality(ctx: Ctx) -> DataFrame:
    return ctx.model.query([], ["Worst Zone Quality"])


@query("worst_zone_quality_by_site")
def worst_zone_quality_by_site(ctx: Ctx) -> DataFrame:
    return ctx.model.query([SITE], ["Worst Zone Quality"])


@query("worst_zone_quality_by_sensor_type")
def worst_zone_quality_by_sensor_type(ctx: Ctx) -> DataFrame:
    return ctx.model.query([SENSOR_TYPE], ["Worst Zone Quality", "Total Readings"])


@query("worst_zone_quality_by_sensor_type_in_production")
def worst_zone_quality_by_sensor_type_in_production(ctx: Ctx) -> DataFrame:
    return ctx.model.query([SENSOR_TYPE], ["Worst Zone Quality"], filters={ZONE_TYPE: "Production"})


@query("worst_zone_quality_by_sensor_type_in_site")
def worst_zone_quality_by_sensor_type_in_site(ctx: Ctx) -> DataFrame:
    return ctx.model.query([SENSOR_TYPE], ["Worst Zone Quality", "Total Readings"], filters={SITE: "ASIA"})


@query("alerts_by_site_severity_filter")
def alerts_by_site_severity_filter(ctx: Ctx) -> DataFrame:
    """A caller's filter on Severity.  Total Alerts takes it; Critical and Warning
    Alerts have a Severity filter of their own, which replaces it."""
    return ctx.model.query([SITE], ["Total Alerts", "Critical Alerts", "Warning Alerts"],
                           filters={"alerts.Severity": "Warning"})


@query("quality_of_anomalies_by_zone_type")
def quality_of_anomalies_by_zone_type(ctx: Ctx) -> DataFrame:
    """Measures over anomalous readings of one quality."""
    return ctx.model.query([ZONE_TYPE], ["Total Readings", "Anomaly Count", "Max Reading Value"],
                           filters={"readings.IsAnomaly": True, "readings.QualityFlag": ["Suspect", "Good"]})


@query("measures_overview")
def measures_overview(ctx: Ctx) -> DataFrame:
    """All twelve measures in one row."""
    return ctx.model.query([], ALL_MEASURES)


@query("fs_anomaly_by_zone_type_7d")
def fs_anomaly_by_zone_type_7d(ctx: Ctx) -> DataFrame:
    """The zone-type question restricted to the last 7 days of readings
    (a half-open range on the fact's own timestamp, applied before its
    aggregate)."""
    lo = R.as_of_max(ctx.readings_plain, minus="7d")
    return ctx.model.query([ZONE_TYPE], ["Anomaly Rate", "Total Readings", "Anomaly Count"],
                           time_range=(lo, None))


@query("fs_rate_by_site")
def fs_rate_by_site(ctx: Ctx) -> DataFrame:
    """Flagship drill-across: both facts under one dimension chain."""
    return ctx.model.query([SITE], ["Total Readings", "Anomaly Rate", "Total Alerts", "Alert Rate"])


# ------------------------------------------------------------- oracle -----
# Facts carried to every dimension level through explicit left joins.
_DIMS = """,
rdim AS (
  SELECT r.*, s.sensor_name, s.sensor_type, z.zone_type, st.site_name
  FROM readings r
  LEFT JOIN sensors s ON r.SensorId = s.sensor_id
  LEFT JOIN zones z ON s.zone_id = z.zone_id
  LEFT JOIN sites st ON z.site_id = st.site_id),
adim AS (
  SELECT a.*, s.sensor_name, s.sensor_type AS dim_sensor_type, z.zone_type, st.site_name
  FROM alerts a
  LEFT JOIN sensors s ON a.SensorId = s.sensor_id
  LEFT JOIN zones z ON s.zone_id = z.zone_id
  LEFT JOIN sites st ON z.site_id = st.site_id),
rsum AS (SELECT count(*) AS n, count(*) FILTER (WHERE IsAnomaly) AS a,
                count(*) FILTER (WHERE QualityFlag = 'Good') AS g,
                sum(ReadingValue) AS vs, count(ReadingValue) AS vc,
                min(ReadingValue) AS vmin, max(ReadingValue) AS vmax FROM readings),
asum AS (SELECT count(*) AS n, count(*) FILTER (WHERE upper(Severity) = 'CRITICAL') AS c,
                count(*) FILTER (WHERE upper(Severity) = 'WARNING') AS w FROM alerts),
wzq AS (
  SELECT min(CASE WHEN NULLIF(f.n, 0) IS NULL THEN 0.0
                  ELSE CAST(NULLIF(f.g, 0) AS DOUBLE) / f.n END) AS v
  FROM (SELECT zone_type FROM zones UNION SELECT zone_type FROM rdim) m
  LEFT JOIN (SELECT zone_type, count(*) AS n, count(*) FILTER (WHERE QualityFlag = 'Good') AS g
             FROM rdim GROUP BY zone_type) f
    ON m.zone_type IS NOT DISTINCT FROM f.zone_type)
"""


def _div0(a: str, b: str) -> str:
    """DIVIDE(a, b, 0) with COUNTROWS blanks: 0 if b is 0, NULL if a is 0."""
    return (f"(CASE WHEN NULLIF({b}, 0) IS NULL THEN 0.0 "
            f"ELSE CAST(NULLIF({a}, 0) AS DOUBLE) / {b} END)")


def _members_join(attr: str, member_sql: str, fact_sql: str, select: str, where: str) -> str:
    return f"""SELECT {select} FROM (
      SELECT COALESCE(m.k, f.k) AS {attr}, f.* EXCLUDE (k)
      FROM ({member_sql}) m FULL OUTER JOIN ({fact_sql}) f ON m.k IS NOT DISTINCT FROM f.k)
    WHERE {where}"""


_RMEAS = ("count(*) AS n, count(*) FILTER (WHERE IsAnomaly) AS a, "
          "count(*) FILTER (WHERE QualityFlag = 'Good') AS g, "
          "sum(ReadingValue) AS vs, count(ReadingValue) AS vc")

# What a dimension filter leaves of the zones (z, st) and, through them, of sensors and readings.
_IN_PRODUCTION = "zone_type = 'Production'"
_IN_SITE = "site_name = 'ASIA'"


def _wzq_by_type(condition: str) -> str:
    """Worst zone quality by sensor type: the groups are the sensors' types, the zone
    types iterated are all that the filter leaves, whether they have readings or not."""
    return f"""
        SELECT m.sensor_type,
               min(CASE WHEN NULLIF(f.n, 0) IS NULL THEN 0.0
                        ELSE CAST(NULLIF(f.g, 0) AS DOUBLE) / f.n END) AS WorstZoneQuality,
               CAST(NULLIF(sum(f.n), 0) AS BIGINT) AS TotalReadings
        FROM (SELECT s.sensor_type, z.zone_type
              FROM (SELECT DISTINCT sd.sensor_type FROM (
                      SELECT s.sensor_type, z.zone_type, st.site_name FROM sensors s
                      LEFT JOIN zones z ON s.zone_id = z.zone_id LEFT JOIN sites st ON z.site_id = st.site_id
                      UNION ALL SELECT sensor_type, zone_type, site_name FROM rdim) sd WHERE {condition}) s
              CROSS JOIN (SELECT DISTINCT zone_type FROM zones z LEFT JOIN sites st ON z.site_id = st.site_id
                          WHERE {condition}) z) m
        LEFT JOIN (SELECT sensor_type, zone_type, count(*) AS n, count(*) FILTER (WHERE QualityFlag = 'Good') AS g
                   FROM rdim WHERE {condition} GROUP BY sensor_type, zone_type) f
          ON m.sensor_type IS NOT DISTINCT FROM f.sensor_type AND m.zone_type IS NOT DISTINCT FROM f.zone_type
        GROUP BY m.sensor_type"""


ORACLE.update({
    "fs_total_readings": with_base("SELECT NULLIF(n, 0) AS TotalReadings FROM rsum", _DIMS),
    "fs_anomaly_rate": with_base(
        f"SELECT {_div0('a', 'n')} AS AnomalyRate, NULLIF(a, 0) AS AnomalyCount, "
        "NULLIF(n, 0) AS TotalReadings FROM rsum", _DIMS),
    "fs_readings_by_site": with_base(
        f"""SELECT site_name, NULLIF(n, 0) AS TotalReadings, vs / NULLIF(vc, 0) AS AvgValue
            FROM (SELECT site_name, {_RMEAS} FROM rdim GROUP BY site_name)
            WHERE NULLIF(n, 0) IS NOT NULL OR vs / NULLIF(vc, 0) IS NOT NULL""", _DIMS),
    "fs_alerts_by_severity": with_base(
        "SELECT NULLIF(c, 0) AS CriticalAlerts, NULLIF(w, 0) AS WarningAlerts, "
        "NULLIF(n, 0) AS TotalAlerts FROM asum", _DIMS),
    "fs_top5_anomaly_sensors": with_base(
        """SELECT sensor_name, sensor_type, Anomalies FROM (
             SELECT sensor_name, sensor_type, Anomalies,
                    rank() OVER (ORDER BY Anomalies DESC NULLS LAST) AS rk
             FROM (SELECT sensor_name, sensor_type,
                          NULLIF(count(*) FILTER (WHERE IsAnomaly), 0) AS Anomalies
                   FROM rdim GROUP BY sensor_name, sensor_type))
           WHERE rk <= 5""", _DIMS),
    "fs_anomaly_by_zone_type": with_base(
        _members_join("zone_type", "SELECT DISTINCT zone_type AS k FROM zones",
                      f"SELECT zone_type AS k, {_RMEAS} FROM rdim GROUP BY zone_type",
                      f"zone_type, {_div0('a', 'n')} AS AnomalyRate, NULLIF(n, 0) AS TotalReadings, "
                      "NULLIF(a, 0) AS AnomalyCount",
                      "TRUE"), _DIMS),
    "fs_temp_by_site": with_base(
        """SELECT site_name, sum(ReadingValue) / NULLIF(count(ReadingValue), 0) AS AvgTemperature
           FROM rdim WHERE sensor_type = 'Temperature' GROUP BY site_name
           HAVING sum(ReadingValue) / NULLIF(count(ReadingValue), 0) IS NOT NULL""", _DIMS),
    "fs_top_alert_site": with_base(
        """SELECT site_name, TotalAlerts FROM (
             SELECT site_name, TotalAlerts, rank() OVER (ORDER BY TotalAlerts DESC NULLS LAST) AS rk
             FROM (SELECT site_name, NULLIF(count(*), 0) AS TotalAlerts FROM adim GROUP BY site_name))
           WHERE rk <= 1""", _DIMS),
    "fs_quality_by_type": with_base(
        _members_join("sensor_type", "SELECT DISTINCT sensor_type AS k FROM sensors",
                      f"SELECT sensor_type AS k, {_RMEAS} FROM rdim GROUP BY sensor_type",
                      f"sensor_type, {_div0('g', 'n')} AS GoodQualityRate, NULLIF(n, 0) AS TotalReadings",
                      "TRUE"), _DIMS),
    "fs_critical_in_production": with_base(
        """SELECT NULLIF(count(*) FILTER (WHERE upper(Severity) = 'CRITICAL'), 0)
                  AS CriticalAlertsInProduction
           FROM adim WHERE zone_type = 'Production'""", _DIMS),
    "rpt_cards": with_base(
        f"""SELECT NULLIF(r.n, 0) AS TotalReadings, {_div0('r.a', 'r.n')} AS AnomalyRate,
                   NULLIF(a.n, 0) AS TotalAlerts, NULLIF(a.c, 0) AS CriticalAlerts,
                   NULLIF(a.w, 0) AS WarningAlerts, {_div0('a.n', 'r.n')} AS AlertRate
            FROM rsum r, asum a""", _DIMS),
    "rpt_anomaly_by_zone": with_base(
        _members_join("zone_type", "SELECT DISTINCT zone_type AS k FROM zones",
                      f"SELECT zone_type AS k, {_RMEAS} FROM rdim GROUP BY zone_type",
                      f"zone_type, {_div0('a', 'n')} AS AnomalyRate", "TRUE")
        + " ORDER BY AnomalyRate DESC", _DIMS),
    "rpt_readings_by_site": with_base(
        """SELECT site_name, NULLIF(count(*), 0) AS TotalReadings FROM rdim GROUP BY site_name
           ORDER BY TotalReadings DESC""", _DIMS),
    "rpt_quality_by_type": with_base(
        _members_join("sensor_type", "SELECT DISTINCT sensor_type AS k FROM sensors",
                      f"SELECT sensor_type AS k, {_RMEAS} FROM rdim GROUP BY sensor_type",
                      f"sensor_type, {_div0('g', 'n')} AS GoodQualityRate", "TRUE")
        + " ORDER BY GoodQualityRate DESC", _DIMS),
    "rpt_alerts_by_site": with_base(
        """SELECT site_name, NULLIF(count(*), 0) AS TotalAlerts FROM adim GROUP BY site_name
           ORDER BY TotalAlerts DESC""", _DIMS),
    "rpt_avg_by_site": with_base(
        """SELECT site_name, sum(ReadingValue) / NULLIF(count(ReadingValue), 0) AS AvgReadingValue
           FROM rdim GROUP BY site_name
           HAVING count(ReadingValue) > 0 ORDER BY AvgReadingValue DESC""", _DIMS),
    "measure_worst_zone_quality": with_base("SELECT v AS WorstZoneQuality FROM wzq", _DIMS),
    "worst_zone_quality_by_site": with_base(
        """SELECT site_name, min(rate) AS WorstZoneQuality FROM (
             SELECT m.site_name, m.zone_type,
                    CASE WHEN NULLIF(f.n, 0) IS NULL THEN 0.0
                         ELSE CAST(NULLIF(f.g, 0) AS DOUBLE) / f.n END AS rate
             FROM (SELECT st.site_name, z.zone_type FROM zones z
                   LEFT JOIN sites st ON z.site_id = st.site_id
                   UNION SELECT site_name, zone_type FROM rdim) m
             LEFT JOIN (SELECT site_name, zone_type, count(*) AS n,
                               count(*) FILTER (WHERE QualityFlag = 'Good') AS g
                        FROM rdim GROUP BY site_name, zone_type) f
               ON m.site_name IS NOT DISTINCT FROM f.site_name
              AND m.zone_type IS NOT DISTINCT FROM f.zone_type)
           GROUP BY site_name HAVING min(rate) IS NOT NULL""", _DIMS),
    "worst_zone_quality_by_sensor_type": with_base(
        f"SELECT sensor_type, WorstZoneQuality, TotalReadings FROM ({_wzq_by_type('TRUE')})", _DIMS),
    "worst_zone_quality_by_sensor_type_in_production": with_base(
        f"SELECT sensor_type, WorstZoneQuality FROM ({_wzq_by_type(_IN_PRODUCTION)}) WHERE WorstZoneQuality IS NOT NULL", _DIMS),
    "worst_zone_quality_by_sensor_type_in_site": with_base(
        f"SELECT sensor_type, WorstZoneQuality, TotalReadings FROM ({_wzq_by_type(_IN_SITE)})", _DIMS),
    "alerts_by_site_severity_filter": with_base(
        """SELECT site_name, NULLIF(count(*) FILTER (WHERE Severity = 'Warning'), 0) AS TotalAlerts,
                  NULLIF(count(*) FILTER (WHERE upper(Severity) = 'CRITICAL'), 0) AS CriticalAlerts,
                  NULLIF(count(*) FILTER (WHERE upper(Severity) = 'WARNING'), 0) AS WarningAlerts
           FROM adim GROUP BY site_name
           HAVING count(*) FILTER (WHERE upper(Severity) IN ('CRITICAL', 'WARNING')) > 0""", _DIMS),
    "quality_of_anomalies_by_zone_type": with_base(
        """SELECT zone_type, NULLIF(count(*) FILTER (WHERE IsAnomaly), 0) AS TotalReadings,
                  NULLIF(count(*) FILTER (WHERE IsAnomaly), 0) AS AnomalyCount,
                  max(ReadingValue) FILTER (WHERE IsAnomaly) AS MaxReadingValue
           FROM rdim WHERE QualityFlag IN ('Suspect', 'Good') GROUP BY zone_type
           HAVING count(*) FILTER (WHERE IsAnomaly) > 0""", _DIMS),
    "measures_overview": with_base(
        f"""SELECT NULLIF(r.n, 0) AS TotalReadings, r.vs / NULLIF(r.vc, 0) AS AvgReadingValue,
                   r.vmax AS MaxReadingValue, r.vmin AS MinReadingValue,
                   NULLIF(r.a, 0) AS AnomalyCount, {_div0('r.a', 'r.n')} AS AnomalyRate,
                   {_div0('r.g', 'r.n')} AS GoodQualityRate, NULLIF(a.n, 0) AS TotalAlerts,
                   NULLIF(a.c, 0) AS CriticalAlerts, NULLIF(a.w, 0) AS WarningAlerts,
                   {_div0('a.n', 'r.n')} AS AlertRate, w.v AS WorstZoneQuality
            FROM rsum r, asum a, wzq w""", _DIMS),
    "fs_anomaly_by_zone_type_7d": with_base(
        _members_join("zone_type", "SELECT DISTINCT zone_type AS k FROM zones",
                      f"""SELECT zone_type AS k, {_RMEAS} FROM rdim
                          WHERE "Timestamp" >= (SELECT max("Timestamp") FROM readings) - INTERVAL '7 days'
                          GROUP BY zone_type""",
                      f"zone_type, {_div0('a', 'n')} AS AnomalyRate, NULLIF(n, 0) AS TotalReadings, "
                      "NULLIF(a, 0) AS AnomalyCount",
                      "TRUE"), _DIMS),
    "fs_rate_by_site": with_base(
        f"""SELECT COALESCE(m.k, r.k, a.k) AS site_name, NULLIF(r.n, 0) AS TotalReadings,
                   {_div0('r.a', 'r.n')} AS AnomalyRate, NULLIF(a.n, 0) AS TotalAlerts,
                   {_div0('a.n', 'r.n')} AS AlertRate
            FROM (SELECT DISTINCT site_name AS k FROM sites) m
            FULL OUTER JOIN (SELECT site_name AS k, count(*) AS n,
                                    count(*) FILTER (WHERE IsAnomaly) AS a
                             FROM rdim GROUP BY site_name) r ON m.k IS NOT DISTINCT FROM r.k
            FULL OUTER JOIN (SELECT site_name AS k, count(*) AS n FROM adim GROUP BY site_name) a
              ON COALESCE(m.k, r.k) IS NOT DISTINCT FROM a.k""", _DIMS),
})
