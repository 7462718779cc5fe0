"""SQL formulations of the named queries, for DuckDB.  The model's fixed values
(thresholds and the mapping of the test tables) are shared with the library;
the queries are written apart from it.

The test-table mapping (``sources.testdata``) is spelled out once as CTEs;
every query is then plain SQL over ``readings`` / ``alerts`` / dimension CTEs.
Rounding uses the same half-away-from-zero rule as ``round_stable``.
"""

from __future__ import annotations

from sensorium.schemas import SENSOR_TYPES, ZONE_TYPES
from sensorium.sources.testdata import (
    ANOMALY_ABOVE, EVENT_SENSOR_TYPE, MISSING_QUALITY_BELOW, PRIORITY_SEVERITY,
    SEGMENT_SENSOR_TYPE, SUSPECT_ABOVE,
)


def _case(col: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {_lit(k)} THEN {_lit(v)}" for k, v in mapping.items())
    return f"CASE {col} {whens} END"


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(float(v))


def thr(col: str, field: str) -> str:
    idx = {"unit": 1, "min_normal": 2, "max_normal": 3, "min_critical": 4, "max_critical": 5}[field]
    return _case(col, {t[0]: t[idx] for t in SENSOR_TYPES})


def rnd(x: str, d: int) -> str:
    """SQL twin of ``round_stable``."""
    s = float(10 ** d)
    return f"(sign({x}) * floor(abs({x}) * {s} + {0.5 + 1e-6}) / {s})"


def tdiv(a: str, b: str) -> str:
    """Division that is NULL on a zero denominator."""
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


ZONE_TYPE_SQL = "CASE n_nationkey % 4 " + " ".join(
    f"WHEN {i} THEN {_lit(t)}" for i, t in enumerate(ZONE_TYPES)) + " END"

_BELOW = f"(o.o_totalprice < {thr('s.stype', 'min_normal')})"
_THRESH = f"CASE WHEN {_BELOW} THEN {thr('s.stype', 'min_normal')} ELSE {thr('s.stype', 'max_normal')} END"

BASE = f"""
WITH
sites AS (SELECT r_regionkey AS site_id, r_name AS site_name FROM region),
zones AS (SELECT n_nationkey AS zone_id, n_name AS zone_name, {ZONE_TYPE_SQL} AS zone_type,
                 n_regionkey AS site_id FROM nation),
sensors AS (
  SELECT c_custkey AS sensor_id, c_name AS sensor_name,
         {_case('c_mktsegment', SEGMENT_SENSOR_TYPE)} AS sensor_type, c_nationkey AS zone_id
  FROM customer),
sensor_loc AS (
  SELECT c.c_custkey AS sid, c.c_nationkey AS zid, n.n_regionkey AS site_id,
         {_case('c.c_mktsegment', SEGMENT_SENSOR_TYPE)} AS stype
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
readings AS (
  SELECT e.event_id AS ReadingId, e.user_id AS SensorId, s.zid AS ZoneId, s.site_id AS SiteId,
         e.ts AS "Timestamp", {_case('e.event_type', EVENT_SENSOR_TYPE)} AS SensorType,
         e.value AS ReadingValue,
         {thr(_case('e.event_type', EVENT_SENSOR_TYPE), 'unit')} AS Unit,
         e.value > {ANOMALY_ABOVE} AS IsAnomaly,
         CASE WHEN e.value < {MISSING_QUALITY_BELOW} THEN NULL
              WHEN e.value > {SUSPECT_ABOVE} THEN 'Suspect' ELSE 'Good' END AS QualityFlag
  FROM events e LEFT JOIN sensor_loc s ON e.user_id = s.sid),
alerts AS (
  SELECT o.o_orderkey AS AlertId, o.o_custkey AS SensorId, s.zid AS ZoneId, s.site_id AS SiteId,
         o.o_orderdate AS "Timestamp", s.stype AS SensorType,
         CASE WHEN {_BELOW} THEN 'BelowThreshold' ELSE 'AboveThreshold' END AS AlertType,
         {_case('o.o_orderpriority', PRIORITY_SEVERITY)} AS Severity,
         o.o_totalprice AS ReadingValue,
         {_THRESH} AS ThresholdValue,
         CASE WHEN {_BELOW}
              THEN s.stype || ' too low: ' || CAST(o.o_totalprice AS VARCHAR) || ' '
                   || {thr('s.stype', 'unit')} || ' (min: ' || CAST({_THRESH} AS VARCHAR) || ')'
              ELSE s.stype || ' too high: ' || CAST(o.o_totalprice AS VARCHAR) || ' '
                   || {thr('s.stype', 'unit')} || ' (max: ' || CAST({_THRESH} AS VARCHAR) || ')'
         END AS Message
  FROM orders o LEFT JOIN sensor_loc s ON o.o_custkey = s.sid)
"""

_STATS = """count(*) AS ReadingCount, avg(ReadingValue) AS AvgValue, min(ReadingValue) AS MinValue,
       max(ReadingValue) AS MaxValue, count(*) FILTER (WHERE IsAnomaly) AS AnomalyCount,
       count(*) FILTER (WHERE QualityFlag = 'Good') AS GoodQualityCount"""

VIEW_SQL = {
    "mv_readings_hourly": f"""SELECT time_bucket(INTERVAL '1 hour', "Timestamp") AS "Timestamp",
       SensorType, SiteId, {_STATS} FROM readings GROUP BY 1, 2, 3""",
    "mv_readings_daily": f"""SELECT time_bucket(INTERVAL '1 day', "Timestamp") AS "Timestamp",
       SensorType, SiteId, {_STATS} FROM readings GROUP BY 1, 2, 3""",
    "mv_anomaly_rate_hourly": """SELECT time_bucket(INTERVAL '1 hour', "Timestamp") AS "Timestamp",
       SiteId, count(*) AS TotalReadings, count(*) FILTER (WHERE IsAnomaly) AS AnomalyCount
       FROM readings GROUP BY 1, 2""",
    "mv_alerts_daily": """SELECT time_bucket(INTERVAL '1 day', "Timestamp") AS "Timestamp",
       Severity, SiteId, SensorType, count(*) AS AlertCount, avg(ReadingValue) AS AvgReading,
       avg(ThresholdValue) AS AvgThreshold FROM alerts GROUP BY 1, 2, 3, 4""",
    "mv_quality_daily": """SELECT time_bucket(INTERVAL '1 day', "Timestamp") AS "Timestamp",
       SensorType, SiteId, count(*) AS TotalReadings, count(*) FILTER (WHERE QualityFlag = 'Good') AS GoodCount,
       count(*) FILTER (WHERE QualityFlag IS DISTINCT FROM 'Good') AS DegradedCount
       FROM readings GROUP BY 1, 2, 3""",
}


def with_base(body: str, extra_ctes: str = "") -> str:
    return BASE + extra_ctes + "\n" + body


def _view_cte(name: str) -> str:
    return f", {name} AS ({VIEW_SQL[name]})\n"


def _avg_tile(stype: str, name: str, d: int) -> str:
    return with_base(f"SELECT {rnd('avg(ReadingValue)', d)} AS {name} FROM readings "
                     f"WHERE SensorType = '{stype}'")


ORACLE: dict[str, str] = {}
for _n, _sql in VIEW_SQL.items():
    ORACLE[_n] = with_base(_sql)

ORACLE.update({
    "mv_hourly_recent": with_base(
        """SELECT * FROM mv_readings_hourly
           WHERE "Timestamp" > (SELECT max("Timestamp") FROM readings) - INTERVAL '24 hours'
           ORDER BY "Timestamp" DESC""", _view_cte("mv_readings_hourly")),
    "mv_anomaly_over_5": with_base(
        """SELECT *, (AnomalyCount * 100.0) / NULLIF(CAST(TotalReadings AS DOUBLE), 0) AS AnomalyRate
           FROM mv_anomaly_rate_hourly
           WHERE (AnomalyCount * 100.0) / NULLIF(CAST(TotalReadings AS DOUBLE), 0) > 5
           ORDER BY "Timestamp" DESC""", _view_cte("mv_anomaly_rate_hourly")),
    "mv_alerts_by_site": with_base(
        "SELECT SiteId, CAST(sum(AlertCount) AS BIGINT) AS TotalAlerts FROM mv_alerts_daily GROUP BY SiteId",
        _view_cte("mv_alerts_daily")),
    "view_lineitem_daily": """
        SELECT CAST(l_shipdate AS TIMESTAMP) AS "Timestamp", l_returnflag AS SensorType, l_linestatus AS SiteId,
               count(*) AS ReadingCount, avg(l_quantity) AS AvgValue, min(l_quantity) AS MinValue, max(l_quantity) AS MaxValue,
               count(*) FILTER (WHERE l_quantity > 45) AS AnomalyCount, count(*) FILTER (WHERE l_quantity > 25) AS GoodQualityCount
        FROM lineitem GROUP BY 1, 2, 3""",
    "tile_total_readings": with_base("SELECT count(*) AS Count FROM readings"),
    "tile_anomaly_rate": with_base(
        f"""SELECT {rnd(tdiv('Anomalies', 'Total') + ' * 100.0', 2)} AS AnomalyRate
            FROM (SELECT count(*) AS Total, count(*) FILTER (WHERE IsAnomaly) AS Anomalies FROM readings)"""),
    "tile_total_alerts": with_base("SELECT count(*) AS Count FROM alerts"),
    "tile_readings_15m": with_base(
        f"""SELECT time_bucket(INTERVAL '15 minutes', "Timestamp") AS "Timestamp", SensorType,
                   {rnd('avg(ReadingValue)', 2)} AS AvgValue
            FROM readings GROUP BY 1, 2 ORDER BY 1"""),
    "tile_alerts_by_severity": with_base(
        "SELECT Severity, count(*) AS Count FROM alerts GROUP BY Severity ORDER BY Count DESC"),
    "tile_top10_sensors": with_base(
        f"""SELECT SensorId, SensorType, count(*) AS AlertCount,
                   {rnd('avg(ReadingValue)', 2)} AS AvgReading
            FROM alerts GROUP BY SensorId, SensorType
            ORDER BY AlertCount DESC NULLS LAST, SensorId ASC NULLS FIRST, SensorType ASC NULLS FIRST
            LIMIT 10"""),
    "tile_anomaly_rate_by_site": with_base(
        f"""SELECT SiteId, {rnd(tdiv('Anomalies', 'Total') + ' * 100.0', 2)} AS AnomalyRate
            FROM (SELECT SiteId, count(*) AS Total, count(*) FILTER (WHERE IsAnomaly) AS Anomalies
                  FROM readings GROUP BY SiteId) ORDER BY AnomalyRate DESC"""),
    "tile_readings_by_type_site": with_base(
        """SELECT SiteId, SensorType, count(*) AS Count FROM readings
           GROUP BY SiteId, SensorType ORDER BY SiteId, SensorType"""),
    "tile_latest50_alerts": with_base(
        """SELECT "Timestamp", SiteId, SensorType, Severity, AlertType, ReadingValue, ThresholdValue,
                  Message, AlertId
           FROM alerts ORDER BY "Timestamp" DESC NULLS LAST, AlertId ASC LIMIT 50"""),
    "tile_avg_temperature": _avg_tile("Temperature", "AvgTemp", 1),
    "tile_avg_humidity": _avg_tile("Humidity", "AvgHumidity", 1),
    "tile_avg_pressure": _avg_tile("Pressure", "AvgPressure", 1),
    "tile_avg_co2": _avg_tile("CO2", "AvgCO2", 1),
    "tile_avg_vibration": _avg_tile("Vibration", "AvgVibration", 2),
    "live_count_5m": with_base(
        """SELECT count(*) AS Count FROM readings
           WHERE "Timestamp" > (SELECT max("Timestamp") FROM readings) - INTERVAL '5 minutes'"""),
    "anomaly_rate_1h": with_base(
        f"""SELECT TotalReadings, Anomalies, {rnd(tdiv('Anomalies * 100.0', 'TotalReadings'), 2)} AS AnomalyRate
            FROM (SELECT count(*) AS TotalReadings, count(*) FILTER (WHERE IsAnomaly) AS Anomalies FROM readings
                  WHERE "Timestamp" > (SELECT max("Timestamp") FROM readings) - INTERVAL '1 hour')"""),
    "temp_by_site_1m": with_base(
        """SELECT time_bucket(INTERVAL '1 minute', "Timestamp") AS "Timestamp", SiteId,
                  avg(ReadingValue) AS AvgTemp
           FROM readings
           WHERE SensorType = 'Temperature'
             AND "Timestamp" > (SELECT max("Timestamp") FROM readings) - INTERVAL '1 hour'
           GROUP BY 1, 2"""),
    "alerts_severity_30m": with_base(
        """SELECT Severity, count(*) AS AlertCount FROM alerts
           WHERE "Timestamp" > (SELECT max("Timestamp") FROM alerts) - INTERVAL '30 minutes'
           GROUP BY Severity"""),
    "top_sensors_1h": with_base(
        """SELECT SensorId, SensorType, count(*) AS AlertCount FROM alerts
           WHERE "Timestamp" > (SELECT max("Timestamp") FROM alerts) - INTERVAL '1 hour'
           GROUP BY SensorId, SensorType
           ORDER BY AlertCount DESC, SensorId ASC NULLS FIRST, SensorType ASC NULLS FIRST LIMIT 10"""),
    "temp_by_zone_1h": with_base(
        """SELECT ZoneId, avg(ReadingValue) AS AvgValue FROM readings
           WHERE "Timestamp" > (SELECT max("Timestamp") FROM readings) - INTERVAL '1 hour'
             AND SensorType = 'Temperature'
           GROUP BY ZoneId"""),
    "diag_time_range": with_base(
        """SELECT min("Timestamp") AS min_Timestamp, max("Timestamp") AS max_Timestamp FROM readings"""),
    "diag_by_site": with_base(
        "SELECT SiteId, count(*) AS count_ FROM readings GROUP BY SiteId ORDER BY count_ DESC"),
    "diag_by_type": with_base(
        "SELECT SensorType, count(*) AS count_ FROM readings GROUP BY SensorType ORDER BY count_ DESC"),
    "diag_alerts_severity": with_base(
        "SELECT Severity, count(*) AS count_ FROM alerts GROUP BY Severity"),
    "check_anomaly_overall": with_base(
        f"""SELECT total, anomalies, {rnd(tdiv('anomalies * 100.0', 'total'), 1)} AS rate
            FROM (SELECT count(*) AS total, count(*) FILTER (WHERE IsAnomaly) AS anomalies FROM readings)"""),
    "check_anomaly_by_type": with_base(
        f"""SELECT SensorType, Total, Anomalies, {rnd(tdiv('Anomalies * 100.0', 'Total'), 1)} AS AnomalyPct
            FROM (SELECT SensorType, count(*) AS Total, count(*) FILTER (WHERE IsAnomaly) AS Anomalies
                  FROM readings GROUP BY SensorType) ORDER BY AnomalyPct DESC"""),
    "check_latest5": with_base(
        """SELECT ReadingId, SensorId, ZoneId, SiteId, "Timestamp", SensorType, ReadingValue, Unit,
                  IsAnomaly, QualityFlag
           FROM readings ORDER BY "Timestamp" DESC, ReadingId ASC LIMIT 5"""),
})
