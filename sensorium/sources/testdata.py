"""The sensor model laid over the driver's TPC-H-style test tables.

Mapping (one place, used by every named query and mirrored in the SQL oracle):

====================  =========================================================
sites                 region:   r_regionkey → site_id, r_name → site_name
zones                 nation:   n_nationkey → zone_id, n_regionkey → site_id,
                      zone_type = ZONE_TYPES[n_nationkey % 4]
sensors               customer: c_custkey → sensor_id, c_name → sensor_name,
                      c_nationkey → zone_id, c_mktsegment → sensor_type
                      (SEGMENT_SENSOR_TYPE), thresholds by sensor type
readings              events:   event_id → ReadingId, user_id → SensorId,
                      ts → Timestamp, event_type → SensorType
                      (EVENT_SENSOR_TYPE), value → ReadingValue,
                      IsAnomaly = value > 100, QualityFlag = missing if
                      value < 1, Suspect if value > 150, else Good;
                      ZoneId / SiteId through the sensor (left joins)
stored alerts         orders, priority 1-URGENT as Critical and the others as
                      Warning: o_orderkey → AlertId, o_custkey → SensorId,
                      o_orderdate → Timestamp, o_totalprice → ReadingValue;
                      type, threshold and message by the alert rules
====================  =========================================================

Joins and scale.  ``nation`` and ``region`` have a fixed size (25 and 5 rows
at every scale factor) and are broadcast explicitly.  ``customer`` grows with
the data: ``locate`` hints a broadcast only while the optimizer's statistics
prove it small (``broadcast_if_small``); otherwise the planner chooses, and
AQE's skew-join handling splits hot keys of a sort-merge join.  Joins to dimensions are left joins so that a
fact with an unknown sensor keeps its row with missing zone and site.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorium.schemas import (
    ALERT_HIGH_FACTOR, ALERT_LOW_FACTOR, ALERT_TYPE_ABOVE, ALERT_TYPE_BELOW, SENSOR_TYPES,
    SEVERITY_CRITICAL,
    SEVERITY_WARNING, ZONE_TYPES, QUALITY_GOOD, QUALITY_SUSPECT,
)

# Fixed values of the test mapping (our choice, mirrored in plans/oracle.py).
EVENT_SENSOR_TYPE = {
    "view": "Temperature",
    "click": "Humidity",
    "purchase": "Pressure",
    "signup": "CO2",
    "error": "Vibration",
}
SEGMENT_SENSOR_TYPE = {
    "AUTOMOBILE": "Temperature",
    "BUILDING": "Humidity",
    "FURNITURE": "Pressure",
    "HOUSEHOLD": "CO2",
    "MACHINERY": "Vibration",
}
PRIORITY_SEVERITY = {
    "1-URGENT": SEVERITY_CRITICAL,
    "2-HIGH": SEVERITY_WARNING,
    "3-MEDIUM": SEVERITY_WARNING,
    "4-NOT SPECIFIED": SEVERITY_WARNING,
    "5-LOW": SEVERITY_WARNING,
}
ANOMALY_ABOVE = 100.0
SUSPECT_ABOVE = 150.0
MISSING_QUALITY_BELOW = 1.0

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


_READERS: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The test table ``name`` (read-only input: the reader and its file
    listing are reused within a session)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _READERS:
        _READERS[key] = spark.read.parquet(path)
    return _READERS[key]


def _sql_lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return f"CAST({float(v)!r} AS DOUBLE)"


def _case(col: str, mapping: dict) -> Column:
    """A fixed lookup as one SQL CASE expression (a single plan node)."""
    whens = " ".join(f"WHEN {_sql_lit(k)} THEN {_sql_lit(v)}" for k, v in mapping.items())
    return F.expr(f"CASE {col} {whens} END")


def threshold(sensor_type: str, field: str) -> Column:
    """Unit or threshold of a sensor type (column name or SQL expression),
    from the fixed threshold table."""
    idx = {"unit": 1, "min_normal": 2, "max_normal": 3, "min_critical": 4, "max_critical": 5}[field]
    return _case(sensor_type, {t[0]: t[idx] for t in SENSOR_TYPES})


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("site_id"), F.col("r_name").alias("site_name"))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = F.array(*[F.lit(t) for t in ZONE_TYPES])
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("zone_id"),
        F.col("n_name").alias("zone_name"),
        F.element_at(types, (F.pmod(F.col("n_nationkey"), F.lit(len(ZONE_TYPES))) + 1).cast("int"))
        .alias("zone_type"),
        F.col("n_regionkey").alias("site_id"),
    )


def sensors(spark: SparkSession, sf_dir: str, with_site: bool = True,
            with_thresholds: bool = True) -> DataFrame:
    """dim_sensors: one row per customer, with type, unit and thresholds."""
    stype = _case("c_mktsegment", SEGMENT_SENSOR_TYPE)
    df = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("sensor_id"),
        F.col("c_name").alias("sensor_name"),
        stype.alias("sensor_type"),
        F.col("c_nationkey").alias("zone_id"),
    )
    if with_thresholds:
        df = df.select(
            "*",
            threshold("sensor_type", "unit").alias("unit"),
            *[threshold("sensor_type", f).alias(f)
              for f in ("min_normal", "max_normal", "min_critical", "max_critical")],
        )
    if with_site:
        nat = table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("zone_id"), F.col("n_regionkey").alias("site_id"))
        df = df.join(F.broadcast(nat), "zone_id", "left")
    return df


def sensor_locations(spark: SparkSession, sf_dir: str, with_type: bool = False) -> DataFrame:
    """sensor id → ZoneId, SiteId (and the sensor's type as ``_stype``)."""
    cust_cols = [F.col("c_custkey").alias("_sid"), F.col("c_nationkey").alias("ZoneId")]
    if with_type:
        cust_cols.append(_case("c_mktsegment", SEGMENT_SENSOR_TYPE).alias("_stype"))
    cust = table(spark, sf_dir, "customer").select(*cust_cols)
    nat = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("_zid"), F.col("n_regionkey").alias("SiteId"))
    return cust.join(F.broadcast(nat), cust["ZoneId"] == nat["_zid"], "left").drop("_zid")


def locate(fact: DataFrame, spark: SparkSession, sf_dir: str, key: str = "SensorId",
           with_type: bool = False) -> DataFrame:
    """Attach ZoneId / SiteId (and ``_stype``) to ``fact`` through its sensor.

    Left join: an unknown sensor keeps its row with missing location.  The
    location table is broadcast only when its row count is proven small.
    """
    from sensorium.operators.joins import broadcast_if_small
    loc = broadcast_if_small(sensor_locations(spark, sf_dir, with_type))
    return fact.join(loc, fact[key] == loc["_sid"], "left").drop("_sid")


def readings(spark: SparkSession, sf_dir: str, located: bool = True) -> DataFrame:
    """SensorReading over ``events``.  ``located=False`` skips the sensor join
    for queries that never touch ZoneId / SiteId."""
    value = F.col("value")
    stype = _case("event_type", EVENT_SENSOR_TYPE)
    ev = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("ReadingId"),
        F.col("user_id").alias("SensorId"),
        F.col("ts").alias("Timestamp"),
        stype.alias("SensorType"),
        value.alias("ReadingValue"),
        threshold("SensorType", "unit").alias("Unit"),
        (value > ANOMALY_ABOVE).alias("IsAnomaly"),
        F.when(value < MISSING_QUALITY_BELOW, F.lit(None).cast("string"))
        .when(value > SUSPECT_ABOVE, F.lit(QUALITY_SUSPECT))
        .otherwise(F.lit(QUALITY_GOOD)).alias("QualityFlag"),
    )
    if not located:
        return ev
    out = locate(ev, spark, sf_dir, "SensorId")
    return out.select("ReadingId", "SensorId", "ZoneId", "SiteId", "Timestamp", "SensorType",
                      "ReadingValue", "Unit", "IsAnomaly", "QualityFlag")


def stored_alerts(spark: SparkSession, sf_dir: str, located: bool = True) -> DataFrame:
    """SensorAlert over ``orders`` (urgent → Critical, else Warning)."""
    sev = _case("o_orderpriority", PRIORITY_SEVERITY)
    od = (table(spark, sf_dir, "orders")
          .select(F.col("o_orderkey").alias("AlertId"),
                  F.col("o_custkey").alias("SensorId"),
                  F.col("o_orderdate").alias("Timestamp"),
                  sev.alias("Severity"),
                  F.col("o_totalprice").alias("ReadingValue")))
    if not located:
        return od
    return enrich_alerts(od, spark, sf_dir)


def enrich_alerts(od: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored alert rows → full SensorAlert rows: location, sensor type, and
    type / threshold / message by the alert rules."""
    out = locate(od, spark, sf_dir, "SensorId", with_type=True)
    out = out.select("*", threshold("_stype", "min_normal").alias("_min"),
                     threshold("_stype", "max_normal").alias("_max"),
                     threshold("_stype", "unit").alias("_unit"))
    st = F.col("_stype")
    v = F.col("ReadingValue")
    below = v < F.col("_min")
    thr = F.when(below, F.col("_min")).otherwise(F.col("_max"))
    from sensorium.operators.alerts import alert_message
    return out.select(
        "AlertId", "SensorId", "ZoneId", "SiteId", "Timestamp",
        st.alias("SensorType"),
        F.when(below, F.lit(ALERT_TYPE_BELOW)).otherwise(F.lit(ALERT_TYPE_ABOVE)).alias("AlertType"),
        "Severity", "ReadingValue",
        thr.alias("ThresholdValue"),
        alert_message(st, below, v, F.col("_unit"), thr).alias("Message"),
    )


__all__ = [
    "ALERT_HIGH_FACTOR", "ALERT_LOW_FACTOR", "EVENT_SENSOR_TYPE", "SEGMENT_SENSOR_TYPE",
    "PRIORITY_SEVERITY", "TABLES", "enrich_alerts", "locate", "readings", "sensor_locations",
    "sensors", "sites", "stored_alerts", "table", "threshold", "zones",
]
