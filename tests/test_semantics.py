"""Blank / null / tie semantics on hand-made frames (survey 2.13, N1–N10)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sensorium.operators import relational as R
from sensorium.operators.model import SensorModel
from sensorium.plans.views import VIEWS

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)

SITE = "dim_sites.site_name"
ZONE_TYPE = "dim_zones.zone_type"
SENSOR_TYPE = "dim_sensors.sensor_type"


@pytest.fixture(scope="module")
def model(spark):
    sites = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "site_id int, site_name string")
    zones = spark.createDataFrame(
        [(10, "Production", 1), (11, "Storage", 1), (20, "Office", 2), (30, "HVAC", 3)],
        "zone_id int, zone_type string, site_id int")
    sensors = spark.createDataFrame(
        [(100, "s100", "Temperature", 10), (101, "s101", "Humidity", 11),
         (200, "s200", "Temperature", 20)],
        "sensor_id long, sensor_name string, sensor_type string, zone_id int")
    readings = spark.createDataFrame(
        [(100, True, "Good", 10.0, T0), (100, False, "Suspect", 20.0, T0),
         (101, False, None, 30.0, T0), (200, False, "Good", 40.0, T0),
         (999, True, "Good", 50.0, T0)],
        "SensorId long, IsAnomaly boolean, QualityFlag string, ReadingValue double, "
        "Timestamp timestamp_ntz")
    alerts = spark.createDataFrame(
        [(100, "Critical", T0), (100, "CRITICAL", T0), (200, "warning", T0), (999, "Warning", T0)],
        "SensorId long, Severity string, Timestamp timestamp_ntz")
    return SensorModel(readings=readings, alerts=alerts, dim_sites=sites, dim_zones=zones,
                       dim_sensors=sensors)


def by_key(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_n1_severity_case_insensitive(model):
    r = model.query([], ["Critical Alerts", "Warning Alerts", "Total Alerts"]).collect()[0]
    assert (r["CriticalAlerts"], r["WarningAlerts"], r["TotalAlerts"]) == (2, 2, 4)


def test_n6_blank_vs_zero_rate(model):
    out = by_key(model.query([ZONE_TYPE], ["Anomaly Rate", "Total Readings"]), "zone_type")
    assert out["Production"]["AnomalyRate"] == 0.5
    assert out["Office"]["AnomalyRate"] is None          # readings, no anomaly: BLANK
    assert out["HVAC"]["AnomalyRate"] == 0.0             # no readings: DIVIDE alternate
    assert out["HVAC"]["TotalReadings"] is None


def test_n8_members_without_facts(model):
    plain = by_key(model.query([SITE], ["Total Readings"]), "site_name")
    assert "C" not in plain                               # all measures blank → dropped
    with_rate = by_key(model.query([SITE], ["Total Readings", "Anomaly Rate"]), "site_name")
    assert with_rate["C"]["AnomalyRate"] == 0.0 and with_rate["C"]["TotalReadings"] is None


def test_n9_unknown_sensor_forms_blank_group(model):
    out = by_key(model.query([SITE], ["Total Readings"]), "site_name")
    assert out[None]["TotalReadings"] == 1
    assert out["A"]["TotalReadings"] == 3
    assert out["B"]["TotalReadings"] == 1


def test_n7_worst_zone_skips_blank(model, spark):
    # Storage has readings but no Good one → BLANK, skipped; HVAC has none → 0.
    assert model.query([], ["Worst Zone Quality"]).collect()[0]["WorstZoneQuality"] == 0.0
    no_hvac = SensorModel(readings=model.readings, alerts=model.alerts, dim_sites=model.dim_sites,
                          dim_zones=model.dim_zones.where(F.col("zone_type") != "HVAC"),
                          dim_sensors=model.dim_sensors)
    assert no_hvac.query([], ["Worst Zone Quality"]).collect()[0]["WorstZoneQuality"] == 0.5


def test_filters_make_dimension_inner(model):
    r = model.query([], ["Critical Alerts"], filters={ZONE_TYPE: "Production"}).collect()[0]
    assert r["CriticalAlerts"] == 2
    t = by_key(model.query([SITE], ["Avg Reading Value"], filters={SENSOR_TYPE: "Temperature"}),
               "site_name")
    assert t == {"A": {"site_name": "A", "AvgReadingValue": 15.0},
                 "B": {"site_name": "B", "AvgReadingValue": 40.0}}


def test_summarize_base_keeps_fact_combinations_only(model):
    out = by_key(model.query([SITE], ["Anomaly Count"], base="readings"), "site_name")
    assert set(out) == {"A", "B", None}
    assert out["B"]["AnomalyCount"] is None               # ADDCOLUMNS keeps blank rows


def test_empty_facts_one_row(spark, model):
    empty = model.readings.limit(0)
    m = SensorModel(readings=empty, alerts=model.alerts.limit(0), dim_sites=model.dim_sites,
                    dim_zones=model.dim_zones, dim_sensors=model.dim_sensors)
    rows = m.query([], ["Total Readings", "Anomaly Rate", "Alert Rate"]).collect()
    assert len(rows) == 1
    assert rows[0]["TotalReadings"] is None and rows[0]["AnomalyRate"] == 0.0
    assert rows[0]["AlertRate"] == 0.0


def test_n5_kql_ratio_of_nothing_is_null(spark, model):
    from sensorium.functions import pct
    empty = model.readings.limit(0)
    r = empty.agg(F.count(F.lit(1)).alias("t"), F.count_if("IsAnomaly").alias("a")) \
        .select(pct("a", "t", 2).alias("rate")).collect()
    assert r == [(None,)] or r[0]["rate"] is None


def test_j5_no_fact_to_fact_join(model):
    plan = model.query([SITE], ["Alert Rate"])._jdf.queryExecution().executedPlan().toString()
    # Every join in the plan has a dimension on one side: the two facts are
    # aggregated apart and meet only in the final union + aggregate.
    assert "Union" in plan


def test_n10_top_vs_topn_ties(spark):
    df = spark.createDataFrame([("a", 5), ("b", 4), ("c", 4), ("d", 1)], "k string, x int")
    assert R.top_n(df, 2, "x", tie_break=["k"]).count() == 2
    assert sorted(r["k"] for r in R.top_n_ties(df, 2, "x").collect()) == ["a", "b", "c"]
    assert R.top_n_ties(df, 10, "x").count() == 4
    with_null = spark.createDataFrame([("a", 5), ("b", None), ("c", None)], "k string, x int")
    assert R.top_n_ties(with_null, 2, "x").count() == 3


def test_n3_quality_total_is_good_plus_degraded(spark, model):
    v = VIEWS["mv_quality_daily"]
    r = model.readings.withColumn("SensorType", F.lit("T")).withColumn("SiteId", F.lit(1))
    row = v.compute(r).collect()[0]
    assert row["TotalReadings"] == row["GoodCount"] + row["DegradedCount"] == 5
    assert row["DegradedCount"] == 2                      # Suspect and missing


def test_view_partial_merge_equals_compute(spark, model):
    v = VIEWS["mv_readings_hourly"]
    r = model.readings.withColumn("SensorType", F.lit("T")).withColumn("SiteId", F.lit(1))
    a, b = r.where(F.col("SensorId") == 100), r.where(F.col("SensorId") != 100)
    merged = v.merge(v.partial(a).unionByName(v.partial(b)))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, v.compute(r).collect()))


def test_since_is_strict_and_anchored(spark):
    df = spark.createDataFrame([(T0,), (T0 - dt.timedelta(minutes=5),),
                                (T0 - dt.timedelta(minutes=6),)], "Timestamp timestamp_ntz")
    assert R.since(df, "5m", as_of="max").count() == 1
    assert R.since(df, "6m", as_of="max").count() == 2


def test_small_relational_helpers(spark, model):
    r = model.readings
    assert R.preview(r, 2).count() == 2
    assert sorted(x[0] for x in R.values(model.dim_zones, "zone_type").collect()) == \
        ["HVAC", "Office", "Production", "Storage"]
    assert R.between(r, T0, None).count() == 5 and R.between(r, None, T0).count() == 0
    per_sensor_max = R.min_over(r, ["SensorId"], F.max("ReadingValue"), name="m").collect()[0]["m"]
    assert per_sensor_max == 20.0            # min over sensors of their max value
    assert R.count_by(r, "SensorId").count() == 4
    assert R.time_range(r).collect()[0]["max_Timestamp"] == T0
    r = r.withColumn("ReadingId", F.monotonically_increasing_id())
    drawn = [sorted(map(str, R.sample_n(x, 3, "ReadingId").collect())) for x in (r, r.repartition(5))]
    assert len(drawn[0]) == 3 and drawn[0] == drawn[1]          # the same whatever the partitioning


def test_worst_zone_by_sensor_attribute(spark, model):
    # Sensor-type groups see every zone type: Temperature and Humidity each
    # miss some zone types, which rate 0.
    out = by_key(model.query([SENSOR_TYPE], ["Worst Zone Quality"]), "sensor_type")
    assert out["Temperature"]["WorstZoneQuality"] == 0.0
    assert out["Humidity"]["WorstZoneQuality"] == 0.0

    zones = spark.createDataFrame([(i, t, 1) for i, t in enumerate(
        ["Production", "Storage", "Office", "HVAC"])], "zone_id int, zone_type string, site_id int")
    sensors = spark.createDataFrame([(i, f"s{i}", "T", i) for i in range(4)],
                                    "sensor_id long, sensor_name string, sensor_type string, zone_id int")
    readings = spark.createDataFrame(
        [(0, "Good"), (0, "Suspect"), (1, "Good"), (2, "Good"), (3, "Suspect")],
        "SensorId long, QualityFlag string").withColumn("IsAnomaly", F.lit(False)) \
        .withColumn("ReadingValue", F.lit(1.0)).withColumn("Timestamp", F.lit(T0).cast("timestamp_ntz"))
    full = SensorModel(readings=readings, alerts=model.alerts.limit(0), dim_sites=model.dim_sites,
                       dim_zones=zones, dim_sensors=sensors)
    # Every zone type has readings; HVAC has no Good one (blank, skipped).
    r = full.query([SENSOR_TYPE], ["Worst Zone Quality"]).collect()[0]
    assert r["WorstZoneQuality"] == 0.5
    assert full.query([], ["Worst Zone Quality"]).collect()[0]["WorstZoneQuality"] == 0.5


def test_topn_ascending_worst_n(spark):
    df = spark.createDataFrame([("a", 5), ("b", 4), ("c", 4), ("d", 1)], "k string, x int")
    assert sorted(r["k"] for r in R.top_n_ties(df, 2, "x", ascending=True).collect()) == ["b", "c", "d"]
    nulls = spark.createDataFrame([("a", None), ("b", None), ("c", 3), ("d", 7)], "k string, x int")
    assert sorted(r["k"] for r in R.top_n_ties(nulls, 1, "x", ascending=True).collect()) == ["a", "b"]
    assert sorted(r["k"] for r in R.top_n_ties(nulls, 3, "x", ascending=True).collect()) == ["a", "b", "c"]
    assert R.top_n_ties(nulls, 9, "x", ascending=True).count() == 4


def test_grouping_across_two_dimension_tables_keeps_existing_combinations(model):
    out = model.query([SITE, ZONE_TYPE], ["Total Readings", "Anomaly Rate"]).collect()
    combos = {(r["site_name"], r["zone_type"]) for r in out}
    # Members come from the zone hierarchy (zones with their site), plus the
    # blank group of the unknown sensor — no site × zone-type cross product.
    assert combos == {("A", "Production"), ("A", "Storage"), ("B", "Office"), ("C", "HVAC"),
                      (None, None)}
    by = {(r["site_name"], r["zone_type"]): r for r in out}
    assert by[("A", "Production")]["TotalReadings"] == 2
    assert by[("C", "HVAC")]["AnomalyRate"] == 0.0 and by[("C", "HVAC")]["TotalReadings"] is None
