"""Alert rules against the golden consequences of the stock thresholds (2.9)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sensorium.operators import alerts as A

T0 = dt.datetime(2024, 1, 1, 6, 0, 0)

# (type, value) → (AlertType, Severity, Threshold)
GOLDEN = [
    ("Temperature", 5.4, "BelowThreshold", "Critical", 18.0),
    ("Temperature", 5.5, "BelowThreshold", "Warning", 18.0),
    ("Temperature", 40.5, "AboveThreshold", "Warning", 28.0),
    ("Temperature", 40.6, "AboveThreshold", "Critical", 28.0),
    ("Humidity", 10.9, "BelowThreshold", "Critical", 30.0),
    ("Humidity", 11.0, "BelowThreshold", "Warning", 30.0),
    ("Humidity", 81.0, "AboveThreshold", "Warning", 60.0),
    ("Humidity", 81.1, "AboveThreshold", "Critical", 60.0),
    ("Pressure", 980.0, "BelowThreshold", "Critical", 990.0),   # every pressure alert is Critical
    ("Pressure", 1030.0, "AboveThreshold", "Critical", 1025.0),
    ("CO2", 329.0, "BelowThreshold", "Critical", 400.0),
    ("CO2", 330.0, "BelowThreshold", "Warning", 400.0),
    ("CO2", 4500.0, "AboveThreshold", "Warning", 1000.0),
    ("CO2", 4500.5, "AboveThreshold", "Critical", 1000.0),
    ("Vibration", 9.9, "AboveThreshold", "Warning", 4.5),
    ("Vibration", 10.0, "AboveThreshold", "Critical", 4.5),
    ("Vibration", 0.0, "AboveThreshold", "Warning", 4.5),      # else-branch: "too high: 0.0"
]


@pytest.fixture(scope="module")
def readings(spark):
    rows = [(f"r{i}", 1, 1, 1, T0, t, v, True) for i, (t, v, *_rest) in enumerate(GOLDEN)]
    rows.append(("normal", 1, 1, 1, T0, "Temperature", 22.0, False))
    return spark.createDataFrame(
        rows, "ReadingId string, SensorId long, ZoneId int, SiteId int, Timestamp timestamp_ntz, "
              "SensorType string, ReadingValue double, IsAnomaly boolean")


def test_golden_alert_rules(spark, readings):
    out = {r["AlertId"]: r for r in
           A.derive_alerts(readings, A.threshold_table(spark), by="type").collect()}
    assert "AL-normal" not in out                         # A1: only anomalies alert
    for i, (t, v, kind, sev, thr) in enumerate(GOLDEN):
        r = out[f"AL-r{i}"]
        assert (r["AlertType"], r["Severity"], r["ThresholdValue"]) == (kind, sev, thr), (t, v)


def test_messages(spark, readings):
    out = {r["AlertId"]: r["Message"] for r in
           A.derive_alerts(readings, A.threshold_table(spark), by="type").collect()}
    assert out["AL-r0"] == "Temperature too low: 5.4 °C (min: 18.0)"
    assert out["AL-r16"] == "Vibration too high: 0.0 mm/s (max: 4.5)"


def test_by_sensor_thresholds(spark, readings):
    sensors = spark.createDataFrame(
        [(1, "Temperature", "°C", 18.0, 28.0, 5.0, 45.0)],
        "sensor_id long, sensor_type string, unit string, min_normal double, max_normal double, "
        "min_critical double, max_critical double")
    out = A.derive_alerts(readings, sensors, by="sensor")
    # Every anomaly is judged by its sensor's own (temperature) thresholds.
    assert out.count() == len(GOLDEN)
    assert out.where(F.col("Message").startswith("Temperature")).count() == len(GOLDEN)


def test_thinning_is_deterministic(spark, readings):
    a = A.derive_alerts(readings, A.threshold_table(spark), by="type", keep_p=0.5)
    b = A.derive_alerts(readings, A.threshold_table(spark), by="type", keep_p=0.5)
    assert sorted(r["AlertId"] for r in a.collect()) == sorted(r["AlertId"] for r in b.collect())
    # A ratio above 1 (0.05 / 0.03) keeps every anomaly.
    assert A.derive_alerts(readings, A.threshold_table(spark), by="type",
                           keep_p=0.05 / 0.03).count() == len(GOLDEN)


def test_expected_value_and_bands(spark, readings):
    e = A.residual_score(readings, A.threshold_table(spark), by="type")
    row = e.where(F.col("ReadingId") == "normal").collect()[0]
    # 06:00 UTC: sine = 1 → mid + 0.4·spread = 23 + 2 = 25; residual (22−25)/(0.15·5)
    assert abs(row["ExpectedValue"] - 25.0) < 1e-9
    assert abs(row["ResidualScore"] - (-4.0)) < 1e-9
    bands = {r["ReadingId"]: r["RangeBand"] for r in
             A.range_band(readings, A.threshold_table(spark), by="type").collect()}
    assert bands["normal"] == "normal"
    assert bands["r0"] == "warning"                       # 5.4: outside normal, inside critical
    q = {r["ReadingId"]: r["DerivedQuality"] for r in
         A.flag_quality(readings, A.threshold_table(spark), by="type").collect()}
    assert q["normal"] == "Good" and q["r0"] == "Suspect"


def test_numbers_as_python_prints_them(spark):
    from sensorium.operators.alerts import fmt_number
    values = [0.0005, 12345678.5, 5.0, 12.34, -0.25, 0.0, 1e15, 123456789012345.6, 1e16, 1.5e300, 0.0001, 9.9e-5, 5e-5, -1.25e-7,
              1e7, 123.0, 0.001, 99999999.0, float("nan"), float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(fmt_number(F.col("x"))).collect()] == [repr(v) for v in values]


def test_readings_without_thresholds_keep_their_row(spark):
    from sensorium.operators import alerts as A
    r = spark.createDataFrame([(1, "Unheard", 5.0), (2, "CO2", 500.0)], "ReadingId int, SensorType string, ReadingValue double")
    r = r.withColumn("Timestamp", F.lit("2024-01-01 06:00:00").cast("timestamp"))
    t = A.threshold_table(spark)
    for fn, column in ((A.expected_value, "ExpectedValue"), (A.residual_score, "ResidualScore"), (A.flag_quality, "DerivedQuality"),
                       (A.range_band, "RangeBand")):
        got = {x["ReadingId"]: x[column] for x in fn(r, t, by="type").collect()}
        assert set(got) == {1, 2} and got[1] is None and got[2] is not None, column
