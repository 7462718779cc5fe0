"""The measure layer against a brute-force evaluation of the measure
definitions, on random small snowflakes with unknown sensors, empty sites,
missing quality flags and mixed-case severities."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sensorium.operators.model import SensorModel

T0 = dt.datetime(2024, 1, 1)
SITES = [(1, "A"), (2, "B"), (3, "C")]
ZONES = [(10, "Production", 1), (11, "Storage", 1), (20, "Office", 2), (30, "HVAC", 3)]
SENSORS = [(100, 10), (101, 11), (200, 20), (300, 30)]

reading = st.tuples(st.sampled_from([100, 101, 200, 300, 999]), st.booleans(),
                    st.sampled_from(["Good", "Suspect", None]),
                    st.floats(min_value=0, max_value=100, allow_nan=False).map(lambda v: round(v, 2)))
alert = st.tuples(st.sampled_from([100, 101, 200, 300, 999]),
                  st.sampled_from(["Critical", "CRITICAL", "Warning", "warning", "Info"]))


def site_of(sensor):
    zone = dict(SENSORS).get(sensor)
    site = {z: s for z, _, s in ZONES}.get(zone)
    return dict(SITES).get(site)


def brute(readings, alerts):
    """Per site_name: TotalReadings, AnomalyRate, GoodQualityRate, CriticalAlerts, AlertRate."""
    out = {}
    for key in [n for _, n in SITES] + [None]:
        rs = [r for r in readings if site_of(r[0]) == key]
        al = [a for a in alerts if site_of(a[0]) == key]
        n = len(rs) or None
        anom = sum(1 for r in rs if r[1]) or None
        good = sum(1 for r in rs if r[2] == "Good") or None
        crit = sum(1 for a in al if a[1].upper() == "CRITICAL") or None
        nal = len(al) or None
        rate = (lambda a, b: 0.0 if b is None else (None if a is None else a / b))
        row = {"TotalReadings": n, "AnomalyRate": rate(anom, n), "GoodQualityRate": rate(good, n),
               "CriticalAlerts": crit, "AlertRate": rate(nal, n)}
        is_member = key is not None
        has_facts = bool(rs or al)
        if (is_member or has_facts) and any(v is not None for v in row.values()):
            out[key] = row
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(reading, max_size=25), st.lists(alert, max_size=12))
def test_model_matches_brute_force(spark, readings, alerts):
    r = spark.createDataFrame(
        [(s, a, q, v, T0) for s, a, q, v in readings],
        "SensorId long, IsAnomaly boolean, QualityFlag string, ReadingValue double, "
        "Timestamp timestamp_ntz")
    a = spark.createDataFrame([(s, sev, T0) for s, sev in alerts],
                              "SensorId long, Severity string, Timestamp timestamp_ntz")
    m = SensorModel(
        readings=r, alerts=a,
        dim_sites=spark.createDataFrame(SITES, "site_id int, site_name string"),
        dim_zones=spark.createDataFrame(ZONES, "zone_id int, zone_type string, site_id int"),
        dim_sensors=spark.createDataFrame([(s, f"s{s}", "T", z) for s, z in SENSORS],
                                          "sensor_id long, sensor_name string, sensor_type string, "
                                          "zone_id int"))
    got = {row["site_name"]: {k: row[k] for k in row.asDict() if k != "site_name"}
           for row in m.query(["dim_sites.site_name"],
                              ["Total Readings", "Anomaly Rate", "Good Quality Rate",
                               "Critical Alerts", "Alert Rate"]).collect()}
    want = brute(readings, alerts)
    assert set(got) == set(want)
    for k in want:
        for col, v in want[k].items():
            g = got[k][col]
            assert (g is None and v is None) or abs(g - v) < 1e-12, (k, col, g, v)
