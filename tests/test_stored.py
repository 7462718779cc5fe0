"""Answers from stored partials, footers and day folders equal those of the raw rows."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from plan_metrics import output_rows
from sensorium.operators import relational as R
from sensorium.operators.joins import key_ranges
from sensorium.operators.model import ALL_MEASURES, SensorModel
from sensorium.operators.navigate import Lattice
from sensorium.plans.context import Ctx
from sensorium.plans.views import LATTICE_BASE, VIEWS, Agg, ViewDef
from sensorium.sources.dimensions import VersionedDimension, join_bucketed
from sensorium.sources.stored import footer_time_range, footers, latest_stored, newest_days
from sensorium.streaming.batchlog import BatchTable, children
from sensorium.streaming.incremental import IncrementalView
from sensorium.streaming.ingest import READING_TABLE, Ingest, alert_handler, await_batches, event_stream, to_events


@pytest.fixture(scope="module")
def ctx(spark):
    return Ctx(spark, SF_SMALL)


def rows_of(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def scanned(df):
    return df._jdf.queryExecution().toString()


_COUNT, _AVG = Agg("n", "count"), Agg("v", "avg", lambda: F.col("ReadingValue"))


@pytest.mark.parametrize("name", [n for n, v in VIEWS.items() if v.source == "readings"])
def test_views_fold_from_one_store(ctx, name):
    df = ctx.lattice.answer(VIEWS[name])
    assert "events.parquet" not in scanned(df) and "readings_hourly" in scanned(df)
    assert rows_of(df) == rows_of(VIEWS[name].compute(ctx.readings))


@pytest.mark.parametrize("want,filters,time_range", [
    (ViewDef("a", "readings", None, (), (_COUNT, _AVG)), {}, None),
    (ViewDef("b", "readings", "1d", ("SiteId",), (_COUNT,)), {"SensorType": ["Temperature", "CO2"]}, None),
    (ViewDef("c", "readings", "4h", ("SensorType",), (_AVG,)), {"SiteId": 1}, (dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 9))),
    (ViewDef("d", "readings", None, ("SiteId",), (_COUNT,)), {}, (None, dt.datetime(2024, 1, 9))),
])
def test_covered_questions(ctx, want, filters, time_range):
    df = ctx.lattice.answer(want, filters, time_range)
    assert "events.parquet" not in scanned(df)
    raw = Lattice([], lambda: ctx.readings).answer(want, filters, time_range)
    assert "events.parquet" in scanned(raw) and rows_of(df) == rows_of(raw) != []


@pytest.mark.parametrize("want,filters,time_range", [
    (ViewDef("bin", "readings", "15m", ("SiteId",), (_COUNT,)), {}, None),                       # finer bins
    (ViewDef("odd", "readings", "90m", ("SiteId",), (_COUNT,)), {}, None),                       # no multiple of an hour
    (ViewDef("key", "readings", None, ("SensorId",), (_COUNT,)), {}, None),                      # another key
    (ViewDef("agg", "readings", None, (), (Agg("s", "max", lambda: F.col("SensorId")),)), {}, None),
    (ViewDef("flt", "readings", None, (), (_COUNT,)), {"QualityFlag": "Good"}, None),            # a filter on no key
    (ViewDef("cut", "readings", None, (), (_COUNT,)), {}, (dt.datetime(2024, 1, 5, 7, 30), None)),  # within a bin
])
def test_uncovered_questions_go_to_the_rows(ctx, want, filters, time_range):
    df = ctx.lattice.answer(want, filters, time_range)
    assert "events.parquet" in scanned(df)
    assert rows_of(df) == rows_of(Lattice([], lambda: ctx.readings).answer(want, filters, time_range))


def test_the_coarsest_store_answers(spark, ctx, scratch):
    daily = ViewDef("daily", "readings", "1d", ("SiteId",), (_COUNT,))
    total = ViewDef("total", "readings", None, ("SiteId",), (_COUNT,))
    stores = {v.name: IncrementalView(spark, v, f"{scratch}/{v.name}") for v in (LATTICE_BASE, daily, total)}
    lattice = Lattice(list(stores.values()), lambda: ctx.readings)
    by_site = ViewDef("q", "readings", None, ("SiteId",), (_COUNT,))
    assert lattice.pick(by_site) is stores["total"]
    assert lattice.pick(by_site, days=("2024-01-01", None)) is stores["daily"]
    assert lattice.pick(ViewDef("q", "readings", "1d", ("SiteId",), (_COUNT,))) is stores["daily"]
    assert lattice.pick(by_site, ["SensorType"]) is stores[LATTICE_BASE.name]
    assert lattice.pick(ViewDef("q", "alerts", None, ("SiteId",), (_COUNT,))) is None


def test_measures_from_stored_pieces(ctx):
    raw, stored = ctx.model, ctx.stored_model
    site, ztype, stype = "dim_sites.site_name", "dim_zones.zone_type", "dim_sensors.sensor_type"
    for args in [dict(group_by=[], measures=ALL_MEASURES), dict(group_by=[site], measures=ALL_MEASURES),
                 dict(group_by=[stype], measures=["Worst Zone Quality", "Alert Rate"]),
                 dict(group_by=[ztype], measures=["Avg Reading Value", "Critical Alerts"], filters={site: "ASIA"}),
                 dict(group_by=[site], measures=["Total Readings"], time_range=(dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 9)))]:
        df = stored.query(**args)
        assert "events.parquet" not in scanned(df) and "orders.parquet" not in scanned(df)
        assert rows_of(df) == rows_of(raw.query(**args))
    for args in [dict(group_by=[site], measures=["Total Readings"], filters={"readings.QualityFlag": "Good"}),
                 dict(group_by=[site], measures=["Total Readings"], time_range=(dt.datetime(2024, 1, 3, 5), None))]:
        df = stored.query(**args)
        assert "events.parquet" in scanned(df) and rows_of(df) == rows_of(raw.query(**args))
    assert isinstance(stored, SensorModel) and not raw.stored


def test_footers(spark, ctx, scratch):
    for kind in ("timestamp_ntz", "timestamp"):
        rows = ctx.readings_plain.select("ReadingId", F.col("Timestamp").cast(kind).alias("Timestamp"))
        before = spark.conf.get("spark.sql.parquet.outputTimestampType")
        for unit in ("TIMESTAMP_MICROS", "TIMESTAMP_MILLIS"):
            spark.conf.set("spark.sql.parquet.outputTimestampType", unit)
            rows.write.parquet(f"{scratch}/{kind}-{unit}")
            spark.conf.set("spark.sql.parquet.outputTimestampType", before)
            got = footer_time_range(spark, f"{scratch}/{kind}-{unit}", "Timestamp")
            stored = spark.read.parquet(f"{scratch}/{kind}-{unit}")
            assert got.columns == ["min_Timestamp", "max_Timestamp"] and rows_of(got) == rows_of(R.time_range(stored))
    spark.createDataFrame([], rows.schema).write.parquet(f"{scratch}/empty")
    assert footer_time_range(spark, f"{scratch}/empty", "Timestamp").collect()[0][0] is None
    assert footers(spark, f"{scratch}/empty").count() == 0
    assert spark.read.parquet(f"{scratch}/empty")._jdf.queryExecution().toString().count("BatchScan") == 0  # as before


def test_latest_from_the_newest_days(spark, scratch):
    rows = spark.range(0, 300).select("id", F.timestamp_seconds(F.floor(F.col("id") / 3) * 8640 + 1704067200).alias("Timestamp"),
                                      (F.col("id") % 7).alias("k")).withColumn("event_date", F.to_date("Timestamp"))
    rows = rows.unionByName(rows.where("id < 5").withColumn("Timestamp", F.lit(None).cast("timestamp")).withColumn(
        "event_date", F.lit(None).cast("date"))).persist()
    t = BatchTable(spark, f"{scratch}/t", ["event_date"])
    for i in range(3):
        t.write(rows.where(F.col("id") % 3 == i), i, "q")
    schema = rows.drop("event_date").schema
    for n in (1, 2, 29, 30, 31, 77, 299, 300, 303, 1000):
        got, want = latest_stored(t, n, tie_break=["id"], schema=schema), R.latest(rows, n, tie_break=["id"])
        assert rows_of(got.select("id", "Timestamp")) == rows_of(want.select("id", "Timestamp")), n
    assert newest_days(t, 1) == t.days()[-1] and newest_days(t, 300) == t.days()[0] and newest_days(t, 301) is None
    got = latest_stored(t, 4, tie_break=["id"], schema=schema)
    assert {f.split("event_date=")[1][:10] for f in got.inputFiles()} == {t.days()[-1]}
    only = F.col("k") == 3
    got = latest_stored(t, 9, tie_break=["id"], where=only, schema=schema)
    assert rows_of(got.select("id")) == rows_of(R.latest(rows.where(only), 9, tie_break=["id"]).select("id"))


def test_bucketed_join_exchanges_no_fact(spark, ctx):
    readings, sensors = ctx.bucketed()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = join_bucketed(readings, sensors, "SensorId", "sensor_id")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
        assert df.count() == ctx.readings_plain.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_dimension_is_replaced_while_a_stream_runs(spark, ctx, scratch):
    """Thresholds change between micro-batches of one running query; each batch keeps to one version,
    also when it is replayed."""
    readings = ctx.readings.where("SensorType = 'Temperature'").limit(40).persist()
    dimension = VersionedDimension(spark, f"{scratch}/limits", keep=2)
    with pytest.raises(ValueError):
        dimension.read()
    limits = ctx.thresholds
    low, high = limits.withColumn("min_normal", F.lit(-1e9)), limits.withColumn("min_normal", F.lit(1e9))
    assert dimension.write(low) == 0
    anomalies = readings.withColumn("IsAnomaly", F.lit(True))
    handle = alert_handler(dimension, f"{scratch}/alerts")
    events, stream_dir = to_events(anomalies), f"{scratch}/in"
    part = lambda i: events.where(F.pmod(F.xxhash64("value"), F.lit(2)) == i)
    seen = []

    def note(rows, batch_id, source):
        seen.append((batch_id, rows.count()))

    ingest = Ingest(schemas={READING_TABLE: ctx.readings.schema}, handlers={READING_TABLE: [handle, note]})
    part(0).coalesce(1).write.mode("append").text(stream_dir)
    q = ingest.start(event_stream(spark, stream_dir), f"{scratch}/ck", trigger="200 milliseconds")
    try:
        assert await_batches(q, 1)
        dimension.write(high)
        part(1).coalesce(1).write.mode("append").text(stream_dir)
        assert await_batches(q, 2)
    finally:
        q.stop()
    (b0, n0), (b1, n1) = seen
    assert n0 + n1 == 40 and min(n0, n1) > 0
    alerts = BatchTable(spark, f"{scratch}/alerts").read(keys=True).groupBy("_batch", "AlertType").count().collect()
    assert {(r["_batch"], r["AlertType"]): r["count"] for r in alerts} == {(b0, "AboveThreshold"): n0, (b1, "BelowThreshold"): n1}
    # A replay of the second batch after another change meets the version it met first.
    dimension.write(low)
    source, = [n for n in children(spark, f"{scratch}/limits/_pins")]
    assert dimension.for_batch(b1, source).where("min_normal = 1e9").count() == limits.count()
    assert dimension.for_batch(b1 + 1, source).where("min_normal = 1e9").count() == 0
    dimension.write(low)
    with pytest.raises(ValueError, match="gone"):
        dimension.for_batch(b1, source)


def test_key_ranges(spark):
    import random
    rng = random.Random(2)
    assert key_ranges(spark.createDataFrame([], "k long"), "k") == []
    assert key_ranges(spark.createDataFrame([(None,), (5,)], "k long"), "k") == [(5, 5)]
    for keys in ([3, 4, 5, 100, 101, 900], rng.sample(range(10**9), 300), list(range(50)), [-7, 2**62]):
        for most in (1, 2, 10):
            ranges = key_ranges(spark.createDataFrame([(k,) for k in keys], "k long"), "k", most)
            assert 1 <= len(ranges) <= most and all(any(a <= k <= b for a, b in ranges) for k in keys)
            assert all(b < c for (_, b), (c, _) in zip(ranges, ranges[1:])) and all(a in keys and b in keys for a, b in ranges)
    assert key_ranges(spark.createDataFrame([(k,) for k in (3, 4, 5, 100, 101, 900)], "k long"), "k", 3) == [(3, 5), (100, 101), (900, 900)]


def test_dimension_filters_skip_rows_of_a_clustered_fact(spark, scratch):
    """Two zones of twenty: the scan of the stored fact gives out little more than their sensors' rows."""
    rows = spark.range(0, 400_000, numPartitions=4).select(
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("SensorId"), F.timestamp_seconds(F.col("id") % 86400 + 1704067200).alias("Timestamp"),
        F.rand(3).alias("ReadingValue"), F.lit("Good").alias("QualityFlag"), F.lit(False).alias("IsAnomaly"))
    table = BatchTable(spark, f"{scratch}/clustered", ["event_date"], ["SensorId"])
    table.write(rows.withColumn("event_date", F.to_date("Timestamp")), 0, "q")
    sensors = spark.range(1000).select(F.col("id").alias("sensor_id"), F.floor(F.col("id") / 50).alias("zone_id"))
    zones = spark.range(20).select(F.col("id").alias("zone_id"), F.concat(F.lit("z"), "id").alias("zone_name"), F.lit(1).alias("site_id"))
    sites = spark.createDataFrame([(1, "s")], "site_id int, site_name string")
    plain = SensorModel(table.read(), rows.limit(0), sites, zones, sensors)
    clustered = replace(plain, clustered=("readings",))
    ask = dict(group_by=["dim_zones.zone_name"], measures=["Total Readings"], filters={"dim_zones.zone_name": ["z3", "z11"]})
    df = clustered.query(**ask)
    assert rows_of(df) == rows_of(plain.query(**ask)) and df.count() == 2
    everything, few = max(output_rows(plain.query(**ask))), max(output_rows(df))
    assert everything == 400_000 and few < 150_000
    assert clustered.query(**{**ask, "filters": {"dim_zones.zone_name": "nowhere"}}).count() == 0
