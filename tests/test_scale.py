"""Scale behaviour on small inputs: the broadcast bound falls back to a
shuffle join with equal results, and a hot sensor holding a third of all rows
is folded by partial aggregation before any shuffle."""

import contextlib
import datetime as dt
import io

from pyspark.sql import functions as F

from sensorium.operators import joins
from sensorium.operators.model import SensorModel

T0 = dt.datetime(2024, 1, 1)


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def make_model(spark, max_bytes):
    n = 3000
    sites = spark.createDataFrame([(i, f"S{i}") for i in range(3)], "site_id int, site_name string")
    zones = spark.createDataFrame([(i, ["Production", "Storage"][i % 2], i % 3) for i in range(12)],
                                  "zone_id int, zone_type string, site_id int")
    sensors = spark.range(300).select(F.col("id").alias("sensor_id"),
                                      F.concat(F.lit("s"), F.col("id").cast("string")).alias("sensor_name"),
                                      F.lit("Temperature").alias("sensor_type"),
                                      (F.col("id") % 12).cast("int").alias("zone_id"))
    # Sensor 0 holds a third of all readings.
    readings = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 300).alias("SensorId"),
        (F.col("id") % 7 == 0).alias("IsAnomaly"),
        F.lit("Good").alias("QualityFlag"),
        (F.col("id") % 100).cast("double").alias("ReadingValue"),
        F.lit(T0).cast("timestamp_ntz").alias("Timestamp"))
    alerts = readings.where("IsAnomaly").select("SensorId", F.lit("Critical").alias("Severity"),
                                                 "Timestamp")
    return SensorModel(readings=readings, alerts=alerts, dim_sites=sites, dim_zones=zones,
                       dim_sensors=sensors, broadcast_max_bytes=max_bytes)


def test_broadcast_bound_falls_back_with_equal_results(spark):
    measures = ["Total Readings", "Anomaly Rate", "Alert Rate"]
    small = make_model(spark, joins.MAX_SOURCE_BYTES).query(["dim_sites.site_name"], measures)
    bounded = make_model(spark, 10)          # any dimension is larger: no broadcast hint
    big = bounded.query(["dim_sites.site_name"], measures)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, big.collect()))
    # Without a proof and without the planner's own size-based broadcast, the
    # sensor join is a shuffle join.
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = formatted(bounded.query(["dim_sensors.sensor_name"], ["Total Readings"]))
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_hot_sensor_is_pre_aggregated(spark):
    m = make_model(spark, joins.MAX_SOURCE_BYTES)
    df = m.query(["dim_sites.site_name"], ["Total Readings"])
    plan = formatted(df)
    # The fact side is aggregated per sensor (partial + final) before the join.
    assert "partial_count" in plan
    total = sum(r["TotalReadings"] for r in df.collect())
    assert total == 3000
    hot = m.query(["dim_sensors.sensor_name"], ["Total Readings"], base="readings") \
        .where(F.col("sensor_name") == "s0").collect()[0]
    assert hot["TotalReadings"] == 1000


def test_size_proof_runs_no_job(spark, tmp_path):
    path = f"file://{tmp_path}/dim"
    spark.range(1000).write.parquet(path)
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None) or [])
    df = spark.read.schema("id long").parquet(path)
    assert 0 < joins.source_bytes(df) < 100_000
    hinted, plain = joins.broadcast_if_small(df), joins.broadcast_if_small(df, 10)
    assert "broadcast" in hinted._jdf.queryExecution().logical().toString()
    assert "broadcast" not in plain._jdf.queryExecution().logical().toString()
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None) or []) == before


def test_no_job_runs_while_a_query_is_built(spark):
    import __spark_entry__ as E
    tracker = spark.sparkContext.statusTracker()
    for name in ("mv_readings_hourly", "fs_rate_by_site", "alerts_derived", "tile_top10_sensors"):
        E.queries()[name](spark, "/root/testdata/sf0.001")       # footers are read once
        before = len(tracker.getJobIdsForGroup(None) or [])
        E.queries()[name](spark, "/root/testdata/sf0.001")
        assert len(tracker.getJobIdsForGroup(None) or []) == before, name


def test_scratch_is_removed(spark):
    from sensorium.session import release_scratch, scratch_path
    from sensorium.streaming.batchlog import exists
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(f"{path}/t")
    assert exists(spark, path)
    release_scratch(spark)
    assert not exists(spark, path)


def test_partitioned_overwrite_replaces_the_table(spark, tmp_path):
    from sensorium.sources import tables as TB
    path = f"file://{tmp_path}/t"
    TB.write_table(spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "x int, p string"), path, partition_by=["p"])
    TB.write_table(spark.createDataFrame([(9, "b")], "x int, p string"), path, partition_by=["p"])
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(9, "b")]


def test_recent_rows_prune_days_and_row_groups(spark, tmp_path):
    """The last minutes of a stream-written table: one day's folder, and of it only the row groups in time."""
    from sensorium.operators import relational as R
    from sensorium.streaming.batchlog import BatchTable
    before = spark.conf.get("spark.sql.parquet.outputTimestampType")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    try:
        rows = spark.range(0, 40_000).select("id", F.timestamp_seconds(F.col("id") * 8 + 1704067200).alias("Timestamp"))
        rows = rows.withColumn("event_date", F.to_date("Timestamp"))
        t = BatchTable(spark, f"file://{tmp_path}/t", ["event_date"])
        for i in range(4):
            part = rows.where((F.col("id") >= 10_000 * i) & (F.col("id") < 10_000 * (i + 1)))
            t.write(part.sortWithinPartitions("Timestamp"), i, "q")
        recent = R.since(t.read(), "5m", as_of="max")
        assert recent.count() == 38
        plan = recent._jdf.queryExecution().executedPlan().toString()
        assert any("event_date" in x.split("]")[0] for x in plan.split("PartitionFilters: [")[1:])
        assert "GreaterThan(Timestamp," in plan or "PushedFilters: [IsNotNull(Timestamp)" in plan
    finally:
        spark.conf.set("spark.sql.parquet.outputTimestampType", before)
