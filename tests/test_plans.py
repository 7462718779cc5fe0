"""Plan checks: pushed filters, pruned columns, broadcast of fixed-size
dimensions, partial aggregation, top-n without a global sort."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from plan_metrics import output_rows


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def q():
    return E.queries()


def test_filter_pushed_to_scan(spark, q):
    from sensorium.plans.context import Ctx
    f = formatted(Ctx(spark, SF_SMALL).readings_plain.where("ReadingValue > 150"))
    assert "GreaterThan(value,150.0)" in f


def test_located_view_shuffles_once(spark, q):
    """With broadcast locations the raw rows are located first: one exchange, of bins by sites."""
    p = plan(q["mv_readings_hourly"](spark, SF_SMALL))
    assert p.count("Exchange hashpartitioning") == 1


def test_columns_pruned(spark, q):
    f = formatted(q["tile_avg_temperature"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_type:string,value:double>" in f


def test_two_phase_aggregate(spark, q):
    p = plan(q["mv_readings_hourly"](spark, SF_SMALL))
    assert "partial_count" in p or "partial_" in p


def test_top_n_without_global_sort(spark, q):
    f = formatted(q["tile_top10_sensors"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in f


def test_fixed_dimensions_broadcast(spark, q):
    f = formatted(q["tile_anomaly_rate_by_site"](spark, SF_SMALL))
    assert "BroadcastExchange" in f


def test_drill_across_never_joins_facts(spark, q):
    f = formatted(q["fs_rate_by_site"](spark, SF_SMALL))
    assert "Union" in f
    assert "CartesianProduct" not in f and "BroadcastNestedLoopJoin" not in f
    # The two facts are pre-aggregated by sensor before any join.
    assert f.count("Scan parquet") >= 2


def test_no_cartesian_anywhere(spark, q):
    for name in ("fs_top5_anomaly_sensors", "fs_top_alert_site", "rpt_cards",
                 "measures_overview", "hierarchy_sensors"):
        f = formatted(q[name](spark, SF_SMALL))
        assert "CartesianProduct" not in f, name
        assert "BroadcastNestedLoopJoin" not in f, name


def _scans(f: str, table: str) -> int:
    return sum(1 for line in f.splitlines()
               if line.startswith("Location:") and f"{table}.parquet" in line)


def test_one_scan_per_fact(spark, q):
    f = formatted(q["measures_overview"](spark, SF_SMALL))
    assert _scans(f, "events") == 1 and _scans(f, "orders") == 1
    f = formatted(q["fs_rate_by_site"](spark, SF_SMALL))
    assert _scans(f, "events") == 1 and _scans(f, "orders") == 1
    f = formatted(q["mv_readings_hourly"](spark, SF_SMALL))
    assert _scans(f, "events") == 1


def test_since_prunes_date_partitions(spark, scratch):
    from pyspark.sql import functions as F

    from sensorium.operators.relational import since
    from sensorium.plans.context import Ctx
    from sensorium.streaming.batchlog import BatchTable
    r = Ctx(spark, SF_SMALL).readings_plain.withColumn("event_date", F.to_date("Timestamp"))
    t = BatchTable(spark, f"{scratch}/readings", partition_by=["event_date"])
    t.write(r, 0)
    recent = since(t.read(), "1h", as_of=F.lit("2024-01-30 12:00:00").cast("timestamp_ntz"))
    f = formatted(recent)
    scan = [line for line in f.splitlines() if line.startswith("PartitionFilters:")]
    assert scan and "event_date" in scan[0]
    assert recent.count() == r.where(
        (F.col("Timestamp") > F.lit("2024-01-30 11:00:00").cast("timestamp_ntz"))).count()


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "FlatMapCoGroupsInPandas", "PythonUDF", "AggregateInPandas")
EAGER = ("stream_", "bucketed_", "clustered_", "dims_csv_roundtrip", "mv_served_", "lattice_", "stored_", "retention_stream_table", "refreshed_tiles")


def test_no_python_in_any_query_plan(spark, q):
    for name, fn in sorted(q.items()):
        if name.startswith(EAGER):
            continue
        f = formatted(fn(spark, SF_SMALL))
        assert not any(node in f for node in PYTHON_NODES), name


@pytest.mark.parametrize("name", ["tile_total_readings", "tile_total_alerts", "diag_time_range", "table_counts"])
def test_counts_and_extremes_come_from_footers(spark, q, name):
    f = formatted(q[name](spark, SF_SMALL))
    assert "PushedAggregation" in f and "PushedAggregation: []" not in f


def test_recent_queries_skip_row_groups(spark, tmp_path):
    """The bound of a relative-time query is one value to the scan, so row groups out of it aren't read."""
    from pyspark.sql import functions as F

    from sensorium.plans import queries as Q
    rows = spark.range(0, 400_000).select(F.col("id").alias("event_id"), (F.col("id") % 50).alias("user_id"),
                                          F.timestamp_seconds(F.col("id") + 1704067200).alias("ts"),
                                          F.lit("temp").alias("event_type"), F.lit(1.0).alias("value"))
    before = spark.conf.get("spark.sql.parquet.outputTimestampType")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    rows.coalesce(1).write.option("parquet.block.size", 256 << 10).parquet(f"file://{tmp_path}/events.parquet")
    spark.conf.set("spark.sql.parquet.outputTimestampType", before)
    df = Q.REGISTRY["live_count_5m"](spark, f"file://{tmp_path}")
    assert df.collect()[0][0] == 300
    read = [m for m in output_rows(df) if m > 0]
    assert max(read) >= 300 and sum(1 for m in read if m < 100_000) >= 1

