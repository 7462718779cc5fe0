"""Hierarchy build (S8) against the known configuration output."""

from pyspark.sql import functions as F

from sensorium.operators.hierarchy import build_hierarchy

# The configured sites.
SITE_NAMES = ["Paris HQ", "Lyon Factory", "Marseille Warehouse"]
SITE_REGIONS = ["Île-de-France", "Auvergne-Rhône-Alpes", "Provence-Alpes-Côte d'Azur"]
SITE_COUNTRIES = ["France", "France", "France"]


def test_hierarchy_golden_rows(spark):
    src = spark.createDataFrame(
        [(i, n, r, c) for i, (n, r, c) in enumerate(zip(SITE_NAMES, SITE_REGIONS, SITE_COUNTRIES))],
        "i int, name string, region string, country string")
    sites, zones, sensors = build_hierarchy(src, "i", "name", "region", "country")
    s = {r["site_id"]: r for r in sites.collect()}
    assert sorted(s) == ["SITE_001", "SITE_002", "SITE_003"]
    assert (s["SITE_002"]["latitude"], s["SITE_002"]["longitude"]) == (45.3, 3.8)

    z = {r["zone_id"]: r for r in zones.collect()}
    assert len(z) == 12
    assert z["SITE_001_Z01"]["zone_name"] == "Production - Paris HQ"
    assert z["SITE_001_Z01"]["area_sqm"] == 124.0
    assert z["SITE_001_Z04"]["zone_type"] == "HVAC" and z["SITE_001_Z04"]["floor"] == 2
    assert z["SITE_003_Z04"]["area_sqm"] == 307.0

    n = {r["sensor_id"]: r for r in sensors.collect()}
    assert len(n) == 60
    assert n["SN_0001"]["sensor_name"] == "Temperature Sensor 1"
    assert n["SN_0001"]["zone_id"] == "SITE_001_Z01"
    assert n["SN_0060"]["sensor_type"] == "Vibration"
    assert n["SN_0060"]["zone_id"] == "SITE_003_Z04"
    assert (n["SN_0003"]["min_normal"], n["SN_0003"]["max_critical"]) == (990.0, 1060.0)
    assert str(n["SN_0002"]["install_date"]) == "2024-06-15"


def test_long_numbers_keep_all_their_digits(spark):
    src = spark.range(2000).select(F.col("id").cast("int").alias("i"), F.concat(F.lit("site"), "id").alias("name"))
    sites, zones, sensors = build_hierarchy(src, "i", "name")
    assert sites.select("site_id").distinct().count() == 2000
    assert zones.select("zone_id").distinct().count() == 8000
    assert sensors.select("sensor_id").distinct().count() == 40000
    assert sensors.where("sensor_id = 'SN_40000'").count() == 1


def test_large_hierarchy_is_dealt_out_to_more_tasks_as_it_grows(spark, tmp_path, monkeypatch):
    """One small file of many sites: no task makes or compares more than its share of the ids."""
    import __spark_entry__ as E
    from sensorium.operators import hierarchy as H
    monkeypatch.setattr(H, "SENSORS_PER_TASK", 2000)
    for n, tasks in ((300, 3), (3000, 30)):
        path = f"{tmp_path}/{n}"
        spark.range(n).select(F.col("id").alias("c_custkey"), F.concat(F.lit("c"), "id").alias("c_name")) \
            .coalesce(1).write.parquet(f"{path}/customer.parquet")
        assert H.hierarchy_tasks(n) == tasks
        made = build_hierarchy(H.deal_sites(spark.read.parquet(f"{path}/customer.parquet"), tasks), "c_custkey", "c_name")[2]
        held = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(held) == n * 20 and max(held) <= 2000 + 20
        out = E.queries()["hierarchy_sensors_large"](spark, path)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan and f"RoundRobinPartitioning({tasks})" in plan
        assert f", {tasks}), REPARTITION_BY_NUM" in plan
        assert [tuple(r) for r in out.collect()] == [(n * 20, n * 20, n * 4, n, 8 if n * 20 > 9999 else 7)]


def test_count_ids_skips_nulls_and_repeats(spark):
    from sensorium.operators.hierarchy import count_ids
    schema = "i long, name string"
    for rows, expected in (([(1, "a"), (1, "a"), (1, "b"), (2, None), (None, "c"), (None, None)], (120, 40, 8, 2, 7)),
                           ([(None, "a")], (20, 0, 0, 0, None)), ([], (0, 0, 0, 0, None))):
        out = count_ids(build_hierarchy(spark.createDataFrame(rows, schema), "i", "name")[2], 3)
        assert [tuple(r) for r in out.collect()] == [expected]
        assert [(f.name, f.dataType.simpleString(), f.nullable) for f in out.schema.fields] == [
            ("sensors", "bigint", False), ("sensor_ids", "bigint", False), ("zone_ids", "bigint", False),
            ("site_ids", "bigint", False), ("longest", "int", True)]
