"""Sources, sinks and table management."""

import pytest
from pyspark.sql import functions as F

from sensorium.schemas import DIM_SITES, SENSOR_ALERT
from sensorium.sources import tables as TB


def test_typed_and_inferred_csv_with_quotes(spark, scratch):
    path = f"{scratch}/sites_csv"
    df = spark.createDataFrame(
        [("SITE_001", 'Paris "HQ", main', "IdF", "France", 43.3, 2.3, True)], DIM_SITES)
    TB.write_csv(df, path)
    typed = TB.read_csv(spark, path, DIM_SITES).collect()[0]
    assert typed["site_name"] == 'Paris "HQ", main' and typed["is_active"] is True
    inferred = TB.read_csv(spark, path)
    assert dict(inferred.dtypes)["latitude"] == "double"


def test_write_append_and_counts(spark, scratch):
    path = f"{scratch}/tbl"
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    TB.write_table(df, path)
    TB.append_batch(df, path, chunk_rows=3)
    back = spark.read.parquet(path)
    assert back.count() == 20
    stats = TB.file_stats(back).collect()[0]
    assert stats["row_count"] == 20 and stats["file_count"] >= 4
    v = {r["table_name"]: r for r in TB.verify_tables({"t": back, "u": df}).collect()}
    assert (v["t"]["row_count"], v["t"]["column_count"]) == (20, 2)
    assert {r["table_name"]: r["row_count"] for r in TB.table_counts({"t": back}).collect()} == {"t": 20}
    cols, rows = TB.fetch(back.orderBy("id"), 20)
    assert cols == ["id", "x"] and len(rows) == 20
    with pytest.raises(ValueError, match="more than 3 rows"):
        TB.fetch(back, 3)


def test_expired_days_are_dropped(spark, scratch):
    path = f"{scratch}/days"
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-05"), (3, "2024-01-06")], "x int, d string")
    TB.write_table(df.select("x", F.col("d").cast("date").alias("event_date")), path, partition_by=["event_date"])
    assert TB.drop_expired(spark, path, 3, "2024-01-08") == ["2024-01-01"]
    assert sorted(r["x"] for r in spark.read.parquet(path).collect()) == [2, 3]
    TB.write_table(df, f"{scratch}/undated")
    with pytest.raises(ValueError, match="folders"):
        TB.drop_expired(spark, f"{scratch}/undated", 3, "2024-01-08")


def test_retention_of_a_table_that_ingest_writes(spark, scratch):
    from sensorium.streaming.ingest import append_history, read_table
    rows = spark.range(40).select("id", F.timestamp_seconds(F.col("id") * 43200 + 1704067200).alias("Timestamp"))
    for part in range(3):
        append_history(rows.where(F.col("id") % 3 == part), f"{scratch}/t", f"part{part}", ["event_date"])
    gone = TB.drop_expired(spark, f"{scratch}/t", 7, "2024-01-20")
    assert gone == [f"2024-01-{d:02d}" for d in range(1, 13)]
    assert read_table(spark, f"{scratch}/t").count() == 40 - 24


def test_catalog_registration_of_files(spark, scratch):
    spark.range(4).write.parquet(f"{scratch}/reg")
    spark.sql("DROP TABLE IF EXISTS reg_t")
    TB.register_all(spark, {"reg_t": f"{scratch}/reg"})
    assert spark.newSession().table("reg_t").count() == 4        # another session of the catalog sees it
    spark.sql("DROP TABLE IF EXISTS reg_t")


def test_create_merge_table_adds_columns(spark, scratch):
    name = "sensor_alert_cm"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    narrow = type(SENSOR_ALERT)(SENSOR_ALERT.fields[:5])
    assert TB.create_merge_table(spark, name, narrow, f"{scratch}/cm") == []
    spark.sql(f"INSERT INTO {name} (AlertId, SensorId) VALUES ('a1', 's1')")
    added = TB.create_merge_table(spark, name, SENSOR_ALERT, f"{scratch}/cm")
    assert added == [f.name for f in SENSOR_ALERT.fields[5:]]
    row = spark.table(name).where("AlertId = 'a1'").collect()[0]
    assert row["Message"] is None
    assert TB.create_merge_table(spark, name, SENSOR_ALERT, f"{scratch}/cm") == []
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_shortcut_and_register(spark, scratch):
    path = f"{scratch}/short"
    spark.range(5).write.parquet(path)
    spark.sql("DROP TABLE IF EXISTS short_t")
    assert TB.shortcut(spark, "short_t", path).count() == 5
    assert TB.register_all(spark, {"v_one": spark.range(1)}) == ["v_one"]
    assert spark.table("v_one").count() == 1
    spark.sql("DROP TABLE IF EXISTS short_t")


def test_retention_filter(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 31)
    df = spark.createDataFrame([(t0,), (t0 - dt.timedelta(days=3),), (t0 - dt.timedelta(days=40),)],
                               "Timestamp timestamp_ntz")
    assert TB.apply_retention(df, 7, as_of=F.lit(t0)).count() == 2
    assert TB.apply_retention(df, 7, as_of=t0).count() == 2          # plain datetime
    assert TB.apply_retention(df, 50, as_of=t0).count() == 3


def test_load_dim_and_sensors(spark, scratch):
    from sensorium.operators.hierarchy import build_hierarchy
    src = spark.createDataFrame([(0, "Paris HQ")], "i int, name string")
    _, _, sensors = build_hierarchy(src, "i", "name")
    path = f"{scratch}/dim_sensors_tbl"
    spark.sql("DROP TABLE IF EXISTS dim_sensors_t")
    sensors.write.mode("overwrite").option("path", path).saveAsTable("dim_sensors_t")
    loaded = TB.load_dim(spark, "dim_sensors_t")
    assert loaded.count() == 20
    proj = TB.load_sensors(loaded.withColumn("min_normal", F.col("min_normal").cast("string")))
    assert dict(proj.dtypes)["min_normal"] == "double"
    assert proj.columns == ["sensor_id", "sensor_type", "unit", "zone_id", "site_id",
                            "min_normal", "max_normal", "min_critical", "max_critical"]
    spark.sql("DROP TABLE IF EXISTS dim_sensors_t")
