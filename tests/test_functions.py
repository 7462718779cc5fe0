import datetime as dt

from pyspark.sql import functions as F

from sensorium.functions import (
    bin_time, bool_text, clamp, divide, from_iso_text, ieq, kql_ratio, ne_safe, pad_id,
    parse_bool, parse_span, pct, round_stable, sec_of_day, to_iso_text,
)


def one(spark, col):
    return spark.range(1).select(col.alias("v")).collect()[0]["v"]


def test_round_stable_half_away_from_zero(spark):
    assert one(spark, round_stable(F.lit(2.675), 2)) == 2.68
    assert one(spark, round_stable(F.lit(2.15), 1)) == 2.2
    assert one(spark, round_stable(F.lit(-2.675), 2)) == -2.68
    assert one(spark, round_stable(F.lit(0.0), 2)) == 0.0
    assert one(spark, round_stable(F.lit(None).cast("double"), 2)) is None


def test_divide_dax_semantics(spark):
    assert one(spark, divide(F.lit(1), F.lit(0), 0.0)) == 0.0
    assert one(spark, divide(F.lit(1), F.lit(None).cast("int"), 0.0)) == 0.0
    assert one(spark, divide(F.lit(None).cast("int"), F.lit(4), 0.0)) is None
    assert one(spark, divide(F.lit(1), F.lit(4), 0.0)) == 0.25


def test_kql_ratio_and_pct_null_on_zero(spark):
    assert one(spark, kql_ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, pct(F.lit(1), F.lit(0), 2)) is None
    assert one(spark, pct(F.lit(1), F.lit(3), 2)) == 33.33
    assert one(spark, pct(F.lit(2), F.lit(3), 1, scale_first=False)) == 66.7


def test_ne_safe_counts_missing_as_different(spark):
    df = spark.createDataFrame([("Good",), ("Suspect",), (None,)], "q string")
    assert df.where(F.col("q") != "Good").count() == 1
    assert df.where(ne_safe("q", "Good")).count() == 2


def test_ieq_case_insensitive(spark):
    df = spark.createDataFrame([("Critical",), ("CRITICAL",), ("warning",)], "s string")
    assert df.where(ieq("s", "CRITICAL")).count() == 2
    assert df.where(ieq("s", "Warning")).count() == 1


def test_parse_span():
    assert parse_span("15m") == 900
    assert parse_span("1h") == 3600
    assert parse_span("1d") == 86400
    assert parse_span("5 minutes") == 300


def test_bin_time_keeps_type_and_nulls(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 37, 12),), (None,)], "ts timestamp_ntz")
    out = df.select(bin_time("ts", "15m").alias("b"), bin_time("ts", "1h").alias("h"),
                    bin_time("ts", "1d").alias("d"))
    assert dict(out.dtypes)["b"] == "timestamp_ntz"
    rows = out.collect()
    assert rows[0]["b"] == dt.datetime(2024, 1, 1, 10, 30)
    assert rows[0]["h"] == dt.datetime(2024, 1, 1, 10, 0)
    assert rows[0]["d"] == dt.datetime(2024, 1, 1)
    assert rows[1]["b"] is None


def test_iso_text_round_trip(spark):
    ts = dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    df = spark.createDataFrame([(ts,)], "ts timestamp_ntz")
    text = df.select(to_iso_text("ts").alias("t")).collect()[0]["t"]
    assert text == "2024-01-02T03:04:05.123456Z"
    back = spark.createDataFrame([(text,)], "t string").select(
        from_iso_text("t").cast("timestamp_ntz").alias("v")).collect()[0]["v"]
    assert back == ts


def test_bool_text(spark):
    assert one(spark, bool_text(F.lit(True))) == "true"
    assert one(spark, parse_bool(F.lit("FALSE"))) is False
    assert one(spark, parse_bool(F.lit("maybe"))) is None


def test_clamp_pad_sec_of_day(spark):
    assert one(spark, clamp(F.lit(5.0), 1.0, 3.0)) == 3.0
    assert one(spark, pad_id("SN_", F.lit(7), 4)) == "SN_0007"
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 6, 0, 0),)], "ts timestamp_ntz")
    s = df.select(sec_of_day("ts").alias("s"), F.sin(F.lit(6.283185307179586) * sec_of_day("ts")
                                                      / 86400.0).alias("x")).collect()[0]
    assert s["s"] == 21600.0
    assert abs(s["x"] - 1.0) < 1e-12   # the daily sine peaks at 06:00 UTC (N15)


def test_named_queries_pin_utc(spark):
    import __spark_entry__ as E
    from conftest import SF_SMALL
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        rows = E.queries()["mv_readings_daily"](spark, SF_SMALL).collect()
        assert all(r["Timestamp"].hour == 0 for r in rows)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
