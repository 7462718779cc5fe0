"""Answers from how a stored table lies: file footers and day folders.

* ``footers`` reads a table so that counts and extremes come from the Parquet footers
  (aggregate push-down of Spark's v2 reader): no data page is read (G1, G7, S22).
* ``footer_time_range`` has the same for times, whose statistics the reader gives as
  whole numbers only.
* ``latest_stored`` is top N by partition order: the newest days are counted by their
  footers until they hold N rows, and only these are read (O4, O5).
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorium.operators.relational import latest, time_range
from sensorium.streaming.batchlog import BatchTable

_V1_SOURCES = "spark.sql.sources.useV1SourceList"
_PUSH_DOWN = "spark.sql.parquet.aggregatePushdown"


@contextmanager
def _v2_reader(spark: SparkSession):
    """Within it, Parquet is read by the v2 source; frames made here keep it."""
    spark.conf.set(_PUSH_DOWN, "true")  # looked up when a query is planned; the v1 source has no use for it
    before = spark.conf.get(_V1_SOURCES)
    spark.conf.set(_V1_SOURCES, ",".join(s for s in before.split(",") if s.strip().lower() != "parquet"))
    try:
        yield
    finally:
        spark.conf.set(_V1_SOURCES, before)


def footers(spark: SparkSession, *paths: str, schema: T.StructType | None = None, base_path: str | None = None) -> DataFrame:
    """A table whose ungrouped counts, minima and maxima (numbers, dates, booleans) are taken
    from footers.  Grouped ones are, too, if all partition columns are the keys.  Minima and
    maxima need files with the same flat columns, and a ``schema`` that has all of them."""
    with _v2_reader(spark):
        reader = spark.read if schema is None else spark.read.schema(schema)
        return (reader.option("basePath", base_path) if base_path else reader).parquet(*paths)


def footer_time_range(spark: SparkSession, path: str, ts: str, name: str | None = None) -> DataFrame:
    """One row ``min_<name>``, ``max_<name>`` of a time column, from footers.

    Times are kept as whole numbers of microseconds since 1970, and so are their
    statistics.  A file may have another unit (or INT96 without statistics); one stored row
    tells, and then the column is read instead."""
    name = name or ts
    plain = spark.read.parquet(path).select(F.col(ts).alias(name))
    kind = plain.schema[name].dataType
    # All columns in their order: footers' statistics are looked up by a column's place.
    fields = [T.StructField(f.name, T.LongType()) if f.name == ts else f for f in spark.read.parquet(path).schema.fields]
    numbers = footers(spark, path, schema=T.StructType(fields))
    found = numbers.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))

    def time(column: str) -> Column:
        if isinstance(kind, T.TimestampNTZType):
            seconds = f"cast(cast({column} as decimal(20, 0)) / 1000000 as decimal(18, 6))"
            return F.expr(f"timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds})")
        return F.timestamp_micros(column)

    out = found.select(time("lo").alias(f"min_{name}"), time("hi").alias(f"max_{name}"))
    some, range_ = plain.where(F.col(name).isNotNull()).first(), out.first()
    if some is not None and (range_[0] is None or not range_[0] <= some[0] <= range_[1]):
        return time_range(plain, name)
    return out


def newest_days(table: BatchTable, n: int, where: Column | None = None, schema: T.StructType | None = None) -> str | None:
    """The day from which on a day-partitioned table holds ``n`` rows, or None if it holds fewer.
    Days are looked at from the newest backwards, twice as many each time; without a filter
    only their footers are opened."""
    days, held, step = table.days()[::-1], 0, 1
    column = table.partition_by[0]
    keys = [*table.partition_by, "_source", "_batch"]
    while days:
        part, days = days[:step], days[step:]
        step *= 2
        if where is None:
            paths = [f"{table.root}/{column}={d}" for d in part]
            per_folder = footers(table.spark, *paths, base_path=table.root).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
            counts = per_folder.groupBy(F.col(column).cast("string").alias("day")).agg(F.sum("rows").alias("rows"))
        else:
            rows = table.read(schema, (part[-1], part[0])).where(where)
            counts = rows.groupBy(F.col(column).cast("string").alias("day")).agg(F.count(F.lit(1)).alias("rows"))
        found = {r["day"]: r["rows"] for r in counts.collect()}  # a row per day looked at
        for day in part:
            held += found.get(day, 0)
            if held >= n:
                return day
    return None


def latest_stored(table: BatchTable, n: int, ts: str = "Timestamp", tie_break: list[str] | None = None,
                  where: Column | None = None, schema: T.StructType | None = None) -> DataFrame:
    """The ``n`` latest rows (of those ``where`` holds), equal to ``latest`` of the whole
    table: ties at the end lie in one day, as the day is taken from the time."""
    first = newest_days(table, n, where, schema)
    rows = table.read(schema, None if first is None else (first, None))
    return latest(rows if where is None else rows.where(where), n, ts, tie_break)
