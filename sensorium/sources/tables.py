"""Batch sources, sinks and table management.

Formats are a parameter (Parquet by default; Delta, ORC or JSON when the
cluster has them).  Table-level statistics are one-row aggregates unioned
together: a check over many tables is one Spark job (one scan per table), and
nothing but the final numbers reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorium.operators.relational import as_of_max


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             header: bool = True, **options) -> DataFrame:
    """Typed CSV scan (S1), or inferred when ``schema`` is None.

    A doubled quote inside a quoted field is read as one quote (S10).
    """
    reader = (spark.read.option("header", str(header).lower())
              .option("quote", '"').option("escape", '"'))
    for k, v in options.items():
        reader = reader.option(k, v)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                partition_by: list[str] | None = None, max_records_per_file: int | None = None) -> None:
    """Table sink (S3, S11 with ``mode="append"``).  Overwriting replaces the whole
    table, partitioned or not."""
    w = df.write.mode(mode).format(fmt).option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.save(path)


def append_batch(df: DataFrame, path: str, chunk_rows: int | None = None, fmt: str = "parquet",
                 partition_by: list[str] | None = None) -> None:
    """Append a batch (S11); ``chunk_rows`` bounds the rows per output file."""
    write_table(df, path, mode="append", fmt=fmt, partition_by=partition_by,
                max_records_per_file=chunk_rows)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV sink with header (S7); quotes inside text are doubled."""
    (df.write.mode(mode).option("header", "true").option("quote", '"')
     .option("escape", '"').csv(path))


def load_dim(spark: SparkSession, name: str) -> DataFrame:
    """Catalog scan ``SELECT * FROM name``."""
    return spark.table(name)


def load_sensors(sensors: DataFrame) -> DataFrame:
    """Projecting scan with the thresholds as doubles."""
    return sensors.select(
        "sensor_id", "sensor_type", "unit", "zone_id", "site_id",
        *[F.col(c).cast("double").alias(c)
          for c in ("min_normal", "max_normal", "min_critical", "max_critical")])


def _one_row(name: str, df: DataFrame, with_columns: bool) -> DataFrame:
    cols = [F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")]
    if with_columns:
        cols.append(F.lit(len(df.columns)).alias("column_count"))
    return df.agg(*cols[1:]).select(cols[0], "*")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, one row each."""
    parts = [_one_row(n, df, False) for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def verify_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per table."""
    parts = [_one_row(n, df, True) for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def file_stats(df: DataFrame) -> DataFrame:
    """Storage statistics of a file-based table (S21): number of files, rows,
    oldest and newest file modification time."""
    meta = df.select(F.col("_metadata.file_path").alias("p"),
                     F.col("_metadata.file_modification_time").alias("m"))
    return meta.agg(F.count_distinct("p").alias("file_count"),
                    F.count(F.lit(1)).alias("row_count"),
                    F.min("m").alias("min_created"), F.max("m").alias("max_created"))


def apply_retention(df: DataFrame, days: int, as_of=None, ts: str = "Timestamp",
                    date_col: str | None = "event_date") -> DataFrame:
    """Rows younger than ``days`` relative to ``as_of`` (S20), as a read filter.

    ``as_of``: a Column or literal; ``"max"`` = the table's latest time; default now.
    On a table partitioned by ``date_col`` the filter prunes whole partitions;
    ``drop_expired`` removes them from storage.
    """
    if isinstance(as_of, str) and as_of == "max":
        cut = as_of_max(df, ts, days * 86400)
    else:
        anchor = F.current_timestamp() if as_of is None else as_of if isinstance(as_of, Column) else F.lit(as_of)
        cut = anchor - F.make_dt_interval(days=F.lit(days))
    out = df.where(F.col(ts) >= cut)
    if date_col and date_col in df.columns:
        out = out.where(F.col(date_col) >= F.to_date(cut))
    return out


def create_merge_table(spark: SparkSession, name: str, schema: T.StructType, location: str,
                       fmt: str = "parquet") -> list[str]:
    """Create the table if missing, else add the columns it lacks.

    Existing columns are never changed or dropped; rows written before read
    the new columns as missing.  Returns the added column names.
    """
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING {fmt} LOCATION '{location}'")
    have = {f.name.lower() for f in spark.table(name).schema.fields}
    missing = [f for f in schema.fields if f.name.lower() not in have]
    if missing:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({cols})")
    return [f.name for f in missing]


def shortcut(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
             schema: T.StructType | None = None) -> DataFrame:
    """Zero-copy table over existing files (S16): no data is moved.  ``schema`` says
    which columns to read where the files don't all have the same."""
    columns = "(" + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields) + ") " if schema else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} {columns}USING {fmt} LOCATION '{path}'")
    return spark.table(name)


def register_all(spark: SparkSession, tables: dict[str, DataFrame | str], fmt: str = "parquet") -> list[str]:
    """Named access for BI tools (S18).  A path becomes a catalog table over its
    files, which other sessions of the catalog see; a DataFrame a temp view of
    this session."""
    for n, t in tables.items():
        if isinstance(t, str):
            shortcut(spark, n, t, fmt)
        else:
            t.createOrReplaceTempView(n)
    return sorted(tables)


def drop_expired(spark: SparkSession, path: str, days: int, as_of: str, date_col: str = "event_date") -> list[str]:
    """Remove the day folders of a table that are older than ``days`` before the date
    ``as_of`` (S20 as storage).  Returns their dates.  ``path`` is the root of a table whose
    outermost folders are ``date_col=…``, as ingest writes them; any other raises."""
    from datetime import date, timedelta

    from sensorium.session import remove_path
    from sensorium.streaming.batchlog import children
    cut = date.fromisoformat(as_of) - timedelta(days=days)
    dated = [n.partition("=")[2] for n in children(spark, path) if n.startswith(f"{date_col}=")]
    if not dated:
        raise ValueError(f"{path} has no {date_col}=… folders")
    gone = [d for d in dated if d != "__HIVE_DEFAULT_PARTITION__" and date.fromisoformat(d) < cut]
    for day in gone:
        remove_path(spark, f"{path.rstrip('/')}/{date_col}={day}")
    return gone


def fetch(df: DataFrame, max_rows: int = 1000) -> tuple[list[str], list[tuple]]:
    """A small result to the client as (columns, rows) (S23).  A result of more
    than ``max_rows`` rows raises; nothing is cut silently."""
    rows = [tuple(r) for r in df.limit(max_rows + 1).collect()]
    if len(rows) > max_rows:
        raise ValueError(f"the result has more than {max_rows} rows")
    return df.columns, rows
