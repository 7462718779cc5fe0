"""Helpers shared by the operators: written intermediate tables, checked
broadcasts, white space."""

from __future__ import annotations

import atexit
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorium.session import checkpoint_root, remove_path

#: White space that separates words, as a character class body (Java, Python and RE2 alike).
SPACE = r"\x20\x09-\x0D"
#: The same characters as a plain string.
SPACE_CHARS = " \t\n\x0b\x0c\r"

#: Rows of whole texts that go to a Python worker at once, while ``materialise`` writes.
BATCH_ROWS = 1000
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

_WRITTEN: dict[str, list[str]] = {}


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage: what follows reads files that every executor sees, so a
    lost executor costs only its running tasks.  ``release`` removes the
    tables; it also runs when the driver's Python ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"
    app = spark.sparkContext.applicationId
    if app not in _WRITTEN:
        atexit.register(release, spark)
    _WRITTEN.setdefault(app, []).append(path)
    before = spark.conf.get(_BATCH_ROWS)
    spark.conf.set(_BATCH_ROWS, str(min(int(before), BATCH_ROWS)))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)


def written(spark: SparkSession) -> list[str]:
    """Paths of the tables that ``materialise`` wrote in this session and that are still there."""
    return list(_WRITTEN.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, paths: list[str] | None = None, keep: DataFrame | None = None) -> None:
    """Remove the tables that ``materialise`` wrote in this session (or those of ``paths``),
    but for those that ``keep`` reads.  Call it when the results built on them
    have been stored."""
    context = spark.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    known = _WRITTEN.get(context.applicationId, [])
    read = keep.inputFiles() if keep is not None else []
    for path in list(known) if paths is None else paths:
        name = path.rsplit("/", 1)[-1]  # unique
        if path in known and not any(f"/{name}/" in f for f in read):
            known.remove(path)
            remove_path(spark, path)


def broadcast_checked(table: DataFrame, max_rows: int) -> tuple[DataFrame, bool]:
    """``table`` with a broadcast hint if it has at most ``max_rows`` rows, and
    whether it has.  Counts the whole table, so hand in a written one."""
    small = table.count() <= max_rows
    return (F.broadcast(table) if small else table), small


def words(text: Column) -> Column:
    """The words of a text: maximal runs without white space; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workers_see_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.  On a
    cluster whose nodes don't, submit it with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with a function of this package."""
    workers_see_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def whole_row(df: DataFrame, columns: list[str] | None = None) -> Column:
    """All (or these) columns as one struct, so that no helper column can clash with them."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in columns or df.columns])


def salted(key: Column, copies: int) -> Column:
    """A salt in [0, copies) that depends on the row's key alone, so a task that
    runs again deals its rows alike."""
    return F.pmod(F.xxhash64(key), F.lit(copies)).cast("int")
