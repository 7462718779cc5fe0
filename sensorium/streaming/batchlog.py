"""Batch-keyed tables: what a stream's writes leave under a path.

    root/[event_date=…/]_source=<query id>/_batch=N/    rows written by micro-batch N

* ``write(df, N)`` leaves exactly the rows of this run of its own (query, batch),
  so a replayed batch replaces its own output whatever it held before, and two
  queries (or one with a new checkpoint, whose batch ids start again at 0) never
  touch each other's rows.
* The partition columns are the outermost folders.  ``read(days=…)`` lists only
  the days asked for, not the batches of a table's whole life, and
  ``read(schema=…)`` opens no footer to learn the columns.
* An unreadable folder fails the read.

Rows are written once; nothing rewrites them.  Each batch is clustered by its
partition columns, so it leaves few files.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE_PROPERTY = "sql.streaming.queryId"
BATCH_SOURCE = "batch"
KEYS = ("_source", "_batch")
#: Empty files that say which batches have begun to write; hidden from readers.
_BEGUN = "_begun"


def current_source(spark: SparkSession) -> str:
    """The id of the streaming query whose batch is being processed.  It stays the
    same over restarts from one checkpoint."""
    return spark.sparkContext.getLocalProperty(SOURCE_PROPERTY) or BATCH_SOURCE


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, target = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(target)) if fs.exists(target) else []


def touch(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.create(target, True).close()


def versions(spark: SparkSession, base: str) -> list[int]:
    """Complete ``version=N`` folders of a table that is replaced whole, oldest first."""
    found = [int(n.removeprefix("version=")) for n in children(spark, base) if n.startswith("version=")]
    return sorted(v for v in found if exists(spark, f"{base}/version={v}/_SUCCESS"))


def iso(day) -> str | None:
    return day.isoformat() if isinstance(day, dt.date) else day


class BatchTable:
    def __init__(self, spark: SparkSession, root: str, partition_by: list[str] | None = None,
                 cluster_by: list[str] | None = None):
        """``cluster_by``: rows of a folder are sorted by these columns, so that filters on them
        skip row groups and pages."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.partition_by = list(partition_by or [])
        self.cluster_by = list(cluster_by or [])

    def batch_path(self, batch_id: int, source: str) -> str:
        """The folder of a batch; a pattern of several if the table has partition columns."""
        outer = "".join(f"{c}=*/" for c in self.partition_by)
        return f"{self.root}/{outer}_source={source}/_batch={int(batch_id)}"

    def remove_batch(self, batch_id: int, source: str) -> None:
        """Remove the rows of a batch, and the folders that have become empty."""
        fs, pattern = _file_system(self.spark, self.batch_path(batch_id, source))
        for found in fs.globStatus(pattern) or []:
            folder = found.getPath()
            fs.delete(folder, True)
            for _ in range(len(self.partition_by) + 1):
                folder = folder.getParent()
                if len(fs.listStatus(folder)) or not fs.delete(folder, False):
                    break

    def batches(self, source: str) -> list[int]:
        """Numbers of the batches of a source with rows, of a table without partition columns."""
        names = children(self.spark, f"{self.root}/_source={source}")
        return sorted(int(n.partition("=")[2]) for n in names if n.startswith("_batch="))

    def write(self, df: DataFrame, batch_id: int, source: str | None = None) -> None:
        """Write (or write again) the rows of one batch."""
        source = source or current_source(self.spark)
        # A name that Spark would take for a number or a date when it reads folders isn't kept as it is.
        if not re.fullmatch(r"[\w.-]+", source) or re.fullmatch(r"[\d.eE+-]+", source):
            raise ValueError(f"not a name for a source of batches: {source!r}")
        mark = f"{self.root}/{_BEGUN}/{source}/{int(batch_id)}"
        if exists(self.spark, mark):
            self.remove_batch(batch_id, source)  # a replay; what it left may lie in other days
        else:
            touch(self.spark, mark)
        if self.partition_by:
            df = df.hint("rebalance", *self.partition_by)  # a hot value is split over tasks
        df = df.withColumn("_source", F.lit(source)).withColumn("_batch", F.lit(int(batch_id)))
        if self.cluster_by:
            df = df.sortWithinPartitions(*self.partition_by, *self.cluster_by)
        # Dynamic overwriting stages files apart for each job, so writers of one table don't meet.
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy(*self.partition_by, *KEYS).parquet(self.root)

    def _folders(self) -> list[str]:
        return [n for n in children(self.spark, self.root) if "=" in n]

    def is_empty(self) -> bool:
        """Whether no row has been written yet."""
        return not self._folders()

    def days(self) -> list[str]:
        """Values of the outermost partition column that hold rows, ascending; one listing of one folder."""
        found = [n.partition("=")[2] for n in self._folders()]
        return sorted(d for d in found if d != "__HIVE_DEFAULT_PARTITION__")

    def read(self, schema: T.StructType | None = None, days: tuple | None = None, keys: bool = False) -> DataFrame:
        """The rows of every batch.  ``schema`` declares the columns (else they are taken from
        a footer); ``days`` (first, last; either may be None) limits the outermost partition
        column, and nothing else is listed.  ``keys`` keeps ``_source`` and ``_batch``."""
        if self.is_empty():
            if schema is None:
                raise ValueError(f"nothing written to {self.root} yet")
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.option("basePath", self.root)
        if schema is not None:
            inner = {*self.partition_by, *KEYS}
            reader = reader.schema(T.StructType([f for f in schema.fields if f.name not in inner]))
        if days is None:
            df = reader.parquet(self.root)
        else:
            column = self._folders()[0].partition("=")[0]
            every = self.days()
            wanted = [d for d in every if (days[0] is None or d >= iso(days[0])) and (days[1] is None or d <= iso(days[1]))]
            df = reader.parquet(*[f"{self.root}/{column}={d}" for d in wanted or every[:1]])
            if not wanted:
                df = df.where(F.lit(False))
        return df if keys else df.drop(*KEYS)
