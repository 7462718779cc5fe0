"""Dimensions that are replaced while streams run, and ones too large to broadcast.

* :class:`VersionedDimension` — a dimension table that is overwritten whole.  Each
  overwriting is a folder of its own, which readers take up once it is complete.  A
  micro-batch reads one version all through; which one is kept with the batch, so a
  replayed batch meets the version that it met first.
* ``write_bucketed`` / ``join_bucketed`` — fact and dimension stored by buckets of the
  same key: their join reads matching buckets side by side, without an exchange of
  either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorium.session import remove_path
from sensorium.streaming.batchlog import children, touch, versions

KEEP_VERSIONS = 5


class VersionedDimension:
    def __init__(self, spark: SparkSession, root: str, keep: int = KEEP_VERSIONS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep = keep

    def write(self, df: DataFrame) -> int:
        """Replace the dimension; returns the number of the new version.  One writer at a time.
        The last ``keep`` versions stay for batches that run, or run again."""
        known = versions(self.spark, self.root)
        new = known[-1] + 1 if known else 0
        df.write.mode("overwrite").parquet(f"{self.root}/version={new}")
        for old in versions(self.spark, self.root)[:-self.keep]:
            remove_path(self.spark, f"{self.root}/version={old}")
        return new

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version, or a given one."""
        if version is None:
            known = versions(self.spark, self.root)
            if not known:
                raise ValueError(f"nothing written to {self.root} yet")
            version = known[-1]
        return self.spark.read.parquet(f"{self.root}/version={version}")

    def for_batch(self, batch_id: int, source: str) -> DataFrame:
        """The version that the first run of this micro-batch read, or, in the first run, the newest."""
        pins = f"{self.root}/_pins/{source}"
        pinned = {int(n.partition("-")[0]): int(n.partition("-")[2]) for n in children(self.spark, pins)}
        known = versions(self.spark, self.root)
        version = pinned.get(batch_id, known[-1] if known else None)
        if version is None:
            raise ValueError(f"nothing written to {self.root} yet")
        if version not in known:
            raise ValueError(f"version {version} of {self.root}, which batch {batch_id} has read, is gone; keep more versions")
        if batch_id not in pinned:
            touch(self.spark, f"{pins}/{batch_id}-{version}")
            for old in pinned:  # only the last batch can run again
                if old < batch_id - 1:
                    remove_path(self.spark, f"{pins}/{old}-{pinned[old]}")
        return self.read(version)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str) -> DataFrame:
    """Store ``df`` as the catalog table ``name`` in ``buckets`` buckets of ``key``, one sorted file
    each (a hot key makes its bucket's file large, but splits at row groups when read)."""
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key) \
        .option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def join_bucketed(fact: DataFrame, dimension: DataFrame, fact_key: str, key: str) -> DataFrame:
    """``fact`` with the dimension's other columns; rows of unknown keys keep them missing.  Both
    stored by the same number of buckets of their keys: no row is exchanged."""
    side = dimension.hint("merge").withColumnRenamed(key, "_dimension_key")
    return fact.join(side, F.col(fact_key) == F.col("_dimension_key"), "left").drop("_dimension_key")
