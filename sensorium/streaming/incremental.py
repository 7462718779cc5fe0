"""Incremental aggregate views kept current by a stream.

A view is stored as mergeable partial aggregates in two plain Parquet tables:

    root/open/_source=…/_batch=N/   partials of one micro-batch, in few files sorted by bin
    root/closed/bin_period=…/       partials folded over batches, one folder a day or month

``read`` folds what it needs of both and finalises.  Partials are order-free, so
late rows of any age are folded in without a watermark (T9); a backfill (T8) is one
more source of partials.

``compact`` is one Spark job: the open partials of committed batches and the closed
periods they fall in are folded, and exactly these periods are overwritten (dynamic
partition overwrite).  Closed rows carry the source and the highest batch that was
folded (``_upto``), and a reader takes no open rows that its period has already: a
compaction that fails half way, or runs again, counts nothing twice.  Files stay
bounded by the periods and the open batches.

The folder is a day for bins of up to an hour and a month for daily bins, so that a
folder holds some 24 to 31 bins.  Snapshots, and swapping a folder's files under
running readers, are left to a table format where there is one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorium.functions.scalar import parse_span
from sensorium.plans.views import ViewDef
from sensorium.session import remove_path
from sensorium.streaming.batchlog import BatchTable, children, current_source, touch

PERIOD = "bin_period"
_FOLDED = "_folded"  # an empty file per source: up to which batch its last compaction went
_DAY_SECONDS = 86400


class IncrementalView:
    """A :class:`ViewDef` kept as mergeable partials."""

    def __init__(self, spark: SparkSession, view: ViewDef, root: str):
        self.spark = spark
        self.view = view
        self.root = root.rstrip("/")
        self.open = BatchTable(spark, f"{self.root}/open")
        self.closed = f"{self.root}/closed"

    # ---- writing -----------------------------------------------------------
    def _period(self, ts: Column) -> Column:
        """The folder that a bin belongs to; bins without a time go to one of their own."""
        never = F.to_date(F.lit("1970-01-01"))
        if not self.view.span:
            return never
        unit = "month" if parse_span(self.view.span) >= _DAY_SECONDS else "day"
        return F.coalesce(F.to_date(F.date_trunc(unit, ts)), never)

    def apply_batch(self, df: DataFrame, batch_id: int, source: str | None = None) -> None:
        """Fold one micro-batch (idempotent per source and ``batch_id``)."""
        self.write_partials(self.view.partial(df), batch_id, source)

    def write_partials(self, partials: DataFrame, batch_id: int, source: str | None = None) -> None:
        if self.view.span:
            partials = partials.hint("rebalance", self.view.ts).sortWithinPartitions(self.view.ts)
        else:
            partials = partials.hint("rebalance")
        self.open.write(partials, batch_id, source)

    def backfill(self, history: DataFrame) -> None:
        """Fold historical rows (``with (backfill=true)``).  Done once; another history
        needs a view of its own."""
        self.apply_batch(history, 0, "backfill")

    # ---- state -------------------------------------------------------------
    def _closed(self, periods: list | None = None) -> DataFrame | None:
        """Closed rows; of the listed periods only (others aren't listed or opened)."""
        there = [n for n in children(self.spark, self.closed) if n.startswith(f"{PERIOD}=")]
        if periods is not None:
            there = sorted({f"{PERIOD}={p}" for p in periods} & set(there))
        if not there:
            return None
        paths = [self.closed] if periods is None else [f"{self.closed}/{n}" for n in there]
        return self.spark.read.option("basePath", self.closed).parquet(*paths)

    def _open(self) -> DataFrame | None:
        """Rows of open batches that their closed period doesn't hold yet."""
        if self.open.is_empty():
            return None
        rows = self.open.read(keys=True)
        rows = rows.withColumn(PERIOD, self._period(F.col(self.view.ts) if self.view.span else F.lit(None)))
        closed = self._closed()
        if closed is None:
            return rows
        held = closed.groupBy(F.col(PERIOD).alias("_p"), F.col("_source").alias("_s")).agg(F.max("_upto").alias("_held"))
        held = rows.join(held, (rows[PERIOD] == held["_p"]) & (rows["_source"] == held["_s"]), "left")
        return held.where(F.col("_held").isNull() | (F.col("_batch") > F.col("_held"))).drop("_p", "_s", "_held")

    def partials(self) -> DataFrame | None:
        """Partials of all batches, each counted once; None before the first."""
        closed, fresh = self._closed(), self._open()
        parts = [p.drop("_source", "_batch", "_upto") for p in (closed, fresh) if p is not None]
        return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0] if parts else None

    def latest(self, minus: str | int | None = None) -> Column:
        """The view's latest bin as a scalar subquery; it reads open batches and the
        newest closed period only."""
        periods = sorted(n.partition("=")[2] for n in children(self.spark, self.closed) if n.startswith(f"{PERIOD}="))
        parts = [p for p in (self._closed(periods[-1:]) if periods else None,
                             None if self.open.is_empty() else self.open.read()) if p is not None]
        if not parts:
            raise ValueError(f"view {self.view.name} has no data yet")
        bins = [p.select(self.view.ts) for p in parts]
        newest = F.max(self.view.ts)
        if minus is not None:
            newest = newest - F.make_dt_interval(secs=F.lit(parse_span(minus)))
        return (bins[0].unionByName(bins[1]) if len(bins) == 2 else bins[0]).agg(newest).scalar()

    def read(self, source_schema=None, days: tuple | None = None) -> DataFrame:
        """The view as of the last written batch, finalised; only bins of ``days``
        (first, last; either may be None) if given.  Before any batch was written
        the view is empty; ``source_schema`` then gives its shape."""
        state = self.partials()
        if state is None:
            if source_schema is None:
                raise ValueError(f"view {self.view.name} has no data yet")
            return self.view.compute(self.spark.createDataFrame([], source_schema))
        return self.view.merge(self.within(state, days).drop(PERIOD))

    def within(self, state: DataFrame, days: tuple | None) -> DataFrame:
        """The partials of bins in ``days``; closed periods outside aren't opened."""
        for bound, first in zip(days or (), (True, False), strict=False):
            if bound is None:
                continue
            day = F.to_date(bound if isinstance(bound, Column) else F.lit(bound))
            ts = F.to_date(self.view.ts)
            state = state.where((F.col(PERIOD) >= self._period(day)) & (ts >= day) if first
                                else (F.col(PERIOD) <= self._period(day)) & (ts <= day))
        return state

    # ---- compaction --------------------------------------------------------
    def compact(self, upto_batch: int, source: str | None = None) -> None:
        """Fold the batches of ``source`` up to ``upto_batch`` into their periods.  Only
        committed batches may be folded; inside ``foreachBatch`` of batch N every batch
        < N is committed.  One compaction runs at a time.

        Batches that the compaction before this one has folded are removed, so a running
        reader keeps its files for the time between two compactions."""
        source = source or current_source(self.spark)
        marks = f"{self.root}/{_FOLDED}/{source}"
        before = max(map(int, children(self.spark, marks)), default=-1)
        rows = self._open()
        todo = None if rows is None else rows.where((F.col("_source") == source) & (F.col("_batch") <= upto_batch))
        # Periods that batches fall in: as many values as there are days or months in them.
        periods = [] if todo is None else [r[0] for r in todo.select(PERIOD).distinct().collect()]
        if periods:
            todo = todo.withColumn("_upto", F.lit(int(upto_batch)).cast("long")).drop("_batch")
            old = self._closed(periods)
            state = todo if old is None else todo.unionByName(old)
            folded = self.view.fold(state, extra=(PERIOD, "_source"), latest=("_upto",))
            order = [PERIOD, self.view.ts] if self.view.span else [PERIOD]
            folded.hint("rebalance", PERIOD).sortWithinPartitions(*order).write.mode("overwrite") \
                .option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD).parquet(self.closed)
        if upto_batch > before:
            touch(self.spark, f"{marks}/{int(upto_batch)}")
            if before >= 0:
                remove_path(self.spark, f"{marks}/{before}")
        for batch_id in self.open.batches(source):
            if batch_id <= before:
                self.open.remove_batch(batch_id, source)

    def attach(self, every_compact: int | None = None):
        """A ``foreachBatch`` function folding each batch into this view;
        compacts the committed batches every ``every_compact`` batches."""
        def handle(df: DataFrame, batch_id: int, source: str | None = None) -> None:
            self.apply_batch(df, batch_id, source)
            if every_compact and batch_id > 0 and batch_id % every_compact == 0:
                self.compact(batch_id - 1, source)
        return handle


def list_views(spark: SparkSession, pattern: str = "mv_*") -> list[str]:
    """Catalog tables whose name matches ``pattern``."""
    return [r["tableName"] for r in spark.sql(f"SHOW TABLES LIKE '{pattern}'").collect()]


def drop_view(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def recreate_view(spark: SparkSession, name: str, view: ViewDef, source: DataFrame,
                  location: str) -> DataFrame:
    """Drop and rebuild a materialised view table from its source."""
    drop_view(spark, name)
    view.compute(source).write.mode("overwrite").option("path", location).saveAsTable(name)
    return spark.table(name)
