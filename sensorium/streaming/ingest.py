"""Event and file streams into fact tables.

One streaming query reads the source once and, per micro-batch
(``foreachBatch``), routes the rows to every destination: fact tables,
quarantine, derived alerts and incremental views.  Each destination write is
keyed by the query and batch id, so a batch replayed after a failure replaces
its own output: the checkpoint plus idempotent writes give exactly-once results
on at-least-once delivery (T5).

Wire form (S12): one JSON object per event, the columns of one fact table plus
``_table``; timestamps as ISO-8601 text with microseconds and ``Z``, booleans
as ``true``/``false``.
"""

from __future__ import annotations

import datetime as dt
import threading
import time
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from sensorium.functions.scalar import bin_time, bool_text, parse_bool, parse_span, to_iso_text
from sensorium.operators.relational import as_of_max
from sensorium.session import remove_path
from sensorium.streaming.batchlog import BatchTable, current_source, exists, versions

READING_TABLE = "SensorReading"
ALERT_TABLE = "SensorAlert"


# ------------------------------------------------------------- encode -----
def _wire(col: str, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return to_iso_text(col).alias(col)
    if isinstance(dtype, T.BooleanType):
        return bool_text(col).alias(col)
    return F.col(col)


def to_events(readings: DataFrame | None = None, alerts: DataFrame | None = None) -> DataFrame:
    """Fact rows → one ``value`` JSON text per event, tagged with ``_table``."""
    parts = []
    for df, tag in ((readings, READING_TABLE), (alerts, ALERT_TABLE)):
        if df is None:
            continue
        cols = [_wire(f.name, f.dataType) for f in df.schema.fields]
        parts.append(df.select(F.to_json(F.struct(*cols, F.lit(tag).alias("_table"))).alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------- decode -----
def envelope_schema(schemas: dict[str, T.StructType]) -> T.StructType:
    """All fields of all routed tables as text, plus ``_table``."""
    names: list[str] = []
    for s in schemas.values():
        for f in s.fields:
            if f.name not in names:
                names.append(f.name)
    return T.StructType([T.StructField(n, T.StringType()) for n in names]
                        + [T.StructField("_table", T.StringType())])


def _typed(col: Column, dtype: T.DataType) -> Column:
    """Wire text → typed value.  A malformed value becomes missing instead of
    failing the micro-batch (ANSI casts would raise)."""
    if isinstance(dtype, T.BooleanType):
        return parse_bool(col)
    if isinstance(dtype, T.TimestampNTZType):
        return F.try_to_timestamp(col).cast("timestamp_ntz")
    if isinstance(dtype, T.TimestampType):
        return F.try_to_timestamp(col)
    return col.try_cast(dtype)


def parse_events(raw: DataFrame, schemas: dict[str, T.StructType]) -> DataFrame:
    """``value`` JSON text → envelope columns (text) + ``_table`` + ``value``.

    A malformed line parses to all-missing fields (``_table`` missing) and so
    lands in quarantine with its original text.
    """
    env = F.from_json(F.col("value"), envelope_schema(schemas), {"mode": "PERMISSIVE"})
    return raw.select(F.col("value"), env.alias("e")).select("value", "e.*")


def route(parsed: DataFrame, schemas: dict[str, T.StructType]) -> dict[str, DataFrame]:
    """Demultiplex parsed events to one typed DataFrame per table, plus
    ``_quarantine``: events with an unknown or missing ``_table``, and events
    of which a field is there but does not convert, with the raw text and the
    reason.  Every event goes to exactly one of them."""
    out = {}
    known = list(schemas)
    reason = F.when(F.col("_table").isNull(), F.lit("no table")).when(~F.col("_table").isin(known), F.lit("unknown table"))
    for name, schema in schemas.items():
        bad = F.concat_ws(", ", *[F.when(F.col(f.name).isNotNull() & _typed(F.col(f.name), f.dataType).isNull(), F.lit(f.name))
                                  for f in schema.fields])
        rows = parsed.where((F.col("_table") == name) & (bad == ""))
        out[name] = rows.select(*[_typed(F.col(f.name), f.dataType).alias(f.name)
                                  for f in schema.fields])
        reason = reason.when((F.col("_table") == name) & (bad != ""), F.concat(F.lit("does not convert: "), bad))
    out["_quarantine"] = parsed.withColumn("reason", reason).where(F.col("reason").isNotNull()) \
        .select("value", "_table", "reason")
    return out


# -------------------------------------------------------------- sources ---
def batch_cap(fmt: str, max_files_per_trigger: int | None, max_offsets_per_trigger: int | None) -> dict[str, int]:
    """The source option that bounds a micro-batch (T4)."""
    if fmt == "kafka":
        if max_files_per_trigger:
            raise ValueError("a message bus is capped by max_offsets_per_trigger")
        return {"maxOffsetsPerTrigger": max_offsets_per_trigger} if max_offsets_per_trigger else {}
    if max_offsets_per_trigger:
        raise ValueError("files are capped by max_files_per_trigger")
    return {"maxFilesPerTrigger": max_files_per_trigger} if max_files_per_trigger else {}


def event_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                 fmt: str = "text", max_offsets_per_trigger: int | None = None, **options) -> DataFrame:
    """A stream of ``value`` texts: files in a directory (default) or a
    message bus via ``fmt="kafka"`` (untested here: no Kafka jar present)."""
    reader = spark.readStream.format(fmt)
    for k, v in batch_cap(fmt, max_files_per_trigger, max_offsets_per_trigger).items():
        reader = reader.option(k, v)
    for k, v in options.items():
        reader = reader.option(k, v)
    if fmt == "kafka":
        return reader.load().select(F.col("value").cast("string").alias("value"))
    return reader.load(path)


def csv_stream(spark: SparkSession, path: str, schema: T.StructType,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming CSV ingest of one fact table (S9, S10 quoting)."""
    r = (spark.readStream.schema(schema).option("header", "false")
         .option("quote", '"').option("escape", '"'))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(path)


# ---------------------------------------------------------------- sinks ---
def write_batch_partition(df: DataFrame, path: str, batch_id: int,
                          partition_by: list[str] | None = None, source: str | None = None) -> None:
    """Idempotent append: replace only what this query's batch wrote."""
    BatchTable(df.sparkSession, path, partition_by).write(df, batch_id, source)


def append_history(df: DataFrame, path: str, name: str, partition_by: list[str] | None = None) -> None:
    """Append a batch of rows to a stream-written table (S11 and S15 into one
    table).  Appending again under the same ``name`` replaces the first one."""
    BatchTable(df.sparkSession, path, partition_by).write(with_event_date(df, partition_by), 0, f"history-{name}")


def with_event_date(df: DataFrame, partition_by: list[str] | None) -> DataFrame:
    """Add the ``event_date`` that the table is partitioned by, from its first timestamp."""
    if "event_date" not in (partition_by or []) or "event_date" in df.columns:
        return df
    ts = next(f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)))
    return df.withColumn("event_date", F.to_date(ts))


def one_of_each(df: DataFrame, key: str) -> DataFrame:
    """One row per key, the smallest of those that share it, so that a replay keeps
    the same one; rows without a key all stay."""
    row = F.struct(*[F.col(c) for c in df.columns])
    kept = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(row).alias("_row")).select("_row.*")
    return kept.unionByName(df.where(F.col(key).isNull()))


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, days: tuple | None = None) -> DataFrame:
    """Batch view of a stream-written table (S17): same files, no copy.  With the declared
    ``schema`` and the ``days`` (first, last) of interest it lists and opens only these."""
    return BatchTable(spark, path).read(schema, days)


def read_recent(spark: SparkSession, path: str, span: str | int, schema: T.StructType | None = None,
                ts: str = "Timestamp") -> DataFrame:
    """Rows of the last ``span`` before the newest one of a table partitioned by ``event_date``.
    The newest day's folder holds the newest row; only the days from which rows can be
    recent enough are listed, and within them row groups are skipped."""
    table = BatchTable(spark, path)
    days = table.days()
    if not days:
        return table.read(schema)
    first = dt.date.fromisoformat(days[-1]) - dt.timedelta(days=-(-parse_span(span) // 86400))
    lower = as_of_max(table.read(schema, (days[-1], None)), ts, span)
    return table.read(schema, (first, None)).where(F.col(ts) > lower)


@dataclass
class Ingest:
    """Routing ingest: one source, many destinations per micro-batch.

    * ``schemas``        — table name → typed schema of that table;
    * ``tables``         — table name → output path (facts appended, S15);
    * ``quarantine``     — path for rows that cannot be routed;
    * ``handlers``       — table name → list of ``f(df, batch_id, source)`` run on the
      routed rows (incremental views, alert derivation …);
    * ``partition_by``   — table name → partition columns (``event_date`` …);
    * ``dedup_key``      — table name → unique id; duplicates inside one batch
      are dropped (across batches: ``start(dedup_delay=…)``).  Rows without an
      id, and tables without a ``dedup_key``, keep every row;
    * ``totals``         — path of a table of events per destination and batch, from which
      ``ingest_totals`` has the totals over the ingest's whole life (T6);
    * ``parallel_writes`` — destinations written concurrently per batch (each
      is its own Spark job; they share nothing but the cached batch).
    """
    schemas: dict[str, T.StructType]
    tables: dict[str, str] = field(default_factory=dict)
    quarantine: str | None = None
    handlers: dict[str, list[Callable[..., None]]] = field(default_factory=dict)
    partition_by: dict[str, list[str]] = field(default_factory=dict)
    dedup_key: dict[str, str] = field(default_factory=dict)
    totals: str | None = None
    parallel_writes: int = 1

    def process(self, raw: DataFrame, batch_id: int) -> None:
        # The batch feeds several writes: parse it once and keep it for them.
        if "_table" in raw.columns:          # parsed (and deduplicated) upstream
            parsed = raw.persist()
        else:
            parsed = parse_events(raw, self.schemas).persist()
        source = current_source(raw.sparkSession)   # a property of this thread
        try:
            tasks = self._tasks(route(parsed, self.schemas), batch_id, source)
            if self.parallel_writes > 1 and len(tasks) > 1:
                # Independent destinations are independent Spark jobs: submit
                # them together so small batches use the whole cluster.
                from concurrent.futures import ThreadPoolExecutor
                with ThreadPoolExecutor(max_workers=self.parallel_writes) as pool:
                    for f in [pool.submit(t) for t in tasks]:
                        f.result()
            else:
                for t in tasks:
                    t()
        finally:
            parsed.unpersist()

    def _tasks(self, routed: dict[str, DataFrame], batch_id: int, source: str) -> list:
        tasks = []
        if self.totals:
            tasks.append(lambda: write_batch_partition(_counts(routed), self.totals, batch_id, source=source))
        for name, df in routed.items():
            if name == "_quarantine":
                if self.quarantine:
                    # Usually empty: a cheap check on the cached batch saves
                    # an empty write job and its commit.
                    def quarantine(df=df):
                        if not df.isEmpty():
                            write_batch_partition(df, self.quarantine, batch_id, source=source)
                    tasks.append(quarantine)
                continue
            if name in self.dedup_key:
                df = one_of_each(df, self.dedup_key[name])
            parts = self.partition_by.get(name)
            df = with_event_date(df, parts)
            if name in self.tables:
                tasks.append(lambda df=df, name=name, parts=parts: write_batch_partition(
                    df, self.tables[name], batch_id, parts, source))
            for h in self.handlers.get(name, []):
                tasks.append(lambda h=h, df=df: h(df, batch_id, source))
        return tasks

    def start(self, stream: DataFrame, checkpoint: str, trigger: str | None = None,
              available_now: bool = False, observe: bool = True,
              dedup_delay: str | None = None) -> StreamingQuery:
        """Start the query.  ``trigger="2 seconds"`` for periodic micro-batches
        (T1), ``available_now=True`` to process what is there and stop (T3).

        ``dedup_delay`` drops redelivered events (same table and ``dedup_key``)
        arriving within that delay of the first copy, across micro-batches.
        The watermark is on *arrival* time, not event time, so rows that are
        late in event time are still kept (T9) and the dedup state stays
        bounded by the delay.
        """
        counted = lambda df, name: df.observe(name, F.count(F.lit(1)).alias("events")) if observe else df
        if dedup_delay and self.dedup_key:
            parsed = parse_events(stream, self.schemas)
            # Rows without an id, and tables without a dedup key, never equal another row: they pass
            # by the stateful operator, and its state holds ids that are really there.
            key = F.coalesce(*[F.when(F.col("_table") == t, F.col(k)) for t, k in self.dedup_key.items()])
            keyed = counted(parsed.withColumn("_dkey", key).where(F.col("_dkey").isNotNull()), "ingest")
            keyed = (keyed.withColumn("_arrival", F.current_timestamp()).withWatermark("_arrival", dedup_delay)
                     .dropDuplicatesWithinWatermark(["_table", "_dkey"]))
            src = keyed.drop("_dkey", "_arrival").unionByName(counted(parsed.where(key.isNull()), "ingest_keyless"))
        else:
            src = counted(stream, "ingest")
        watch_totals(stream.sparkSession)
        w = src.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.process)
        if available_now:
            w = w.trigger(availableNow=True)
        elif trigger:
            w = w.trigger(processingTime=trigger)
        return w.start()


def _counts(routed: dict[str, DataFrame]) -> DataFrame:
    """(destination, events) of a batch: one row each."""
    parts = [df.agg(F.count(F.lit(1)).alias("events")).select(F.lit(name.lstrip("_")).alias("destination"), "events")
             for name, df in routed.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def ingest_totals(spark: SparkSession, path: str) -> DataFrame:
    """(destination, events, batches) over all batches of all runs and queries that wrote
    their totals to ``path`` (T6).  A batch's totals are keyed like its rows, so a restart
    goes on and a replayed batch counts once."""
    schema = T.StructType([T.StructField("destination", T.StringType()), T.StructField("events", T.LongType())])
    return read_table(spark, path, schema).groupBy("destination").agg(
        F.sum("events").alias("events"), F.count(F.lit(1)).alias("batches"))


def window_handler(view, late_path: str, lateness: str | int = "10 minutes", ts: str = "Timestamp") -> Callable[..., None]:
    """A handler for tumbling windows with a watermark (T10) that keeps its late rows.

    The watermark of batch N is the latest time of the batches before it, less ``lateness``.
    Rows of windows that had ended by then are late: they go to the table ``late_path``
    (with the ``watermark`` they missed); all others go into the partials of ``view`` (an
    :class:`~sensorium.streaming.incremental.IncrementalView` with a span), whose windows
    before the watermark are final.  Rows without a time are late.  Each batch stores the
    latest time so far under its own key, so a replay meets the same watermark, and a
    restart goes on from it; nothing but that one value is state."""
    secs, span = parse_span(lateness), parse_span(view.view.span)

    def handle(rows: DataFrame, batch_id: int, source: str | None = None) -> None:
        spark = rows.sparkSession
        source = source or current_source(spark)
        marks = BatchTable(spark, f"{view.root}/marks")
        kind = rows.schema[ts].dataType
        before = F.lit(None).cast(kind)
        if batch_id and exists(spark, marks.batch_path(batch_id - 1, source)):
            before = spark.read.parquet(marks.batch_path(batch_id - 1, source)).agg(F.max("latest")).scalar()
        watermark = before - F.make_dt_interval(secs=F.lit(secs))
        ends = bin_time(ts, span) + F.make_dt_interval(secs=F.lit(span))
        late = F.col(ts).isNull() | F.coalesce(ends <= watermark, F.lit(False))
        view.apply_batch(rows.where(~late), batch_id, source)
        write_batch_partition(rows.where(late).withColumn("watermark", watermark), late_path, batch_id, source=source)
        marks.write(rows.agg(F.greatest(F.max(ts), before).alias("latest")), batch_id, source)
        if batch_id > 1:
            marks.remove_batch(batch_id - 2, source)
    return handle


def _in_batch(dimension, batch_id: int, source: str | None) -> DataFrame:
    """A dimension as a micro-batch sees it: a versioned one is read anew."""
    if isinstance(dimension, DataFrame):
        return dimension
    return dimension.for_batch(batch_id, source or current_source(dimension.spark))


def alert_handler(thresholds, path: str, by: str = "type", keep_p: float = 1.0) -> Callable[..., None]:
    """Live alert derivation on routed readings (T11): stateless, written per
    batch id like every other destination.  ``thresholds``: a table, or a
    :class:`~sensorium.sources.dimensions.VersionedDimension` that may be replaced while the
    stream runs."""
    from sensorium.operators.alerts import derive_alerts

    def handle(readings: DataFrame, batch_id: int, source: str | None = None) -> None:
        limits = _in_batch(thresholds, batch_id, source)
        write_batch_partition(derive_alerts(readings, limits, by=by, keep_p=keep_p), path, batch_id, source=source)
    return handle


def locate_handler(sensors, path: str, partition_by: list[str] | None = None, key: str = "SensorId") -> Callable[..., None]:
    """A handler that stores facts with their sensor's attributes as of the batch.
    ``sensors`` (a table or a versioned dimension) has ``sensor_id`` and the attributes; rows of
    unknown sensors keep them missing."""
    from sensorium.operators.joins import broadcast_if_small

    def handle(rows: DataFrame, batch_id: int, source: str | None = None) -> None:
        side = broadcast_if_small(_in_batch(sensors, batch_id, source).withColumnRenamed("sensor_id", "_sensor_id"))
        located = rows.join(side, F.col(key) == F.col("_sensor_id"), "left").drop("_sensor_id")
        write_batch_partition(with_event_date(located, partition_by), path, batch_id, partition_by, source)
    return handle


# ----------------------------------------------------- query controls -----
def run_once(q: StreamingQuery, timeout_sec: float | None = None) -> StreamingQuery:
    """Wait for an ``availableNow`` query to drain its input."""
    q.awaitTermination(timeout_sec)
    return q


def run_for(q: StreamingQuery, seconds: float) -> StreamingQuery:
    """Let a query run ``seconds`` then stop it."""
    q.awaitTermination(seconds)
    q.stop()
    return q


def _metrics(progress) -> dict[str, int]:
    """Observed numbers of a batch; what is counted in two branches of a stream is one number."""
    out: dict[str, int] = {}
    for name, row in (progress.observedMetrics or {}).items():
        for k, v in row.asDict().items():
            key = f"{name.removesuffix('_keyless')}.{k}"
            out[key] = out.get(key, 0) + int(v or 0)
    return out


class _Totals(StreamingQueryListener):
    """Batches done and metrics observed, per run of a query, from its first batch on."""

    def __init__(self):
        self.lock = threading.Condition()
        self.runs: dict[str, dict[int, dict[str, int]]] = {}

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        p = event.progress
        seen = _metrics(p)
        with self.lock:
            self.runs.setdefault(str(p.runId), {})[p.batchId] = seen
            self.lock.notify_all()

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        with self.lock:
            self.lock.notify_all()


_TOTALS: dict[str, _Totals] = {}


def watch_totals(spark: SparkSession) -> _Totals:
    """The session's listener for running totals; the first call adds it."""
    app = spark.sparkContext.applicationId
    if app not in _TOTALS:
        _TOTALS[app] = _Totals()
        spark.streams.addListener(_TOTALS[app])
    return _TOTALS[app]


def _batches(q: StreamingQuery) -> dict[int, dict[str, int]]:
    totals = watch_totals(SparkSession.active())
    for p in q.recentProgress:  # what the listener has yet to be told
        seen = _metrics(p)
        with totals.lock:
            totals.runs.setdefault(str(q.runId), {}).setdefault(p.batchId, seen)
    with totals.lock:
        return dict(totals.runs.get(str(q.runId), {}))


def await_batches(q: StreamingQuery, n: int, timeout_sec: float = 120.0) -> bool:
    """Block until this run of the query completed ``n`` micro-batches (or failed,
    or the timeout passed).  Returns whether ``n`` batches completed."""
    deadline = time.monotonic() + timeout_sec
    while time.monotonic() < deadline:
        if q.exception() is not None:
            return False
        if len(_batches(q)) >= n:
            return True
        time.sleep(0.2)
    return False


def ingest_progress(q: StreamingQuery) -> dict[str, int]:
    """Running totals of the observed metrics over all batches of this run."""
    totals: dict[str, int] = {}
    for seen in _batches(q).values():
        for k, v in seen.items():
            totals[k] = totals.get(k, 0) + v
    return totals


# ----------------------------------------------- stateful stream ops ------
def dedup_within_watermark(stream: DataFrame, key: str, ts: str = "Timestamp",
                           delay: str = "10 minutes") -> DataFrame:
    """Drop repeated ``key`` values arriving within ``delay`` of each other
    (at-least-once delivery duplicates); state is bounded by the watermark."""
    return (stream.withColumn(ts, F.col(ts).cast("timestamp"))
            .withWatermark(ts, delay).dropDuplicatesWithinWatermark([key]))


def windowed(stream: DataFrame, span: str, keys: list[str], aggs: list[Column],
             lateness: str = "10 minutes", ts: str = "Timestamp") -> DataFrame:
    """Tumbling-window aggregate with bounded state (T10, append mode).

    Rows later than the watermark are dropped by Spark; ``window_handler`` keeps them apart,
    and the incremental view (:mod:`sensorium.streaming.incremental`) folds them in.
    ``timestamp_ntz`` input is cast to ``timestamp`` first (N20).
    """
    s = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)
    return (s.groupBy(F.window(ts, span).alias("w"), *keys).agg(*aggs)
            .withColumn(ts, F.col("w.start")).drop("w"))


def refresh_tables(spark: SparkSession, queries: dict[str, Callable[[], DataFrame]],
                   out_root: str, checkpoint: str, every: str = "30 seconds") -> StreamingQuery:
    """Recompute small result tables on a timer.

    A ``rate`` source drives one micro-batch per interval; each batch writes
    every result table whole into a folder of its own, which ``read_refreshed``
    takes up once it is complete.  The last two versions are kept.
    """
    def refresh(_df: DataFrame, batch_id: int) -> None:
        for name, fn in queries.items():
            base = f"{out_root.rstrip('/')}/{name}"
            fn().write.mode("overwrite").parquet(f"{base}/version={batch_id}")
            for old in versions(spark, base)[:-2]:
                remove_path(spark, f"{base}/version={old}")

    tick = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (tick.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(refresh).trigger(processingTime=every).start())


def read_refreshed(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    """The newest complete version of a refreshed table."""
    base = f"{out_root.rstrip('/')}/{name}"
    known = versions(spark, base)
    if not known:
        raise ValueError(f"{name} has not been refreshed yet")
    return spark.read.parquet(f"{base}/version={known[-1]}")
