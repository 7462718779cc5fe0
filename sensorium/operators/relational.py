"""Relational operators of the query surfaces (P, G, W, O of the survey).

Thin, declarative DataFrame compositions: Catalyst pushes the filters into the
Parquet scan, prunes columns, and plans two-phase aggregation for every
``groupBy``.  Nothing here collects data to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorium.functions.scalar import parse_span
from sensorium.operators.alerts import keep_fraction

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_of_max(df: DataFrame, ts: str = "Timestamp", minus: str | int | None = None) -> Column:
    """The table's own latest timestamp as a scalar subquery (lazy, one
    aggregate job), for repeatable "last N minutes" queries (N19).  ``minus``
    is taken off inside the subquery, so that a comparison with it is a
    comparison with one value, which prunes row groups."""
    latest = F.max(ts)
    if minus is not None:
        latest = latest - F.make_dt_interval(secs=F.lit(parse_span(minus)))
    return df.agg(latest).scalar()


def since(df: DataFrame, span: str | int, as_of: Column | str | None = None,
          ts: str = "Timestamp", date_col: str | None = "event_date") -> DataFrame:
    """Rows with ``ts > as_of - span`` (strict, like ``Timestamp > ago(span)``).

    ``as_of``: a Column or literal; ``"max"`` = the table's own max timestamp;
    default ``current_timestamp()``.  If ``df`` is partitioned by a date column
    (``date_col``), the implied date predicate is added so whole partitions are
    pruned before any file is opened.
    """
    secs = parse_span(span)
    if as_of is None:
        anchor = F.current_timestamp()
    elif isinstance(as_of, str) and as_of == "max":
        anchor = None
    elif isinstance(as_of, Column):
        anchor = as_of
    else:
        anchor = F.lit(as_of)
    lower = as_of_max(df, ts, span) if anchor is None else anchor - F.make_dt_interval(secs=F.lit(secs))
    out = df.where(F.col(ts) > lower)
    if date_col and date_col in df.columns:
        out = out.where(F.col(date_col) >= F.to_date(lower))
    return out


def between(df: DataFrame, lo, hi, ts: str = "Timestamp") -> DataFrame:
    """Half-open time range ``lo <= ts < hi`` (either end optional)."""
    if lo is not None:
        df = df.where(F.col(ts) >= F.lit(lo))
    if hi is not None:
        df = df.where(F.col(ts) < F.lit(hi))
    return df


def row_count(df: DataFrame, name: str = "Count") -> DataFrame:
    """``T | count``: one row, even for an empty input."""
    return df.agg(F.count(F.lit(1)).alias(name))


def count_by(df: DataFrame, *keys: ColumnOrName, name: str = "count_") -> DataFrame:
    """``summarize count() by keys`` (default output name ``count_``)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def time_range(df: DataFrame, ts: str = "Timestamp") -> DataFrame:
    """``summarize min(ts), max(ts)``."""
    return df.agg(F.min(ts).alias(f"min_{ts}"), F.max(ts).alias(f"max_{ts}"))


def top_n(df: DataFrame, n: int, by: ColumnOrName, ascending: bool = False,
          tie_break: list[ColumnOrName] | None = None) -> DataFrame:
    """``top n by x desc``: exactly ``n`` rows.

    ``tie_break`` keys make the chosen row set deterministic.  Plans as
    ``TakeOrderedAndProject``: each task keeps its own best ``n``; only
    ``n × tasks`` rows reach the final merge.
    """
    first = _c(by).asc_nulls_first() if ascending else _c(by).desc_nulls_last()
    order = [first] + [_c(t).asc() for t in (tie_break or [])]
    return df.orderBy(*order).limit(n)


def latest(df: DataFrame, n: int, ts: str = "Timestamp", tie_break: list[str] | None = None) -> DataFrame:
    """``order by ts desc | take n``."""
    return top_n(df, n, ts, ascending=False, tie_break=tie_break)


def top_n_ties(df: DataFrame, n: int, by: ColumnOrName, ascending: bool = False) -> DataFrame:
    """``TOPN(n, …, by, DESC|ASC)``: the first ``n`` rows plus every row tied
    with the n-th (O6).  Missing values rank lowest, as BLANK does: last when
    descending, first when ascending ("worst N").

    The n-th value comes from a top-n (``TakeOrderedAndProject``) folded into
    one scalar subquery; the input is then filtered against it.  Same row set
    as ``rank() <= n`` without a single-partition window.
    """
    x = _c(by)
    v = F.col("_v")
    order = v.asc_nulls_first() if ascending else v.desc_nulls_last()
    head = df.select(x.alias("_v")).orderBy(order).limit(n)
    edge = F.max("_v") if ascending else F.min("_v")
    # One scalar subquery carrying the three numbers (evaluated once).
    stats = head.agg(F.struct(edge.alias("nth"), F.count(F.lit(1)).alias("k"),
                              F.count("_v").alias("kv")).alias("s")).scalar()
    if ascending:
        # Missing values come first: all of them are in the head or tie with
        # its last row; non-missing rows qualify up to the n-th value.
        keep = (stats["k"] < F.lit(n)) | x.isNull() | ((stats["kv"] > 0) & (x <= stats["nth"]))
    else:
        # Fewer than n rows: keep all.  A missing n-th value: every
        # non-missing row is already in the head and all missing rows tie.
        keep = (stats["k"] < F.lit(n)) | (stats["kv"] < stats["k"]) | (x >= stats["nth"])
    return df.where(keep)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` rows, in no particular order (``show`` / ``rows[:n]``)."""
    return df.limit(n)


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` rows drawn without replacement (O7), the same on every run.

    The order is the MD5 of the row's key and the seed, whatever the
    partitioning; a top-n, so each task keeps only ``n`` rows.
    """
    draw = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))).cast("binary"))
    return df.withColumn("_r", draw).orderBy("_r", key).limit(n).drop("_r")


def thin(df: DataFrame, p: float, key: ColumnOrName, seed: int = 42) -> DataFrame:
    """Bernoulli thinning with probability ``p`` (O8), deterministic in ``key``
    so a replayed row is kept or dropped the same way."""
    return df.where(keep_fraction(_c(key), p, seed))


def values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of an attribute (``VALUES``)."""
    return df.select(col).distinct()


def min_over(df: DataFrame, group: list[str], measure: Column, name: str = "min_value") -> DataFrame:
    """A per-group measure, then its minimum over the groups.

    Missing group values are ignored by ``min``, like MINX ignores BLANK.
    """
    per = df.groupBy(*group).agg(measure.alias("_m"))
    return per.agg(F.min("_m").alias(name))
