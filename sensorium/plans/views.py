"""Aggregate view definitions (materialised views of the survey, 2.8 / 2.10).

A :class:`ViewDef` is (source, time bin, keys, aggregates).  The same
definition is evaluated three ways:

* :meth:`ViewDef.compute` — one batch aggregate over the whole source;
* :meth:`ViewDef.partial` — mergeable pieces of one micro-batch (count, sum,
  min, max, conditional count) — what the incremental view stores;
* :meth:`ViewDef.merge` — folds any set of partials and finalises
  (avg = sum / count).  ``merge(partial(a) ∪ partial(b)) == compute(a ∪ b)``,
  for any split and any arrival order, so late rows need no watermark.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorium.functions.scalar import bin_time, ne_safe
from sensorium.schemas import QUALITY_GOOD


@dataclass(frozen=True)
class Agg:
    name: str
    kind: str                       # count | avg | min | max | countif
    expr: Callable[[], Column] | None = None


@dataclass(frozen=True)
class ViewDef:
    name: str
    source: str                     # "readings" | "alerts"
    span: str | None                # time bin; None = no time key
    keys: tuple[str, ...]
    aggs: tuple[Agg, ...]
    ts: str = "Timestamp"

    # ---- whole-source evaluation ----------------------------------------
    def _key_names(self) -> list[str]:
        return ([self.ts] if self.span else []) + list(self.keys)

    def _group(self, df: DataFrame, keys=None, extra=()):
        keys = self.keys if keys is None else keys
        cols = ([bin_time(self.ts, self.span).alias(self.ts)] if self.span else []) + list(keys)
        return df.groupBy(*cols, *extra)

    def compute(self, df: DataFrame) -> DataFrame:
        out = []
        for a in self.aggs:
            if a.kind == "count":
                out.append(F.count(F.lit(1)).alias(a.name))
            elif a.kind == "avg":
                out.append(F.avg(a.expr()).alias(a.name))
            elif a.kind == "min":
                out.append(F.min(a.expr()).alias(a.name))
            elif a.kind == "max":
                out.append(F.max(a.expr()).alias(a.name))
            elif a.kind == "countif":
                out.append(F.count_if(a.expr()).alias(a.name))
            else:
                raise ValueError(a.kind)
        return self._group(df).agg(*out)

    # ---- incremental evaluation -----------------------------------------
    def partial(self, df: DataFrame, keys=None, extra=()) -> DataFrame:
        out = []
        for a in self.aggs:
            if a.kind == "count":
                out.append(F.count(F.lit(1)).alias(f"{a.name}__n"))
            elif a.kind == "avg":
                out += [F.sum(a.expr()).alias(f"{a.name}__s"),
                        F.count(a.expr()).alias(f"{a.name}__c")]
            elif a.kind == "min":
                out.append(F.min(a.expr()).alias(f"{a.name}__min"))
            elif a.kind == "max":
                out.append(F.max(a.expr()).alias(f"{a.name}__max"))
            elif a.kind == "countif":
                out.append(F.count_if(a.expr()).alias(f"{a.name}__n"))
        return self._group(df, keys, extra).agg(*out)

    def fold(self, partials: DataFrame, extra=(), latest=()) -> DataFrame:
        """Partials → partials (one row per group): used by compaction.  ``extra`` are
        further keys, ``latest`` columns of which the greatest value is kept."""
        out = [F.max(c).alias(c) for c in latest]
        for c in partials.columns:
            if c.endswith("__n") or c.endswith("__s") or c.endswith("__c"):
                out.append(F.sum(c).alias(c))
            elif c.endswith("__min"):
                out.append(F.min(c).alias(c))
            elif c.endswith("__max"):
                out.append(F.max(c).alias(c))
        return partials.groupBy(*self._key_names(), *extra).agg(*out)

    def finalize(self, folded: DataFrame) -> DataFrame:
        cols = [F.col(k) for k in self._key_names()]
        for a in self.aggs:
            if a.kind in ("count", "countif"):
                cols.append(F.col(f"{a.name}__n").alias(a.name))
            elif a.kind == "avg":
                cols.append(F.try_divide(F.col(f"{a.name}__s"),
                                         F.col(f"{a.name}__c").cast("double")).alias(a.name))
            elif a.kind == "min":
                cols.append(F.col(f"{a.name}__min").alias(a.name))
            elif a.kind == "max":
                cols.append(F.col(f"{a.name}__max").alias(a.name))
        return folded.select(*cols)

    def merge(self, partials: DataFrame) -> DataFrame:
        return self.finalize(self.fold(partials))

    def compute_located(self, fact: DataFrame, locate, located_keys, key: str = "SensorId") -> DataFrame:
        """``compute`` for a fact whose ``located_keys`` (SiteId, ZoneId …)
        come from a dimension reached by ``key``.

        The fact is first aggregated into mergeable pieces per (bin, own keys,
        ``key``); only those partial rows meet the dimension (``locate``), and
        are then folded to the view's keys.  The join input shrinks from every
        row to one row per sensor and bin, and a hot sensor is folded on the
        map side before any shuffle.
        """
        own = [k for k in self.keys if k not in located_keys]
        partial = self.partial(fact, keys=own, extra=(key,))
        return self.finalize(self.fold(locate(partial)))

    def output_columns(self) -> list[str]:
        return [*self._key_names(), *[a.name for a in self.aggs]]


_value = lambda: F.col("ReadingValue")          # noqa: E731
_anomaly = lambda: F.col("IsAnomaly") == F.lit(True)
_good = lambda: F.col("QualityFlag") == F.lit(QUALITY_GOOD)

_READING_STATS = (
    Agg("ReadingCount", "count"),
    Agg("AvgValue", "avg", _value),
    Agg("MinValue", "min", _value),
    Agg("MaxValue", "max", _value),
    Agg("AnomalyCount", "countif", _anomaly),
    Agg("GoodQualityCount", "countif", _good),
)

VIEWS: dict[str, ViewDef] = {v.name: v for v in [
    ViewDef("mv_readings_hourly", "readings", "1h", ("SensorType", "SiteId"), _READING_STATS),
    ViewDef("mv_readings_daily", "readings", "1d", ("SensorType", "SiteId"), _READING_STATS),
    ViewDef("mv_anomaly_rate_hourly", "readings", "1h", ("SiteId",), (
        Agg("TotalReadings", "count"),
        Agg("AnomalyCount", "countif", _anomaly),
    )),
    ViewDef("mv_alerts_daily", "alerts", "1d", ("Severity", "SiteId", "SensorType"), (
        Agg("AlertCount", "count"),
        Agg("AvgReading", "avg", lambda: F.col("ReadingValue")),
        Agg("AvgThreshold", "avg", lambda: F.col("ThresholdValue")),
    )),
    ViewDef("mv_quality_daily", "readings", "1d", ("SensorType", "SiteId"), (
        Agg("TotalReadings", "count"),
        Agg("GoodCount", "countif", _good),
        # QualityFlag != "Good" with a missing flag counted as not good.
        Agg("DegradedCount", "countif", lambda: ne_safe("QualityFlag", QUALITY_GOOD)),
    )),
]}

#: Hourly partials that hold the pieces of every view of the readings; the others are folded from them.
LATTICE_BASE = ViewDef("readings_hourly", "readings", "1h", ("SensorType", "SiteId"), (
    *_READING_STATS, Agg("DegradedCount", "countif", lambda: ne_safe("QualityFlag", QUALITY_GOOD))))
