"""Aggregate navigation: a question is answered from the coarsest stored partials that
cover it, else from the raw facts.

A view stored as mergeable partials (count, sum, min, max) at one grain answers every
question at a coarser one: fewer keys, a longer time bin, equality filters on its keys,
whole days.  So one fine store feeds a lattice of views, and it alone is maintained.

* :class:`Lattice` — :class:`~sensorium.plans.views.ViewDef` questions (views, tiles);
* :class:`SensorPieces` — the measure layer's pieces per sensor
  (``SensorModel(stored=…)``), from partials kept by sensor and day.

Pieces are matched by what they compute (kind and expression), not by name.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorium.functions.scalar import bin_time, ieq, parse_span
from sensorium.plans.views import Agg, ViewDef
from sensorium.schemas import QUALITY_GOOD
from sensorium.streaming.incremental import PERIOD, IncrementalView

_PARTS = {"count": ("n",), "countif": ("n",), "avg": ("s", "c"), "min": ("min",), "max": ("max",)}
_MERGE = {"n": F.sum, "s": F.sum, "c": F.sum, "min": F.min, "max": F.max}


def _identity(agg: Agg) -> tuple[str, str]:
    return agg.kind, "" if agg.expr is None else str(agg.expr())


def _days(time_range: tuple | None) -> tuple | None:
    """A half-open range as (first, last) whole days; raises if it cuts one."""
    if time_range is None:
        return None
    lo, hi = time_range
    for bound in (lo, hi):
        if bound is not None and (not isinstance(bound, dt.datetime) or bound.time() != dt.time()):
            raise ValueError("not whole days")
    return (None if lo is None else lo.date().isoformat(), None if hi is None else (hi.date() - dt.timedelta(days=1)).isoformat())


class Lattice:
    """Stored views of one source, and its raw rows for what they don't cover."""

    def __init__(self, stores: Sequence[IncrementalView], raw: Callable[[], DataFrame]):
        self.stores = list(stores)
        self.raw = raw

    @staticmethod
    def covers(stored: ViewDef, want: ViewDef, filters: Sequence[str] = ()) -> bool:
        """Whether partials of ``stored`` hold all that ``want`` needs."""
        if stored.source != want.source or not set(want.keys) | set(filters) <= set(stored.keys):
            return False
        if want.span and (not stored.span or parse_span(want.span) % parse_span(stored.span)):
            return False
        return {_identity(a) for a in want.aggs} <= {_identity(a) for a in stored.aggs}

    def pick(self, want: ViewDef, filters: Sequence[str] = (), days: tuple | None = None) -> IncrementalView | None:
        """The store with the fewest groups that covers the question."""
        able = [s for s in self.stores if self.covers(s.view, want, filters)
                and (days is None or s.view.span and 86400 % parse_span(s.view.span) == 0)]
        return min(able, key=lambda s: (-parse_span(s.view.span) if s.view.span else float("-inf"), len(s.view.keys)), default=None)

    def partials(self, want: ViewDef, filters: dict | None = None, time_range: tuple | None = None) -> DataFrame:
        """Partials of ``want`` over the rows of ``filters`` (key → value or list) and
        ``time_range`` (half-open)."""
        filters = dict(filters or {})
        try:
            days, whole = _days(time_range), True
        except ValueError:
            days, whole = None, False
        store = self.pick(want, list(filters), days) if whole else None
        if store is None:
            rows, (lo, hi) = self.raw(), time_range or (None, None)
            if lo is not None:
                rows = rows.where(F.col(want.ts) >= F.lit(lo))
            if hi is not None:
                rows = rows.where(F.col(want.ts) < F.lit(hi))
            return want.partial(self._filtered(rows, filters))
        state = self._filtered(store.within(store.partials(), days).drop(PERIOD), filters)
        by_what = {_identity(a): a.name for a in store.view.aggs}
        pieces = {f"{a.name}__{p}": f"{by_what[_identity(a)]}__{p}" for a in want.aggs for p in _PARTS[a.kind]}
        keys = ([bin_time(want.ts, want.span).alias(want.ts)] if want.span else []) + list(want.keys)
        return state.groupBy(*keys).agg(*[_MERGE[new.rpartition("__")[2]](old).alias(new) for new, old in pieces.items()])

    @staticmethod
    def _filtered(rows: DataFrame, filters: dict) -> DataFrame:
        for key, value in filters.items():
            rows = rows.where(F.col(key).isin(list(value)) if isinstance(value, (list, tuple, set)) else F.col(key) == F.lit(value))
        return rows

    def answer(self, want: ViewDef, filters: dict | None = None, time_range: tuple | None = None) -> DataFrame:
        """``want`` over the source, as ``want.compute`` of its rows gives it."""
        return want.finalize(self.partials(want, filters, time_range))


#: Partials by sensor and day that hold every piece of the measure layer.
BY_SENSOR = {
    "readings": ViewDef("readings_by_sensor_daily", "readings", "1d", ("SensorId",), (
        Agg("n", "count"),
        Agg("anom", "countif", lambda: F.col("IsAnomaly")),
        Agg("good", "countif", lambda: F.col("QualityFlag") == QUALITY_GOOD),
        Agg("v", "avg", lambda: F.col("ReadingValue")),
        Agg("vmin", "min", lambda: F.col("ReadingValue")),
        Agg("vmax", "max", lambda: F.col("ReadingValue")),
    )),
    "alerts": ViewDef("alerts_by_sensor_daily", "alerts", "1d", ("SensorId",), (
        Agg("n", "count"),
        Agg("crit", "countif", lambda: ieq("Severity", "CRITICAL")),
        Agg("warn", "countif", lambda: ieq("Severity", "WARNING")),
    )),
}
#: Where the measure layer's pieces are in them.
_PIECE = {"n": "n__n", "anom": "anom__n", "good": "good__n", "vsum": "v__s", "vcnt": "v__c", "vmin": "vmin__min",
          "vmax": "vmax__max", "crit": "crit__n", "warn": "warn__n"}


class SensorPieces:
    """Pieces of one fact by sensor, from a store of ``BY_SENSOR[fact]``."""

    def __init__(self, store: IncrementalView):
        self.store = store

    def per_sensor(self, fact: str, names: list[str], own_filters: dict, time_range: tuple | None) -> DataFrame | None:
        """(_sensor, fact__name…), or None where the partials don't cover the question:
        filters on columns of the fact, and ranges that cut a day."""
        try:
            days = _days(time_range)
        except ValueError:
            return None
        if own_filters or not set(names) <= set(_PIECE):
            return None
        state = self.store.within(self.store.partials(), days)
        return state.groupBy(F.col("SensorId").alias("_sensor")).agg(
            *[_MERGE[_PIECE[n].rpartition("__")[2]](_PIECE[n]).alias(f"{fact}__{n}") for n in names])
