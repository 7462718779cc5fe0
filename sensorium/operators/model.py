"""The measure layer: a snowflake model (sites ← zones ← sensors ← facts) with
named measures, evaluated per group the way a BI semantic model does.

Plan shape of :meth:`SensorModel.query` (no fact is ever joined to another):

1. each fact is filtered on its own columns (time range) and **pre-aggregated
   by SensorId** into mergeable pieces (counts, sums, min, max).  The partial
   aggregate folds a hot sensor on the map side, so a key holding a third of
   all rows costs one partial row per task, not a third of the data;
2. the per-sensor pieces meet the dimension chain sensors → zones → sites
   (left joins, so unknown sensors form the missing group; dimension filters
   make them inner).  A dimension side is broadcast only after
   :func:`broadcast_if_small` proved its size, otherwise the planner
   chooses (AQE);
3. pieces are re-aggregated by the group attributes;
4. drill-across: every fact's aggregate and the dimension members (for
   measures that are defined on empty groups) are unioned and grouped once by
   the keys (null keys group together, so no null-safe join is needed);
5. measure expressions finalise the pieces; all-missing rows are dropped.

Blank semantics follow the DAX measure definitions: a count of nothing is
missing, ``DIVIDE(a, b, 0)`` gives 0 when b is missing or 0 and missing when a
is missing.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorium.functions.scalar import divide, ieq
from sensorium.operators.joins import MAX_SOURCE_BYTES, broadcast_if_small, in_ranges, key_ranges
from sensorium.schemas import QUALITY_GOOD


def _nz(c: Column) -> Column:
    """A count of nothing is missing (COUNTROWS semantics)."""
    return F.when(c == 0, F.lit(None)).otherwise(c)


def _where(condition: Column) -> Column:
    """1 where the condition holds, else missing."""
    return F.when(condition, F.lit(1))


# Mergeable pieces: (fact, name) → (partial aggregate, input, merge kind, column that the piece filters itself).
PIECES: dict[tuple[str, str], tuple[Callable, Callable[[], Column], str, str | None]] = {
    ("readings", "n"): (F.count, lambda: F.lit(1), "sum", None),
    ("readings", "anom"): (F.count, lambda: _where(F.col("IsAnomaly")), "sum", "IsAnomaly"),
    ("readings", "good"): (F.count, lambda: _where(F.col("QualityFlag") == QUALITY_GOOD), "sum", "QualityFlag"),
    ("readings", "vsum"): (F.sum, lambda: F.col("ReadingValue"), "sum", None),
    ("readings", "vcnt"): (F.count, lambda: F.col("ReadingValue"), "sum", None),
    ("readings", "vmin"): (F.min, lambda: F.col("ReadingValue"), "min", None),
    ("readings", "vmax"): (F.max, lambda: F.col("ReadingValue"), "max", None),
    ("alerts", "n"): (F.count, lambda: F.lit(1), "sum", None),
    ("alerts", "crit"): (F.count, lambda: _where(ieq("Severity", "CRITICAL")), "sum", "Severity"),
    ("alerts", "warn"): (F.count, lambda: _where(ieq("Severity", "WARNING")), "sum", "Severity"),
}
FACTS = ("readings", "alerts")


def _p(fact: str, name: str) -> Column:
    return F.col(f"{fact}__{name}")


@dataclass(frozen=True)
class Measure:
    name: str
    column: str
    pieces: tuple[tuple[str, str], ...]
    final: Callable[[], Column]
    defined_on_empty: bool = False   # DIVIDE(…, alt) measures: value even without facts


MEASURES: dict[str, Measure] = {m.name: m for m in [
    Measure("Total Readings", "TotalReadings", (("readings", "n"),),
            lambda: _nz(_p("readings", "n"))),
    Measure("Avg Reading Value", "AvgReadingValue", (("readings", "vsum"), ("readings", "vcnt")),
            lambda: F.try_divide(_p("readings", "vsum"), _nz(_p("readings", "vcnt")))),
    Measure("Max Reading Value", "MaxReadingValue", (("readings", "vmax"),),
            lambda: _p("readings", "vmax")),
    Measure("Min Reading Value", "MinReadingValue", (("readings", "vmin"),),
            lambda: _p("readings", "vmin")),
    Measure("Anomaly Count", "AnomalyCount", (("readings", "anom"),),
            lambda: _nz(_p("readings", "anom"))),
    Measure("Anomaly Rate", "AnomalyRate", (("readings", "anom"), ("readings", "n")),
            lambda: divide(_nz(_p("readings", "anom")), _nz(_p("readings", "n")), 0.0),
            defined_on_empty=True),
    Measure("Good Quality Rate", "GoodQualityRate", (("readings", "good"), ("readings", "n")),
            lambda: divide(_nz(_p("readings", "good")), _nz(_p("readings", "n")), 0.0),
            defined_on_empty=True),
    Measure("Total Alerts", "TotalAlerts", (("alerts", "n"),),
            lambda: _nz(_p("alerts", "n"))),
    Measure("Critical Alerts", "CriticalAlerts", (("alerts", "crit"),),
            lambda: _nz(_p("alerts", "crit"))),
    Measure("Warning Alerts", "WarningAlerts", (("alerts", "warn"),),
            lambda: _nz(_p("alerts", "warn"))),
    Measure("Alert Rate", "AlertRate", (("alerts", "n"), ("readings", "n")),
            lambda: divide(_nz(_p("alerts", "n")), _nz(_p("readings", "n")), 0.0),
            defined_on_empty=True),
]}
WORST_ZONE_QUALITY = "Worst Zone Quality"
ALL_MEASURES = list(MEASURES) + [WORST_ZONE_QUALITY]

# Dimension attributes and the level of the table that owns them.
LEVEL = {"dim_sites": 0, "dim_zones": 1, "dim_sensors": 2}


@dataclass
class SensorModel:
    """Facts and dimensions of the model, as DataFrames.

    ``readings`` / ``alerts`` need ``SensorId`` plus the columns their pieces
    read; the dimensions need their keys (``site_id``, ``zone_id``/``site_id``,
    ``sensor_id``/``zone_id``) and the attributes queried.
    """
    readings: DataFrame
    alerts: DataFrame
    dim_sites: DataFrame
    dim_zones: DataFrame
    dim_sensors: DataFrame
    timestamp_col: str = "Timestamp"
    broadcast_max_bytes: int = MAX_SOURCE_BYTES
    #: fact → stored pieces by sensor (``operators.navigate.SensorPieces``), used where they cover a question.
    stored: dict = field(default_factory=dict)
    #: Facts clustered by SensorId: filters on dimensions reach their scans as ranges of sensor ids,
    #: for which one small job is run over the dimensions when a query is built.
    clustered: tuple[str, ...] = ()
    _checked: dict = field(default_factory=dict)

    # ---- dimension chain -------------------------------------------------
    @staticmethod
    def _split(attr: str) -> tuple[str, str]:
        tbl, col = attr.split(".", 1)
        if tbl not in LEVEL:
            raise ValueError(f"unknown dimension table in {attr!r}")
        return tbl, col

    def _dim(self, name: str, cols: list[str]) -> DataFrame:
        df = getattr(self, name).select(*cols)
        key = (name, tuple(cols))
        if key not in self._checked:
            self._checked[key] = broadcast_if_small(df, self.broadcast_max_bytes)
        return self._checked[key]

    def _chain(self, attrs: list[str], top_level: int) -> DataFrame:
        """Rows of the table at ``top_level`` with the requested attributes of
        itself and of the tables above it (``sensor_id``/``zone_id``/``site_id``
        keys kept as ``_sensor``/``_zone``/``_site``)."""
        by_tbl: dict[str, list[str]] = {t: [] for t in LEVEL}
        for a in attrs:
            t, c = self._split(a)
            if c not in by_tbl[t]:
                by_tbl[t].append(c)
        if top_level == 2:
            df = self.dim_sensors.select(
                F.col("sensor_id").alias("_sensor"), F.col("zone_id").alias("_zone"),
                *[F.col(c).alias(f"dim_sensors.{c}") for c in by_tbl["dim_sensors"]])
            if by_tbl["dim_zones"] or by_tbl["dim_sites"]:
                df = df.join(self._zone_part(by_tbl), "_zone", "left")
            return df
        if top_level == 1:
            return self._zone_part(by_tbl)
        return self._dim("dim_sites", ["site_id"] + by_tbl["dim_sites"]).select(
            F.col("site_id").alias("_site"),
            *[F.col(c).alias(f"dim_sites.{c}") for c in by_tbl["dim_sites"]])

    def _zone_part(self, by_tbl: dict) -> DataFrame:
        z = self._dim("dim_zones", ["zone_id", "site_id"] + by_tbl["dim_zones"])
        z = z.select(F.col("zone_id").alias("_zone"), F.col("site_id").alias("_site"),
                     *[F.col(c).alias(f"dim_zones.{c}") for c in by_tbl["dim_zones"]])
        if by_tbl["dim_sites"]:
            s = self._dim("dim_sites", ["site_id"] + by_tbl["dim_sites"]).select(
                F.col("site_id").alias("_site"),
                *[F.col(c).alias(f"dim_sites.{c}") for c in by_tbl["dim_sites"]])
            z = z.join(s, "_site", "left")
        return z

    # ---- facts -----------------------------------------------------------
    def _fact(self, fact: str, time_range) -> DataFrame:
        df = getattr(self, fact)
        if time_range is not None:
            lo, hi = time_range
            ts = F.col(self.timestamp_col)
            if lo is not None:
                df = df.where(ts >= (lo if isinstance(lo, Column) else F.lit(lo)))
            if hi is not None:
                df = df.where(ts < (hi if isinstance(hi, Column) else F.lit(hi)))
        return df

    @staticmethod
    def _filter_col(attr: str, value) -> Column:
        c = F.col(f"`{attr}`")
        if isinstance(value, (list, tuple, set)):
            return c.isin(list(value))
        return c == F.lit(value)

    def _per_sensor(self, fact: str, pieces: list, own: dict, time_range, filters: dict) -> DataFrame:
        """Pieces of one fact by sensor, from its rows; ``own`` are filters on its columns,
        ``filters`` on dimensions."""
        rows = self._fact(fact, time_range)
        if filters and fact in self.clustered:
            sensors = self._apply_filters(self._chain(list(filters), 2), filters)
            rows = rows.where(in_ranges(F.col("SensorId"), key_ranges(sensors, "_sensor")))
        # A piece's own filter replaces the caller's on the same column.
        replaced = {column for _, _, _, _, column in pieces if column in own}
        for column in [c for c in own if c not in replaced]:
            rows = rows.where(self._filter_col(column, own[column]))

        def kept(value: Column, column: str | None) -> Column:
            for c in replaced - {column}:
                value = F.when(self._filter_col(c, own[c]), value)
            return value

        return rows.groupBy(F.col("SensorId").alias("_sensor")).agg(
            *[agg(kept(value(), column)).alias(f"{fact}__{n}") for n, agg, value, _, column in pieces])

    def _fact_groups(self, fact: str, names: list[str], keys: list[str], filters: dict,
                     time_range, extra_keys: list[str] = ()) -> DataFrame:
        """Pieces of one fact aggregated by the group attributes."""
        own = {a.split(".", 1)[1]: v for a, v in filters.items() if a.split(".", 1)[0] == fact}
        filters = {a: v for a, v in filters.items() if a.split(".", 1)[0] not in FACTS}
        pieces = [(n, *PIECES[(fact, n)]) for n in names]
        per_sensor = self.stored[fact].per_sensor(fact, names, own, time_range) if fact in self.stored else None
        if per_sensor is None:
            per_sensor = self._per_sensor(fact, pieces, own, time_range, filters)
        attrs = list(dict.fromkeys(list(keys) + list(extra_keys) + list(filters)))
        if attrs:
            chain = self._apply_filters(self._chain(attrs, 2), filters)
            chain = broadcast_if_small(chain, self.broadcast_max_bytes)
            joined = per_sensor.join(chain, "_sensor", "inner" if filters else "left")
        else:
            joined = per_sensor
        merge = {"sum": F.sum, "min": F.min, "max": F.max}
        group_cols = [F.col(f"`{k}`").alias(k) for k in list(keys) + list(extra_keys)]
        return joined.groupBy(*group_cols).agg(
            *[merge[kind](f"{fact}__{n}").alias(f"{fact}__{n}") for n, _, _, kind, _ in pieces])

    def _apply_filters(self, df: DataFrame, filters: dict) -> DataFrame:
        for attr, value in filters.items():
            df = df.where(self._filter_col(attr, value))
        return df

    def _members(self, keys: list[str], filters: dict) -> DataFrame:
        """Dimension members of the group attributes (auto-exist within the
        owning table; filters on that table or tables above it apply)."""
        level = max(LEVEL[self._split(k)[0]] for k in keys)
        member_filters = {a: v for a, v in filters.items()
                          if LEVEL.get(a.split(".", 1)[0], 3) <= level}
        chain = self._chain(list(keys) + list(member_filters), level)
        chain = self._apply_filters(chain, member_filters)
        return chain.select(*[F.col(f"`{k}`").alias(k) for k in keys]).distinct()

    # ---- public API ------------------------------------------------------
    def query(self, group_by: list[str] | None = None, measures: list[str] | None = None,
              filters: dict | None = None, time_range=None, base: str | None = None,
              drop_blank: bool = True) -> DataFrame:
        """Evaluate ``measures`` per combination of ``group_by`` attributes.

        * ``group_by`` — ``"dim_sites.site_name"`` style attributes; empty for
          one row (ROW);
        * ``filters`` — ``{attribute: value or list}`` (CALCULATE / CALCULATETABLE
          filters) on dimension attributes, and on columns of a fact as
          ``"alerts.Severity"``.  A measure that filters the same fact column
          itself replaces the caller's filter with its own;
        * ``time_range`` — ``(lo, hi)``, half-open, on each fact's timestamp;
        * ``base`` — ``"readings"``/``"alerts"``: only combinations present in
          that fact (SUMMARIZE); default: all dimension members
          (SUMMARIZECOLUMNS), rows where every measure is missing dropped.

        Output columns: the attribute column names (``site_name``…) then one
        column per measure (``TotalReadings``…).
        """
        keys = list(group_by or [])
        measures = list(measures or [])
        filters = dict(filters or {})
        for m in measures:
            if m not in ALL_MEASURES:
                raise KeyError(f"unknown measure {m!r}")
        for a in filters:
            if a.split(".", 1)[0] not in FACTS:
                self._split(a)
        plain = [MEASURES[m] for m in measures if m in MEASURES]
        by_fact: dict[str, list[str]] = {}
        for m in plain:
            for fact, name in m.pieces:
                by_fact.setdefault(fact, [])
                if name not in by_fact[fact]:
                    by_fact[fact].append(name)

        parts = []
        marked = False
        for f, names in by_fact.items():
            if f == "readings" and WORST_ZONE_QUALITY in measures:
                continue                      # folded into the zone-type pass below
            part = self._fact_groups(f, names, keys, filters, time_range)
            if f == base:
                # Every group of the base fact's own aggregate is present in
                # that fact: mark it here instead of aggregating the fact again.
                part = part.withColumn(f"_in_{base}", F.lit(1))
                marked = True
            parts.append(part)
        if WORST_ZONE_QUALITY in measures:
            parts.append(self._zone_pass(keys, filters, time_range,
                                             by_fact.setdefault("readings", [])))
        if keys and base is None and (WORST_ZONE_QUALITY in measures or any(m.defined_on_empty for m in plain)):
            parts.append(self._members(keys, filters))

        if not parts:
            raise ValueError("no measure or base fact requested")
        allp = parts[0]
        for p in parts[1:]:
            allp = allp.unionByName(p, allowMissingColumns=True)
        if base is not None and not marked:
            # Only combinations present in the base fact survive.
            present = f"_in_{base}"
            base_part = (self._fact_groups(base, ["n"], keys, filters, time_range)
                         .select(*[F.col(f"`{k}`") for k in keys], F.lit(1).alias(present)))
            allp = allp.unionByName(base_part, allowMissingColumns=True)
        piece_cols = [c for c in allp.columns if "__" in c]
        merge = {}
        for (fact, name), (_, _, kind, _) in PIECES.items():
            merge[f"{fact}__{name}"] = {"sum": F.sum, "min": F.min, "max": F.max}[kind]
        aggs = [merge[c](c).alias(c) for c in piece_cols]
        wzq = F.col("_wzq")
        if WORST_ZONE_QUALITY in measures:
            aggs.append(F.min("_wzq").alias("_wzq"))
            if any(LEVEL[self._split(k)[0]] == 2 for k in keys):
                zt = "dim_zones.zone_type"
                aggs.append(F.count_distinct(F.col(f"`{zt}`")).alias("_zt_seen"))
                visible = {a: v for a, v in filters.items() if LEVEL.get(a.split(".", 1)[0], 3) <= 1}
                all_types = self._apply_filters(self._chain([zt, *visible], 1), visible) \
                    .agg(F.count_distinct(F.col(f"`{zt}`"))).scalar()
                wzq = F.when(F.col("_zt_seen") < all_types, F.lit(0.0)).otherwise(F.col("_wzq"))
        if base is not None:
            aggs.append(F.max(f"_in_{base}").alias(f"_in_{base}"))
        key_cols = [F.col(f"`{k}`").alias(k) for k in keys]
        grouped = allp.groupBy(*key_cols).agg(*aggs) if keys else allp.agg(*aggs)
        if base is not None:
            grouped = grouped.where(F.col(f"_in_{base}").isNotNull())
        out_cols = [F.col(f"`{k}`").alias(self._split(k)[1]) for k in keys]
        for m in measures:
            if m == WORST_ZONE_QUALITY:
                out_cols.append(wzq.alias("WorstZoneQuality"))
            else:
                out_cols.append(MEASURES[m].final().alias(MEASURES[m].column))
        result = grouped.select(*out_cols)
        if keys and drop_blank and measures and base is None:
            names = [MEASURES[m].column if m in MEASURES else "WorstZoneQuality" for m in measures]
            cond = None
            for n in names:
                c = F.col(n).isNotNull()
                cond = c if cond is None else (cond | c)
            result = result.where(cond)
        return result

    def _zone_pass(self, keys: list[str], filters: dict, time_range,
                       names: list[str]) -> DataFrame:
        """Readings pieces per (keys, zone type) plus MINX over zone types of
        Good Quality Rate (G12/G13/G17), in one pass over the readings.

        The zone types iterated are the members visible in the group's filter
        context: zone types of the group's zones when grouping at site or zone
        level, every zone type when grouping by a sensor attribute (a zone type
        without readings rates 0, DIVIDE's alternate); one with readings but no
        Good reading is missing and skipped by the minimum.  The output carries every readings piece (summed again by the
        caller's final group-by) and ``_wzq`` per (keys, zone type).
        """
        zt = "dim_zones.zone_type"
        for piece in ("good", "n"):
            if piece not in names:
                names.append(piece)
        inner_keys = list(dict.fromkeys(keys + [zt]))
        facts = self._fact_groups("readings", names, keys, filters, time_range,
                                  extra_keys=[zt] if zt not in keys else [])
        sensor_level = any(LEVEL[self._split(k)[0]] == 2 for k in keys)
        if sensor_level:
            # A sensor filter does not reach the zones: every zone type is
            # visible.  Instead of pairing each group with each zone type, the
            # caller compares the number of zone types with readings against
            # the number of zone types (a missing one rates 0).
            both = facts
        else:
            members = self._members(inner_keys, {a: v for a, v in filters.items()
                                                 if LEVEL.get(a.split(".", 1)[0], 3) <= 1})
            both = facts.unionByName(members, allowMissingColumns=True)
        key_cols = [F.col(f"`{k}`").alias(k) for k in inner_keys]
        per_zone = both.groupBy(*key_cols).agg(
            *[{"sum": F.sum, "min": F.min, "max": F.max}[PIECES[("readings", n)][2]](
                f"readings__{n}").alias(f"readings__{n}") for n in names])
        rate = divide(_nz(F.col("readings__good")), _nz(F.col("readings__n")), 0.0)
        return per_zone.withColumn("_wzq", rate)
