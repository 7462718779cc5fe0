"""Mixing sources to target weights by entropy balancing.

Each source gets a target number of words: its weight's share of the budget,
but no more than ``max_copies`` times what it has; what that leaves over is
shared again by weight.  Document rates are those closest to "every document
once" in relative entropy that meet the targets: the solution of the convex
dual is an exponential tilt, rate = min(max_copies, exp(lambda * size / mean
size)), with one multiplier per source.  Newton steps, kept inside a shrinking
bracket, find the multipliers; each step is one distributed aggregation.

A rate depends on a document only through its source and size, so all steps
run over the table of (source, size, count), built by one map-side-combined
aggregation.  Rounding goes over the same cells, largest sizes first: a cell of
n documents gets the whole number of copies nearest to what its rates ask for
plus what larger cells left over, so a source misses its target by about half
a short document.  Which documents of a cell get the extra copy follows their
rank by hash in the cell; large cells are ranked in buckets.

Sums are exact decimals and ties are broken by id and text, so reruns agree.

Defined results: a null source is a source of its own, last in order; null and
empty texts have size 0 and take nothing; repeated rows are documents each;
an empty table gives an empty result; only the named columns are read.
There may be any number of sources: their sizes, targets and multipliers are
written tables, and what comes to the driver are a few sums a step.
"""

from __future__ import annotations

import itertools

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorium.llm.common import broadcast_checked, materialise, table, whole_row, words, workers_see_package

WEIGHTS = (5.0, 2.0, 1.0)
BUDGET = 1.5
MAX_COPIES = 2
MAX_STEPS = 80
UNIT = 1 << 20  # rates are rounded to this grid, so that their sums are exact
BUCKET_ROWS = 1_000


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def _exact(x: Column) -> Column:
    return F.sum(x.cast("decimal(38,9)")).cast("double")


def in_order(sources: DataFrame) -> DataFrame:
    """``sources`` (with a column ``source``) and ``place``, from 0, by code point, null last.  Sorted
    by ranges; a part's first place is the number of rows in the parts before it."""
    rows = sources.orderBy(F.col("source").isNull(), "source").withColumn("_at", F.monotonically_increasing_id())
    rows = materialise(rows, "sources-sorted")
    part = F.shiftright("_at", 33).cast("int")
    counts = {r["part"]: r["n"] for r in rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}  # a row per part
    first = list(itertools.accumulate((counts.get(i, 0) for i in range(max(counts, default=0) + 1)), initial=0))
    return rows.withColumn("place", F.get(F.array(*map(F.lit, first)), part) + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at")


def source_targets(cells: DataFrame, weights=WEIGHTS, budget: float = BUDGET, cap: float = MAX_COPIES) -> DataFrame:
    """(source, words, docs, target) per source of the cells: ``budget`` times all words by weight, at most
    ``cap`` times the source's own, the excess shared again by weight.

    A source is full when its share, level * weight, is over its cap.  Each round sets the level
    by what the full ones leave to the others; it only rises, until no more become full."""
    found = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words"), F.sum("n").alias("docs"))
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("place", F.lit(len(weights))).cast("int"))
    found = materialise(in_order(found).select("source", "words", "docs", weight.alias("weight")), "sources")
    most = F.col("words") * float(cap)
    total = float(budget) * (found.agg(F.sum("words")).first()[0] or 0)
    share, n_full = F.lit(0.0), -1
    while True:
        full = share > most
        row = found.agg(F.sum(F.when(full, F.col("words")).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))),
                        F.count_if(full)).first()
        held, open_weight, now_full = row[0] or 0, row[1] or 0.0, row[2]
        if now_full == n_full or not open_weight:
            break
        n_full = now_full
        share = F.col("weight") * F.lit((total - float(cap) * held) / open_weight)
    target = F.when(share > most, most).otherwise(share) if open_weight else most
    return materialise(found.select("source", "words", "docs", target.alias("target")), "targets")


def _with_rates(cells: DataFrame, params: DataFrame, cap: float) -> DataFrame:
    tilt = F.exp(F.least(F.col("lambda") * F.col("size") / F.col("mean"), F.lit(50.0)))
    rate = F.when(F.col("full"), F.lit(float(cap))).otherwise(F.least(F.lit(float(cap)), tilt))
    params = params.select(F.col("source").alias("p_source"), "lambda", "mean", "full")
    return cells.join(params, _same("source", "p_source")).drop("p_source").withColumn("rate", rate)


def solve(cells: DataFrame, goals: DataFrame, cap: float = MAX_COPIES) -> DataFrame:
    """(source, lambda, mean, full): the dual's multipliers, by safeguarded Newton steps over the cells
    towards the targets of ``goals``.  A step is one aggregation by source of the cells, and one written
    table of a row per source."""
    no, far = F.lit(False), float("inf")
    full, words = F.col("target") >= cap * F.col("words"), F.col("words")
    state = goals.select("source", "target", F.greatest(words / F.greatest("docs", F.lit(1)), F.lit(1e-9)).alias("mean"),
                         full.alias("full"), ((words > 0) & ~full).alias("busy"),
                         F.when((words > 0) & ~full, F.log(F.greatest("target", F.lit(1e-300)) / words)).otherwise(0.0).alias("lambda"),
                         F.lit(-far).alias("low"), F.lit(far).alias("high"))
    state = materialise(state, "multipliers")
    for _ in range(MAX_STEPS):
        if not state.where("busy").limit(1).count():
            break
        mass = F.col("n") * F.col("size") * F.col("rate")
        slope = F.when(F.col("rate") < cap, mass * F.col("size") / F.col("mean")).otherwise(0.0)
        got = _with_rates(cells, state.where("busy"), cap).groupBy(F.col("source").alias("g_source")).agg(
            _exact(mass).alias("f"), _exact(slope).alias("g"))
        x, gap = F.col("lambda"), F.col("f") - F.col("target")
        low, high = F.when(gap < 0, x).otherwise(F.col("low")), F.when(gap < 0, F.col("high")).otherwise(x)
        newton = x - gap / F.when(F.col("g") > 0, F.col("g"))
        outward = x + F.when(gap < 0, 1.0).otherwise(-1.0) * F.greatest(F.lit(1.0), F.abs(x))
        inside = lambda v: F.coalesce((low < v) & (v < high), no)  # noqa: B023, E731
        step = F.when(inside(newton), newton).when((low == -far) | (high == far), outward).otherwise((low + high) / 2)
        met = F.abs(gap) <= 1e-7 * F.col("target")
        stuck = (step == x) | ~inside(step)  # no number lies between
        moved = F.coalesce(F.col("busy") & ~met & ~stuck, no)
        state = state.join(got, _same("source", "g_source"), "left").select(
            "source", "target", "mean", "full", moved.alias("busy"), F.when(moved, step).otherwise(x).alias("lambda"),
            F.when(moved, low).otherwise(F.col("low")).alias("low"), F.when(moved, high).otherwise(F.col("high")).alias("high"))
        state = materialise(state, "multipliers")
    return state.select("source", "lambda", "mean", "full")


def _quotas(cells: pa.Table) -> pa.Table:
    """Extra copies per cell of one source, largest sizes first.  One source has
    at most one cell per size, so its rows are bounded by the longest text."""
    cells = cells.sort_by([("size", "descending")])
    carry, out = 0, []
    for size, n, part in zip(*(cells[c].to_pylist() for c in ("size", "n", "part")), strict=True):
        wanted = n * part * size + carry  # words, in units of the grid
        quota = min(max((2 * wanted + size * UNIT) // (2 * size * UNIT), 0), n) if size else 0
        carry = wanted - quota * size * UNIT
        out.append(quota)
    return cells.append_column("quota", pa.array(out, pa.int64()))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, budget: float = BUDGET, cap: int = MAX_COPIES, carry: dict | None = None) -> DataFrame:
    """One row per row of ``docs``: id, ``size``, ``source_size``, ``target``, ``copies``
    and ``taken``.  ``carry`` adds columns by expression."""
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source"),
                       F.size(words(F.col(text_col))).cast("long").alias("size"), F.xxhash64(text_col).alias("_text"),
                       *[e.alias(k) for k, e in (carry or {}).items()])
    base = materialise(base, "sizes")
    cells = materialise(base.groupBy("source", "size").agg(F.count("*").alias("n")), "cells")
    goals = source_targets(cells, weights, budget, cap)
    rated = _with_rates(cells, solve(cells, goals, cap), cap)
    whole = F.floor("rate").cast("long")
    rated = rated.select("source", "size", "n", whole.alias("whole"),
                         F.round((F.col("rate") - whole) * UNIT).cast("long").alias("part"))
    workers_see_package(spark)
    schema = "source string, size long, n long, whole long, part long, quota long"
    quotas = materialise(rated.groupBy("source").applyInArrow(_quotas, schema), "quotas")
    info = goals.select(F.col("source").alias("i_source"), F.col("words").alias("source_size"), "target")
    small, _ = broadcast_checked(quotas.withColumnsRenamed({"source": "q_source", "size": "q_size"}), 200_000)
    rows = base.join(small, F.col("source").eqNullSafe(F.col("q_source")) & (F.col("size") == F.col("q_size")))
    rows = rows.drop("q_source", "q_size")
    rows = rows.withColumn("_hash", F.xxhash64("_id", "size"))
    rows = rows.withColumn("_bucket", F.pmod("_hash", F.ceil(F.col("n") / BUCKET_ROWS)))
    # Ranks in a cell: a bucket holds about BUCKET_ROWS rows, a cell n / BUCKET_ROWS buckets.
    filled = rows.groupBy("source", "size", "_bucket").agg(F.count("*").alias("_rows"))
    before = filled.withColumn("_before", F.coalesce(F.sum("_rows").over(
        Window.partitionBy("source", "size").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    before = before.where("_before > 0").select(F.col("source").alias("b_source"), F.col("size").alias("b_size"),
                                                F.col("_bucket").alias("b_bucket"), "_before")
    before, _ = broadcast_checked(materialise(before, "ranks-before"), 200_000)
    rank = F.row_number().over(Window.partitionBy("source", "size", "_bucket").orderBy("_hash", "_id", "_text"))
    rows = rows.withColumn("_rank", rank).join(
        before, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("size") == F.col("b_size"))
        & (F.col("_bucket") == F.col("b_bucket")), "left")
    copies = F.col("whole") + (F.col("_rank") + F.coalesce("_before", F.lit(0)) <= F.col("quota")).cast("long")
    rows = rows.join(broadcast_checked(info, 200_000)[0], _same("source", "i_source"))
    return rows.select(F.col("_id").alias(id_col), "size", "source_size", "target", copies.alias("copies"),
                       (copies * F.col("size")).alias("taken"), *(carry or {}))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with their columns."""
    rows = mix(docs, id_col, text_col, source_col, carry={"_doc": whole_row(docs)})
    return rows.select(F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))), "_doc").select("_doc.*")


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
