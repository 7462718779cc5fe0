"""Join helpers with an explicit size discipline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes on disk; in memory a dimension of this size takes about ten times as much.
MAX_SOURCE_BYTES = 8 << 20


def source_bytes(df: DataFrame) -> int:
    """Total size of the sources that ``df`` reads, by the optimizer's statistics.
    Nothing is run for it."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_SOURCE_BYTES) -> DataFrame:
    """Hint a broadcast only while the sources of ``df`` are at most ``max_bytes``.

    For dimensions and chains of them joined on their keys, whose rows are
    bounded by their sources'.  Beyond the bound the planner decides (AQE may
    still switch at runtime and splits skewed partitions).
    """
    return F.broadcast(df) if source_bytes(df) <= max_bytes else df


MAX_RANGES = 10
_CELLS = 256


def key_ranges(keys: DataFrame, key: str, max_ranges: int = MAX_RANGES) -> list[tuple[int, int]]:
    """At most ``max_ranges`` ranges (first, last) that together hold every value of a whole-number
    key.  The keys are gathered in ``_CELLS`` cells of equal width, and the widest gaps between
    cells' keys separate the ranges; what comes to the driver is a row per cell."""
    ends = keys.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    if ends["lo"] is None:
        return []
    width = (ends["hi"] - ends["lo"]) // _CELLS + 1
    cell = F.floor((F.col(key) - F.lit(ends["lo"])) / width)
    rows = sorted((r["lo"], r["hi"]) for r in keys.where(F.col(key).isNotNull()).groupBy(cell.alias("cell")).agg(
        F.min(key).alias("lo"), F.max(key).alias("hi")).collect())
    gaps = sorted(range(1, len(rows)), key=lambda i: rows[i - 1][1] - rows[i][0])[:max_ranges - 1]
    starts = [0, *sorted(i for i in gaps if rows[i][0] - rows[i - 1][1] > 1), len(rows)]
    return [(rows[a][0], rows[b - 1][1]) for a, b in zip(starts, starts[1:], strict=False)]


def in_ranges(column: Column, ranges: list[tuple[int, int]]) -> Column:
    """Whether a column lies in one of the ranges: a filter that scans prune by."""
    out = F.lit(False)
    for i, (first, last) in enumerate(ranges):
        here = (column >= F.lit(first)) & (column <= F.lit(last))
        out = here if i == 0 else out | here
    return out
