"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorium.llm.common import materialise


def connected(links: DataFrame) -> DataFrame:
    """(node, root) of each node of ``links`` (a, b); the root is the component's
    smallest node.  Alternates large-star and small-star steps until nothing
    changes, which takes a number of rounds logarithmic in the components' size.
    Each round is a written table of at most as many rows as there are links."""
    edges = materialise(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct(), "links")
    if not edges.limit(1).count():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = materialise(large.distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            small.select("a", F.col("m").alias("b")))
        edges = materialise(small.where("a <> b").distinct(), "small-star")


def connected_more(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """What ``connected`` returns for the links that ``roots`` (its result; None: no links)
    stands for together with ``links``, as a written table.  Components are known by their
    roots, so only links between them take rounds; without any, ``roots`` is returned as it is."""
    if roots is None:
        return materialise(connected(links), "roots")
    for side in ("a", "b"):
        known = roots.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root"))
        links = links.join(known, side, "left").withColumn(f"{side}_root", F.coalesce(f"{side}_root", side))
    moved = materialise(connected(links.select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))), "moved")
    if not moved.limit(1).count():
        return roots
    new = moved.select(F.col("node").alias("root"), F.col("root").alias("new"))
    out = roots.join(new, "root", "left").select("node", F.coalesce("new", "root").alias("root"))
    return materialise(out.unionByName(moved.join(roots.select("node"), "node", "left_anti")), "roots")
