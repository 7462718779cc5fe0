"""Similarity join of shingle sets with adaptive multi-match prefixes.

Two documents link when the Jaccard similarity of their sets of word shingles
reaches ``percent`` / 100.  All documents share one order of tokens: tokens
found in many prefixes last, the others by hash.  If x links with anything, the
overlap is at least ceil(t |x|), so the first |x| - ceil(t |x|) + l tokens of x
and of its partner have l of them in common, for any l.

1. Sets.  Each text gives its set's size, digest and the first tokens by hash.
   Texts with equal sets are one node from here on.
2. Order.  Tokens are counted over all these lists; those in more than
   ``hot_df`` lists are hot and go last, the more frequent the later.  A node
   whose list has too few other tokens reads its whole set again from its text,
   and tokens that many of these sets share are hot as well.
3. Adaptive prefixes.  For each l a node's cost is estimated: the entries that its
   prefix meets - the sum of (frequency - 1), growing with l - and the candidates
   among them, entries / l at most, that must be verified.  The cheapest l is taken,
   so costly nodes get longer prefixes and need more shared tokens; a pair needs the
   smaller l of its two.
4. Dense buckets.  Where many nodes share a token, each is paired with the
   bucket's hub, which is linear in the rows.  Pairs with enough matches are
   verified, and links merge nodes into provisional components; nodes that are
   left get hubs of their own in the next round.  After a few rounds a large
   group of variants of one text is one component but for stragglers.
5. All the rest.  Pairs of nodes of *different* components in one bucket are
   counted, filtered by the number of shared prefix tokens and by the bound
   that it sets on the overlap, and verified.  Pairs inside a component are
   never formed; no link between two components can be missed.
6. Components that meet in many rows aren't compared row by row.  A pivot p, the
   smallest set among a component and those that it meets, is taken out of all
   their sets.  If x or y isn't linked with p, then |y & p| < t (|x| + |y|) / (1 + t)
   for that one, so x and y, to be linked, share tokens outside of p: at least
   t (|x| + |y|) / (1 + t) less what the poorer of them shares with p.  Variants of
   one text share little but that text, so what is left of them meets rarely.
   The rows are those of the sets, whatever the number of pairs.

Verification drops pairs whose odd sketches prove too large a difference, and
intersects the whole sets of the others.  Only their texts are read for it.

Defined results: null, empty and blank texts have an empty set, link with
nothing and are their own component; a document's component is the smallest
id reachable, itself included; null ids stay null, and a component of rows
without ids is null; repeated rows are documents with equal sets; an empty
table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorium.llm.common import broadcast_checked, map_arrow, materialise, table
from sensorium.llm.components import connected_more
from sensorium.llm.shingles import least_difference, odd_sketch, set_digest, shingle_set

K = 3
PERCENT = 90
HOT_DF = 10
#: Longest prefixes that are looked at: this many tokens more than the plain one, less one.
MAX_MATCHES = 8
#: What verifying a candidate costs, in entries of a token's list.
VERIFY_COST = 8
#: Tokens in more prefixes than this are dense; their buckets get hubs before pairs are formed.
DENSE_DF = 16
HUB_ROUNDS = 4
#: Two components that meet in more pairs of rows than this are compared outside a pivot.
DIRECT_ROWS = 32
BROADCAST_ROWS = 200_000


def _ceil_share(n, percent: int):
    """ceil(percent * n / 100), for numbers and columns of whole numbers."""
    return F.ceil(n * percent / 100) if isinstance(n, Column) else -(-percent * n // 100)


def prefix_length(n, percent: int):
    """Tokens of a set of ``n`` of which one at least is shared with any partner."""
    return n - _ceil_share(n, percent) + 1


_SKETCH = "id long, digest binary, n int, tokens array<long>, row long, odd binary"


def _sketch(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, sizes, lists, sketches = [], [], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                hashes = shingle_set(text, k)
                prefix = prefix_length(len(hashes), percent)
                sizes.append(len(hashes))
                digests.append(set_digest(hashes) if len(hashes) else None)
                sketches.append(odd_sketch(hashes))
                lists.append(hashes[:prefix + MAX_MATCHES - 1 + max(8, prefix // 4)])
            offsets = np.append(0, np.cumsum([len(x) for x in lists])).astype("i4")
            values = np.concatenate(lists) if lists else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)), batch.column(2),
                 pa.array(sketches, pa.binary())], names=["id", "digest", "n", "tokens", "row", "odd"])
    return run


def _whole_sets(k: int, as_list: bool):
    """(node, set) of the rows whose text has the node's set, as tokens or as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sets = [], []
            for node, digest, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                          batch.column(2).cast(pa.binary()).to_pylist(), strict=True):
                hashes = shingle_set(text, k)
                if set_digest(hashes) == digest:
                    nodes.append(node)
                    sets.append(hashes if as_list else hashes.tobytes())
            kind = pa.list_(pa.int64()) if as_list else pa.binary()
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, kind)], names=["node", "tokens"])
    return run


def _any(table: DataFrame) -> bool:
    """Whether a written table has rows."""
    return table.limit(1).count() > 0


def whole_sets(docs: DataFrame, nodes: DataFrame, k: int, as_list: bool, name: str) -> DataFrame:
    """Whole sets of ``nodes`` (node, digest, first_id; a written table), read from one text of each."""
    kind = "array<long>" if as_list else "binary"
    if not _any(nodes):
        return nodes.select("node", F.lit(None).cast(kind).alias("tokens")).limit(0)
    nodes, _ = broadcast_checked(nodes, BROADCAST_ROWS)
    rows = docs.join(nodes, docs["_id"].eqNullSafe(nodes["first_id"])).select("node", "digest", "_text")
    sets = map_arrow(rows, _whole_sets(k, as_list), f"node long, tokens {kind}")
    return materialise(sets.dropDuplicates(["node"]), name)


def _overlaps(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, left, right = (batch.column(i) for i in range(4))
            keep = []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(c[i].as_buffer(), np.int64) for c in (left, right))
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _differences(percent: int):
    """Pairs whose odd sketches leave room for the similarity: J >= t means that the sets
    differ in (1 - t) / (1 + t) of their sizes' sum at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both, left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist()
            keep = [(100 + percent) * least_difference(x, y) <= (100 - percent) * n
                    for n, x, y in zip(both, left, right, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def verify(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, k: int, percent: int, name: str) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    def both_sides(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
        for side in ("a", "b"):
            pairs = pairs.join(table.select(F.col("node").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns]), side)
        return pairs

    def of(pairs: DataFrame, nodes: DataFrame, step: str) -> DataFrame:
        needed = materialise(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), f"{name}-{step}-ids")
        return materialise(nodes.join(broadcast_checked(needed, BROADCAST_ROWS)[0], "node"), f"{name}-{step}-nodes")

    pairs = materialise(pairs.select("a", "b"), name + "-pairs")
    if not _any(pairs):
        return pairs
    met = of(pairs, nodes.select("node", "n", "odd", "digest", "first_id"), "met")
    sketched = both_sides(pairs, met, "n", "odd").select("a", "b", F.col("a_n") + F.col("b_n"), "a_odd", "b_odd")
    pairs = materialise(map_arrow(sketched, _differences(percent), "a long, b long"), name + "-close")
    if not _any(pairs):
        return pairs
    sets = whole_sets(docs, of(pairs, met.select("node", "digest", "first_id"), "close"), k, False, name + "-sets")
    both = both_sides(pairs, sets, "tokens").select("a", "b", "a_tokens", "b_tokens")
    return materialise(map_arrow(both, _overlaps(percent), "a long, b long"), name + "-links")


def _in_order(nodes: DataFrame, hot: DataFrame, percent: int) -> DataFrame:
    """Each node's first tokens in the common order - cold ones by hash, then hot ones
    by level and hash - as ``prefix``; null where its list doesn't hold enough."""
    listed = nodes.select("node", F.explode("tokens").alias("token"))
    hot_here = listed.join(hot, "token").groupBy("node").agg(
        F.array_sort(F.collect_list(F.struct("level", "token")))["token"].alias("hot"))
    out = nodes.join(hot_here, "node", "left").withColumn("hot", F.coalesce("hot", F.array().cast("array<long>")))
    out = out.withColumn("cold", F.array_except("tokens", "hot")).withColumn("need", _need(percent))
    enough = (F.size("cold") >= F.col("need")) | (F.size("tokens") == F.col("n"))
    return out.select("node", "n", "need", "digest", "first_id", F.when(
        enough, F.slice(F.concat("cold", "hot"), F.lit(1), F.col("need"))).alias("prefix"))


def _need(percent: int) -> Column:
    """Tokens that the longest prefix of a node takes."""
    return F.least(F.col("n"), prefix_length(F.col("n"), percent) + (MAX_MATCHES - 1)).cast("int")


def _level(df: Column) -> Column:
    return F.floor(F.log2(df)).cast("int")


def prefixes(docs: DataFrame, nodes: DataFrame, k: int, percent: int, hot_df: int) -> DataFrame:
    """(node, n, matches, length, token, df, early, dense): the tokens of each node's prefix
    that other prefixes have too.  Partners of its size or larger share one of the ``early`` ones; ``dense`` is the number of the node's dense tokens."""
    base = prefix_length(F.col("n"), percent)
    listed = nodes.select("node", F.explode("tokens").alias("token"))
    shared = materialise(listed.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "shared-tokens")
    hot = materialise(shared.where(F.col("df") > hot_df).select("token", _level(F.col("df")).alias("level")), "hot-tokens")

    # Nodes whose list has too few cold tokens read their whole set.  What these sets share
    # beyond the lists is counted, too, and joins the hot tokens; the order is fixed then.
    hot_here = listed.join(broadcast_checked(hot, BROADCAST_ROWS)[0], "token").groupBy("node").agg(F.count("*").alias("hot"))
    first = nodes.select("node", "n", "digest", "first_id", F.size("tokens").alias("size")).join(hot_here, "node")
    first = materialise(first.where((F.col("size") - F.col("hot") < _need(percent)) & (F.col("size") < F.col("n"))), "short-first")
    sets = whole_sets(docs, first.select("node", "digest", "first_id"), k, True, "short-first-sets")
    again = sets.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    again = again.where(F.col("df") > hot_df).select("token", _level(F.col("df")).alias("level"))
    hot = materialise(hot.unionByName(again).groupBy("token").agg(F.max("level").alias("level")), "hot-all")
    hot, _ = broadcast_checked(hot, BROADCAST_ROWS)

    ordered = materialise(_in_order(nodes, hot, percent), "ordered")
    short = materialise(ordered.where("prefix is null").drop("prefix"), "short")
    late = materialise(short.join(first.select("node"), "node", "left_anti"), "short-late")
    sets = sets.join(short.select("node"), "node", "left_semi").unionByName(
        whole_sets(docs, late.select("node", "digest", "first_id"), k, True, "short-late-sets"))
    flagged = sets.select("node", F.explode("tokens").alias("token")).join(hot, "token", "left")
    cold = F.array_sort(F.collect_list(F.when(F.col("level").isNull(), F.col("token"))))
    warm = F.array_sort(F.collect_list(F.when(F.col("level").isNotNull(), F.struct("level", "token"))))["token"]
    full = flagged.groupBy("node").agg(cold.alias("cold"), warm.alias("warm"))
    full = short.select("node", "n", "need").join(full, "node").select(
        "node", "n", F.slice(F.concat("cold", "warm"), F.lit(1), F.col("need")).alias("prefix"))
    full = materialise(full, "short-prefixes")

    rows = ordered.where("prefix is not null").select("node", "n", "prefix").unionByName(full)
    rows = rows.select("node", "n", F.posexplode("prefix").alias("rank", "token"))
    rows = materialise(rows, "prefix-rows")
    # What counts from here on is in how many prefixes a token really is.
    met = rows.join(rows.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "token")

    # Reading the prefix's lists costs a step for each entry; a candidate that is met l times at least
    # costs VERIFY_COST, and there are no more than entries / l of them.  The cheapest l is taken.
    steps = range(1, MAX_MATCHES + 1)
    entries = [F.coalesce(F.sum(F.when(F.col("rank") < base + (m - 1), F.col("df") - 1)), F.lit(0)).alias(f"entries_{m}") for m in steps]
    per_node = met.groupBy("node", "n").agg(*entries, F.collect_list(F.struct("rank", "token", "df")).alias("t"))
    most = F.greatest(F.least(F.lit(MAX_MATCHES), F.col("n") - base + 1), F.lit(1))
    costs = F.array(*[F.struct(F.when(F.lit(m) <= most, F.col(f"entries_{m}") * (1 + VERIFY_COST / m)).otherwise(float("inf")).alias("cost"),
                               F.lit(m).alias("matches")) for m in steps])
    # By explode the choice is made once for a node, not again for each of its tokens below.
    per_node = per_node.select("node", "n", "t", F.explode(F.array(F.array_min(costs)["matches"])).alias("matches"))
    per_node = per_node.withColumn("length", (base + F.col("matches") - 1).cast("int"))
    per_node = per_node.withColumn("t", F.filter("t", lambda x: x["rank"] < F.col("length")))
    per_node = per_node.withColumn("dense", F.size(F.filter("t", lambda x: x["df"] > DENSE_DF)))
    out = per_node.select("node", "n", "matches", "length", "dense", F.explode("t").alias("x"))
    # A partner y at least as large shares t (|x| + |y|) / (1 + t) >= 2 t |x| / (1 + t) tokens, so the
    # first that they share stands before all but that many of x (however many matches it takes).
    early = F.col("x.rank") <= F.col("n") - F.ceil(2 * percent * F.col("n") / (100 + percent))
    return materialise(out.select("node", "n", "matches", "length", "x.token", "x.df", early.alias("early"), "dense"), "prefixes")


def _similar_size(n: Column, m: Column, percent: int) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _to_hubs(dense: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs of each node that is in no component yet with the hub of its dense buckets.
    A bucket's hub is the node with most dense tokens in its prefix: in a group of
    variants of one text, the one with fewest words of its own."""
    alone = dense.join(roots, "node", "left_anti").select("token", "node", "n", "matches", "length", "dense")
    item = F.struct("dense", "node", "n", "matches", "length")
    hubs = alone.groupBy("token").agg(F.max(item).alias("h"))
    pairs = alone.join(hubs, "token").where((F.col("node") != F.col("h.node")) & _similar_size(F.col("n"), F.col("h.n"), percent))
    enough = F.greatest(F.least("matches", "h.matches"), F.least("length", "h.length") / 4)
    # Only what shares a fair part of the prefixes is worth a look here; the rest is done exactly.
    return pairs.groupBy(F.least("node", "h.node").alias("a"), F.greatest("node", "h.node").alias("b")).agg(
        F.count("*").alias("shared"), F.min(enough).alias("enough")).where("shared >= enough")


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _needed(percent: int) -> Column:
    """Shared prefix tokens that a pair (a, b) needs.  What isn't shared in the prefixes is at
    most the longer rest, and J >= t asks for ceil(t (|a| + |b|) / (1 + t)) in all."""
    wanted = F.ceil(percent * (F.col("a_n") + F.col("b_n")) / (100 + percent))
    unseen = F.greatest(F.col("a_n") - F.col("a_length"), F.col("b_n") - F.col("b_length"))
    return F.greatest(F.least("a_matches", "b_matches").cast("long"), wanted - unseen)


def _side(df: DataFrame, s: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{s}_{c}") for c in df.columns])


def _pair(percent: int) -> list[Column]:
    return [F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b"), _needed(percent).alias("needs")]


def _shared_enough(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) with as many rows, uncounted ones included, as they need."""
    counted = rows.groupBy("a", "b").agg((F.count("*") + F.first("uncounted")).alias("shared"), F.first("needs").alias("needs"))
    return counted.where("shared >= needs").select("a", "b")


def _across(rows: DataFrame, dense: DataFrame, roots: DataFrame, docs: DataFrame, nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """Candidate pairs of nodes in different components, by all they share of their prefixes."""
    similar = _similar_size(F.col("a_n"), F.col("b_n"), percent)
    columns = ["token", "root", "node", "n", "matches", "length", "early", "dense"]

    # Small buckets: their rows pairwise, at most DENSE_DF / 2 pairs for each row.
    small = _rooted(rows.where(F.col("df") <= DENSE_DF), roots).select(columns)
    pairs = _side(small, "a").join(_side(small, "b"), (F.col("a_token") == F.col("b_token"))
                                   & (F.col("a_node") < F.col("b_node")) & (F.col("a_root") != F.col("b_root")) & similar)

    # Dense ones: which components meet there by an early token, and by how many pairs of rows.
    dense = materialise(_rooted(dense, roots).select(columns), "rooted")
    held = dense.groupBy("token", "root").agg(F.count("*").alias("c"), F.min(F.when(F.col("early"), F.col("n"))).alias("early"),
                                               F.min("n").alias("low"), F.max("n").alias("high"), F.min("node").alias("node"))
    several = held.groupBy("token").agg(F.count("*").alias("roots")).where("roots > 1").select("token")
    held = materialise(held.join(several, "token"), "bucket-roots")
    sizes = dense.groupBy("root").agg(F.count_distinct("node").alias("size"))
    other = held.select("token", F.col("root").alias("other"), F.col("c").alias("d"), F.col("low").alias("other_low"),
                        F.col("high").alias("other_high"), F.col("node").alias("other_node"))
    # Of two nodes the smaller set's early tokens decide; of equal ones the smaller node's.
    later = (F.col("other_high") > F.col("early")) | ((F.col("other_high") == F.col("early")) & (
        (F.col("c") > 1) | (F.col("d") > 1) | (F.col("node") < F.col("other_node"))))
    meeting = held.where("early is not null").join(other, "token").where(
        (F.col("root") != F.col("other")) & later
        & (100 * F.col("high") >= percent * F.col("other_low"))).groupBy(
        F.least("root", "other").alias("root"), F.greatest("root", "other").alias("other")).agg(
        F.sum(F.col("c") * F.col("d")).alias("by_token"))
    meeting = meeting.join(sizes, "root").join(sizes.select(F.col("root").alias("other"), F.col("size").alias("other_size")), "other")
    meeting = materialise(meeting, "meeting")
    # Rows counted here may lack dense tokens of pairs whose components don't meet by an early
    # dense one; no more than the pair's smaller number of them.
    uncounted = F.least("a_dense", "b_dense")
    pairs = pairs.select(*_pair(percent), uncounted.alias("uncounted"))
    if not _any(meeting):
        return _shared_enough(pairs)

    # Components that meet in few rows: by the rows of those buckets.
    product, direct = F.col("size") * F.col("other_size"), F.least("by_token", F.col("size") * F.col("other_size")) <= DIRECT_ROWS
    few = materialise(meeting.where(direct & (F.col("by_token") <= product)).select("root", "other"), "meeting-few")
    met = held.select("token", "root").join(few, "root").join(other.select("token", "other"), ["token", "other"])
    met = met.join(_side(dense, "a"), (F.col("token") == F.col("a_token")) & (F.col("root") == F.col("a_root")))
    met = met.join(_side(dense, "b"), (F.col("token") == F.col("b_token")) & (F.col("other") == F.col("b_root")) & similar)
    counted = _shared_enough(pairs.unionByName(met.select(*_pair(percent), uncounted.alias("uncounted"))))

    # Components that have few pairs, but meet in more rows: all their pairs.
    members = materialise(dense.select("root", "node", "n").distinct(), "dense-members")
    small = meeting.where(direct & (F.col("by_token") > product)).select("root", "other")
    small = small.join(_side(members, "a"), F.col("root") == F.col("a_root")).join(
        _side(members, "b"), (F.col("other") == F.col("b_root")) & similar)
    counted = counted.unionByName(small.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")))

    # The others: the larger component of each meeting, and all that it meets, less a pivot's tokens.
    larger = (F.col("size") > F.col("other_size")) | ((F.col("size") == F.col("other_size")) & (F.col("root") < F.col("other")))
    many = meeting.where(~direct).select(
        F.when(larger, F.col("root")).otherwise(F.col("other")).alias("hub"),
        F.when(larger, F.col("other")).otherwise(F.col("root")).alias("guest"))
    many = materialise(many, "meeting-many")
    if not _any(many):
        return counted.distinct()
    return counted.unionByName(_outside_pivots(many, members, docs, nodes, k, percent)).distinct()


def _less(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tokens of each row's set that aren't in its pivot's."""
    for batch in batches:
        sets, pivots = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
        rest = [np.setdiff1d(np.frombuffer(sets[i].as_buffer(), np.int64), np.frombuffer(pivots[i].as_buffer(), np.int64), True)
                for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(rest, pa.list_(pa.int64()))],
                                         names=[*batch.schema.names[:-2], "rest"])


def _outside_pivots(many: DataFrame, members: DataFrame, docs: DataFrame, nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """Candidate pairs between the components ``hub`` and ``guest`` of ``many``; ``members`` is (root, node, n)."""
    hosts = many.select("hub").distinct().join(members, F.col("hub") == F.col("root")).withColumn("host", F.lit(True))
    guests = many.join(members, F.col("guest") == F.col("root")).drop("guest").withColumn("host", F.lit(False))
    rows = materialise(hosts.unionByName(guests), "pivot-members")
    pivots = rows.groupBy("hub").agg(F.min(F.struct("n", "node", "root")).alias("p")).select(
        "hub", F.col("p.n").alias("p_n"), F.col("p.node").alias("p_node"), F.col("p.root").alias("p_root"))
    pivots = materialise(pivots, "pivots")
    needed = rows.select("node").distinct().join(nodes.select("node", "digest", "first_id"), "node")
    sets = whole_sets(docs, materialise(needed, "pivot-nodes"), k, False, "pivot-sets")
    held = rows.join(pivots, "hub").join(sets, "node").join(
        sets.select(F.col("node").alias("p_node"), F.col("tokens").alias("p_tokens")), "p_node")
    held = held.select("hub", "host", "root", "node", "n", "p_n", "p_node", "p_root", "tokens", "p_tokens")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in held.schema.fields[:-2])
    rest = materialise(map_arrow(held, _less, f"{kinds}, rest array<long>"), "pivot-rest")
    inside = F.col("n") - F.size("rest")  # shared with the pivot
    linked = 100 * inside >= percent * (F.col("n") + F.col("p_n") - inside)

    with_pivot = rest.where(linked & (F.col("root") != F.col("p_root"))).select(
        F.least("node", "p_node").alias("a"), F.greatest("node", "p_node").alias("b"))
    # Any partner is at least as large as the pivot and as the similarity asks, which bounds what the two
    # share outside of it from below.  Of the tokens outside, the rarest first, all but that many less one
    # suffice to meet: those that most of the group have, as the pivot alone lacks them, come last.
    side = rest.select("hub", "host", "root", "node", "n", "p_n", inside.alias("inside"), linked.alias("linked"), F.explode("rest").alias("token"))
    side = materialise(side, "pivot-tokens")
    often = side.groupBy("hub", "token").agg(F.count("*").alias("often")).where("often > 1")
    least_n = F.greatest(_ceil_share(F.col("n"), percent), F.col("p_n"))
    wanted = F.greatest(F.ceil(percent * (F.col("n") + least_n) / (100 + percent)) - F.col("inside"), F.lit(1))
    length = (F.col("n") - F.col("inside") - wanted + 1).cast("int")
    alone = F.col("n") - F.col("inside") - F.size("t")  # tokens that no other has come first of all
    first = side.join(often, ["hub", "token"]).groupBy("hub", "host", "root", "node", "n", "p_n", "inside", "linked").agg(
        F.array_sort(F.collect_list(F.struct("often", "token")))["token"].alias("t"))
    first = first.withColumn("keep", (length - alone).cast("int")).where("keep > 0")
    first = materialise(first.select("hub", "host", "root", "node", "n", "linked", F.explode(F.slice("t", F.lit(1), F.col("keep"))).alias("token")),
                        "pivot-prefixes")
    a, b = _side(first.where("host"), "a"), _side(first.where("not host"), "b")
    both = a.join(b, (F.col("a_hub") == F.col("b_hub")) & (F.col("a_token") == F.col("b_token")) & ~(F.col("a_linked") & F.col("b_linked"))
                  & _similar_size(F.col("a_n"), F.col("b_n"), percent))
    return with_pivot.unionByName(both.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct())


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, percent: int = PERCENT,
                   hot_df: int = HOT_DF) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id``, ``digest`` (of the set; null:
    empty) and ``row`` (hash of the text)."""
    docs = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"),
                       F.xxhash64(text_col).alias("_row"))
    sets = materialise(map_arrow(docs, _sketch(k, percent), _SKETCH), "sketches")
    nodes = sets.where("digest is not null").groupBy("digest").agg(
        F.min("id").alias("first_id"), F.first(F.struct("n", "tokens", "odd")).alias("s"))
    nodes = nodes.select(F.monotonically_increasing_id().alias("node"), "digest", "first_id", "s.n", "s.tokens", "s.odd")
    nodes = materialise(nodes, "nodes")

    rows = prefixes(docs, nodes, k, percent, hot_df)
    dense = materialise(rows.where(F.col("df") > DENSE_DF), "dense")
    none, roots = nodes.select("node", F.col("node").alias("root")).limit(0), None
    for round_no in range(HUB_ROUNDS):
        found = verify(_to_hubs(dense, none if roots is None else roots, percent), docs, nodes, k, percent, f"hubs-{round_no}")
        if not _any(found):
            break
        roots = connected_more(roots, found)
    pairs = _across(rows, dense, none if roots is None else roots, docs, nodes, k, percent)
    found = verify(pairs, docs, nodes, k, percent, "rest")
    roots = connected_more(roots, found)

    named = roots.join(nodes.select("node", "first_id"), "node").groupBy("root").agg(F.min("first_id").alias("name"))
    labels = nodes.select("node", "digest", "first_id").join(roots, "node", "left").join(named, "root", "left")
    labels = labels.select(F.col("digest").alias("l_digest"), F.coalesce("name", "first_id").alias("component"))
    rows = sets.select("id", "digest", "n", "row")
    linked = rows.join(labels, rows["digest"] == labels["l_digest"], "left")
    return linked.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
                         F.coalesce("component", "id").alias("component_id"), "digest", "row")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay when each group keeps the one with its smallest
    id, with their columns.  Documents without shingles are in no group, and
    groups without any id keep their rows."""
    groups = similar_groups(docs, id_col, text_col, k, percent)
    gone = groups.where(~F.col(id_col).eqNullSafe(F.col("component_id")))
    gone = materialise(gone.select(F.col(id_col).alias("_gid"), F.col("row").alias("_grow")).distinct(), "near-copies")
    gone, _ = broadcast_checked(gone, BROADCAST_ROWS)
    same = docs[id_col].cast("long").eqNullSafe(gone["_gid"]) & (F.xxhash64(docs[text_col]) == gone["_grow"])
    return docs.join(gone, same, "left_anti")


def op2_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return similar_groups(table(spark, sf_dir, "documents")).drop("digest", "row")
