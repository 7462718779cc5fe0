"""Ranked lexical search over bags of terms, with equal bags scored once.

A document's score for an item depends only on how often it holds the items'
terms (its tf vector) and on its length norm ``m``.  Copies and boilerplate give
many documents with the same two, so:

1. Bags.  One pass over the whole texts counts each document's terms and keeps
   those of the items' vocabulary, as (term number, tf) in ascending order.
   ``N``, ``L`` and the terms' document frequencies are aggregated from it, and
   with them each document's ``m``.
2. Classes.  Documents are grouped by a hash of (m, vector), and by the two
   themselves, so equal hashes of different bags never meet.  The ``k`` smallest
   ids of a class are all that a ranking of ``k`` can name; the limit is applied
   before the shuffle (a window group limit), so a class of any size costs ``k``
   rows a task.
3. Scores.  A class is scored once, by the row of its smallest id: a task
   multiplies blocks of classes by the items' weights, block of items by block
   of items, and keeps the ``k`` best classes of each item.  A class that is not
   among the ``k`` best by (score, smallest id) has ``k`` documents ahead of all
   of its own, so this is exact.
4. Members.  The best classes are expanded to their documents, by ascending id.

Scores are 64-bit integers.  They are summed as doubles while every partial sum
is an integer under 2**53, which the weights prove per item; else as integers.

The vocabulary goes to the tasks by broadcast if its bytes, counted first, are
within ``max_bytes``; else the documents' terms are joined to it.  Items are
scored in blocks of at most ``max_bytes``, each in one pass over the classes.

Defined results: null and empty texts have no terms; documents without id rank
after the others with their score; repeated rows are documents of their own;
rows of items with equal id and equal terms are one item, items without terms
have no rows; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorium.llm.common import map_arrow, materialise, table

K = 10
TOP_SCORE = 1_000_000_000
MAX_BYTES = 32 << 20
ITEM_BLOCK = 512
CLASS_BLOCK = 512

# Terms of a UTF-8 text with A-Z lower-cased: every byte from 0x80 on is part of a letter beyond ASCII.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_BAG = "id long, n long, terms array<int>, tfs array<int>"


def terms(text: bytes | None) -> list[bytes]:
    return _TERM.findall((text or b"").lower())


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted(set(terms(t))) for t in batch.column(1).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.binary())).cast(pa.list_(pa.string()))],
                                         names=["item_id", "terms"])


def _bags(vocabulary):
    """Counts of the vocabulary's terms per text; with no vocabulary at hand, of all terms by name."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value if vocabulary is not None else None
        kind = pa.list_(pa.int32()) if number is not None else pa.list_(pa.string())
        for batch in batches:
            sizes, names, tfs = [], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                found = terms(text)
                sizes.append(len(found))
                if number is not None:
                    bag = Counter(filter(None, map(number.get, found)))
                else:
                    bag = Counter(x.decode() for x in found)
                pairs = sorted(bag.items())
                names.append([t for t, _ in pairs])
                tfs.append([n for _, n in pairs])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(names, kind),
                                              pa.array(tfs, pa.list_(pa.int32()))], names=["id", "n", "terms", "tfs"])
    return run


def _joined_bags(docs: DataFrame, numbers: DataFrame) -> DataFrame:
    """The bags where the vocabulary is too large to send around: terms joined to it."""
    named = materialise(map_arrow(docs, _bags(None), "id long, n long, terms array<string>, tfs array<int>")
                        .withColumn("row", F.monotonically_increasing_id()), "search-named-bags")
    held = named.select("row", F.explode(F.arrays_zip("terms", "tfs")).alias("x")).select("row", "x.*")
    held = held.join(numbers.withColumnRenamed("name", "terms"), "terms")
    held = held.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("number", "tfs"))).alias("bag"))
    bag = F.coalesce("bag", F.array().cast("array<struct<number:int,tfs:int>>"))
    return named.select("row", "id", "n").join(held, "row", "left").select(
        "id", "n", bag["number"].alias("terms"), bag["tfs"].alias("tfs"))


def _best(scores: np.ndarray, heads: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k best scores above 0, ties by the smaller head."""
    rows = np.flatnonzero(scores > 0)
    if len(rows) > k:
        least = np.partition(scores[rows], len(rows) - k)[len(rows) - k]
        rows = rows[scores[rows] >= least]
    return rows[np.lexsort((heads[rows], -scores[rows]))][:k]


def _item_blocks(listed) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(first item, term numbers in use, weights by term and item) of blocks of items."""
    out = []
    for s in range(0, len(listed), ITEM_BLOCK):
        part = listed[s:s + ITEM_BLOCK]
        used = np.unique(np.concatenate([t for _, t, _ in part]))
        exact = max(int(w.sum()) for _, _, w in part) * (TOP_SCORE // 1000) < 1 << 53
        weights = np.zeros((len(used), len(part)), np.float64 if exact else np.int64)
        for j, (_, t, w) in enumerate(part):
            weights[np.searchsorted(used, t), j] = w
        out.append((s, used, weights))
    return out


def _score(items, k: int):
    """The best classes of each item among those of a task: items is a broadcast list of
    (item number, term numbers, weights)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = items.value
        blocks = _item_blocks(listed)
        none = np.empty(0, np.int64)
        best = [(none, none, none) for _ in listed]
        for batch in batches:
            for low in range(0, batch.num_rows, CLASS_BLOCK):
                rows = batch.slice(low, CLASS_BLOCK)
                names, heads, m = (rows.column(i).to_numpy() for i in range(3))
                numbers, tf = (rows.column(i).flatten().to_numpy().astype(np.int64) for i in (3, 4))
                at = np.repeat(np.arange(rows.num_rows), rows.column(3).value_lengths().to_numpy())
                part = (TOP_SCORE * tf) // (1000 * tf + 8 * m[at])
                for s, used, weights in blocks:
                    column = np.searchsorted(used, numbers)
                    column[column == len(used)] = 0
                    here = used[column] == numbers
                    dense = np.zeros((rows.num_rows, len(used)), weights.dtype)
                    dense[at[here], column[here]] = part[here]
                    scores = (dense @ weights).astype(np.int64)
                    floors = np.array([b[2][-1] if len(b[2]) == k else 1 for b in best[s:s + weights.shape[1]]])
                    for j in np.flatnonzero((scores >= floors).any(axis=0)).tolist():
                        good = np.flatnonzero(scores[:, j] >= floors[j])
                        old = best[s + j]
                        new = [np.append(x, y) for x, y in zip(old, (names[good], heads[good], scores[good, j]), strict=True)]
                        keep = _best(new[2], new[1], k)
                        best[s + j] = tuple(x[keep] for x in new)
        counts = [len(b[0]) for b in best]
        if sum(counts):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat([i for i, _, _ in listed], counts), pa.int64()),
                 *[pa.array(np.concatenate([b[i] for b in best])) for i in range(3)]],
                names=["item", "class", "head", "score"])
    return run


def _numbered(names: DataFrame) -> DataFrame:
    """Distinct names with numbers from 1 on that are nearly without gaps."""
    rows = materialise(names.distinct().withColumn("at", F.monotonically_increasing_id()), "search-names")
    place = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    width = (rows.agg(F.max(place).alias("w")).first()["w"] or 0) + 1
    number = F.shiftright("at", 33) * width + place + 1
    return materialise(rows.select("name", number.cast("int").alias("number")), "search-terms")


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text: str = "text", k: int = K, max_bytes: int = MAX_BYTES) -> DataFrame:
    """(item id, rank, doc id, score): each item's ``k`` best documents with a score above 0."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    asked = map_arrow(asked, _item_terms, "item_id long, terms array<string>").where("size(terms) > 0").distinct()
    asked = materialise(asked.withColumn("item", F.monotonically_increasing_id()), "search-items")
    numbers = _numbered(asked.select(F.explode("terms").alias("name")))

    size = numbers.agg(F.sum(F.octet_length("name") + 120).alias("a")).first()["a"] or 0
    if size <= max_bytes:
        vocabulary = spark.sparkContext.broadcast({r["name"].encode(): r["number"] for r in numbers.toLocalIterator()})
        bags = map_arrow(texts, _bags(vocabulary), _BAG)
    else:
        bags = _joined_bags(texts, numbers)
    bags = materialise(bags.where("n > 0"), "search-bags")

    total = bags.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    frequency = bags.select(F.explode("terms").alias("number")).groupBy("number").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * total["docs"] + 2)) / (2 * F.col("df") + 1))).cast("long")
    weights = asked.select("item", F.explode("terms").alias("name")).join(numbers, "name").join(frequency, "number")
    weights = materialise(weights.select("item", "number", weight.alias("w")), "search-weights")

    m = F.expr(f"10 + (90 * n * {total['docs']}) div {max(total['terms'], 1)}")
    rows = bags.where("size(terms) > 0").select("id", m.alias("m"), "terms", "tfs")
    rows = rows.withColumn("hash", F.xxhash64("m", "terms", "tfs"))
    same_bag = Window.partitionBy("hash", "m", "terms", "tfs")
    members = rows.withColumn("place", F.row_number().over(same_bag.orderBy(F.asc_nulls_last("id")))).where(F.col("place") <= k)
    members = members.withColumn("row", F.monotonically_increasing_id())
    members = members.withColumn("class", F.first("row").over(same_bag.orderBy("place")))
    members = materialise(members.select("id", "class", "place", "m", "terms", "tfs"), "search-members")
    classes = members.where("place = 1").select("class", F.coalesce("id", F.lit((1 << 63) - 1)).alias("head"), "m", "terms", "tfs")

    blocks = -(-weights.count() * 16 // max_bytes)
    best = None
    for block in range(blocks):
        here = weights.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        per_item = here.groupBy("item").agg(F.array_sort(F.collect_list(F.struct("number", "w"))).alias("x"))
        listed = [(r["item"], np.array([x["number"] for x in r["x"]], np.int64), np.array([x["w"] for x in r["x"]], np.int64))
                  for r in per_item.toLocalIterator()]
        if not listed:
            continue
        scored = map_arrow(classes, _score(spark.sparkContext.broadcast(listed), k),
                           "item long, class long, head long, score long")
        of_item = Window.partitionBy("item").orderBy(F.desc("score"), "head", "class")
        scored = scored.withColumn("place", F.row_number().over(of_item)).where(F.col("place") <= k).drop("place", "head")
        scored = materialise(scored, f"search-best-{block}")
        best = scored if best is None else best.unionByName(scored)
    if best is None:
        best = spark.createDataFrame([], "item long, class long, score long")

    found = members.select("class", "id").join(best, "class")
    ranked = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    found = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return found.join(asked.select("item", "item_id"), "item").select(
        F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def op11_lexical_search(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH lowered AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
sizes AS (SELECT row, doc_id, len(terms) AS n FROM lowered WHERE len(terms) > 0),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
held AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM lowered) GROUP BY row, term),
df AS (SELECT term, count(*) AS df FROM held GROUP BY term),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
          FROM benchmark),
weights AS (SELECT item_id, term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)::DOUBLE))::BIGINT AS w
            FROM asked JOIN df USING (term), totals),
scores AS (
  SELECT item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // totals.terms))))::BIGINT AS score
  FROM weights JOIN held USING (term) JOIN sizes USING (row), totals GROUP BY item_id, row, doc_id),
ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, row) AS rank
           FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
