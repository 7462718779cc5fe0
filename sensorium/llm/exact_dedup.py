"""Exact dedup by skew-safe combining.

Equal texts are found by digest, but two rows count as equal only when their
whole texts are: the text is part of the grouping key of every stage.

1. Digests are counted (map-side combined).  Digests with more than
   ``hot_share`` of all rows are *hot*; there are at most 1 / ``hot_share`` of
   them, which bounds what is broadcast.
2. Local and salted: rows are grouped by (digest, salt, text).  The map side
   of that aggregation is the dedup inside each partition; its reduce side
   merges the local winners of one salt.  Only hot digests have salts, so cold
   texts are shuffled once.
3. Global: the salt winners of hot digests are grouped by (digest, text).
4. Each row looks up the winner of its group, by digest alone; hot digests from
   a broadcast of at most 1 / ``hot_share`` digests.  Where one digest stands
   for several texts (which a test provokes with a weak digest), by text too.

Defined results: a null text equals the empty text; rows with equal text and
equal id are one group in which the id stays (every row with that id says
``kept``); a group whose ids are all null has a null ``keep_id`` and its rows
say ``kept`` = false (``drop_copies`` keeps one row of any group); empty tables
give empty results; other columns of the input are ignored, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorium.llm.common import broadcast_checked, materialise, salted, table, whole_row

HOT_SHARE = 1 / 1000
SALTS = 32


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 digest: Callable[[Column], Column] = sha256, hot_share: float = HOT_SHARE,
                 salts: int = SALTS) -> DataFrame:
    """One row per input row: id, ``keep_id`` (largest id of its group),
    ``group_size``, ``kept`` and ``digest``."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    rows = rows.withColumn("_digest", digest(F.col("_text")))
    keyed = materialise(rows.select("_id", "_digest"), "digests")
    counts = materialise(keyed.groupBy("_digest").agg(F.count("*").alias("_n")).where("_n > 1"), "digest-counts")
    limit = max(salts, hot_share * keyed.count())
    hot = F.broadcast(counts.where(F.col("_n") > limit).select("_digest", F.lit(True).alias("_hot")))

    def mark(df: DataFrame) -> DataFrame:
        return df.join(hot, "_digest", "left").withColumn("_hot", F.coalesce("_hot", F.lit(False)))

    salt = F.when(F.col("_hot"), salted(F.struct("_id"), salts)).otherwise(F.lit(0))
    merged = materialise(
        mark(rows).groupBy("_digest", "_hot", salt.alias("_salt"), "_text")
        .agg(F.max("_id").alias("_keep"), F.count("*").alias("_size"))
        .where("_hot or _size > 1"), "salted-winners")
    cold = merged.where("not _hot").select("_digest", "_hot", "_text", "_keep", "_size")
    winners = materialise(cold.unionByName(
        merged.where("_hot").groupBy("_digest", "_hot", "_text")
        .agg(F.max("_keep").alias("_keep"), F.sum("_size").alias("_size"))), "winners")

    # Digests that stand for several texts: their winners don't make up all rows.
    mixed = materialise(winners.groupBy("_digest").agg(F.count("*").alias("_texts"), F.sum("_size").alias("_rows"))
                        .join(counts, "_digest").where("_texts > 1 or _rows < _n").select("_digest"), "mixed")
    plain, by_digest, parts = mark(keyed), winners.drop("_text"), []
    if mixed.limit(1).count():
        plain, by_digest = (x.join(mixed, "_digest", "left_anti") for x in (plain, by_digest))
        parts.append(rows.join(mixed, "_digest", "left_semi")
                     .join(winners.drop("_hot"), ["_digest", "_text"], "left").drop("_text"))
    parts.append(plain.where("not _hot").drop("_hot").join(by_digest.where("not _hot").drop("_hot"), "_digest", "left"))
    parts.append(plain.where("_hot").drop("_hot").join(F.broadcast(by_digest.where("_hot").drop("_hot")), "_digest", "left"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    keep = F.when(F.col("_size").isNull(), F.col("_id")).otherwise(F.col("_keep"))
    return out.select(F.col("_id").alias(id_col), keep.alias("keep_id"),
                      F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
                      F.coalesce(F.col("_id") == keep, F.lit(False)).alias("kept"),
                      F.col("_digest").alias("digest"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: all columns, one row of each group of equal
    texts.  Of rows that repeat the kept id with the same text, or of a group
    without ids, any one stays (they differ in no key)."""
    groups = exact_groups(docs, id_col, text_col)
    stays = F.col("kept") | F.col("keep_id").isNull()
    keys = groups.groupBy(F.col(id_col).alias("_kid"), F.col("digest").alias("_kdigest")).agg(
        F.bool_or(stays).alias("_stays"), F.count("*").alias("_krows"))
    # Only the rows that don't simply stay are looked up: dropped ones and repeats of a kept one.
    odd, _ = broadcast_checked(materialise(keys.where("not _stays or _krows > 1"), "odd-rows"), 200_000)
    rows = docs.select(whole_row(docs).alias("_doc"), F.col(id_col).alias("_kid"),
                       sha256(F.coalesce(F.col(text_col), F.lit(""))).alias("_kdigest"))
    same = rows["_kid"].eqNullSafe(odd["_kid"]) & (rows["_kdigest"] == odd["_kdigest"])
    repeats = odd.where("_stays")
    again = rows.join(repeats, rows["_kid"].eqNullSafe(repeats["_kid"]) & (rows["_kdigest"] == repeats["_kdigest"]),
                      "left_semi").dropDuplicates(["_kid", "_kdigest"])
    return rows.join(odd, same, "left_anti").unionByName(again).select("_doc.*")


def op7_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).withColumnRenamed("digest", "text_sha256")


ORACLE = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
