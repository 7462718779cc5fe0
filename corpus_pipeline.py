"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept and returns a DataFrame; all but the last return the columns of
``documents``.  Stages are written and read again between each other.

Defined results, in every stage: other columns than ``doc_id``, ``text`` and
``source`` are passed on as they are, whatever their names; an empty table gives
an empty result with the same columns; a stage that runs again returns the same
rows.  What a stage does with nulls and ties stands at the stage.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from sensorium.llm import exact_dedup, mixing, ngram_join, packing, quality
from sensorium.llm.common import materialise, release, table, written

_TABLES: dict[str, list[str]] = {}


def stage(function):
    """A stage first removes the tables that the stages before it wrote for
    themselves, unless ``docs`` still reads them."""
    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        release(spark, _TABLES.pop(app, []), keep=docs)
        before = set(written(spark))
        out = function(spark, docs, sf_dir)
        _TABLES[app] = [path for path in written(spark) if path not in before]
        return out
    return run_stage


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules' model rejects go.  A null text has no words and goes
    with the short ones; a null id makes no difference; rows with equal texts are
    judged alike, each of them."""
    return quality.keep_good(docs)


@stage
def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays.  A null text equals the empty
    one; of rows with equal text and id one stays, and of a group whose ids are all
    null one stays."""
    return exact_dedup.drop_copies(docs)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 5-word shingles (Jaccard 0.8 or more), directly or through
    others, the one with the smallest id stays.  Null and blank texts are linked with
    nothing and stay; a document without id goes if its group has one with an id, and
    groups without any id keep their rows."""
    return ngram_join.keep_one(docs)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated, up to twice, so that sources meet their
    weights.  A null source is a source of its own; texts without words take nothing
    and go; which of a source's equally long documents is repeated follows a hash of
    id and length, then id, then text."""
    return mixing.mixed(docs)


@stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, placed in sequences of 1024 tokens.  A null text is its
    separator alone; a null id stays null; rows that repeat are packed each; equal
    fills are taken in the order of their pieces' bytes."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Shingle joins, entropy balancing and packing have no SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for i, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, name.replace(" ", "-"))
            release(spark, before)
            before = written(spark)[-1:]
    return docs
