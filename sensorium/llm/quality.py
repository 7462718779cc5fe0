"""Quality rules under weak supervision, in DataFrame functions only.

Each rule votes good (1) or bad (-1) on a document, or abstains (0).  A
two-class model gives every rule a rate of each vote among good and among bad
documents; expectation-maximisation estimates these rates and the share of
good documents from the votes of all documents, without labels.  A document's
posterior probability of being good decides, in place of "every rule must pass".
No rule is taken to err on fewer than ``MIN_ERROR`` of the documents of a class:
else rates fall to nearly 0 and one bad vote outweighs all good ones.

The votes of a document are one of 3^rules patterns, so the statistics that
EM needs of the whole corpus are one count per pattern: a single aggregation
with map-side combining, and a table that doesn't grow with the corpus.  Each
EM step is an aggregation over that table; only the model's few numbers come
to the driver.

Defined results: null and empty texts have no words and fail the base rules;
every input row is judged, repeated ones alike; an empty table gives an empty
result; only the named columns are read.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorium.llm.common import SPACE, SPACE_CHARS, materialise, table, whole_row, words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MIN_POSTERIOR = 0.5
MAX_STEPS = 30
#: Least rate of either vote in either class.
MIN_ERROR = 0.01
#: A word of letters with their combining marks and joiners, with marks of a sentence around it
#: (Latin and Greek, Arabic, Indic, Ethiopic, Armenian, East Asian).
PLAIN_WORD = (r"""^[("'\u00ab\u2039\u2018\u201c\u201a\u201e\u00bf\u00a1\u300c\u300e\uff08]*"""
              r"""\p{L}[\p{L}\p{M}\u200c\u200d'\u2019-]*"""
              r"""[.,;:!?)"'\u00bb\u203a\u2019\u201c\u201d\u2026\u037e\u0387\u060c\u061b\u061f\u06d4\u0964\u0965"""
              r"""\u0589\u1362-\u1368\u104a\u104b\u17d4\u17d5\u3001\u3002\u300d\u300f\uff01\uff09\uff0c\uff1a\uff1b\uff1f]*$""")
TOLERANCE = 1e-4


def _removed(text: str, pattern: str) -> Column:
    """How many characters of ``text`` the pattern's matches hold."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def features(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Counts of each text, from the whole text, one row per row of ``docs``, whose
    columns (all, or ``carry``) go along as the struct ``row``."""
    df = docs.select(whole_row(docs, carry).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    df = df.select("_id", "_text", words(F.col("_text")).alias("_words"), lines.alias("_lines"))
    hashes = F.transform("_words", lambda w: F.xxhash64(w))
    df = df.withColumn("_hashes", hashes)
    count = F.size("_words") - (WINDOW - 1)
    windows = F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.xxhash64(
        *[F.get(F.col("_hashes"), i + j) for j in range(WINDOW)])))
    df = df.withColumn("_windows", windows)
    # Where a window occurs more than once: sort (window, place); equal neighbours.
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    df = df.withColumn("_sorted", F.when(repeated, F.sort_array(F.arrays_zip(
        F.col("_windows").alias("h"), F.sequence(F.lit(0), F.size("_windows") - 1).alias("p")))))
    hash_at = lambda i: F.get(F.col("_sorted"), i)["h"]
    equal = lambda a, b: F.coalesce(a == b, F.lit(False))
    places = F.transform(F.filter("_sorted", lambda x, i: equal(x["h"], hash_at(i - 1)) | equal(x["h"], hash_at(i + 1))),
                         lambda x: x["p"])
    df = df.withColumn("_places", F.when(F.col("_sorted").isNotNull(), F.array_sort(places)))
    covered = F.aggregate(
        F.transform("_places", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(
            F.get(F.col("_places"), i + 1) - p, F.lit(WINDOW)))), F.lit(0).cast("long"), lambda a, x: a + x)
    return df.select(
        F.col("_id").alias("row"), F.size("_words").cast("long").alias("n_words"),
        F.aggregate("_words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
        _removed("_text", r"[#*$%&|<>]+").cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("_hashes")).cast("long").alias("n_distinct"),
        F.size(F.filter("_words", lambda w: F.rlike(w, F.lit(PLAIN_WORD)))).cast("long").alias("n_plain"),
        _removed("_text", r"\p{Lu}+").cast("long").alias("n_upper"),
        _removed("_text", r"[!?]+").cast("long").alias("n_shouts"))


def votes() -> dict[str, Column]:
    """The rules.  Each is (bad if, good if) of the counts; neither: it abstains."""
    c, n = F.col, F.greatest(F.col("n_words"), F.lit(1))
    share = lambda x, of=n: c(x) / of
    rules = {
        "symbols": (share("n_symbols") > 0.1, share("n_symbols") < 0.03),
        "upper": (share("n_upper", F.greatest(c("word_chars"), F.lit(1))) > 0.4,
                  share("n_upper", F.greatest(c("word_chars"), F.lit(1))) < 0.2),
        "shouts": (share("n_shouts") > 0.2, share("n_shouts") < 0.05),
        "repeats": (share("n_repeat_words") > 0.35, share("n_repeat_words") < 0.02),
        "lines": (share("n_dup_lines", F.greatest(c("n_lines"), F.lit(1))) > 0.5, c("n_dup_lines") == 0),
        "variety": ((n >= 50) & (share("n_distinct", F.least(n, F.lit(400))) < 0.15),
                    (n >= 50) & (share("n_distinct", F.least(n, F.lit(400))) > 0.3)),
        "plain": (share("n_plain") < 0.6, share("n_plain") > 0.85),
        "word_length": ((share("word_chars") < 2.5) | (share("word_chars") > 14),
                        share("word_chars").between(3.5, 10)),
    }
    return {k: F.when(bad, -1).when(good, 1).otherwise(0) for k, (bad, good) in rules.items()}


def posterior(model: dict, names: list[str]) -> Column:
    """Probability that a document with these votes is good.  The model is one array, looked
    up by rule and vote, so that all EM steps share one generated code."""
    odds = lambda name, v: math.log(model[name, 1, v]) - math.log(model[name, 0, v]) if v else 0.0
    prior = math.log(model["prior"]) - math.log(1 - model["prior"])
    weights = F.array(*[F.lit(odds(name, v) + (prior if i == 0 else 0.0)) for i, name in enumerate(names) for v in (-1, 0, 1)])
    total = functools.reduce(lambda a, b: a + b, [F.get(weights, F.col(name) + (3 * i + 1)) for i, name in enumerate(names)])
    return 1 / (1 + F.exp(-total))


def estimate(patterns: DataFrame, names: list[str], least: float = 0.0) -> dict:
    """EM over the pattern counts.  ``model[rule, class, vote]`` is the rate of a
    vote among the rule's votes on documents of the class (abstentions carry no
    weight).  It starts from the assumption that a bad document offends against
    three rules in ten and a good one against one in a hundred, and keeps a
    thousandth of the corpus as pseudo-counts in favour of it.  Rates stay
    between ``least`` and ``1 - least``, whatever the size of the corpus (the
    likelihood of each rate has one peak, so the nearest bound is its maximum)."""
    start = {(1, 1): 0.99, (1, -1): 0.01, (0, 1): 0.7, (0, -1): 0.3}
    model = {(name, *k): v for name in names for k, v in start.items()} | {"prior": 0.85}
    for _ in range(MAX_STEPS):
        weighed = patterns.withColumn("good", posterior(model, names) * F.col("n"))
        cells = {(name, y, v): F.sum(F.when(F.col(name) == v, F.col("good") if y else F.col("n") - F.col("good")))
                 for name in names for y in (0, 1) for v in (1, -1)}
        row = weighed.agg(F.sum("n"), F.sum("good"), *cells.values()).first()
        total = row[0] or 0
        if not total:
            return model
        pseudo = max(1.0, total / 1000)
        sums = {k: (x or 0.0) + pseudo * start[k[1:]] for k, x in zip(cells, row[2:], strict=True)}
        new = {k: min(max(sums[k] / (sums[k[0], k[1], 1] + sums[k[0], k[1], -1]), least), 1 - least) for k in cells}
        new["prior"] = min(max((row[1] + pseudo * 0.85) / (total + pseudo), 1e-6), 1 - 1e-6)
        moved = max(abs(new[k] - model[k]) for k in model)
        model = new
        if moved < TOLERANCE:
            break
    return model


def judge(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``row`` (the columns of ``docs``, or ``carry``), the features, ``base_failed``, ``quality`` (posterior)
    and ``kept`` per row of ``docs``."""
    rules = votes()
    names = list(rules)
    seen = materialise(features(docs, text_col, carry).withColumns(rules), "quality-votes")
    patterns = materialise(seen.groupBy(*names).agg(F.count("*").alias("n")), "vote-patterns")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return seen.withColumn("base_failed", failed).withColumn("quality", posterior(estimate(patterns, names, MIN_ERROR), names)) \
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= MIN_POSTERIOR))


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    return judge(docs, text_col).where("kept").select("row.*")


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), carry=["doc_id"]).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")
