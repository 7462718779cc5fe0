"""URL rules by expression expansion.

Each URL becomes the expressions host suffix x path prefix that a rule could
consist of.  A suffix starts at the host or behind one of its dots; a prefix
ends at each length that some rule's path has, so that a rule's path need not
end with a slash.  Expressions meet rules by an equi-join on the first 32 bits
of their SHA-256; hits are confirmed by the full digest and the expression
itself, and the longest confirmed rule of a URL decides (of equally long ones
the one with the longer host, then block before allow).

Defined results: a null URL or one without ``://`` has an empty host and path
and fits no rule; URLs that no rule fits get ``default``; repeated rows are
judged each; empty tables give empty results; clashing column names in the
input don't matter, since only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorium.llm.common import salted, table

PREFIX_HEX = 8  # 32 bits of the digest
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules up to this many are broadcast (each under 1 KB: a URL rule is a short string).
BROADCAST_RULES = 20_000
SALTS = 16

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType(), False) for c in ("r_host", "r_path", "r_verdict")])
    return spark.createDataFrame(rules, schema)


def judge(urls: DataFrame, rules: DataFrame, url_col: str, carry: list[str], default: str = "allow",
          prefix_hex: int = PREFIX_HEX) -> DataFrame:
    """``carry`` columns, ``host``, ``path``, ``rule`` and ``verdict`` per row of ``urls``."""
    rules = rules.select("r_host", "r_path", "r_verdict").where("r_host is not null and r_path is not null")
    rules = rules.dropDuplicates().withColumn("r_expr", F.concat("r_host", "r_path"))
    rules = rules.withColumn("r_digest", F.sha2("r_expr", 256)).withColumn("r_key", F.substring("r_digest", 1, prefix_hex))
    # Distinct path lengths: at most as many as the longest rule path has characters.
    lengths = [r[0] for r in rules.select(F.length("r_path")).distinct().collect()]

    base = urls.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)],
                       host_of(F.col(url_col)).alias("_host"), path_of(F.col(url_col)).alias("_path"))
    base = base.withColumn("_row", F.monotonically_increasing_id())
    labels = F.split("_host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.filter(F.array(*[F.lit(n) for n in sorted(lengths)]).cast("array<int>"),
                        lambda n: n <= F.length("_path"))
    expressions = F.flatten(F.transform(suffixes, lambda h: F.transform(
        prefixes, lambda n: F.struct(h.alias("h"), F.concat(h, F.substring(F.col("_path"), F.lit(1), n)).alias("e")))))
    spread = base.select("*", F.explode_outer(F.array_distinct(expressions)).alias("_x"))
    spread = spread.withColumn("_digest", F.sha2("_x.e", 256)).withColumn("_key", F.substring("_digest", 1, prefix_hex))

    # Equi-join on the short prefix alone; what meets there by chance fails the confirmation below.
    met = spread["_key"] == rules["r_key"]
    if rules.count() <= BROADCAST_RULES:
        hits = spread.join(F.broadcast(rules), met, "left")
    else:  # many rules: the expressions of a common host are salted, the rules copied to each salt
        spread = spread.withColumn("_salt", salted(F.col("_row"), SALTS))
        rules = rules.withColumn("r_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        hits = spread.join(rules, met & (spread["_salt"] == rules["r_salt"]), "left")
    confirmed = (F.col("_digest") == F.col("r_digest")) & (F.col("_x.h") == F.col("r_host")) & (F.col("_x.e") == F.col("r_expr"))
    best = F.max(F.when(confirmed, F.struct(
        F.length("r_expr").alias("n"), F.length("r_host").alias("h"), F.col("r_verdict").alias("v"),
        F.col("r_expr").alias("rule"))))
    # All rows of a URL stem from one input row, at most labels x lengths of them.
    keys = ["_row", *[f"_c{i}" for i in range(len(carry))], "_host", "_path"]
    out = hits.groupBy(*keys).agg(best.alias("_best"))
    return out.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)], F.col("_host").alias("host"),
                      F.col("_path").alias("path"), F.col("_best.rule").alias("rule"),
                      F.coalesce("_best.v", F.lit(default)).alias("verdict"))


def op4_url_filters(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), rules_table(spark, RULES), "url", ["page_id"])


ORACLE = r"""
WITH rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
u AS (
  SELECT page_id, row_number() OVER () AS n,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
hits AS (
  SELECT u.n, r.host || r.path AS rule, r.verdict,
    row_number() OVER (PARTITION BY u.n ORDER BY length(r.host || r.path) DESC, length(r.host) DESC, r.verdict DESC) AS k
  FROM u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path))
SELECT u.page_id, u.host, u.path, h.rule, coalesce(h.verdict, 'allow') AS verdict
FROM u LEFT JOIN hits h ON h.n = u.n AND h.k = 1
"""
