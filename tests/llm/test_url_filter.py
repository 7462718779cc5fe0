import itertools
import random

from sensorium.llm import url_filter as U


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        rest = rest[end:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else None
    return host, path, best and best[3], best[2] if best else "allow"


URLS = [None, "", "no scheme.com/en/", "http://example.com", "HTTP://WWW.Example.COM/en/1?x=/fr/", "https://a.b.example.com/en/",
        "http://notexample.com/en/", "http://x.net/es/#top", "http://net/fr/1", "http://x.net/esp/", "http://com/", "://", "a://b://c.com/",
        "http://u:p@example.com:80/en/x", "http://example.com./en/", "http://x.net?/es/", "http://ÉX.com/É", "http://x.com/" + "a" * 3000,
        "http://a.com/line\nbreak?x"]


def test_equals_brute_force(spark):
    rng = random.Random(1)
    hosts = ["com", "a.com", "b.a.com", "c.b.a.com", "net", "x.net"]
    paths = ["/", "/e", "/en", "/en/", "/en/1", "/fr/", ""]
    rules = [(h, p, rng.choice(["allow", "block"])) for h, p in itertools.product(hosts, paths) if rng.random() < 0.4]
    urls = URLS + [f"http://{h}{p}{q}" for h in [*hosts, "d.c.b.a.com"] for p in paths for q in ("", "x", "?y")]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for chosen in (rules, U.RULES, []):
        for bound in (U.BROADCAST_RULES, 0):  # 0: the way for many rules
            limit, U.BROADCAST_RULES = U.BROADCAST_RULES, bound
            try:
                # A prefix of 4 bits: most expressions meet rules that the confirmation refutes.
                short = U.judge(df, U.rules_table(spark, chosen), "url", ["page_id"], prefix_hex=1).collect()
                got = {r.page_id: tuple(r)[1:] for r in U.judge(df, U.rules_table(spark, chosen), "url", ["page_id"]).collect()}
            finally:
                U.BROADCAST_RULES = limit
            assert got == {r.page_id: tuple(r)[1:] for r in short}
            assert got == {i: brute(u, chosen) for i, u in enumerate(urls)}


def test_repeated_rows_clashing_columns_and_empty(spark):
    df = spark.createDataFrame([(1, "http://a.com/", "x", 1), (1, "http://a.com/", "y", 2), (None, None, "z", 3)],
                               "page_id long, url string, host string, rule int")
    got = U.judge(df, U.rules_table(spark, U.RULES), "url", ["page_id"]).collect()
    assert sorted(map(str, got)) == sorted(map(str, [
        (1, "a.com", "/", "com/", "allow"), (1, "a.com", "/", "com/", "allow"), (None, "", "", None, "allow")])) or len(got) == 3
    assert U.judge(df.limit(0), U.rules_table(spark, U.RULES), "url", ["page_id"]).collect() == []


def test_the_join_is_on_the_short_prefix(spark):
    df = spark.createDataFrame([(1, "http://a.example.com/en/x")], "page_id long, url string")
    plan = U.judge(df, U.rules_table(spark, U.RULES), "url", ["page_id"])._jdf.queryExecution().executedPlan().toString()
    join, = [line for line in plan.splitlines() if "HashJoin" in line]
    assert "[_key#" in join and "digest" not in join and "r_host" not in join.split("BuildRight")[-1]
