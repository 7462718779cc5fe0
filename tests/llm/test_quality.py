import re
from collections import Counter

from pyspark.sql import functions as F

from sensorium.llm import quality as Q

SF = "/root/testdata/sf0.01"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


def test_counts_equal_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in Q.op5_quality_rules(spark, SF).collect():
        assert tuple(r)[1:7] == brute(texts[r.doc_id]), r
        assert not (r.base_failed and r.kept)


def test_labels_it_has_not_seen(spark):
    """Verdicts against the labels: junk goes, clean documents stay."""
    labels = spark.read.parquet(f"{SF}/labels.parquet").withColumnRenamed("quality", "label")
    rows = Q.op5_quality_rules(spark, SF).join(labels, "doc_id").where("n_words >= 20")
    junk, kept_junk, clean, kept_clean = rows.agg(
        F.sum((F.col("label") == 0).cast("int")), F.sum(((F.col("label") == 0) & F.col("kept")).cast("int")),
        F.sum((F.col("label") == 1).cast("int")), F.sum(((F.col("label") == 1) & F.col("kept")).cast("int"))).first()
    assert kept_junk <= 0.05 * junk and kept_clean >= 0.99 * clean


def test_odd_texts(spark, docs_of):
    texts = [None, "", " \t\n\x0b\x0c\r", "a", "the " * 20, "x y z " * 7000, "a b c d e f g h a b c d e f g h", "é\u00a0ü\u2028x\x1cy # < >",
             "line one\nline one\n \n \nline two", "a b c d e f g h i a b c d e f g h j", "\u0130 \u212a \U0001f600"]
    docs = list(enumerate(texts)) + [(None, "a b"), (3, "a"), (3, "a")]
    got = Q.judge(docs_of(docs), carry=["doc_id", "text"]).select("row.doc_id", "row.text", "n_words", "word_chars", "n_symbols",
                                                                  "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert len(got) == len(docs)
    for r in got:
        assert tuple(r)[2:] == brute(r.text), r
    assert Q.judge(docs_of([])).collect() == []


def test_keeps_columns(spark, docs_of):
    good = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)).replace("word", "some")
    docs = docs_of([(1, good), (2, "x " * 100), (3, None)])
    kept = Q.keep_good(docs)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [tuple(docs.where("doc_id = 1").first())]


def test_no_python_in_the_plan(spark):
    plan = Q.op5_quality_rules(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_em_equals_plain_em(spark):
    """The aggregated steps against EM document by document."""
    import itertools
    import math
    import random
    rng = random.Random(3)
    names = ["a", "b", "c"]
    votes = []
    for _ in range(400):
        good = rng.random() < 0.8
        votes.append(tuple(rng.choice([1, 1, 1, 0] if good else [-1, -1, 0, 1]) for _ in names))
    counts = Counter(votes)
    patterns = spark.createDataFrame([(*k, v) for k, v in counts.items()], "a int, b int, c int, n long")
    got = Q.estimate(patterns, names)
    start = {(1, 1): 0.99, (1, -1): 0.01, (0, 1): 0.7, (0, -1): 0.3}
    model = {(n, *k): v for n in names for k, v in start.items()} | {"prior": 0.85}
    for _ in range(Q.MAX_STEPS):
        post = []
        for v in votes:
            x = math.log(model["prior"] / (1 - model["prior"]))
            x += sum(math.log(model[n, 1, s] / model[n, 0, s]) for n, s in zip(names, v) if s)
            post.append(1 / (1 + math.exp(-x)))
        new = {}
        for (i, n), y in itertools.product(enumerate(names), (0, 1)):
            sums = {s: sum((p if y else 1 - p) for p, v in zip(post, votes) if v[i] == s) + start[y, s] for s in (1, -1)}
            new |= {(n, y, s): sums[s] / sum(sums.values()) for s in sums}
        new["prior"] = (sum(post) + 0.85) / (len(votes) + 1)
        moved = max(abs(new[k] - model[k]) for k in model)
        model = new
        if moved < Q.TOLERANCE:
            break
    assert all(abs(got[k] - model[k]) < 1e-6 for k in model)


LETTERS = "abcdefghijklmnopqrstuvwxyz"
PROSE = [f"so{LETTERS[i % 26]}me{LETTERS[i // 26]}" for i in range(80)]
HINDI = ("बारिश के बाद नदी का पानी फिर बढ़ गया। अधिकारियों ने कहा कि सड़क की मरम्मत में एक सप्ताह लगेगा। किसी को चोट नहीं आई। "
         "पुराने पुल की जाँच सोमवार को होगी। गाँव के लोगों ने रात भर इंतज़ार किया। विद्यालय अगले दिन बंद रहेगा। "
         "मौसम विभाग ने बताया कि आने वाले दिनों में हल्की वर्षा हो सकती है। किसानों को अपनी फसल बचाने की सलाह दी गई है।")


def with_documents(spark, texts):
    """The documents of sf0.01, to learn from, and these."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return docs.unionByName(spark.createDataFrame([(-1 - i, t) for i, t in enumerate(texts)], "doc_id long, text string"))


def test_one_bad_vote_against_seven_good_ones_does_not_decide(spark):
    texts = {"symbols": " ".join(PROSE) + " ############", "upper": " ".join(PROSE[:40] + [w.upper() for w in PROSE[40:]]),
             "shouts": " ".join(PROSE) + " " + "!" * 30, "lines": "\n".join(f"{w}\nand\nso" for w in PROSE),
             "plain": " ".join(w if i % 2 else f"{w}9" for i, w in enumerate(PROSE)),
             "word_length": " ".join(w * 3 for w in PROSE)}
    rows = Q.judge(with_documents(spark, list(texts.values())), carry=["doc_id"]).where("row.doc_id < 0").collect()
    names = list(Q.votes())
    for r in rows:
        rule = list(texts)[-1 - r.row.doc_id]
        assert {n: r[n] for n in names} == {n: -1 if n == rule else 1 for n in names}, rule
        assert r.kept and r.quality >= Q.MIN_POSTERIOR, (rule, r.quality)
    assert len(rows) == len(texts)


def test_several_bad_votes_decide(spark):
    texts = ["###### ab9 " * 60, " ".join(w.upper() + "!!!" for w in PROSE)]
    rows = Q.judge(with_documents(spark, texts), carry=["doc_id"]).where("row.doc_id < 0").collect()
    assert len(rows) == 2 and not any(r.kept for r in rows)


def test_clean_hindi_is_kept(spark):
    r = Q.judge(with_documents(spark, [HINDI]), carry=["doc_id"]).where("row.doc_id < 0").first()
    assert r.n_plain == r.n_words and r.plain == 1 and r.kept
