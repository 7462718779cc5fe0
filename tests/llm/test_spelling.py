import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sensorium.llm import spelling as W

SF = "/root/testdata/sf0.001"


def neighbours(word, letters):
    out = set()
    for i in range(len(word) + 1):
        out |= {word[:i] + c + word[i:] for c in letters}
        if i < len(word):
            out |= {word[:i] + c + word[i + 1:] for c in letters} | {word[:i] + word[i + 1:]}
    return out - {word}


def brute_force(docs, min_count=5):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= min_count}
    letters, form, rows = {c for w in n for c in w}, {}, set()
    near = {w: [x for x in neighbours(w, letters) if x in n] for w in n}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return rows


def found(df):
    rows = [(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def noisy_docs(seed, n_docs=120):
    """Texts of few stems, often with a step or two of an edit."""
    rng = random.Random(seed)
    stems = ["banana", "bananas", "cabbage", "éclairs", "Straße", "tomato", "potato", "ananab", "abcabc"]
    letters = "abcnostéß"

    def change(w):
        i = rng.randrange(len(w))
        return rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:]])

    out = []
    for i in range(n_docs):
        words = rng.choices(stems, weights=[9, 4, 3, 3, 3, 2, 2, 2, 2], k=60)
        out.append((i, " ".join(change(w) if rng.random() < 0.35 else w for w in words)))
    return out


@pytest.mark.parametrize("groups,max_words", [(W.GROUPS, W.MAX_WORDS), (3, W.MAX_WORDS), (14, 4), (2, 3), (1, 5)])
def test_equals_brute_force(docs_of, groups, max_words):
    """Also with subtrees split down to leaves and leaves dealt into blocks."""
    docs = noisy_docs(5)
    assert found(W.variants(docs_of(docs), groups=groups, max_words=max_words)) == brute_force(docs)


def test_leaves_by_pairs_and_by_lookup_agree(docs_of, monkeypatch):
    docs = noisy_docs(6)
    near = {}
    for pairwise in (0, 10_000):
        monkeypatch.setattr(W, "PAIRWISE", pairwise)
        for words in (["abcdef", "abcdeg", "abcdefg", "abcde", "aabcdef", "bbcdef", "fedcba", "abcdefgh", "aaaaaa", "aaaaa", "aaaaaaa"],):
            by_length = {}
            for w in words:
                by_length.setdefault(len(w), W.Leaf()).words.append((w, 1))
            near[pairwise] = {w: sorted(x for leaf in by_length.values() for x, _ in leaf.near(w)) for w in words}
    assert near[0] == near[10_000]
    assert near[0]["aaaaaa"] == ["aaaaa", "aaaaaaa"]
    assert brute_force(docs)


def test_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert found(W.op13_spelling_variants(spark, SF)) == brute_force(docs)


def test_one_apart():
    assert W.one_apart("abc", "abd") and W.one_apart("abc", "abcd") and W.one_apart("abc", "bc") and W.one_apart("aab", "ab")
    assert not any(W.one_apart(*p) for p in [("abc", "abc"), ("abc", "acb"), ("abc", "abcde"), ("abc", "bcd"), ("", "")])
    assert W.one_apart("", "a")


def test_chain_of_forms(docs_of):
    words = {"abcdefgh": 3000, "abcdefg": 400, "abcdef": 60, "abcdefx": 7}
    docs = [(i, w) for w, n in words.items() for i in range(n // 10 or 1)]
    docs = [(i, " ".join([w] * 10)) for i, (_, w) in enumerate(docs)]
    got = {r[0]: r for r in found(W.variants(docs_of(docs)))}
    assert set(got.values()) == brute_force(docs)
    assert got["abcdef"][2] == "abcdefgh" and got["abcdef"][1] == "abcdefg"


def test_deleted_code_points_and_lower_case(docs_of):
    docs = [(i, "ÉCLAIRS Éclairs éclairs STRASSE ×÷×÷×÷ naïveté") for i in range(600)] + [(None, "naïveté"), (7, None), (8, "")]
    got = found(W.variants(docs_of(docs)))
    assert got == brute_force(docs) and {"Éclairs", "éclairs", "strasse", "×÷×÷×÷"} <= {r[0] for r in got}


def test_repeats_empty_and_clashing_columns(docs_of):
    assert W.variants(docs_of([])).count() == 0
    assert W.variants(docs_of([(1, None), (2, "short")])).count() == 0
    docs = docs_of([(1, "banana " * 5), (1, "banana " * 5)]).withColumn("word", F.lit("x")).withColumn("n", F.lit(1))
    assert found(W.variants(docs)) == {("banana", None, "banana", 10, 0, None)}
