import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorium.llm import token_counts as T
from sensorium.llm.common import materialise

public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def counts_of(text):
    return [0, *np.cumsum(np.frombuffer(T.counter().steps(text), "<i2")).tolist()]


def by_library(tokenizer, text):
    parts = [text[:i] for i in range(len(text) + 1)]
    return [len(x.ids) for x in tokenizer.encode_batch(parts, add_special_tokens=False)]


ODD = ["", " ", "\n\n\n x\n\ny", " 're 're you'll 'rest x's'S'LL'll", "a <|endoftext|> b<|endoftext|><|endoftext|>", "<|endof",
       "   " * 9 + "x", "\r\n\r\n a\t\tb", "aaaa" * 40, "-" * 300, "हिन्दी में एक वाक्य है।", "中文字 和 English 😀😀", "\x1c \x85 　x", "꟎ ՘a࢏"]


@pytest.mark.parametrize("text", ODD)
def test_every_prefix_of_odd_texts(tokenizer, text):
    assert counts_of(text) == by_library(tokenizer, text)


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab'srelvmtd  \n\t12!?.,-<|endoftext|>éßÊकि中😀"), max_size=30))
def test_every_prefix_of_random_texts(tokenizer, text):
    assert counts_of(text) == by_library(tokenizer, text)


def test_small_caches_change_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(T, "MAX_UNITS", 3)
    monkeypatch.setattr(T, "MAX_PAIRS", 3)
    monkeypatch.setattr(T, "MAX_LENGTH", 4)
    count = T.Counter(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(4)
    for _ in range(20):
        text = " ".join("".join(rng.choices("abcdeth", k=rng.randint(1, 9))) for _ in range(6))
        assert int(np.frombuffer(count.steps(text), "<i2").sum()) == by_library(tokenizer, text)[-1]


def test_query_equals_the_library(spark, tokenizer):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = T.op12_token_counts(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r["doc_id"]] or ""
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 1024)


def test_questions_are_answered_from_the_table(spark, docs_of, tokenizer):
    rows = [(i, t) for i, t in enumerate([*ODD, None, "word " * 3000])]
    table = materialise(T.prefix_counts(docs_of(rows)), "test-prefixes")
    texts = {i: t or "" for i, t in rows}
    for at in (0, 1, 7, 10_000_000):
        for r in T.tokens_at(table, at).collect():
            assert r["n_tokens"] == len(tokenizer.encode(texts[r["doc_id"]][:at], add_special_tokens=False).ids)
    assert all(r["n_tokens"] is None for r in T.tokens_at(table, F.lit(None)).collect())
    by_column = {r["doc_id"]: r["n_tokens"] for r in T.tokens_at(table, F.col("n_chars")).collect()}
    assert by_column == {r["doc_id"]: r["n_tokens"] for r in table.collect()}
    for budget in (0, 1, 3, 1024):
        for r in T.within_budget(table, budget).collect():
            text = texts[r["doc_id"]]
            fit = [i for i, n in enumerate(by_library(tokenizer, text[:400])) if n <= budget] if len(text) <= 400 else None
            if fit:
                assert r["chars"] == fit[-1]
            cut = text[:r["chars"]]
            assert len(tokenizer.encode(cut, add_special_tokens=False).ids) == r["n_tokens"] <= budget
    with pytest.raises(ValueError):
        T.within_budget(table, -1)


def test_nulls_repeats_empty_table(spark, docs_of):
    got = T.prefix_counts(docs_of([(None, "one two"), (1, None), (2, ""), (3, "a b"), (3, "a b")])).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in got) == [
        (False, 1, 0, 0), (False, 2, 0, 0), (False, 3, 3, 2), (False, 3, 3, 2), (True, 0, 7, 2)]
    assert T.prefix_counts(docs_of([])).count() == 0
    clash = docs_of([(1, "a b")]).withColumn("n_tokens", F.lit("x")).withColumn("prefix", F.lit(1)).withColumn("id", F.lit(9))
    assert [(r["doc_id"], r["n_tokens"]) for r in T.prefix_counts(clash).collect()] == [(1, 2)]
