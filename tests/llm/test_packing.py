import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sensorium.llm import packing as P


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def reference_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, P.SEPARATOR]


def check(rows, docs, tokenizer, capacity):
    """Every piece of every document is there, and sequences are gapless and not overfull."""
    by_sequence, expected = {}, []
    for doc_id, text in docs:
        ids = np.array(reference_ids(tokenizer, text), dtype="<u4")
        n = -(-len(ids) // capacity)
        cuts = [0, *range(len(ids) - (n - 1) * capacity, len(ids), capacity), len(ids)]
        expected += [(doc_id, i, s, e - s, zlib.crc32(ids[s:e].tobytes())) for i, (s, e) in enumerate(zip(cuts, cuts[1:]))]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(key, expected)) == sorted(key((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in rows)
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence), sum(r.length for r in rows)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(max_codepoint=0x24F, exclude_categories=["Cs"]), max_size=60))
def test_fast_ids_are_the_tokenizers_ids(text):
    fast = P.token_ids(text).tolist()
    assert fast == P._encoder(None)[0].encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["", " ", "日本語 текст", "a <|endoftext|> b", "x" * 5000, "\n\n \t", "é" * 300, "1234567890 " * 50])
def test_ids_of_odd_texts(text):
    assert P.token_ids(text).tolist() == P._encoder(None)[0].encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_best_fit_is_best_fit(sizes):
    order = np.argsort(-np.array(sizes, dtype=int), kind="stable") if sizes else np.array([], dtype=int)
    got = P.best_fit(np.array(sizes), order, 64)
    bins = []  # brute force: the fullest bin that still has room
    for i in order.tolist():
        fits = [b for b in bins if sum(sizes[j] for j in b) + sizes[i] <= 64]
        if fits:
            max(fits, key=lambda b: sum(sizes[j] for j in b)).append(i)
        else:
            bins.append([i])
    fill = lambda groups: sorted(sum(sizes[j] for j in g) for g in groups)
    assert fill(got) == fill(bins)


def test_whole_table(spark, tokenizer):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    n, tokens = check(P.op1_best_fit_packing(spark, "/root/testdata/sf0.001").collect(), docs, tokenizer, P.CAPACITY)
    assert n <= 1.02 * tokens / P.CAPACITY + 1


def test_nulls_ties_long_and_repeated_rows(spark, docs_of, tokenizer):
    docs = [(1, None), (2, ""), (3, "same text"), (3, "same text"), (None, "same text"), (4, "long words here " * 4000), (5, "日本 " * 40)]
    rows = P.pack(docs_of(docs).repartition(4), capacity=128, slack=2).collect()
    check(rows, docs, tokenizer, 128)


def test_merge_rounds_beat_local_packing(spark, docs_of, tokenizer):
    docs = [(i, "word " * (20 + i % 25)) for i in range(400)]
    rows = P.pack(docs_of(docs).repartition(40), capacity=64, slack=0).collect()
    n, tokens = check(rows, docs, tokenizer, 64)
    # One place for all: the same best fit without partitions.
    sizes = np.array([len(reference_ids(tokenizer, t)) for _, t in docs])
    rest = [s % 64 or 64 for s in sizes]
    best = len(P.best_fit(np.array(rest), np.argsort(-np.array(rest)), 64)) + sum((s - 1) // 64 for s in sizes)
    assert n <= 1.15 * best  # 40 partitions of ten items each


def test_the_inputs_partitions_do_not_matter(spark, docs_of, tokenizer):
    """Nor does the number of tasks: rounds go on while they save sequences."""
    docs = [(i, "word " * (3 + (i * 7919) % 53)) for i in range(12_000)]
    counts = {}
    for partitions, bounds in ((1, (P.MAX_ITEMS, 400)), (8, (400,)), (64, (P.MAX_ITEMS, 400))):
        for max_items in bounds:
            rows = P.pack(docs_of(docs).repartition(partitions), capacity=256, slack=2, max_items=max_items).collect()
            counts[partitions, max_items] = check(rows, docs, tokenizer, 256)[0]
    assert max(counts.values()) <= 1.01 * min(counts.values()) + 1, counts


def test_items_that_cannot_merge_are_final(spark, docs_of, tokenizer):
    docs = [(i, "word " * 39) for i in range(200)]  # each over half of a sequence
    rows = P.pack(docs_of(docs).repartition(8), capacity=64, slack=0, max_items=20).collect()
    assert check(rows, docs, tokenizer, 64)[0] == 200


def test_empty(spark, docs_of):
    assert P.pack(docs_of([])).collect() == []
