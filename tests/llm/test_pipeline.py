"""The pipeline against plain code, stage by stage, on a small corpus."""

import re
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from sensorium.llm import quality
from sensorium.llm.common import materialise
from .tests_shared import prose

SF = "/root/testdata/sf0.001"


def small(docs_of):
    texts = [prose(i, 60) for i in range(40)]
    near = texts[0].split()
    near[5] = "changed"
    junk = "buy now " * 60
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate(texts)]
    rows += [(100 + i, texts[i], "s1") for i in range(5)] + [(200, " ".join(near), "s0"), (201, junk, "s0"), (202, "short", "s2"), (203, None, "s2")]
    return docs_of(rows)


def test_stages(spark, docs_of):
    docs = small(docs_of)
    names = [n for n, _ in corpus_pipeline.STAGES]
    stages = dict(corpus_pipeline.STAGES)
    assert len(names) == 5

    good = stages[names[0]](spark, docs, SF)
    ids = {r.doc_id for r in good.collect()}
    verdicts = quality.judge(docs, carry=["doc_id"]).where("kept").select("row.doc_id").collect()
    assert ids == {r.doc_id for r in verdicts} and {201, 202, 203} & ids == set() and {200, 104, *range(40)} <= ids

    unique = stages[names[1]](spark, good, SF)
    assert {r.doc_id for r in unique.collect()} == ids - set(range(5))  # of equal texts the largest id stays

    apart = stages[names[2]](spark, unique, SF)
    kept = {r.doc_id: r for r in apart.collect()}
    assert set(kept) == ids - set(range(5)) - {200}  # 200 is close to 100, which stays

    mixed = stages[names[3]](spark, apart, SF)
    taken = [(r.doc_id, r.text) for r in mixed.collect()]
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    total = sum(size(r.text) for r in kept.values())
    assert abs(sum(size(t) for _, t in taken) - 1.5 * total) <= 60 * 3
    assert max(taken.count(x) for x in taken) <= 2
    for stage in (good, unique, apart, mixed):
        assert stage.columns == docs.columns

    packed = stages[names[4]](spark, mixed, SF).collect()
    assert sorted({r.doc_id for r in packed}) == sorted({i for i, _ in taken})
    assert sum(r.piece == 0 for r in packed) == len(taken)


def test_each_stage_equals_plain_code(spark):
    """Every stage over the whole table, on what the stage before it kept."""
    from tokenizers import Tokenizer
    import public_tokenizers
    from .plain_stages import drop_equal, drop_near, keep_good, targets, words
    from .test_packing import check

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows_of = lambda df: sorted((r.doc_id, r.text, r.source) for r in df.collect())
    before = rows_of(docs)
    for (name, stage), plain in zip(corpus_pipeline.STAGES[:3], (keep_good, drop_equal, drop_near), strict=True):
        docs = materialise(stage(spark, docs, SF), "test-stage")
        after = rows_of(docs)
        assert after == sorted(plain(before)), name
        assert 0 < len(after) < len(before), name
        before = after

    mixed = materialise(corpus_pipeline.STAGES[3][1](spark, docs, SF), "test-mixed")
    taken = Counter(rows_of(mixed))
    assert set(taken) <= set(before) and max(taken.values()) <= 2 and mixed.columns == docs.columns
    size, got, longest = Counter(), Counter(), Counter()
    for row in before:
        n = len(words(row[1]))
        size[row[2]] += n
        got[row[2]] += n * taken[row]
        longest[row[2]] = max(longest[row[2]], n)
    for source, target in targets(size).items():
        assert abs(got[source] - target) <= longest[source] / 2 + 1, source  # documents are taken whole

    packed = corpus_pipeline.STAGES[4][1](spark, mixed, SF).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    n, tokens = check(packed, [(i, t) for (i, t, _), k in taken.items() for _ in range(k)], tokenizer, 1024)
    assert n <= 1.05 * tokens / 1024 + 1

    # run() chains the same stages over written tables.
    whole = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, SF).collect())
    assert whole == Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed)


def test_clashing_columns_pass_through(spark, docs_of):
    names = ["_kid", "_kdigest", "_doc", "_id", "row", "n", "size", "target", "copies", "_hash", "digest", "keep_id"]
    docs = small(docs_of).drop("size")
    for i, name in enumerate(names):
        docs = docs.withColumn(name, F.concat(F.lit(f"{i}-"), "doc_id"))
    out = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, out, SF)
        assert out.columns == docs.columns, name
    for r in out.collect():
        assert [r[name] for name in names] == [f"{i}-{r.doc_id}" for i in range(len(names))]


def test_empty_corpus(spark, docs_of):
    out = docs_of([])
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, SF)
    assert out.collect() == []
