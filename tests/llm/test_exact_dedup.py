import hashlib

from pyspark.sql import functions as F

from sensorium.llm import exact_dedup as D


def brute(docs):
    groups = {}
    for i, t in docs:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in docs:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[t or ""]), i is not None and i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def rows(df, digest="digest"):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r[digest]) for r in df.collect()), key=str)


DOCS = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "A"), (5, "A"), (6, "b " * 50000), (7, "b " * 50000), (8, "é"), (9, "é"),
        (None, "null id"), (None, "null id"), (None, "a"), (10, " a"), (11, "single")] + [(100 + i, "hot") for i in range(200)]


def test_equals_brute_force(spark, docs_of):
    assert rows(D.exact_groups(docs_of(DOCS).repartition(7))) == brute(DOCS)


def test_hot_groups_are_salted_and_merged(spark, docs_of):
    got = D.exact_groups(docs_of(DOCS).repartition(7), hot_share=0.01, salts=4)
    assert rows(got) == brute(DOCS)


def test_texts_are_compared_not_digests(spark, docs_of):
    weak = lambda c: F.pmod(F.length(c), F.lit(3)).cast("string")
    for share in (0.01, 10.0):
        got = D.exact_groups(docs_of(DOCS).repartition(7), digest=weak, hot_share=share, salts=4)
        assert [r[:4] for r in rows(got)] == [r[:4] for r in brute(DOCS)]


def test_empty(spark, docs_of):
    assert D.exact_groups(docs_of([])).collect() == [] and D.drop_copies(docs_of([])).collect() == []


def test_drop_copies_keeps_one_row_of_each_text(spark, docs_of):
    docs = docs_of(DOCS)
    kept = D.drop_copies(docs)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text or "") for r in kept.collect()]
    assert sorted(t for _, t in got) == sorted({t or "" for _, t in DOCS})
    best = {}
    for i, t in DOCS:
        best[t or ""] = max(best.get(t or "", -1), -1 if i is None else i)
    assert all((-1 if i is None else i) == best[t] for i, t in got)
