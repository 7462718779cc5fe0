import hashlib
import math
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sensorium.llm import pii as P
from sensorium.llm.common import materialise

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, s):
    digits = re.sub("[^0-9]", "", s)
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in s.split(".")),
            "card": 16 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in doubled) % 10 == 0, "phone": 8 <= len(digits) <= 15}[kind]


def brute(text):
    return {k: [m.span() for m in re.finditer(p, text) if valid(k, m[0])] for k, p in PATTERNS.items()}


@settings(max_examples=1500, deadline=None)
@given(st.text("a1@.-+ ()%é09", max_size=40))
def test_finders_equal_the_patterns(text):
    assert P.find(text) == brute(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["4111111111111111", "4111 1111 1111 1111", "1.2.3.4", "256.1.1.1", "001.2.3.4.5", "a@b.c", "a@b@c.d", "x..y@-.-",
                                 "+1 (499) 555-6503", "+123", " ", ",", "12", "-"]), max_size=8))
def test_finders_on_pieces(parts):
    assert P.find("".join(parts)) == brute("".join(parts))


def test_long_runs_do_not_backtrack():
    for text in ("a" * 200_000, "@" * 50_000, "1" * 200_000, "1." * 100_000, "+1" * 50_000, "a@" * 50_000, "a.b@c." * 20_000):
        P.find(text)


def test_whole_table(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = P.op8_private_data(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = brute(texts[r.doc_id])
        base = ",".join(f"{k}:{s}:{e}" for k in PATTERNS for s, e in spans[k])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(spans[k]) for k in PATTERNS)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert r.spans == base or r.spans.startswith(base + ",") or not base


def corpus():
    """"Zorblatt" and "Quimby" go with one address each in differing texts, near it or far, and once without it;
    "the" stands everywhere; "copyword" in copies of one text only."""
    verbs = ["Ask", "Call", "Meet", "Write", "Visit"]
    docs = [(i, f"text{i} of page{i} with the word writes. Much later") for i in range(150)]
    docs += [(200 + i, f"{v} Zorblatt, today{i} joe@example.org {i}x the. Much later Zorblatt writes") for i, v in enumerate(verbs)]
    docs += [(300 + i, f"{v} Quimby one two{i} three four five ann@example.org on{i} the") for i, v in enumerate(verbs)]
    docs += [(400 + i, f"at{i} Name:bob@site.net {v} the") for i, v in enumerate(verbs + ["See"])]
    docs += [(500 + i, "see copyword at c@d.org please") for i in range(5)]
    return docs + [(600, "Nobody but Zorblatt, and Zorblatt-like the"), (601, "text Names and quimby the")]


@pytest.mark.parametrize("bound", [P.BROADCAST_TERMS, 0])  # 0: the way for many terms and documents
def test_revealing_terms(spark, docs_of, monkeypatch, bound):
    monkeypatch.setattr(P, "BROADCAST_TERMS", bound)
    monkeypatch.setattr(P, "BROADCAST_ROWS", bound)
    rows = {r.doc_id: r.spans for r in P.private_spans(docs_of(corpus())).collect()}
    texts = dict(corpus())

    def spans(doc_id, **words):
        return {f"{kind}:{m.start()}:{m.end()}" for kind, w in words.items() for m in re.finditer(rf"\b{w}\b", texts[doc_id])}

    for i in range(5):
        added = set(rows[200 + i].split(",")[1:])
        assert added == spans(200 + i, removed="Zorblatt") and len(added) == 2           # beside the address and away from it
        assert set(rows[300 + i].split(",")[1:]) == spans(300 + i, removed="(?:Quimby|one|three|four|five)")
    for i in range(6):
        assert spans(400 + i, removed="Name") <= set(rows[400 + i].split(","))            # a fragment beside the match
    assert set(rows[600].split(",")) == spans(600, removed="Zorblatt")                    # a document without the address
    assert rows[500] == "email:16:23" and rows[3] == "" and rows[601] == ""


def test_spans_come_by_kind_then_start(spark, docs_of):
    docs = corpus() + [(700 + i, f"plain{i} Zorblatt") for i in range(2)]                 # P(e | Zorblatt) = 5 / 8
    rows = {r.doc_id: r.spans for r in P.private_spans(docs_of(docs + [(800, "Zorblatt Quimby Zorblatt Quimby a@b.org")])).collect()}
    kinds = [x.split(":")[0] for x in rows[800].split(",")]
    assert kinds == ["email", "name", "name", "removed", "removed"]
    starts = [int(x.split(":")[1]) for x in rows[800].split(",")]
    assert starts == [32, 0, 16, 9, 25]


def test_classes(spark):
    rows = spark.createDataFrame([("Zorblatt", 0.6), ("0815", 0.6), ("zorb", 0.6), ("Émile", 0.7), ("Zorblatt", 0.9)], "t string, s double")
    got = [r[0] for r in rows.select(P.kind_of(rows["t"], rows["s"], 0.8)).collect()]
    assert got == ["name", "number", "term", "name", "removed"]


def test_sanitised_texts(spark, docs_of):
    rows = {r.doc_id: r.text for r in P.sanitise(docs_of(corpus())).collect()}
    assert rows[200] == "Ask , today0 <email> 0x the. Much later  writes" and rows[3] == "text3 of page3 with the word writes. Much later"
    assert rows[600] == "Nobody but , and -like the" and len(rows) == len(corpus())


def test_disclosure_equals_brute_force(spark, docs_of):
    docs = docs_of(corpus())
    found = materialise(P.detect(docs), "test-found")
    got = {(r.entity, r.term): (r.share, r.bits, r.witnesses) for r in P.disclosures(
        found, docs, generalise_at=0.3, min_bits=-99.0, margin=-math.inf).collect()}
    expected = co_occurrence(corpus(), 0.3)
    assert got.keys() == expected.keys() and len(got) > 10
    for k in got:
        assert all(abs(a - b) < 1e-9 for a, b in zip(got[k], expected[k], strict=True))


def co_occurrence(rows, least_share):
    both, contexts, df, mentions, seen = {}, {}, {}, {}, {}
    for i, t in rows:
        terms = set(re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", t))
        for w in terms:
            df[w] = df.get(w, 0) + 1
        for kind, spans in brute(t).items():
            for s, e in spans:
                entity = f"{kind}:{t[s:e]}"
                context = (*[x.strip(P.EDGE) for x in t[:s].split()[-P.REACH:]], *[x.strip(P.EDGE) for x in t[e:].split()[:P.REACH]])
                mentions.setdefault(entity, set()).add(i)
                seen.setdefault(entity, set()).add(context)
                for w in terms:
                    both.setdefault((entity, w), set()).add(i)
                    contexts.setdefault((entity, w), set()).add(context)
    out = {}
    for (entity, w), docs in both.items():
        share = len(docs) / df[w]
        if len(contexts[entity, w]) >= P.MIN_CONTEXTS and share >= least_share:
            out[entity, w] = (share, math.log2(share * len(rows) / len(mentions[entity])), len(contexts[entity, w]))
    return out


def test_near_copies_are_one_witness(spark, docs_of):
    """Variants of one long text with an address, each with a few words changed anywhere, beside the
    address too: none of its many words of its own is taken."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=7))
    base = [word() for _ in range(300)]
    docs = [(i, " ".join(rng.choices(["with", "the", "of", "and", "page"], k=60))) for i in range(400)]
    for i in range(12):
        text = list(base)
        for at in rng.sample(range(300), 3):
            text[at] = word()
        docs.append((500 + i, " ".join([*text[:150], word(), "list@site.org", word(), *text[150:]])))
    assert all(r.spans.count(":") in (0, 2) for r in P.private_spans(docs_of(docs)).collect())


def test_chance_pairs_need_more_evidence(spark, docs_of):
    """Two documents that mention one address share some rare words by chance; the evidence of two
    contexts isn't enough among so many words."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(3000)]
    docs = [(i, " ".join(rng.sample(words, 40))) for i in range(200)]
    docs += [(300 + i, f"w{i} " + " ".join(rng.sample(words, 500)) + f" x{i} list@site.org y{i}") for i in range(2)]
    assert all(r.spans.count(":") <= 2 for r in P.private_spans(docs_of(docs)).collect())


def test_edges(spark, docs_of):
    docs = [(1, None), (2, ""), (None, "a@b.org"), (None, "a@b.org"), (3, "x a@b.org " * 3000)]
    rows = P.private_spans(docs_of(docs)).collect()
    assert sorted((r.doc_id is None, r.n_email) for r in rows) == [(False, 0), (False, 0), (False, 3000), (True, 1), (True, 1)]
    assert P.private_spans(docs_of([])).collect() == []
