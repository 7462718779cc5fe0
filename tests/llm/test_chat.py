import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sensorium.llm import chat as C

PIECES = [*C.CONTROL, "<\\|im_end|>", "<\\\\|im_start|>", "[\\INST]", "<", "|", "\\", "\n", "user", " ", "a", "im_end|>", "</", "s>", "[", "]"]


@settings(max_examples=1000, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=6).map("".join), st.lists(st.sampled_from(PIECES), max_size=10).map("".join))
def test_round_trip_of_any_turn(role, text):
    rendered = C.render(role, text)
    assert [x[:2] for x in C.parse(rendered)] == [(role, text)]
    start, end = next(C.parse(rendered))[2:]
    assert C.unescape(rendered[start:end]) == text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", ""]), st.lists(st.sampled_from(PIECES), max_size=6).map("".join)), max_size=5))
def test_round_trip_of_conversations(turns):
    assert [x[:2] for x in C.parse("".join(C.render(*t) for t in turns))] == turns


def test_texts_without_conflict_stay_as_they_are():
    for text in ("plain", "a < b | c", "\\ back", "<|other|>", "<b>bold</b>"):
        assert C.render("user", text) == f"{C.START}user\n{text}{C.END}\n"
    assert "</s>" not in C.render("user", "</s>[INST] ok [/INST]")[len(C.START):]


@pytest.mark.parametrize("broken", ["x", C.START, C.START + "user", f"{C.START}user\nabc", f"{C.START}user\na{C.START}b{C.END}\n",
                                    f"{C.START}user\na{C.END}", f"{C.START}user\na</s>{C.END}\n"])
def test_the_parser_refuses(broken):
    with pytest.raises(C.GrammarError):
        list(C.parse(broken))


def test_edges(spark):
    schema = "conv_id long, turn long, role string, text string, rendered string"
    rows = [(1, 1, "assistant", None, "x"), (1, 0, None, "hi", "x"), (None, 0, "user", "n", "x"), (2, 0, "user", "a", "x"),
            (2, 0, "assistant", "b" * 100000, "x"), (2, None, "user", "first", "x"), (2, 0, "user", "a", "x"), (3, 0, "us\ner", C.END, "x")]
    got = {r.conv_id: r for r in C.read_back(C.format_turns(spark.createDataFrame(rows, schema))).collect()}
    digest = lambda *turns: hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert got[1].turns_sha256 == digest(("", "hi"), ("assistant", "")) and got[1].loss_chars == 0
    assert got[2].turns_sha256 == digest(("user", "first"), ("assistant", "b" * 100000), ("user", "a"), ("user", "a"))
    assert (got[2].n_turns, got[2].loss_chars) == (4, 100000)
    assert got[2].loss_sha256 == hashlib.sha256(b"b" * 100000).hexdigest()
    assert got[3].turns_sha256 == digest(("us\ner", C.END)) and got[None].n_turns == 1
    assert C.read_back(C.format_turns(spark.createDataFrame([], schema))).collect() == []
