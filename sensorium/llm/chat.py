"""Chat formatting checked by a grammar round trip.

A turn is rendered as ``<|im_start|>role\\n`` + text + ``<|im_end|>\\n``.  A
deterministic parser reads rendered text back; it accepts a control string only
where the grammar has one, and drops one backslash from any escaped one.  Each
turn is rendered as it is, reparsed and compared with its source; if they
differ (or the parser refuses), the text is escaped - a backslash more behind
the first character of everything that looks like a control string, escaped or
not - and the comparison repeated; then the role likewise.  So texts without a
conflict stay as they are, and every rendered turn is known to read back.

The parser knows where the loss mask lies: over the texts of assistant turns.

Turns are rendered where they are read; only the read-back of a whole
conversation needs its turns in order.  For this the rows are dealt and sorted
by conversation and turn (Spark's sort spills) and streamed: the state per
conversation is two running digests, so a conversation of any length takes
bounded memory.

Defined results: null text and null role are empty; turns with the same number
go by role, then text; null turn numbers come first; rows without a
conversation id make up one conversation with a null id; repeated rows are
turns each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorium.llm.common import map_arrow, table

# The template's control strings, and others that tokenizers of chat models know.
START, END = "<|im_start|>", "<|im_end|>"
CONTROL = [START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
MASKED_ROLE = "assistant"

_ALTERNATIVES = "|".join(f"{re.escape(c[0])}{{}}{re.escape(c[1:])}" for c in CONTROL)
_ANY = re.compile(_ALTERNATIVES.replace("{}", r"\\*"))
_ESCAPED = re.compile(_ALTERNATIVES.replace("{}", r"\\+"))
_PLAIN = re.compile(_ALTERNATIVES.replace("{}", ""))


def escape(text: str) -> str:
    return _ANY.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


def escape_role(role: str) -> str:
    return role.replace("\\", "\\\\").replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return re.sub(r"\\([\\n])", lambda m: "\n" if m[1] == "n" else "\\", role)


class GrammarError(ValueError):
    pass


def parse(rendered: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn; start and end bound the text, still
    escaped, in ``rendered``.  Raises where the grammar doesn't hold."""
    at = 0
    while at < len(rendered):
        if not rendered.startswith(START, at):
            raise GrammarError(f"no turn starts at {at}")
        newline = rendered.find("\n", at)
        if newline < 0:
            raise GrammarError("a role doesn't end")
        control = _PLAIN.search(rendered, newline + 1)
        if control is None or control[0] != END or not rendered.startswith("\n", control.end()):
            raise GrammarError(f"turn at {at} doesn't end as it should")
        yield (unescape_role(rendered[at + len(START):newline]), unescape(rendered[newline + 1:control.start()]),
               newline + 1, control.start())
        at = control.end() + 1


def render(role: str, text: str) -> str:
    """The turn in the first form that parses back into itself."""
    for r, t in ((role, text), (role, escape(text)), (escape_role(role), text), (escape_role(role), escape(text))):
        rendered = f"{START}{r}\n{t}{END}\n"
        try:
            if [x[:2] for x in parse(rendered)] == [(role, text)]:
                return rendered
        except GrammarError:
            continue
    raise AssertionError("an escaped turn must read back")


def _render_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        conv, turn, role, text = batch.columns
        out = [render(r or "", t or "") for r, t in zip(role.to_pylist(), text.to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([conv, turn, role, text, pa.array(out, pa.string())],
                                         names=["conv_id", "turn", "role", "text", "rendered"])


def format_turns(conversations: DataFrame) -> DataFrame:
    """``rendered`` for each row of (conv_id, turn, role, text).  A conversation's
    text is the concatenation of its turns in order."""
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return map_arrow(rows, _render_batches, "conv_id long, turn long, role string, text string, rendered string")


_READ = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split(" ")[0] for f in _READ.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def finished(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                          names=names)

    def row():
        return conv, turns, every.hexdigest(), masked, loss.hexdigest(), chars

    started, conv = False, None
    for batch in batches:
        out = []
        for key, rendered in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if not started or key != conv:
                if started:
                    out.append(row())
                started, conv, turns, masked, chars = True, key, 0, 0, 0
                every, loss = hashlib.sha256(), hashlib.sha256()
            for role, text, _, _ in parse(rendered):
                turns += 1
                every.update(f"{role}\n{text}\n".encode())
                if role == MASKED_ROLE:
                    masked += len(text)
                    loss.update(text.encode())
            chars += len(rendered)
        if out:
            yield finished(out)
    if started:
        yield finished([row()])


def read_back(turns: DataFrame) -> DataFrame:
    """Digests of each conversation, read from its rendered turns alone."""
    ordered = turns.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "role", "text")
    return map_arrow(ordered.select("conv_id", "rendered"), _read_batches, _READ)


def op9_chat_formatting(spark, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conflict = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", conflict), (-7, 1, "assistant", conflict)], conversations.schema)
    return read_back(format_turns(conversations.unionByName(probe)))


_SQL_CONTROL = r"([<\[])(\\*)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|<SYS>>|</SYS>>|/?INST\])"
ORACLE = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(24 + length(role) + length(regexp_replace(text, '{_SQL_CONTROL}', '\1\2\\\3', 'g')))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""
