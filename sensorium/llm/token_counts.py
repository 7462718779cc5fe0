"""Exact token counts of every prefix, by dynamic programming.

A byte-pair encoding has a property that makes its prefixes cheap: a sequence of
tokens is the encoding of its bytes just when each two neighbours are the
encoding of theirs.  So of all tokens that end at byte i exactly one can follow
the last token of the prefix before it, and

    count(i) = count(i - length of that token) + 1.

``Prefixes`` walks a piece of text once and has the count, and the last token, of
every prefix.  Which pairs are neighbours in some encoding is settled by merging
their bytes once and remembered.

A text is split as the tokenizer splits it.  What a prefix ends in may be split
otherwise than in the whole text (blanks before a word, a contraction that is cut,
a special string that is cut); units of a run of white space and the piece after
it hold all such cases, so a unit's counts depend on the unit alone.  Words repeat,
so units are remembered, too.

The table ``prefix_counts`` stores, for each document, how much each code point
adds to the count (16 bits each; the sum of the first n is the exact count of the
first n code points).  ``tokens_at`` and ``within_budget`` answer from the table,
without encoding again.

Memory: one batch of texts, and at most ``MAX_UNITS`` remembered units of at most
``MAX_LENGTH`` code points.  Nothing is shuffled.  Time is linear in the text.

Defined results: a null text is the empty text with no tokens; a null id stays
null; repeated rows are counted each; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import json
import struct
from collections.abc import Iterator
from operator import sub

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorium.llm.common import map_arrow, table

LIMIT = 1024
MAX_UNITS = 500_000
MAX_LENGTH = 64
MAX_PAIRS = 500_000
_SHIFT = 20  # bits of a token's number

_SCHEMA = "id long, n_bytes long, n_chars long, n_tokens long, prefix binary"


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable bytes for
    themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Prefixes:
    """Counts of all prefixes under the merges of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters = _byte_letters()
        self.token = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if all(c in letters for c in t)}
        ids, self.merge = model["vocab"], {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merge[ids[a], ids[b]] = (rank, ids[a + b])
        self.bytes = {i: t for t, i in self.token.items()}
        #: Whether two tokens are neighbours in some encoding, by (first << _SHIFT) | second.
        self.pairs: dict[int, bool] = {}
        #: Whether a token is the encoding of its own bytes.
        self.alone: dict[int, bool] = {}

    def encode(self, data: bytes) -> list[int]:
        """The merges done one by one, the lowest rank first."""
        out = [self.token[data[i:i + 1]] for i in range(len(data))]
        none = (len(self.merge), -1)
        while len(out) > 1:
            best = min(range(len(out) - 1), key=lambda i: self.merge.get((out[i], out[i + 1]), none)[0])
            rank, merged = self.merge.get((out[best], out[best + 1]), none)
            if merged < 0:
                break
            out[best:best + 2] = [merged]
        return out

    def _settle(self, key: int) -> bool:
        if len(self.pairs) >= MAX_PAIRS:
            self.pairs.clear()
        a, b = key >> _SHIFT, key & ((1 << _SHIFT) - 1)
        self.pairs[key] = known = self.encode(self.bytes[a] + self.bytes[b]) == [a, b]
        return known

    def counts(self, data: bytes) -> list[int]:
        """Number of tokens of data[:i] for i = 0 .. len(data)."""
        token, pairs, alone = self.token, self.pairs, self.alone
        count, last = [0] * (len(data) + 1), [0] * (len(data) + 1)
        for i in range(1, len(data) + 1):
            for start in range(i - 1, -1, -1):
                t = token.get(data[start:i])
                if t is None:
                    continue
                if start:
                    key = last[start] | t
                    follows = pairs.get(key)
                    if follows is None:
                        follows = self._settle(key)
                else:
                    follows = alone.get(t)
                    if follows is None:
                        follows = alone[t] = self.encode(data[:i]) == [t]
                if follows:  # the only one that does
                    count[i], last[i] = count[start] + 1, t << _SHIFT
                    break
        return count

    def of_text(self, text: str) -> list[int]:
        """As ``counts``, for the code points of a piece that the tokenizer doesn't split."""
        data = text.encode()
        count = self.counts(data)
        if len(data) == len(text):
            return count
        return [n for n, b in zip(count, data, strict=False) if b & 0xC0 != 0x80] + count[-1:]


class Units(dict):
    """How much each code point of a unit adds to the count, as bytes of 16-bit numbers."""

    def __init__(self, prefixes: Prefixes, spaces):
        super().__init__()
        self.prefixes, self.spaces = prefixes, spaces

    def __missing__(self, unit: str) -> bytes:
        counts = self.counts(unit)
        steps = struct.pack(f"<{len(unit)}h", *map(sub, counts[1:], counts))
        if len(unit) <= MAX_LENGTH:
            if len(self) >= MAX_UNITS:
                self.clear()
            self[unit] = steps
        return steps

    def counts(self, unit: str) -> list[int]:
        of = self.prefixes.of_text
        if unit[0] == " " and len(unit) > 1 and not unit[1].isspace():  # the common case of those below
            return of(unit)
        blank = self.spaces.match(unit).end()
        space, piece = unit[:blank], unit[blank:]
        out = of(space)  # a prefix that ends in the run has all of it in one piece
        if not piece:
            return out
        # Before a piece the run gives off its last character: a blank to the piece, another to itself.
        before = of(space[:-1])[-1]
        if space.endswith(" "):
            return out + [before + n for n in of(" " + piece)[2:]]
        before += of(space[-1:])[-1]
        inner = of(piece)
        if len(piece) == 3 and piece[0] == "'" and piece[1].isalpha():  # cut in two, a contraction is two pieces
            inner[2] = inner[1] + of(piece[1])[-1]
        return out + [before + n for n in inner[1:]]


class Counter:
    """Prefix counts of whole texts, as the tokenizer of ``path`` would give them."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.split = tokenizer.pre_tokenizer.pre_tokenize_str
        special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.unit = regex.compile(r"\s*+(?:(?<! )(?:'s|'t|'re|'ve|'m|'ll|'d)|\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+)|\s+")
        self.beyond = regex.compile("[^\x00-ɏ]")
        self.kinds = (regex.compile(r"\p{L}"), regex.compile(r"\p{N}"), regex.compile(r"\s"))
        self.units = Units(Prefixes(path), regex.compile(r"\s*+"))
        self.stand_in: dict[int, str] = {}
        self.seen: set[str] = set()

    def _kind(self, c: str) -> int:
        for kind, pattern in enumerate(self.kinds):
            if pattern.match(c):
                return kind
        return 3

    def _kind_there(self, c: str) -> int:
        """What the tokenizer takes a character for: it stays in one piece with its like."""
        return next((kind for kind, other in enumerate("a1") if len(self.split(other + c)) == 1),
                    3 if len(self.split("!" + c)) == 1 else 2)

    def pieces(self, text: str) -> Iterator[str]:
        """Units of the text.  Characters that the tokenizer's tables class otherwise than
        ours (newer letters) are replaced by one of the same class while splitting."""
        if not self.beyond.search(text):
            yield from self.unit.findall(text)
            return
        new = {c for c in set(text) if c > "ɏ"} - self.seen
        for c in new:
            kind = self._kind_there(c)
            if kind != self._kind(c):
                self.stand_in[ord(c)] = "a1 †"[kind]
        self.seen |= new
        shown = text.translate(self.stand_in) if self.stand_in else text
        for m in self.unit.finditer(shown):
            yield text[m.start():m.end()]

    def steps(self, text: str) -> bytes:
        """How much each code point adds to the count of tokens."""
        if self.special is None or not self.special.search(text):
            return b"".join(map(self.units.__getitem__, self.pieces(text)))
        out, at = [], 0
        for m in self.special.finditer(text):
            # Until its last character a special string is ordinary text.
            plain = b"".join(map(self.units.__getitem__, self.pieces(text[at:m.end()])))[:2 * (m.end() - at - 1)]
            steps = np.frombuffer(plain, "<i2")
            before = int(np.frombuffer(b"".join(map(self.units.__getitem__, self.pieces(text[at:m.start()]))), "<i2").sum())
            out += [plain, np.asarray([before + 1 - int(steps.sum())], "<i2").tobytes()]
            at = m.end()
        return b"".join(out) + b"".join(map(self.units.__getitem__, self.pieces(text[at:])))


@functools.lru_cache(maxsize=2)
def counter(vocabulary: str | None = None) -> Counter:
    import public_tokenizers

    return Counter(vocabulary or public_tokenizers.path("byte_bpe_50k.json"))


def _count(vocabulary: str | None, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary)
        for batch in batches:
            totals, chars, prefix = [], [], []
            for text in batch.column(1).to_pylist():
                steps = count.steps(text)
                totals.append(int(np.frombuffer(steps, "<i2").sum(dtype=np.int64)))
                chars.append(len(text))
                prefix.append(steps if keep else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.binary_length(batch.column(1)).cast(pa.int64()), pa.array(chars, pa.int64()),
                 pa.array(totals, pa.int64()), pa.array(prefix, pa.binary())],
                names=["id", "n_bytes", "n_chars", "n_tokens", "prefix"])
    return run


def prefix_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
                  keep: bool = True) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_chars``, ``n_tokens`` and ``prefix``, what each
    code point adds to the count (null unless ``keep``)."""
    rows = docs.select(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return map_arrow(rows, _count(vocabulary, keep), _SCHEMA).withColumnRenamed("id", id_col)


def _sums(batch: pa.RecordBatch, column: int) -> Iterator[np.ndarray]:
    for steps in batch.column(column).to_pylist():
        yield np.append(0, np.cumsum(np.frombuffer(steps or b"", "<i2"), dtype=np.int64))


def _at(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends = batch.column(1).to_pylist()
        found = [None if end is None else int(sums[min(max(end, 0), len(sums) - 1)])
                 for end, sums in zip(ends, _sums(batch, 2), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int64())],
                                         names=["id", "at", "n_tokens"])


def tokens_at(table: DataFrame, at, id_col: str = "doc_id") -> DataFrame:
    """(id, at, n_tokens): the exact count of the first ``at`` (a column or number) code points;
    beyond the text's ends that of the empty or the whole text, null for null."""
    at = F.lit(at) if isinstance(at, int) else at
    rows = table.select(F.col(id_col).cast("long"), at.cast("long"), "prefix")
    return map_arrow(rows, _at, "id long, at long, n_tokens long").withColumnRenamed("id", id_col)


def _within(budget: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chars, tokens = [], []
            for sums in _sums(batch, 1):
                end = int(np.flatnonzero(sums <= budget)[-1])
                chars.append(end)
                tokens.append(int(sums[end]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(chars, pa.int64()), pa.array(tokens, pa.int64())],
                                             names=["id", "chars", "n_tokens"])
    return run


def within_budget(table: DataFrame, budget: int = LIMIT, id_col: str = "doc_id") -> DataFrame:
    """(id, chars, n_tokens): the longest prefix that has at most ``budget`` (0 or more) tokens when it
    is encoded by itself.  ``substring(text, 1, chars)`` is the truncated text."""
    if budget < 0:
        raise ValueError("a budget is 0 or more tokens")
    rows = table.select(F.col(id_col).cast("long"), "prefix")
    return map_arrow(rows, _within(budget), "id long, chars long, n_tokens long").withColumnRenamed("id", id_col)


def op12_token_counts(spark, sf_dir: str) -> DataFrame:
    counts = prefix_counts(table(spark, sf_dir, "documents"), keep=False)
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
