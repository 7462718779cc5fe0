"""Personal data: pattern matches, and terms that give the protected entities away.

1. Detection.  Emails, IP addresses, card and phone numbers are matched in the
   whole text and validated.  Each match is a mention of an entity (its
   normalised value); the words beside it are the mention's context.
2. Disclosure.  Over the corpus it is counted in how many documents a term stands
   at all (``df(t)``), in how many it stands together with an entity, anywhere in
   the document (``n(t, e)``), and how many independent witnesses there are: the
   *different* contexts that the entity is mentioned in there, or the documents that
   aren't near copies of each other (5-word shingles, found by banded min-hashes), if
   these are fewer.  So copies of a text, near copies, and copies of a passage bring
   one witness.
   n(t, e) / df(t) estimates P(e | t), and log2 P(e | t) / P(e) is the information
   in bits that the term gives about the entity.
3. Threshold.  A term reveals an entity if P(e | t) is at or over ``generalise_at``,
   the information at or over ``min_bits``, and the evidence - bits times witnesses,
   ``min_contexts`` at least - is ``margin`` bits over what naming one pair among
   the terms of documents with entities and the entities costs (log2 of their
   product), so that words which few documents share by chance aren't taken.  Words of everyday use fail by their frequency.
4. Sanitisation.  Every occurrence of a revealing term in every document, with or
   without the entity, is generalised to its class (``name``, ``number``, ``term``),
   or removed where P(e | t) is at or over ``remove_at``.

Spans of the method never overlap those of the patterns, which are kept as
they are.

Only entities with enough contexts, and only terms most of whose documents mention
some such entity, are paired; both filters are exact.  Every count pre-aggregates
before its shuffle, so a hot entity or term is folded on the map side.  Tables of
terms and documents are broadcast if a count says they are few, else joined.

Defined results: a null or empty text has no spans; repeated rows get the same
result each; a null id stays null; an empty table gives an empty result; only
the named columns are read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorium.llm.common import SPACE, broadcast_checked, map_arrow, materialise, table
from sensorium.llm.components import connected
from sensorium.llm.shingles import shingle_set

KINDS = ("email", "ip", "card", "phone")
#: Classes that revealing terms are generalised to, and the kind of those that are removed.
CLASSES = ("name", "number", "term")
REMOVED = "removed"
#: Words on each side of a mention that make its context.
REACH = 3
MIN_CONTEXTS = 2
#: Near copies: 20 bands of 3 min-hashes.  Pairs share one in 0.9999 of cases at similarity 0.8, in 0.93 at
#: 0.5, and in 0.02 at 0.1.
SHINGLE, BANDS, BAND_ROWS = 5, 20, 3
GENERALISE_AT = 0.5
REMOVE_AT = 0.8
MIN_BITS = 4.0
#: Evidence beyond the cost of naming a pair; 2 ** -MARGIN chance pairs are expected.
MARGIN = 10.0
BROADCAST_TERMS = 100_000
BROADCAST_ROWS = 100_000
EDGE = ".,;:!?\"'()[]<>|*#$%&"
#: What separates terms, as a character class body.
_BETWEEN = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"

# The spans of these equal those of the plain patterns in the docstrings below;
# they are written so that no text makes them backtrack over long runs.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")
_WORD = re.compile(f"[^{SPACE}]+")
_TERM = re.compile(f"[^{_BETWEEN}]+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from the @."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            done = m.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def ips(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)`` whose parts are at most 255."""
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield m.span()


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``[0-9]([\\x20-]?[0-9])+`` with 16 to 19 digits that pass Luhn."""
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``\\+[0-9][\\x20().0-9-]+[0-9]`` with 8 to 15 digits."""
    if "+" not in text:
        return
    for m in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            yield m.span()


FINDERS = dict(zip(KINDS, (emails, ips, cards, phones), strict=True))


def find(text: str) -> dict[str, list[tuple[int, int]]]:
    return {kind: list(finder(text)) for kind, finder in FINDERS.items()}


def _entity(kind: str, value: str) -> str:
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else _NOT_DIGIT.sub('', value)}"


def _beside(text: str, start: int, end: int, reach: int) -> list[tuple[int, int]]:
    """The ``reach`` words before and after a span, without marks at their edges."""
    step = 64
    while True:  # a window that surely holds the words: widened while it cuts one off
        low, high = max(0, start - step), min(len(text), end + step)
        left = [m.span() for m in _WORD.finditer(text, low, start)]
        right = [m.span() for m in _WORD.finditer(text, end, high)]
        if (low == 0 or len(left) > reach) and (high == len(text) or len(right) > reach):
            break
        step *= 4
    out = []
    for s, e in left[-reach:] + right[:reach]:
        word = text[s:e]
        inner = word.strip(EDGE)
        if inner:
            s += word.find(inner)
            out.append((s, s + len(inner)))
    return out


_FOUND = ("_id long, _row long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
          "base string, mentions array<struct<entity:string,context:long>>")
_MENTIONS = pa.list_(pa.struct([("entity", pa.string()), ("context", pa.int64())]))


def context_of(text: str, start: int, end: int, reach: int) -> int:
    """A hash of the words beside a mention."""
    near = _beside(text, start, end, reach)
    key = "\0".join(text[a:b] for a, b in near).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "little", signed=True)


def _detect(reach: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split(" ")[0] for f in _FOUND.split(", ")]
        for batch in batches:
            counts: dict[str, list[int]] = {k: [] for k in KINDS}
            digests, bases, mentions = [], [], []
            for text in batch.column(2).to_pylist():
                spans = find(text)
                base = ",".join(f"{k}:{s}:{e}" for k in KINDS for s, e in spans[k])
                bases.append(base)
                digests.append(hashlib.sha256(base.encode()).hexdigest())
                for kind in KINDS:
                    counts[kind].append(len(spans[kind]))
                here = {(_entity(kind, text[s:e]), context_of(text, s, e, reach)) for kind in KINDS for s, e in spans[kind]}
                mentions.append([{"entity": e, "context": c} for e, c in sorted(here)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(counts[k], pa.int64()) for k in KINDS],
                 pa.array(digests), pa.array(bases), pa.array(mentions, _MENTIONS)], names=names)
    return run


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(text).alias("_row"), text.alias("_text"))


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """Pattern spans and the contexts of their mentions, one row per row of ``docs``."""
    return map_arrow(_texts(docs, id_col, text_col), _detect(reach), _FOUND)


def _terms_of(texts: DataFrame) -> DataFrame:
    """(_row, term) of the distinct terms of each row of ``texts``."""
    found = F.array_remove(F.array_distinct(F.split("_text", f"[{_BETWEEN}]+")), "")
    return texts.select("_row", F.explode(found).alias("term"))


def _band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the bands of a text's min-hashes; near copies share one almost surely."""
    factors = np.random.default_rng(8).integers(0, 2**63, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for batch in batches:
        keys = []
        for text in batch.column(1).cast(pa.binary()).to_pylist():
            hashes = shingle_set(text, SHINGLE).view(np.uint64)
            least = [int((hashes * f).min()) for f in factors] if len(hashes) else []
            keys.append([int.from_bytes(hashlib.blake2b(repr((i, least[i:i + BAND_ROWS])).encode(), digest_size=8).digest(), "little", signed=True)
                         for i in range(0, len(least), BAND_ROWS)])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.list_(pa.int64()))], names=["_row", "keys"])


def near_copies(texts: DataFrame) -> DataFrame:
    """(_row, copy_of) of the texts that are linked to others as near copies.  A band's texts are linked
    to its least one, so a group of any size has as many links as bands."""
    keys = map_arrow(texts.select("_row", "_text"), _band_keys, "_row long, keys array<long>")
    keys = materialise(keys.dropDuplicates(["_row"]).select("_row", F.explode("keys").alias("key")), "pii-bands")
    first = keys.groupBy("key").agg(F.min("_row").alias("first"), F.count("*").alias("n")).where("n > 1")
    links = keys.join(first, "key").select(F.col("_row").alias("a"), F.col("first").alias("b"))
    return connected(links).select(F.col("node").alias("_row"), F.col("root").alias("copy_of"))


def disclosures(found: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_contexts: int = MIN_CONTEXTS, generalise_at: float = GENERALISE_AT, min_bits: float = MIN_BITS,
                margin: float = MARGIN) -> DataFrame:
    """(entity, term, share, bits, witnesses) of the terms that reveal an entity.  ``found`` is what
    ``detect`` says of ``docs``, as a written table."""
    texts = _texts(docs, id_col, text_col)
    mentioned = found.select("_row", F.explode("mentions").alias("m")).select("_row", "m.*")
    contexts = mentioned.select("entity", "context").distinct().groupBy("entity").agg(F.count("*").alias("c"))
    # Each document mentions an entity once here; copies of a document are documents, but bring no context.
    n_entity = mentioned.select("_row", "entity").distinct().join(found.groupBy("_row").agg(F.count("*").alias("copies")), "_row")
    n_entity = n_entity.groupBy("entity").agg(F.sum("copies").alias("n_entity"))
    entities = materialise(contexts.where(F.col("c") >= min_contexts).select("entity").join(n_entity, "entity"), "pii-entities")
    held = materialise(mentioned.join(entities.select("entity"), "entity").distinct(), "pii-held")
    rows = materialise(held.select("_row").distinct(), "pii-rows")

    mentioning = texts.join(broadcast_checked(rows, BROADCAST_ROWS)[0], "_row", "left_semi")
    copies = near_copies(mentioning)
    witness = held.join(copies, "_row", "left").withColumn("copy_of", F.coalesce("copy_of", "_row"))
    here = _terms_of(mentioning)
    near = materialise(here.groupBy("term").agg(F.count("*").alias("near")), "pii-near")
    n_terms = near.count()
    near = near.where(F.col("near") >= min_contexts)
    every = _terms_of(texts).join(broadcast_checked(near.select("term"), BROADCAST_TERMS)[0], "term", "left_semi")
    frequency = every.groupBy("term").agg(F.count("*").alias("df"))
    terms = materialise(near.join(frequency, "term").where(F.col("near") >= generalise_at * F.col("df")).select("term", "df"), "pii-terms")
    total, n_entities = found.count(), entities.count()

    here = materialise(here.join(broadcast_checked(terms.select("term"), BROADCAST_TERMS)[0], "term", "left_semi")
                       .groupBy("_row", "term").agg(F.count("*").alias("copies")), "pii-here")
    both = here.join(held.select("_row", "entity").distinct(), "_row").groupBy("entity", "term").agg(F.sum("copies").alias("both"))
    seen = here.select("_row", "term").join(witness, "_row").groupBy("entity", "term").agg(
        F.least(F.count_distinct("context"), F.count_distinct("copy_of")).alias("witnesses"))
    seen = seen.where(F.col("witnesses") >= min_contexts)

    share = F.least(F.col("both") / F.col("df"), F.lit(1.0))
    bits = F.log2(share * total / F.col("n_entity"))
    cost = math.log2(max(n_terms * n_entities, 1)) + margin
    return (both.join(seen, ["entity", "term"]).join(terms, "term").join(entities, "entity")
            .select("entity", "term", share.alias("share"), bits.alias("bits"), "witnesses")
            .where((F.col("share") >= generalise_at) & (F.col("bits") >= min_bits)
                   & (F.col("bits") * F.col("witnesses") > cost)))


def kind_of(term: Column, share: Column, remove_at: float) -> Column:
    number = term.rlike("^[0-9]+$")
    name = F.upper(F.substring(term, 1, 1)) == F.substring(term, 1, 1)
    return F.when(share >= remove_at, REMOVED).when(number, CLASSES[1]).when(name, CLASSES[0]).otherwise(CLASSES[2])


_ORDER = {k: i for i, k in enumerate((*CLASSES, REMOVED))}


def _added(text: str, kinds: dict[str, str]) -> str:
    """Spans of the terms of ``kinds`` that don't overlap the patterns', by kind and start."""
    taken = sorted(x for spans in find(text).values() for x in spans)
    at, out, reached = 0, [], 0  # spans of different patterns may overlap
    for m in _TERM.finditer(text):
        while at < len(taken) and taken[at][0] < m.end():
            reached = max(reached, taken[at][1])
            at += 1
        if m[0] in kinds and reached <= m.start():
            out.append((_ORDER[kinds[m[0]]], *m.span(), kinds[m[0]]))
    return ",".join(f"{k}:{s}:{e}" for _, s, e, k in sorted(out))


def _mark(sent):
    """Spans of the texts that hold revealing terms: those of the last column, or of ``sent``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = sent.value if sent is not None else None
        for batch in batches:
            texts = batch.column(2).to_pylist()
            if every is None:
                marks = [{m["term"]: m["kind"] for m in row} for row in batch.column(3).to_pylist()]
            else:
                marks = [every if not every.keys().isdisjoint(_TERM.findall(t)) else None for t in texts]
            hit = [i for i, m in enumerate(marks) if m]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(hit, pa.int64())), batch.column(1).take(pa.array(hit, pa.int64())),
                                              pa.array([_added(texts[i], marks[i]) for i in hit], pa.string())], names=["_aid", "_arow", "added"])
    return run


def private_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", remove_at: float = REMOVE_AT, **limits) -> DataFrame:
    """All spans per row of ``docs``: counts and digest of the patterns' and ``spans`` (kind:start:end,
    by kind - the patterns', then the classes, then removed terms - and start)."""
    texts = _texts(docs, id_col, text_col)
    found = materialise(detect(docs, id_col, text_col), "pii-found")
    reveal = disclosures(found, docs, id_col, text_col, **limits)
    reveal = materialise(reveal.groupBy("term").agg(F.max("share").alias("share")), "pii-reveal")
    kinds = reveal.select("term", kind_of(F.col("term"), F.col("share"), remove_at).alias("kind"))

    # Wherever a revealing term stands, with an entity or without.  Few terms are sent to the texts.
    spans_schema, n_terms = "_aid long, _arow long, added string", reveal.count()
    if n_terms <= BROADCAST_TERMS:
        sent = docs.sparkSession.sparkContext.broadcast({r["term"]: r["kind"] for r in kinds.toLocalIterator()})
        added = map_arrow(texts if n_terms else texts.limit(0), _mark(sent), spans_schema)
    else:
        marks = _terms_of(texts).join(kinds, "term").groupBy("_row").agg(F.collect_set(F.struct("term", "kind")).alias("marks"))
        marks = materialise(marks, "pii-marks")
        marked = texts.join(broadcast_checked(marks, BROADCAST_ROWS)[0], "_row").select("_id", "_row", "_text", "marks")
        added = map_arrow(marked, _mark(None), spans_schema)
    added = materialise(added.distinct(), "pii-added")

    out = found.drop("mentions").join(broadcast_checked(added, BROADCAST_ROWS)[0],
                                      F.col("_id").eqNullSafe(F.col("_aid")) & (F.col("_row") == F.col("_arow")), "left")
    spans = F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.when(F.col("added") != "", F.col("added")))
    return out.select(F.col("_id").alias(id_col), "n_email", "n_ip", "n_card", "n_phone", "base_sha256",
                      spans.alias("spans"), "_row")


def _blank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            cut = sorted((int(s), int(e), k) for k, s, e in (x.split(":") for x in spans.split(",") if x))
            out, at = [], 0
            for start, end, kind in cut:
                if end <= at:
                    continue
                out += [text[at:max(start, at)], "" if kind == REMOVED else f"<{kind}>"]
                at = end
            texts.append("".join(out) + text[at:])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """``id_col`` and the text with every span generalised to its kind or removed."""
    spans = private_spans(docs, id_col, text_col, **limits).select(
        F.col(id_col).alias("_sid"), F.col("_row").alias("_srow"), "spans").distinct()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(text).alias("_row"), text.alias("_text"))
    rows = rows.join(spans, F.col("_id").eqNullSafe(F.col("_sid")) & (F.col("_row") == F.col("_srow")))
    return map_arrow(rows.select("_id", "_text", "spans"), _blank, "id long, text string").withColumnsRenamed(
        {"id": id_col, "text": text_col})


def op8_private_data(spark, sf_dir: str) -> DataFrame:
    return private_spans(table(spark, sf_dir, "documents")).drop("_row")
