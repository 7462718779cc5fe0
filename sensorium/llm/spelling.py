"""Grouping of spelling variants by a trie of letter-group counts.

Words are near if they differ by exactly one inserted, deleted or replaced code
point.  Such a step adds one letter at most and takes one away at most, so of two
near words' counts by letter group one exceeds the other by one in at most one
group, and falls short by one in at most one.

1. Words.  Tasks count the words of their texts and hand on sums; a word's count
   is one aggregation.
2. Vectors.  The vocabulary's letters are dealt, by frequency, into ``GROUPS``
   groups: the most frequent have groups of their own, the rest share.  A word's
   vector is its number of letters in each group.
3. Trie.  A trie node is a prefix of vectors.  Its top is walked by joins: a
   subtree of more than ``max_words`` words is split into its children, and every
   vector goes to each subtree that it reaches with a budget of one surplus and
   one deficit.  A task builds one subtree at a time.
4. Search.  Words with one vector search together: depth first through the
   subtree, spending the budget where a child's count differs by one.
5. Verification.  Words of the reached leaves are compared exactly.  A leaf of more
   than ``PAIRWISE`` words is looked up by what is left of its words when one code
   point is taken out, which is linear in the leaf.

A word's partial results from several subtrees (number of near words and the most
frequent one) are merged by one aggregation.  Roots follow the forms by pointer
doubling: counts grow at least ``FACTOR``-fold from form to form, so a few rounds
reach the end.

A single leaf of more than ``max_words`` words is dealt into blocks, each searched
by all that reach the leaf, so no task holds more than ``max_words`` words.

Defined results: null and empty texts have no words; a null id is written as an
empty string in the hash; repeated rows count again; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorium.llm.common import map_arrow, materialise, table

GROUPS = 14
MIN_LENGTH = 6
MIN_COUNT = 5
FACTOR = 5
DELETE_EVERY = 199
MAX_WORDS = 10_000
TOP = 2  # levels of the trie that every vector is dealt by
PAIRWISE = 12
FLUSH_WORDS = 200_000

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def lower(text: str) -> str:
    """A-Z alone in lower case."""
    return text.lower() if text.isascii() else text.translate(_LOWER)


def misspelt(run: str, seed: int) -> str:
    """The run, or without one code point where the hash of document and run says so.
    ``seed`` is the crc32 of ``<doc_id>:``."""
    h = zlib.crc32(run.encode(), seed)
    if h % DELETE_EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(counts):
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                          names=["word", "n"])
    counts: Counter = Counter()
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for run, n in Counter([w for w in _RUN.findall(lower(text)) if len(w) >= MIN_LENGTH]).items():
                word = misspelt(run, seed)
                if len(word) >= MIN_LENGTH:
                    counts[word] += n
            if len(counts) >= FLUSH_WORDS:
                yield rows(counts)
                counts.clear()
    if counts:
        yield rows(counts)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words that occur at least ``min_count`` times."""
    texts = docs.select(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    counted = map_arrow(texts, _count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= min_count)


def letter_groups(words: DataFrame, groups: int = GROUPS) -> list[str]:
    """The letters of the words, dealt into groups; the most frequent ones have their own.
    The alphabet of words bounds what comes to the driver (90 letters)."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''")
    found = [r["letter"] for r in letters.groupBy("letter").count().orderBy(F.desc("count"), "letter").collect()]
    alone = groups * 2 // 3
    out = found[:alone] + [""] * max(min(groups, len(found)) - alone, 0)
    for i, letter in enumerate(found[alone:]):
        out[alone + i % (len(out) - alone)] += letter
    return out


def vector(word: Column, groups: list[str]) -> Column:
    return F.array(*[(F.length(word) - F.length(F.translate(word, g, ""))).cast("int") for g in groups])


def one_apart(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point makes a into b."""
    if len(a) < len(b):
        a, b = b, a
    i, n = 0, len(b)
    while i < n and a[i] == b[i]:
        i += 1
    if len(a) == n:
        return i < n and a[i + 1:] == b[i + 1:]
    return len(a) == n + 1 and a[i + 1:] == b[i:]


class Leaf:
    """The words of one vector."""

    __slots__ = ("words", "left")

    def __init__(self):
        self.words: list[tuple[str, int]] = []
        self.left: dict | None = None

    def near(self, word: str) -> list[tuple[str, int]]:
        """The words of the leaf that are one step from ``word``."""
        if len(self.words) <= PAIRWISE:
            return [x for x in self.words if one_apart(word, x[0])]
        if self.left is None:
            self.left = {}
            for x in self.words:
                self.left.setdefault(x[0], []).append(x)
                for i in range(len(x[0])):
                    rest = x[0][:i] + x[0][i + 1:]
                    self.left.setdefault((i, rest), []).append(x)  # replaced at i
                    self.left.setdefault((rest,), []).append(x)  # longer than the other
        left, out = self.left, []
        length = len(self.words[0][0])
        if len(word) == length:
            out = [x for i in range(length) for x in left.get((i, word[:i] + word[i + 1:]), ()) if x[0] != word]
        elif len(word) == length - 1:
            out = list(dict.fromkeys(left.get((word,), ())))
        elif len(word) == length + 1:
            out = [x for rest in {word[:i] + word[i + 1:] for i in range(len(word))} for x in left.get(rest, ())]
        return out


class Trie:
    """Words arranged by successive counts."""

    def __init__(self):
        self.root: dict = {}

    def add(self, counts: tuple[int, ...], word: str, n: int) -> None:
        node = self.root
        for c in counts[:-1]:
            node = node.setdefault(c, {})
        leaf = node.get(counts[-1])
        if leaf is None:
            leaf = node[counts[-1]] = Leaf()
        leaf.words.append((word, n))

    def reach(self, counts: tuple[int, ...]) -> list[Leaf]:
        """The leaves whose counts differ by one surplus and one deficit at most."""
        out, depth = [], len(counts)
        stack = [(0, self.root, True, True)]
        while stack:
            level, node, surplus, deficit = stack.pop()
            if not surplus and not deficit:
                for c in counts[level:]:
                    node = node.get(c)
                    if node is None:
                        break
                else:
                    out.append(node)
                continue
            if level == depth:
                out.append(node)
                continue
            c = counts[level]
            child = node.get(c)
            if child is not None:
                stack.append((level + 1, child, surplus, deficit))
            if surplus:
                child = node.get(c + 1)
                if child is not None:
                    stack.append((level + 1, child, False, deficit))
            if deficit:
                child = node.get(c - 1)
                if child is not None:
                    stack.append((level + 1, child, surplus, False))
        return out


_PARTIAL = "word string, n long, n_near long, form_n long, form string"


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one subtree follow each other, its own words before those that search it,
    and these by vector."""
    subtree, trie, counts, leaves = None, Trie(), None, []
    for batch in batches:
        found: list[tuple] = []
        columns = [batch.column(i).to_pylist() for i in range(5)]
        for node, seeks, vec, word, n in zip(*columns, strict=True):
            if node != subtree:
                subtree, trie, counts = node, Trie(), None
            if not seeks:
                trie.add(tuple(vec), word, n)
                continue
            if vec != counts:
                counts, leaves = vec, trie.reach(tuple(vec))
            total, best = 0, None
            for leaf in leaves:
                for other, m in leaf.near(word):
                    total += 1
                    if best is None or (-m, other) < best:
                        best = (-m, other)
            if best is not None:
                found.append((word, n, total, -best[0], best[1]))
        if found:
            w, n, k, m, f = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(w, pa.string()), pa.array(n, pa.int64()), pa.array(k, pa.int64()),
                                              pa.array(m, pa.int64()), pa.array(f, pa.string())],
                                             names=["word", "n", "n_near", "form_n", "form"])


def _steps(level: int) -> Column:
    """The children of a trie node that a vector may go on to: (count, surplus left, deficit left)."""
    c = F.element_at("vec", level + 1)
    step = lambda by, surplus, deficit: F.struct((c + by).alias("c"), surplus.alias("surplus"), deficit.alias("deficit"))
    s, d, no = F.col("surplus"), F.col("deficit"), F.lit(False)
    return F.filter(F.array(step(0, s, d), F.when(s, step(1, no, d)), F.when(d & (c > 0), step(-1, s, no))), lambda x: x.isNotNull())


def _subtrees(vectors: DataFrame, depth: int, max_words: int) -> tuple[DataFrame, DataFrame]:
    """Where words live and where they search, both as (node, vec[, salts]): the top of the trie,
    walked level by level; nodes of more than ``max_words`` words go on to their children.
    ``vectors`` is (vec, size)."""
    def name(level):
        return F.concat_ws(",", F.slice("vec", 1, level))

    live, seek = [], []
    at_home = vectors.select("vec", "size")
    away = vectors.select("vec", F.lit("").alias("node"), F.lit(True).alias("surplus"), F.lit(True).alias("deficit"))
    for level in range(1, depth + 1):
        away = away.select("vec", "node", F.explode(_steps(level - 1)).alias("x"))
        path = F.concat_ws(",", F.when(F.col("node") != "", F.col("node")), F.col("x.c").cast("string"))
        away = away.select("vec", path.alias("node"), "x.surplus", "x.deficit")
        if level < min(TOP, depth):
            continue
        nodes = at_home.groupBy(name(level).alias("node")).agg(F.sum("size").alias("words"))
        nodes = materialise(nodes.withColumn("done", (F.col("words") <= max_words) | F.lit(level == depth)), f"trie-{level}")
        away = materialise(away.join(nodes, "node"), f"trie-away-{level}")
        at_home = materialise(at_home.withColumn("node", name(level)).join(nodes.select("node", "words", "done"), "node"),
                              f"trie-home-{level}")
        salts = F.ceil(F.col("words") / max_words).cast("int").alias("salts")
        live.append(at_home.where("done").select("vec", "node", salts))
        seek.append(away.where("done").select("vec", "node", salts))
        if not nodes.where("not done").limit(1).count():
            break
        at_home = at_home.where("not done").select("vec", "size")
        away = away.where("not done").select("vec", "node", "surplus", "deficit")
    return _union(live), _union(seek)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def near_words(words: DataFrame, groups: int = GROUPS, max_words: int = MAX_WORDS) -> DataFrame:
    """(word, n, n_near, form_n, form) of the words that have near ones; the form is the near word
    of largest n. ``words`` is (word, n), a written table."""
    dealt = letter_groups(words, groups)
    if not dealt:
        return words.sparkSession.createDataFrame([], _PARTIAL)
    words = materialise(words.select("word", "n", vector(F.col("word"), dealt).alias("vec")), "spelling-vectors")
    vectors = materialise(words.groupBy("vec").agg(F.count("*").alias("size")), "trie-vectors")
    live, seek = _subtrees(vectors, len(dealt), max_words)
    salted = F.pmod(F.xxhash64("word"), F.col("salts"))
    every = F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
    node = F.concat_ws("/", "node", "salt").alias("node")
    rows = words.join(live, "vec").withColumn("salt", salted).select(node, F.lit(False).alias("seeks"), "vec", "word", "n")
    rows = rows.unionByName(words.join(seek, "vec").withColumn("salt", every).select(node, F.lit(True).alias("seeks"), "vec", "word", "n"))
    tasks = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = rows.repartition(tasks, "node").sortWithinPartitions("node", "seeks", "vec")
    parts = map_arrow(rows, _search, _PARTIAL)
    first = F.min(F.struct((-F.col("form_n")).alias("m"), "form")).alias("best")
    merged = parts.groupBy("word", "n").agg(F.sum("n_near").alias("n_near"), first)
    return merged.select("word", "n", "n_near", (-F.col("best.m")).alias("form_n"), F.col("best.form").alias("form"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of each word of ``forms`` (word, form): the end of its chain of forms."""
    chain = materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = chain.join(further, "root", "left")
        if not longer.where("next is not null").limit(1).count():
            return chain
        chain = materialise(longer.select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_count: int = MIN_COUNT,
             factor: int = FACTOR, groups: int = GROUPS, max_words: int = MAX_WORDS) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each word of the documents."""
    words = materialise(vocabulary(docs, id_col, text_col, min_count), "spelling-words")
    near = materialise(near_words(words, groups, max_words), "spelling-near")
    formed = near.where(F.col("form_n") >= factor * F.col("n"))
    ends = roots(formed).select(F.col("word"), "root")
    out = words.join(near.select("word", "n_near"), "word", "left").join(
        formed.select("word", "form", "form_n"), "word", "left").join(ends, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                      F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


def op13_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))
