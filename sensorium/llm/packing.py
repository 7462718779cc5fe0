"""Best-fit packing of token sequences by hierarchical residual packing.

A document's ids and a closing separator are cut into pieces of at most
``capacity`` tokens (only longer documents are cut; the first piece takes the
remainder).  Pieces of full length are sequences of their own.  The others:

1. Each input partition packs its pieces by best fit, longest first, right
   after tokenising them.  Sequences with at most ``slack`` tokens left are
   emitted; underfull ones go on.
2. Underfull sequences become items of the next round: they are dealt to as many
   tasks as their number asks for (about ``max_items`` each) and packed by best
   fit again.  Each round leaves fewer, so the tasks form a tree, whatever the
   input's partitions.  It ends with one task, or when a round has saved less
   than ``MIN_GAIN`` of its sequences; what is underfull then is final.

A sequence in work is one row: its fill and a blob of its pieces (at most
``capacity`` of them), so that nothing has to be joined back at the end.
Every round is a written table; a lost executor costs its running tasks.

Ids are those of the tokenizer file.  For texts of Latin script without a
special token's string, the byte-pair encoder of the rank file with the same
vocabulary yields the same ids several times as fast; all other texts go
through the tokenizer itself.

Defined results: a null or empty text is its separator alone; a null id stays
null; repeated rows are packed each; an empty table gives an empty result;
further columns of the input are ignored.
"""

from __future__ import annotations

import base64
import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorium.llm.common import map_arrow, materialise, table

CAPACITY = 1024
SEPARATOR = 2
SLACK = 8
MAX_ITEMS = 200_000
MIN_GAIN = 0.002
#: Items a task holds while it tokenises (about 100 MB); beyond it packs what it has.
FLUSH_ITEMS = 500_000

_BEYOND_LATIN = re.compile("[^\x00-ɏ]")
_BIN_SCHEMA = "final boolean, fill int, sequence_id long, members binary"
_BIN_ARROW = pa.schema([("final", pa.bool_()), ("fill", pa.int32()), ("sequence_id", pa.int64()), ("members", pa.binary())])
# A member: has_id, id, piece, start, length, crc32 of its ids.
_FIELDS = 6


@functools.lru_cache(maxsize=4)
def _encoder(vocabulary: str | None):
    import tiktoken
    import public_tokenizers
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    ranks, fast = os.path.splitext(path)[0] + ".tiktoken", None
    if os.path.exists(ranks):
        with open(ranks, "rb") as f:
            merge = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merge, special_tokens={})
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    return tokenizer, fast, special


def token_ids(text: str, vocabulary: str | None = None) -> np.ndarray:
    """The ids of a text as unsigned 32-bit numbers, without special tokens added."""
    tokenizer, fast, special = _encoder(vocabulary)
    if fast is not None and not _BEYOND_LATIN.search(text) and not any(s in text for s in special):
        return np.asarray(fast.encode_to_numpy(text, disallowed_special=()), dtype="<u4")
    return np.asarray(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")


def cut(ids: np.ndarray, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece; the first takes the remainder."""
    n = len(ids)
    first = n - (max(-(-n // capacity), 1) - 1) * capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def best_fit(fills: np.ndarray, order: np.ndarray, capacity: int) -> list[list[int]]:
    """Groups of item numbers; each item, in the given order, goes to the open
    group that it leaves least room in.  ``room`` has a bit for each residual
    that some open group has, so a search is a shift and a lowest bit."""
    groups: list[list[int]] = []
    by_residual: list[list[int]] = [[] for _ in range(capacity + 1)]
    room = 0
    for i in order.tolist():
        size = int(fills[i])
        fit = room >> size
        if fit:
            residual = size + (fit & -fit).bit_length() - 1
            stack = by_residual[residual]
            g = stack.pop()
            if not stack:
                room &= ~(1 << residual)
            groups[g].append(i)
            left = residual - size
        else:
            g, left = len(groups), capacity - size
            groups.append([i])
        by_residual[left].append(g)
        room |= 1 << left
    return groups


class _Packer:
    """Packs the items of one task and yields rows of sequences."""

    def __init__(self, round_no: int, capacity: int, slack: int, last: bool):
        self.capacity, self.slack, self.last = capacity, slack, last
        self.next_id = (round_no << 56) | (TaskContext.get().partitionId() << 32)

    def rows(self, finals: list[bool], fills: list[int], members: list[bytes]) -> pa.RecordBatch:
        ids = range(self.next_id, self.next_id + len(fills))
        self.next_id += len(fills)
        return pa.RecordBatch.from_arrays([pa.array(finals, pa.bool_()), pa.array(fills, pa.int32()),
                                           pa.array(ids, pa.int64()), pa.array(members, pa.binary())], schema=_BIN_ARROW)

    def pack(self, fills: list[int], members: list[bytes]) -> Iterator[pa.RecordBatch]:
        if not fills:
            return
        size = np.asarray(fills)
        # Ties are broken by content, so a task that runs again packs alike.
        order = np.asarray(sorted(range(len(fills)), key=lambda i: (-fills[i], members[i])))
        groups = best_fit(size, order, self.capacity)
        for s in range(0, len(groups), 4096):
            part = groups[s:s + 4096]
            total = [int(size[g].sum()) for g in part]
            yield self.rows([self.last or t >= self.capacity - self.slack for t in total], total,
                            [b"".join(members[i] for i in g) for g in part])


def _tokenise(capacity: int, slack: int, vocabulary: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, fills, members = _Packer(0, capacity, slack, False), [], []
        for batch in batches:
            whole: list[bytes] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(token_ids(text or "", vocabulary), np.uint32(SEPARATOR)).astype("<u4")
                for piece, (start, length) in enumerate(cut(ids, capacity)):
                    crc = zlib.crc32(ids[start:start + length].tobytes())
                    member = np.array([doc_id is not None, doc_id or 0, piece, start, length, crc], dtype="<i8").tobytes()
                    if length == capacity:
                        whole.append(member)
                    else:
                        fills.append(length)
                        members.append(member)
            if whole:
                yield packer.rows([True] * len(whole), [capacity] * len(whole), whole)
            if len(fills) >= FLUSH_ITEMS:
                yield from packer.pack(fills, members)
                fills, members = [], []
        yield from packer.pack(fills, members)
    return run


def _merge(round_no: int, capacity: int, slack: int, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fills, members = [], []
        for batch in batches:
            fills += batch.column(0).to_pylist()
            members += batch.column(1).to_pylist()
        yield from _Packer(round_no, capacity, slack, last).pack(fills, members)
    return run


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        blobs = batch.column(1).to_pylist()
        rows = np.frombuffer(b"".join(blobs), dtype="<i8").reshape(-1, _FIELDS)
        counts = np.array([len(b) // (8 * _FIELDS) for b in blobs])
        length = rows[:, 4]
        before = np.cumsum(length) - length
        offset = before - np.repeat(before[np.cumsum(counts) - counts], counts)
        sequence = np.repeat(batch.column(0).to_numpy(), counts)
        yield pa.RecordBatch.from_arrays([
            pa.array(rows[:, 1], pa.int64(), mask=rows[:, 0] == 0), pa.array(rows[:, 2].astype("i4"), pa.int32()),
            *[pa.array(x.astype("i8"), pa.int64()) for x in (rows[:, 3], length, rows[:, 5], sequence, offset)]],
            names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         slack: int = SLACK, max_items: int = MAX_ITEMS, vocabulary: str | None = None) -> DataFrame:
    """One row per piece: id, piece, start, length, crc32 of its ids, sequence and offset."""
    texts = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    bins = materialise(map_arrow(texts, _tokenise(capacity, slack, vocabulary), _BIN_SCHEMA), "packed-0")
    done, round_no, gain = [], 0, 1.0
    while True:
        rest = bins.where("not final").select("fill", "members")
        left = rest.count()
        tasks = -(-left // max_items)
        if not left or gain < MIN_GAIN:
            done.append(bins)
            break
        done.append(bins.where("final"))
        round_no += 1
        bins = materialise(map_arrow(rest.repartition(tasks), _merge(round_no, capacity, slack, tasks == 1), _BIN_SCHEMA),
                           f"packed-{round_no}")
        gain = 1 - bins.count() / left
    every = functools.reduce(DataFrame.unionByName, done).select("sequence_id", "members")
    return map_arrow(every, _placed, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                     "sequence_id long, offset long").withColumnRenamed("doc_id", id_col)


def op1_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
