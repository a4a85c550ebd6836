"""Best-fit packing: all documents into few sequences of a fixed number of tokens, none cut without need.

1. *Pieces.*  A document is its token ids and an end id.  One that is longer than a sequence is cut into full
   pieces and, before them, one shorter piece.  Each task numbers its pieces of each length, and the table is
   written: numbers stand from then on.
2. *Best fit decreasing.*  Items of one length are alike, so the packing depends on the number of pieces of
   each length only: at most ``capacity`` numbers, whatever the data.  The lengths are taken from the longest
   down; a segment tree over remaining capacities gives the tightest open bin that takes the item.  An item
   that is put into the tightest bin leaves it tighter still, so the next one of its length goes there too as
   long as it fits: whole runs of bins are filled at once, with the result of one item at a time.  Each length
   opens at most one run of bins and splits at most two, so runs are below three times the capacity.
3. *Places.*  A piece's rank among all of its length is its number in its task and the sum of the tasks
   before; the run of the plan that holds the rank gives its sequence and offset.

The pieces are shuffled once, as rows of some 60 bytes; nothing is sorted and no task holds all pieces of a
length.

Cases: null text is empty, so one piece of the end id; repeated rows (and null ids) are documents of their own;
texts of any length are whole; an empty table gives an empty result; columns besides id and text are not
carried.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfloom.llm.bpe import located
from shelfloom.llm.common import carried, discard, materialize

#: Tokens of a sequence, and the id that ends a document.
CAPACITY, END_ID = 1024, 2
#: Special tokens of the vocabulary: found in a text, they are their ids.
SPECIAL = {"<|endoftext|>": 50256}

_CODERS: dict[str, object] = {}


def coder(vocabulary: str):
    """The encoder of a rank file, once in each worker.

    tiktoken gives the ids that the tokenizers library gives for the same vocabulary (a test compares them),
    five times as fast.
    """
    if vocabulary not in _CODERS:
        import public_tokenizers
        import tiktoken

        with open(located(vocabulary), "rb") as f:
            ranks = {base64.b64decode(k): int(v) for k, v in map(bytes.split, f)}
        _CODERS[vocabulary] = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
    return _CODERS[vocabulary]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of n tokens: full ones, the first may be shorter."""
    first = n % capacity or min(n, capacity)
    edges = [0, *range(first, n + 1, capacity)]
    return list(zip(edges, edges[1:], strict=False))


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, nth), and ``ids`` array<int> if wanted.

    part and nth: the task that made the piece, and the piece's number among those of its length there.
    They hold for the written table only; materialize it before ``pack``.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    extra = ", ids array<int>" if ids else ""
    schema = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, part int, nth long{extra}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, met = coder(vocabulary), np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                some, rows, tokens = b.slice(lo, 500), [], []
                for at, x in enumerate(some.column(1).to_pylist()):
                    found = np.append(code.encode_to_numpy(x or "", allowed_special="all").astype("<u4"), np.uint32(end_id))
                    for k, (i, j) in enumerate(cut(len(found), capacity)):
                        rows.append((at, k, i, j - i, zlib.crc32(found[i:j].tobytes()), part, met[j - i]))
                        met[j - i] += 1
                        if ids:
                            tokens.append(found[i:j].astype(np.int32))
                at, k, i, n, crc, where, nth = (np.array(c, np.int64) for c in zip(*rows, strict=True))
                out = [some.column(0).take(pa.array(at)), pa.array(k.astype(np.int32)), pa.array(i), pa.array(n), pa.array(crc), pa.array(where.astype(np.int32)), pa.array(nth)]
                names = [id_col, "piece", "start", "length", "ids_crc32", "part", "nth"]
                if ids:
                    edges = np.zeros(len(tokens) + 1, np.int32)
                    np.cumsum([len(x) for x in tokens], out=edges[1:])
                    out.append(pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(tokens))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=names)

    return docs.select(id_col, text).mapInArrow(run, schema)


class OpenBins:
    """A segment tree over remaining capacities; each leaf holds the runs [lo, hi) of bins with so much left."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.some = [False] * (2 * self.width)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(self.width)]

    def _mark(self, left: int) -> None:
        at = left + self.width
        self.some[at] = bool(self.runs[left])
        while at > 1:
            at >>= 1
            self.some[at] = self.some[2 * at] or self.some[2 * at + 1]

    def add(self, left: int, lo: int, hi: int) -> None:
        if left and lo < hi:
            self.runs[left].append((lo, hi))
            self._mark(left)

    def take(self, left: int) -> tuple[int, int]:
        run = self.runs[left].pop()
        self._mark(left)
        return run

    def tightest(self, need: int) -> int | None:
        """The least remaining capacity of at least ``need`` that an open bin has."""
        at = need + self.width
        while not self.some[at]:
            while at & 1:  # right children have nothing to their right below this parent
                at >>= 1
            if at == 0:
                return None
            at += 1
        while at < self.width:
            at = 2 * at if self.some[2 * at] else 2 * at + 1
        return at - self.width


def best_fit(counts: Iterable[tuple[int, int]], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """counts: (length, number of items).  Returns (length, from, to, a_bin, bin, offset) runs.

    The items of this length with ranks [from, to) go ``a_bin`` to each bin from ``bin`` on, at ``offset``.
    """
    bins, fresh, plan = OpenBins(capacity), 0, []
    for size, left in sorted(counts, reverse=True):
        rank = 0
        while left:
            room = bins.tightest(size)
            if room is None:
                room, lo = capacity, fresh
                hi = fresh = fresh - (-left // (capacity // size))
            else:
                lo, hi = bins.take(room)
            each = room // size
            full = min(hi - lo, left // each)
            if full:
                plan.append((size, rank, rank + full * each, each, lo, capacity - room))
                bins.add(room - each * size, lo, lo + full)
                rank, left, lo = rank + full * each, left - full * each, lo + full
            if left and lo < hi:  # fewer than one bin takes
                plan.append((size, rank, rank + left, each, lo, capacity - room))
                bins.add(room - left * size, lo, lo + 1)
                left, lo = 0, lo + 1
            bins.add(room, lo, hi)
    return plan


def pack(table: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``table`` (a written table of ``pieces``) with sequence_id and offset; part and nth go."""
    here = table.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    starts = materialize(here.select("length", "part", "n", before.alias("before")), "pack-starts")
    # At most ``capacity`` rows.
    plan = best_fit([(r["length"], r["n"]) for r in starts.groupBy("length").agg(F.sum("n").alias("n")).collect()], capacity)
    runs = [np.array(c, np.int64) for c in zip(*sorted(plan), strict=True)] if plan else [np.zeros(0, np.int64)] * 6
    shared = table.sparkSession.sparkContext.broadcast(runs)  # bounded by the capacity, not by the data

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        size, first, _, each, lo, offset = shared.value
        n, k = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        at = np.zeros(len(n), np.int64)
        for s in np.unique(n):
            a, b = np.searchsorted(size, [s, s + 1])
            mine = n == s
            at[mine] = a + np.searchsorted(first[a:b], k[mine], "right") - 1
        k = k - first[at]
        return pd.DataFrame({"sequence_id": lo[at] + k // each[at], "offset": offset[at] + k % each[at] * n})

    ranked = table.join(starts.select("length", "part", "before"), ["length", "part"]).withColumn("_at", place("length", F.col("before") + F.col("nth")))
    keep = [c for c in table.columns if c not in ("part", "nth")]
    return carried(ranked.select(*keep, "_at.sequence_id", "_at.offset"), starts)


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """Pieces of all documents, each with its sequence and its offset there."""
    return pack(materialize(pieces(docs, vocabulary, capacity, ids=ids), "pack-pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids, starts): the tokens of each sequence, with the documents and their offsets.

    packed: pieces with ids.  A sequence holds at most ``capacity`` tokens, so a group is bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("starts")
    )
