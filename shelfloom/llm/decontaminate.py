"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Text and benchmark items are compared on letters and digits in lower case, everything else being one
space.  If a region of a document is within ``k`` edits of an item of length ``m``, both share at least
``m - Q + 1 - k * Q`` character q-grams, and the shared ones lie on diagonals (position in the document
less position in the item) that differ by at most ``k``.

1. Every task hashes all q-grams of a batch of documents at once and looks them up in the items' table.
2. Hits are counted in diagonal bands of width ``2 (k + 1)`` that overlap by half, so any ``k + 1``
   neighbouring diagonals lie in one band.
3. Bands that meet the lemma's bound are kept as regions and verified by alignment: the edit distance
   of the whole item to the best part of the region, over the band's diagonals only, all regions of a
   batch at once.

The edit budget is ``edits`` of an item's length, and no more than leaves the bound at one.  Items
are taken in blocks of ``BLOCK`` characters at most; each block is one pass over the documents, so
what travels to the tasks is bounded whatever the benchmark's size.

Cases: null and empty texts match nothing; items shorter than ``Q`` normalised characters cannot be
judged and match nothing; equal items are both reported; repeated documents are judged alike, and
alike whichever documents share their batch, since no region or alignment reaches over the border of
a document; a document shorter than an item by more than the budget does not match it; an empty benchmark or
document table gives documents without a match, or none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Q = 8
BLOCK = 2_000_000
#: Characters of documents handled at once.
BATCH = 1 << 20
_TABLE_BITS = 22
#: Hits expanded to items at once, and cells of alignment bands held at once.
EXPAND = 1 << 21
CELLS = 1 << 20
FAR = 1 << 24


@dataclass(frozen=True)
class DecontaminationSpec:
    edits: float = 0.1


def _fold() -> np.ndarray:
    """Code point -> lower-case code point of a letter or digit, else a space."""
    out = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalnum():
            low = s.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


_FOLD: list[np.ndarray] = []


def normalize(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(codes, where each code was in the text); runs of other characters are one space."""
    if not _FOLD:
        _FOLD.append(_fold())
    codes = _FOLD[0][np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    at = np.flatnonzero(keep)
    return codes[at], at


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """64-bit hashes of all q-grams."""
    h = codes.astype(np.uint64) + np.uint64(1)
    step, mult = 1, 0x9E3779B97F4A7C15
    while step < Q:
        if len(h) <= step:
            return np.empty(0, np.uint64)
        h = h[:-step] * np.uint64(mult) + h[step:]
        step, mult = step * 2, (mult * 0x9E3779B97F4A7C15 + 0x632BE5AB) % (1 << 64)
    return h


def _slot(h: np.ndarray) -> np.ndarray:
    return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)


class Items:
    """A block of benchmark items and the table of their q-grams."""

    def __init__(self, items: list[tuple[int, str]], spec: DecontaminationSpec):
        self.ids, self.codes, budgets = [], [], []
        for i, text in items:
            codes, _ = normalize(text.strip())
            codes = codes[(codes != 32).argmax() :] if len(codes) else codes
            while len(codes) and codes[-1] == 32:
                codes = codes[:-1]
            if len(codes) >= Q:
                self.ids.append(i)
                self.codes.append(codes)
                m = len(codes)
                budgets.append(max(0, min(int(spec.edits * m), (m - Q) // Q)))
        self.length = np.array([len(c) for c in self.codes], np.int64)
        self.budget = np.array(budgets, np.int64)
        self.least = self.length - Q + 1 - self.budget * Q
        h = [gram_hashes(c) for c in self.codes]
        item = np.repeat(np.arange(len(h)), [len(x) for x in h])
        place = np.concatenate([np.arange(len(x)) for x in h]) if h else np.empty(0, np.int64)
        h = np.concatenate(h) if h else np.empty(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.grams, self.item, self.place = h[order], item[order], place[order]
        self.distinct, self.begin, self.times = np.unique(self.grams, return_index=True, return_counts=True)
        self.maybe = np.zeros(1 << _TABLE_BITS, bool)
        self.maybe[_slot(self.distinct)] = True

    def regions(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, lowest diagonal of the band) of the bands that meet the bound."""
        none = np.empty(0, np.int64), np.empty(0, np.int64)
        h = gram_hashes(codes)
        if not len(h) or not len(self.distinct):
            return none
        at = np.flatnonzero(self.maybe[_slot(h)])
        found = np.searchsorted(self.distinct, h[at])
        found[found == len(self.distinct)] = 0
        same = self.distinct[found] == h[at]
        at, found = at[same], found[same]
        longest, step = int(self.length.max(initial=0)), int((self.budget + 1).min())
        span = (len(codes) + 2 * longest) // step + 2
        # Halves of bands are counted first; a band is a half and the next one.  Hits are expanded to the
        # items of their q-grams some at a time, since a frequent q-gram may be in many items.
        keys, counts = [], []
        reach = np.cumsum(self.times[found])
        lo = 0
        while lo < len(at):
            hi = max(int(np.searchsorted(reach, (reach[lo - 1] if lo else 0) + EXPAND, side="right")), lo + 1)
            times = self.times[found[lo:hi]]
            rows = np.repeat(self.begin[found[lo:hi]] - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum())
            item = self.item[rows]
            diagonal = np.repeat(at[lo:hi], times) - self.place[rows] + longest  # not negative
            key, count = np.unique(item * span + diagonal // (self.budget[item] + 1), return_counts=True)
            keys.append(key)
            counts.append(count)
            lo = hi
        if not keys:
            return none
        key, count = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(key, kind="stable")
        key, count = key[order], count[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        half, count = key[first], np.add.reduceat(count, first)
        nxt = np.where(np.concatenate([half[1:] == half[:-1] + 1, [False]]) & ((half + 1) % span != 0), np.concatenate([count[1:], [0]]), 0)
        total = count + nxt
        item, band = half // span, half % span
        keep = total >= self.least[item]
        out_item, out_band = item[keep], band[keep]
        return out_item, out_band * (self.budget[out_item] + 1) - longest

    def verify(self, codes: np.ndarray, item: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(edits, end) of the best alignment of each region's item over the band's diagonals.

        The band reaches ``budget`` diagonals beyond its hits on either side.
        """
        best = np.full(len(item), FAR, np.int64)
        end = np.zeros(len(item), np.int64)
        order = np.argsort(self.length[item], kind="stable")
        padded = np.concatenate([np.zeros(1, np.uint32), codes])
        lo = 0
        while lo < len(order):
            # As many regions at once as CELLS allows; the longest item's band is the widest.
            hi = lo + 1
            while hi < len(order) and (hi + 1 - lo) * (4 * int(self.budget[item[order[hi]]]) + 4) <= CELLS:
                hi += 1
            part = order[lo:hi]
            best[part], end[part] = self._align(codes, padded, item[part], low[part])
            lo = hi
        return best, end

    def _align(self, codes: np.ndarray, padded: np.ndarray, it: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m, k = self.length[it], self.budget[it]
        start = low - k
        column = np.arange(int((4 * k + 4).max()))
        best, end = np.full(len(it), FAR, np.int64), np.zeros(len(it), np.int64)
        active = np.arange(len(it))
        # cost[j]: edits of the item's first i letters, ending before document position start + i + j.
        cost = np.zeros((len(it), len(column)), np.int64)
        for i in range(int(m.max())):
            where = start[active, None] + i + column[None, :]
            letter = padded[np.clip(where + 1, 0, len(codes)) * ((where >= 0) & (where < len(codes)))]
            border = letter == 0
            wanted = np.array([self.codes[x][i] for x in it[active]], np.uint32)
            new = cost + (letter != wanted[:, None])
            new[border] = FAR  # no alignment goes on into another document
            new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + 1)  # the item's letter is missing
            # Extra letters in the document: cheapest of all to the left, one more for each step, as far as
            # the last border, past which every value is lower than those before it.
            shift = column + border.cumsum(axis=1) * (4 * FAR)
            cost = np.minimum(np.minimum.accumulate(new - shift, axis=1) + shift, FAR)
            done = m[active] == i + 1
            if done.any():
                best[active[done]] = cost[done].min(axis=1)
                end[active[done]] = start[active[done]] + i + 1 + cost[done].argmin(axis=1)
            if done.any() or i % 32 == 31:
                stay = ~done & (cost.min(axis=1) <= k[active])  # costs never fall: the others are decided
                active, cost = active[stay], cost[stay]
                if not len(active):
                    break
        return best, end


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size, one block in the driver at a time."""
    block, size = [], 0
    for r in benchmark.where("item_id is not null and text is not null").select("item_id", "text").orderBy("item_id").toLocalIterator():
        if block and size + len(r.text) > BLOCK:
            yield block
            block, size = [], 0
        block.append((r.item_id, r.text))
        size += len(r.text)
    if block:
        yield block


MATCH = "doc_id long, item_id long, begin long, end long, edits long"


def matches(docs: DataFrame, benchmark: DataFrame, spec: DecontaminationSpec = DecontaminationSpec()) -> DataFrame:
    """(doc_id, item_id, begin, end, edits): regions within the budget, in code points of the text.

    Of overlapping regions of one item, the one with the fewest edits is given.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    out = None
    for block in _blocks(benchmark):
        model = spark.sparkContext.broadcast(Items(block, spec))

        def run(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            items = model.value
            for b in batches:
                ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
                lo = 0
                while lo < len(texts):
                    hi, size = lo, 0
                    while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= BATCH):
                        size += len(texts[hi])
                        hi += 1
                    yield _search(items, ids[lo:hi], texts[lo:hi])
                    lo = hi

        found = source.mapInArrow(run, MATCH)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], MATCH) if out is None else out


def _search(items: Items, ids: list, texts: list[str]) -> pa.RecordBatch:
    parts = [normalize(t) for t in texts]
    # A zero parts the documents: it is in no item, so no q-gram spans two documents.
    codes = np.concatenate([x for c, _ in parts for x in (c, np.zeros(1, np.uint32))])
    first = np.concatenate([[0], np.cumsum([len(c) + 1 for c, _ in parts])[:-1]])
    item, low = items.regions(codes)
    rows = []
    if len(item):
        edits, end = items.verify(codes, item, low)
        keep = edits <= items.budget[item]
        item, edits, end = item[keep], edits[keep], end[keep]
        doc = np.searchsorted(first, end - 1, side="right") - 1
        best: list[tuple] = []  # of regions whose ends are less than half an item apart, the best
        last = None
        for d, i, e, n in sorted(zip(doc.tolist(), item.tolist(), end.tolist(), edits.tolist(), strict=True)):
            if last is not None and last[:2] == (d, i) and 2 * (e - last[2]) < items.length[i]:
                best[-1] = min(best[-1], (d, i, n, e))
            else:
                best.append((d, i, n, e))
            last = (d, i, e)
        for d, i, n, e in best:
            at = parts[d][1]
            stop = min(max(e - int(first[d]), 1), len(at))
            begin = max(stop - int(items.length[i]), 0)
            rows.append((ids[d], items.ids[i], int(at[begin]), int(at[stop - 1]) + 1, n))
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=["doc_id", "item_id", "begin", "end", "edits"])


def contaminated(docs: DataFrame, benchmark: DataFrame, spec: DecontaminationSpec = DecontaminationSpec()) -> DataFrame:
    """(doc_id, n_matches, items): one row per document that holds a benchmark item."""
    return matches(docs, benchmark, spec).groupBy("doc_id").agg(F.count("*").alias("n_matches"), F.array_sort(F.collect_set("item_id")).alias("items"))
