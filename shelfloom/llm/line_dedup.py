"""Fuzzy line deduplication: one line of each group of similar lines stays in the corpus.

Lines are compared without case and with white space collapsed.  A line is the set of its
``CHARS``-character shingles (a shorter line is one shingle).

1. One pass gives each line a 64-bit key and minwise signatures, folded into ``bands`` band keys of
   ``rows`` tokens.  All signatures of a batch are computed at once on its rolling hashes.
2. Distinct lines that share a band key are candidates.  Tasks send band keys and lines packed by ranges
   of band keys, so that what is shuffled are a few thousand rows a task; bands with the same lines are
   one bucket.
3. The lines of a bucket meet in one task, in blocks of ``BLOCK_LINES`` lines if it has more.  Bitmaps of
   two lines' shingles bound what they can have in common; the pairs that may meet the threshold are
   verified by exact Jaccard similarity, the likeliest first, only as far as they still join two groups
   (``link_groups``).  Only links leave a task.  Buckets of several blocks also meet in their ends.  For
   the lines of large buckets that stay divided, a prefix filter that loses no similar pair gives the
   candidates that are left, of other blocks or without a common band (``linking``).
4. Union-find by contraction (``components``); of each component the first line, by doc_id and line
   number, stays.  Equal lines share a key and need no verification.

The texts for step 3 are read again from the documents: a bitmap (``KeyFilter``) over the candidates'
keys keeps other lines from being shuffled, an exact join follows.

A pair at similarity 0.8 shares a band with probability 1 - (1 - 0.8^4)^10 = 0.995; at 0.9 more than
0.9999.

Cases: blank lines stay where they are and belong to no group; null text stays null; documents keep
their row even if no line is left; rows that share a doc_id are taken as one document, whose lines
stay in all of them or in none; rows without doc_id stay as they are and take no part; lines of any
length are taken whole; of equal first places, that of the smallest line number stays; empty tables are
fine; other columns pass through, but for n_lines and n_removed, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfloom.llm.common import KeyFilter, discard, materialize
from shelfloom.llm.components import components
from shelfloom.llm.linking import prefix_pairs, star_pairs

CHARS = 8
_RNG = np.random.default_rng(90_017)
_MULT = _RNG.integers(0, 2**31, 256, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
#: Characters hashed at once, and texts that a task holds as Python objects.
BLOCK = 1 << 17
SLICE = 256
#: Eight collisions, each of which moves 100 * shared - threshold * union by 200 at most; long lines have more.
CLOSE = 200 * 8
#: Ranges of band keys (a power of two), and band keys that a task holds before it sends them.
PARTS = 1 << 12
HELD = 1 << 20
#: Lines of a block, characters of the groups that are compared at once, and pairs whose bitmaps are.
BLOCK_LINES = 2048
TOGETHER = 1 << 20
PAIRS = 1 << 14
#: Twice what two collisions move the margin by, as ``CLOSE``; a third among a few hundred shingles has a chance of 1e-13.
SLACK = 2 * 200 * 2
#: Bits of a line's bitmap, and of that of the longest lines.
BITS = (1 << 10, 1 << 14)


@dataclass(frozen=True)
class LineSpec:
    """threshold: per cent of the union of shingles that must be shared.  small: lines of a bucket up to
    which its bands suffice; the lines of larger ones that stay divided pass a prefix filter besides."""

    threshold: int = 80
    bands: int = 10
    rows: int = 4
    small: int = 20


def normalize(line: str) -> str:
    return " ".join(line.lower().split())


def line_key(line: str) -> int:
    """Signed 64-bit key of a normalised line."""
    return xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass")) - (1 << 63)


def shingle_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(32-bit hashes of all shingles of the lines, where each line's begin); no line is empty."""
    joined = "\n".join(lines) + "\n" * CHARS
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    h = codes * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    step, mult = 1, 0x85EBCA77
    while step < CHARS:
        h = h[:-step] * np.uint32(mult) + h[step:]
        h ^= h >> np.uint32(13)
        step, mult = step * 2, (mult * mult + 2) & 0xFFFFFFFF | 1
    sizes = np.array([len(x) for x in lines])
    begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    count = np.maximum(sizes - CHARS + 1, 1)
    # Windows that reach past a line's end belong to no line, but for lines of one short shingle.
    inside = np.zeros(len(h) + 1, np.int32)
    np.add.at(inside, begin, 1)
    np.add.at(inside, begin + count, -1)
    valid = np.cumsum(inside[:-1]) > 0
    short = begin[sizes < CHARS]
    if len(short):
        h = h.copy()
        h[short] = [xxhash.xxh32_intdigest(lines[i].encode("utf-8", "surrogatepass")) for i in np.flatnonzero(sizes < CHARS)]
    return h[valid] * np.uint32(0xC2B2AE3D), np.concatenate([[0], np.cumsum(count)[:-1]])


def band_keys(lines: list[str], spec: LineSpec) -> np.ndarray:
    """(lines x bands) 64-bit keys."""
    h, begin = shingle_hashes(lines)
    out = np.empty((len(lines), spec.bands), np.uint64)
    for band in range(spec.bands):
        key = np.full(len(lines), band + 1, np.uint64)
        for r in range(spec.rows):
            low = np.minimum.reduceat(h * _MULT[band * spec.rows + r], begin)
            key = (key ^ low) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        out[:, band] = key
    return out.view(np.int64)


def _blocks(lines: list[str]) -> Iterator[tuple[int, int]]:
    lo = size = 0
    for i, x in enumerate(lines):
        size += len(x) + 1
        if size >= BLOCK:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(lines):
        yield lo, len(lines)


def _packed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(part, bands, ids): a row for each range of band keys that occurs, with 64-bit numbers as binary."""
    bands, ids = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(bands)
    bands, ids = bands[order], ids[order]
    part = (bands >> np.int64(64 - PARTS.bit_length() + 1)).astype(np.int32)
    first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    ends = pa.py_buffer(np.append(first, len(part)).astype(np.int32) * np.int32(8))
    binary = lambda x: pa.Array.from_buffers(pa.binary(), len(first), [None, ends, pa.py_buffer(x)])
    return pa.array(part[first]), binary(bands), binary(ids)


def sketch(docs: DataFrame, spec: LineSpec) -> DataFrame:
    """(doc_id, line_no, key) of every line that is not blank; other rows hold (part, bands, ids) and no doc_id."""
    names = ["doc_id", "line_no", "key", "part", "bands", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # lines whose bands this task has given: repeats need none
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def rows(columns: list[pa.Array], first: bool) -> pa.RecordBatch:
            n = len(columns[0])
            none = [pa.nulls(n, t) for t in ((pa.int32(), pa.binary(), pa.binary()) if first else (pa.int64(), pa.int32(), pa.int64()))]
            return pa.RecordBatch.from_arrays([*columns, *none] if first else [*none, *columns], names=names)

        for b in batches:
            for lo in range(0, b.num_rows, SLICE):
                ids, numbers, keys, new, at = [], [], [], [], []
                for doc, text in zip(b.column(0).slice(lo, SLICE).to_pylist(), b.column(1).slice(lo, SLICE).to_pylist(), strict=True):
                    for number, line in enumerate(text.split("\n") if text else ()):
                        line = normalize(line)
                        if line:
                            key = line_key(line)
                            if key not in seen:
                                if len(seen) > 1_000_000:
                                    seen.clear()
                                seen.add(key)
                                new.append(line)
                                at.append(key)
                            ids.append(doc)
                            numbers.append(number)
                            keys.append(key)
                yield rows([pa.array(ids, pa.int64()), pa.array(numbers, pa.int32()), pa.array(keys, pa.int64())], True)
                for x, y in _blocks(new):
                    held.append((band_keys(new[x:y], spec).ravel(), np.repeat(np.array(at[x:y], np.int64), spec.bands)))
                    if sum(len(x) for x, _ in held) >= HELD:
                        yield rows(list(_packed(held)), False)
                        held.clear()
        if held:
            yield rows(list(_packed(held)), False)

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    return named.mapInArrow(run, "doc_id long, line_no int, key long, part int, bands binary, ids binary")


def _buckets(lines: DataFrame) -> DataFrame:
    """(bucket, block, blocks, ids): the distinct lines of each band key that several share, in blocks."""

    def flushed(bands: list[bytes], ids: list[bytes]) -> pa.RecordBatch:
        b, k = (np.frombuffer(b"".join(x), np.int64) for x in (bands, ids))
        order = np.argsort(b)
        b = b[order]
        same = b[1:] == b[:-1]
        several = np.append(False, same) | np.append(same, False)
        b, k = b[several], k[order[several]]
        order = np.lexsort((k, b))
        b, k = b[order], k[order]
        once = np.append(True, (b[1:] != b[:-1]) | (k[1:] != k[:-1]))[: len(b)]
        b, k = b[once], k[once]
        first = np.flatnonzero(np.append(True, b[1:] != b[:-1])[: len(b)])
        n = np.diff(np.append(first, len(b)))
        keep = np.repeat(n > 1, n)
        b, k, n = b[keep], k[keep], n[n > 1]
        first = np.cumsum(n) - n
        blocks = -(-n // BLOCK_LINES)
        block = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = np.repeat(first, blocks) + block * BLOCK_LINES
        lists = pa.ListArray.from_arrays(pa.array(np.append(start, len(k)).astype(np.int32)), pa.array(k))
        return pa.RecordBatch.from_arrays([pa.array(b[start]), pa.array(block.astype(np.int32)), pa.array(np.repeat(blocks, blocks).astype(np.int32)), lists], names=["bucket", "block", "blocks", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, bands, ids, size = None, [], [], 0
        for batch in batches:
            for part, b, k in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if part != last and size >= 8 * HELD:
                    yield flushed(bands, ids)
                    bands, ids, size = [], [], 0
                last = part
                bands.append(b)
                ids.append(k)
                size += len(b)
        if bands:
            yield flushed(bands, ids)

    dealt = lines.where("part is not null").select("part", "bands", "ids").repartition("part").sortWithinPartitions("part")
    return dealt.mapInArrow(run, "bucket long, block int, blocks int, ids array<long>")


def _texts(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, line) for a table of distinct keys."""
    shared = docs.sparkSession.sparkContext.broadcast(KeyFilter(keys, "key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, seen = shared.value, set()
        for b in batches:
            for lo in range(0, b.num_rows, SLICE):
                lines = []
                for text in b.column(0).slice(lo, SLICE).to_pylist():
                    if text:
                        lines += [x for x in map(normalize, text.split("\n")) if x]
                k = np.array(list(map(line_key, lines)), np.int64)
                keep = []
                for i in np.flatnonzero(some.test(k)).tolist():
                    key = int(k[i])
                    if key not in seen:
                        if len(seen) > 1_000_000:
                            seen.clear()
                        seen.add(key)
                        keep.append(i)
                yield pa.RecordBatch.from_arrays([pa.array(k[keep]), pa.array([lines[i] for i in keep], pa.string())], names=["key", "line"])

    near = docs.where("doc_id is not null").select("text").mapInArrow(run, "key long, line string")
    return near.join(keys, "key", "left_semi").dropDuplicates(["key"])


def shingle_set(line: str) -> set[str]:
    return {line[i : i + CHARS] for i in range(max(1, len(line) - CHARS + 1))}


def similar(left: list[str], right: list[str], threshold: int) -> np.ndarray:
    """Which pairs of lines meet the threshold.

    Shingles are compared as 32-bit hashes, all pairs of the block at once.  A collision moves a count by
    one, so pairs as close to the threshold as some collisions are decided on the shingles themselves.
    """
    number = {x: i for i, x in enumerate(dict.fromkeys([*left, *right]))}
    a, b = (np.array([number[x] for x in side], np.int64) for side in (left, right))
    h, begin = shingle_hashes(list(number))
    line = np.repeat(np.arange(len(number)), np.diff(np.append(begin, len(h))))
    keys = np.sort((line.astype(np.uint64) << np.uint64(32)) | h)
    keys = keys[np.append(True, keys[1:] != keys[:-1])]
    size = np.bincount((keys >> np.uint64(32)).astype(np.int64), minlength=len(number))
    first = np.concatenate([[0], np.cumsum(size)])
    low = keys & np.uint64(0xFFFFFFFF)

    def of(side: np.ndarray) -> np.ndarray:
        n = size[side]
        at = np.repeat(first[side] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return (np.repeat(np.arange(len(side), dtype=np.uint64), n) << np.uint64(32)) | low[at]

    both = np.sort(np.concatenate([of(a), of(b)]))
    shared = np.bincount((both[1:][both[1:] == both[:-1]] >> np.uint64(32)).astype(np.int64), minlength=len(a))
    margin = 100 * shared - threshold * (size[a] + size[b] - shared)
    keep = margin >= 0
    close = CLOSE * (1 + ((size[a] + size[b]) / (1 << 18)) ** 2)
    for i in np.flatnonzero(np.abs(margin) <= close).tolist():
        x, y = shingle_set(left[i]), shingle_set(right[i])
        keep[i] = 100 * len(x & y) >= threshold * len(x | y)
    return keep


def verified(pairs: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose lines' exact Jaccard similarity meets the threshold."""
    side = lambda c: texts.select(F.col("key").alias(c), F.col("line").alias(f"l{c}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = np.asarray(b.column(4)) + np.asarray(b.column(5))
            reach, lo = np.cumsum(n), 0
            while lo < b.num_rows:
                hi = max(int(np.searchsorted(reach, (reach[lo - 1] if lo else 0) + BLOCK, side="right")), lo + 1)
                part = b.slice(lo, hi - lo)
                keep = similar(part.column(2).to_pylist(), part.column(3).to_pylist(), threshold)
                yield part.filter(pa.array(keep)).select(["a", "b"])
                lo = hi

    joined = pairs.join(side("b"), "b").join(side("a"), "a").withColumns({"na": F.length("la"), "nb": F.length("lb")})
    return joined.select("a", "b", "la", "lb", "na", "nb").mapInArrow(run, "a long, b long")


def _sets(lines: DataFrame) -> DataFrame:
    """(id, s, size): the distinct shingle hashes of whole lines (key, line); size counts shingles as ``verified`` does."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, lines = b.column(0), b.column(1).to_pylist()
            for x, y in _blocks(lines):
                sets = [np.unique(shingle_hashes([line])[0]).astype(np.int64).tobytes() for line in lines[x:y]]
                sizes = [len(shingle_set(line)) for line in lines[x:y]]
                yield pa.RecordBatch.from_arrays([keys.slice(x, y - x), pa.array(sets, pa.binary()), pa.array(sizes, pa.int32())], names=["id", "s", "size"])

    return lines.select("key", "line").mapInArrow(run, "id long, s binary, size int")


def bitmaps(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(a bitmap of each line's shingle hashes, how many they are): a bit says whether an odd number falls on it."""
    width, out, sizes = min(max(BITS[0], 1 << (2 * max(map(len, lines))).bit_length()), BITS[1]), [], []
    for x, y in _blocks(lines):
        h, begin = shingle_hashes(lines[x:y])
        keys = np.sort((np.repeat(np.arange(y - x, dtype=np.uint64), np.diff(np.append(begin, len(h)))) << np.uint64(32)) | h)
        keys = keys[np.append(True, keys[1:] != keys[:-1])]
        line = (keys >> np.uint64(32)).astype(np.int64)
        sizes.append(np.bincount(line, minlength=y - x))
        # A long line takes a block of its own, so a block has few lines or short ones.
        for lo in range(0, y - x, 64):
            some = slice(*np.searchsorted(line, [lo, lo + 64]))
            n = min(64, y - x - lo)
            odd = np.bincount((line[some] - lo) * width + (keys[some] & np.uint64(width - 1)).astype(np.int64), minlength=n * width) & 1
            out.append(np.packbits(odd.astype(np.uint8).reshape(n, width), axis=1).view(np.uint64))
    return np.concatenate(out), np.concatenate(sizes)


def _apart(maps: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least number of shingles that only one line of each pair has."""
    out = np.abs(sizes[a] - sizes[b])
    step = max(PAIRS * 16 // maps.shape[1], 1)
    for lo in range(0, len(a), step):
        hi = lo + step
        out[lo:hi] = np.maximum(out[lo:hi], np.bitwise_count(maps[a[lo:hi]] ^ maps[b[lo:hi]]).sum(axis=1, dtype=np.int64))
    return out


def _pairs(size: int, count: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of members within each of ``count`` groups of ``size`` that follow each other, some at a time."""
    rows = max(4 * PAIRS // size, 1)
    for lo in range(0, size - 1, rows):
        row = np.arange(lo, min(lo + rows, size - 1))
        after = size - 1 - row
        a = np.repeat(row, after)
        b = np.arange(len(a)) - np.repeat(np.cumsum(after) - after, after) + a + 1
        some = max(4 * PAIRS // len(a), 1)
        for at in range(0, count, some):
            base = np.arange(at, min(at + some, count))[:, None] * size
            yield (base + a).ravel(), (base + b).ravel()


def link_groups(ends: np.ndarray, ids: np.ndarray, lines: list[str], threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): links between similar lines, which join all that similar pairs inside the groups join.

    ends: where each group of lines ends.  Two similar sets differ in at most
    (100 - threshold) / (100 + threshold) of the sum of their sizes, and bitmaps differ in no more bits
    than the sets in elements, so no similar pair is lost to them; the sizes get the slack that
    collisions of hashes need.
    """
    _, first, line = np.unique(ids, return_index=True, return_inverse=True)
    text = [lines[i] for i in first]
    maps, sizes = bitmaps(text)
    root = np.arange(len(text))
    n = np.diff(np.append(0, ends))
    found = []
    for size in np.unique(n[n > 1]).tolist():
        members = ((ends - n)[n == size][:, None] + np.arange(size)).ravel()
        for a, b in _pairs(size, len(members) // size):
            x, y = line[members[a]], line[members[b]]
            both = sizes[x] + sizes[y]
            apart = _apart(maps, sizes, x, y)
            keep = (100 + threshold) * apart <= (100 - threshold) * both + SLACK * (1 + (both / (1 << 14)) ** 2)
            x, y = x[keep], y[keep]
            found.append(np.stack([np.minimum(x, y), np.maximum(x, y), apart[keep] * 1_000_000 // np.maximum(both[keep], 1)]))
    left = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.empty((3, 0), np.int64)
    left = left[:, np.argsort(left[2], kind="stable")]
    links, best = [], 1
    length = np.array([len(x) for x in text])
    while left.shape[1]:
        # The likeliest pairs of each component go first, more of them each time.
        pick = np.zeros(left.shape[1], bool)
        for side in (root[left[0]], root[left[1]]):
            order = np.argsort(side, kind="stable")
            begin = np.flatnonzero(np.append(True, side[order][1:] != side[order][:-1]))
            rank = np.arange(len(order)) - np.repeat(begin, np.diff(np.append(begin, len(order))))
            pick[order[rank < best]] = True
        some, left = left[:, pick], left[:, ~pick]
        reach, lo = np.cumsum(length[some[0]] + length[some[1]]), 0
        while lo < some.shape[1]:
            hi = max(int(np.searchsorted(reach, (reach[lo - 1] if lo else 0) + 2 * BLOCK, side="right")), lo + 1)
            x, y = some[0, lo:hi], some[1, lo:hi]
            alike = similar([text[i] for i in x.tolist()], [text[i] for i in y.tolist()], threshold)
            for i, j in zip(x[alike].tolist(), y[alike].tolist(), strict=True):
                if root[i] != root[j]:
                    root[root == root[j]] = root[i]
                    links.append((i, j))
            lo = hi
        left = left[:, root[left[0]] != root[left[1]]]
        best *= 2
    a, b = np.array(links, np.int64).reshape(-1, 2).T
    own = ids[first]
    return np.minimum(own[a], own[b]), np.maximum(own[a], own[b])


def linked(members: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """(a, b): links of similar lines that meet in a group (bucket, block) of members (bucket, block, id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, lines, ids, ends, size = None, [], [], [], 0

        def flushed() -> pa.RecordBatch:
            a, b = link_groups(np.array([*ends, len(lines)]), np.array(ids, np.int64), lines, threshold)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                for bucket, block, i, line in zip(*(c.to_pylist() for c in batch.slice(lo, SLICE).columns), strict=True):
                    if (bucket, block) != last:
                        if size >= TOGETHER:
                            yield flushed()
                            lines, ids, ends, size = [], [], [], 0
                        elif lines:
                            ends.append(len(lines))
                        last = (bucket, block)
                    lines.append(line)
                    ids.append(i)
                    size += len(line)
        if lines:
            yield flushed()

    met = members.join(texts.withColumnRenamed("key", "id"), "id").select("bucket", "block", "id", "line")
    return met.repartition("bucket", "block").sortWithinPartitions("bucket", "block").mapInArrow(run, "a long, b long")


def _grouped(docs: DataFrame, lines: DataFrame, spec: LineSpec) -> DataFrame:
    """(node, component) of the line keys that are similar to others."""
    buckets = materialize(_buckets(lines), "ld-buckets")
    keys = materialize(buckets.select(F.explode("ids").alias("key")).distinct(), "ld-keys")
    texts = materialize(_texts(docs, keys), "ld-texts")
    discard(keys)
    # Bands with the same lines are one.
    whole = buckets.where("blocks = 1").groupBy("ids").agg(F.min("bucket").alias("bucket")).select("bucket", F.lit(0).alias("block"), "ids")
    large = buckets.where("blocks > 1")
    blocks = whole.unionByName(large.select("bucket", "block", "ids"))
    found = [materialize(linked(blocks.select("bucket", "block", F.explode("ids").alias("id")), texts, spec.threshold), "ld-links")]
    if not large.isEmpty():
        members = large.select("bucket", F.explode("ids").alias("id"))
        ends = members.groupBy("bucket").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
        found.append(materialize(verified(star_pairs(members.join(ends, "bucket")), texts, spec.threshold), "ld-links"))

    def joined() -> DataFrame:
        links = found[0]
        for more in found[1:]:
            links = links.unionByName(more)
        return components(links)

    out = joined()
    # Lines of large buckets that stay divided may be similar without a common bucket: a prefix filter loses none.
    named = out.withColumnsRenamed({"node": "id", "component": "label"})
    crowd = buckets.where(f"blocks > 1 or size(ids) > {spec.small}").select("bucket", F.explode("ids").alias("id"))
    crowd = materialize(crowd.join(named, "id", "left").select("bucket", "id", F.coalesce("label", "id").alias("label")), "ld-crowd")
    divided = crowd.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("bucket")
    rest = materialize(crowd.join(divided, "bucket").select(F.col("id").alias("key")).distinct(), "ld-rest")
    if not rest.isEmpty():
        sets = materialize(_sets(texts.join(rest, "key")), "ld-sets")
        pairs = prefix_pairs(sets, named, spec.threshold, "ld")
        found.append(materialize(verified(pairs.select("a", "b"), texts, spec.threshold), "ld-links"))
        discard(sets, pairs)
        if not found[-1].isEmpty():
            discard(out)
            out = joined()
    discard(crowd, rest, buckets, texts, *found)
    return out


def kept_lines(docs: DataFrame, spec: LineSpec = LineSpec()) -> DataFrame:
    """(doc_id, lines): the numbers of the lines that stay, blank ones not counted."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketched = materialize(sketch(docs, spec), "ld-lines")
    groups, lines = _grouped(docs, sketched, spec), sketched.where("key is not null")
    by_key = lines.groupBy("key").agg(F.min(F.struct("doc_id", "line_no")).alias("at"))
    low = by_key.join(groups.withColumnRenamed("node", "key"), "key", "left").groupBy(F.coalesce("component", "key").alias("component")).agg(F.min("at").alias("at"))
    # Lines of several rows with one doc_id may share a number: a set is no longer than a document's lines.
    out = materialize(low.select("at.doc_id", "at.line_no").groupBy("doc_id").agg(F.collect_set("line_no").alias("lines")), "ld-kept")
    discard(sketched, groups)
    return out


def dedup_lines(docs: DataFrame, spec: LineSpec = LineSpec()) -> DataFrame:
    """``docs`` with ``text`` cut to the lines that stay, n_lines and n_removed (lines that are not blank)."""
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    keep = kept_lines(docs, spec).select(F.col("doc_id").alias("__doc"), F.col("lines").alias("__lines"))
    # The kept lines grow with the documents: they are never broadcast, so every size has the same plan.
    joined = docs.select(*columns).join(keep.hint("merge"), F.col("doc_id").cast("long") == F.col("__doc"), "left")

    @F.arrow_udf("text string, n_lines long, n_removed long")
    def cut(texts: pa.Array, kept: pa.Array, whole: pa.Array) -> pa.Array:
        out, total, gone = [], [], []
        for lo in range(0, len(texts), SLICE):
            for text, lines, all_stay in zip(*(x.slice(lo, SLICE).to_pylist() for x in (texts, kept, whole)), strict=True):
                stay, parts, n, lost = set(lines or ()), [], 0, 0
                for i, line in enumerate(text.split("\n") if text is not None else ()):
                    blank = not line or line.isspace()
                    n += not blank
                    if blank or all_stay or i in stay:
                        parts.append(line)
                    else:
                        lost += 1
                out.append(None if text is None else "\n".join(parts))
                total.append(n)
                gone.append(lost)
        return pa.StructArray.from_arrays([pa.array(out, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())], names=["text", "n_lines", "n_removed"])

    made = joined.withColumn("__cut", cut("text", "__lines", F.col("doc_id").isNull()))
    return made.select(*[F.col("__cut.text").alias(c) if c == "text" else F.col(f"`{c}`") for c in columns], "__cut.n_lines", "__cut.n_removed")
