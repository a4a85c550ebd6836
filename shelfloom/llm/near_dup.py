"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its distinct word shingles (64-bit hashes).  Documents with equal sets form a
class at once; classes are joined on similarity:

* Every class has ``COORDS`` minwise tokens.  In each of ``trees`` independent trees, a node (at first
  all classes) picks one or two of these coordinates, 1/threshold on average, by a hash of the node
  alone, and branches its documents by their tokens there.  Two documents of similarity ``threshold``
  share one child on average at any depth, dissimilar ones fewer and fewer.
* The first comparison is at depth ``DEPTH``.  Documents of a node are compared only as far as they can
  still join components (``linking``): with the node's ends first, which settles groups of copies of any
  size, then exhaustively across components if the node is ``small``.  Larger nodes that stay divided
  branch ``DEPTH`` levels further.  After ``rounds`` of them what is left, such as many documents around
  one passage, is compared by a prefix filter on full sets that loses no similar pair: nothing is capped.
* Before the exact check, sketches of the minwise tokens drop pairs that are far off (estimates six
  standard deviations under the threshold).  Only documents of pairs that pass have their full sets
  made, once, in a second reading of the texts.

A pair at the threshold has no common node at depth 2 with probability 0.31 a tree and 0.47 at depth 4:
below 1e-6 and 2e-4 for ``trees`` = 12, and nodes are that deep in hot groups only.  Pairs that are more
similar are missed far less often.

Cases: null or blank text has the empty set, links with nothing and is its own component; texts
shorter than a shingle are one shingle; repeated doc_ids are one vertex; a row without doc_id takes its
class's component and is kept only if no row of the class has an id; equal similarity to the
threshold links; empty tables give empty results; columns besides doc_id and text are not used.
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
from shelfloom.llm.linking import labelled_members, prefix_pairs, rest_pairs, settle, shared_members, star_pairs

COORDS = 96
DEPTH = 2
_SEEDS = np.random.default_rng(7_103)
_MULT = _SEEDS.integers(0, 2**31, COORDS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _SEEDS.integers(0, 2**32, COORDS, dtype=np.uint32)
#: Ids (8 bytes each) up to which a table of them is broadcast.
BROADCAST_IDS = 1 << 17
#: Bytes of text hashed at once.
PIECE = 1 << 20
#: Shingles hashed at once for minwise tokens, and texts that a task holds as Python objects.
CHUNK = 512
SLICE = 256


@dataclass(frozen=True)
class JoinSpec:
    """threshold: per cent of the union that must be shared.  words: words in a shingle.

    small: documents of a node up to which it is compared exhaustively.
    """

    threshold: int = 75
    words: int = 5
    trees: int = 12
    small: int = 32
    rounds: int = 2


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]))


#: Words are hashed all at once: differences of running sums of (random number of a byte) * BASE ** position.
_BASE = 0x9E3779B97F4A7C15
_UP, _DOWN = _powers(_BASE, PIECE), _powers(pow(_BASE, -1, 1 << 64), PIECE)
_BYTE = _SEEDS.integers(0, 2**63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as lower case
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def _words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, where it begins), words cut at ASCII white space."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    edge = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[raw], [True]])))
    start, end = edge[::2], edge[1::2]
    out, lo = np.empty(len(start), np.uint64), 0
    while lo < len(start):
        # As many words as PIECE bytes hold; a longer word is hashed on its own.
        hi = int(np.searchsorted(end, start[lo] + PIECE, side="right"))
        if hi == lo:
            out[lo] = xxhash.xxh3_64_intdigest(bytes(raw[start[lo] : end[lo]]).lower(), 1)
            lo += 1
            continue
        at = int(start[lo])
        piece = raw[at : int(end[hi - 1])]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[piece] * _UP[: len(piece)], dtype=np.uint64)])
        first, last = start[lo:hi] - at, end[lo:hi] - at
        out[lo:hi] = _mix((sums[last] - sums[first]) * _DOWN[first] + (last - first).astype(np.uint64))
        lo = hi
    return out, start


def _folded(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all windows of k words."""
    n = len(h) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : n + i]
        out ^= out >> np.uint64(29)
    return _mix(out)


def shingles(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the n-word shingles of each text; A-Z lower-cased, words cut at ASCII white space."""
    raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    out: list[np.ndarray] = []
    lo = 0
    while lo < len(raw):
        hi, size = lo, 0
        while hi < len(raw) and (hi == lo or size + len(raw[hi]) < PIECE):
            size += len(raw[hi]) + 1
            hi += 1
        h, start = _words(b" ".join(raw[lo:hi]))
        bounds = np.searchsorted(start, np.cumsum([0, *(len(r) + 1 for r in raw[lo:hi])]))
        full = _folded(h, n) if len(h) >= n else h[:0]
        for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            part = full[x : y - n + 1] if y - x >= n else _folded(h[x:y], y - x) if y > x else h[:0]
            out.append(np.unique(part))
        lo = hi
    return out


def minwise(s: np.ndarray) -> np.ndarray:
    """COORDS minwise tokens of a set, 32 bits each."""
    out = np.full(COORDS, np.iinfo(np.uint32).max, np.uint32)
    h = (s >> np.uint64(32)).astype(np.uint32)
    room = np.empty((COORDS, min(len(h), CHUNK)), np.uint32)
    for i in range(0, len(h), CHUNK):
        part = h[i : i + CHUNK]
        tokens = np.multiply(part[None, :], _MULT[:, None], out=room[:, : len(part)])
        tokens += _ADD[:, None]
        np.minimum(out, tokens.min(axis=1), out=out)
    return out


def _coordinates(node: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The coordinates that nodes branch by: (positions of nodes, coordinate), 4/3 for each on average."""
    draw = _mix(node ^ np.uint64(0x5851F42D4C957F2D))
    first = (draw >> np.uint64(8)) % np.uint64(COORDS)
    both = np.flatnonzero(draw % np.uint64(3) == 0)
    # A second coordinate differs from the first.
    second = (first[both] + np.uint64(1) + (draw[both] >> np.uint64(24)) % np.uint64(COORDS - 1)) % np.uint64(COORDS)
    return [(np.arange(len(node)), first), (both, second)]


def branched(node: np.ndarray, who: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, who) ``DEPTH`` levels down; row ``who`` of tokens is the node's document."""
    for _ in range(DEPTH):
        children = []
        for at, c in _coordinates(node):
            token = tokens[who[at], c.astype(np.int64)].astype(np.uint64)
            children.append((_mix(_mix(node[at] * np.uint64(0x9E3779B97F4A7C15) ^ c) ^ token), who[at]))
        node, who = (np.concatenate(x) for x in zip(*children, strict=True))
    return node, who


def profile(docs: DataFrame, spec: JoinSpec) -> DataFrame:
    """(doc_id, n_shingles, set_key, sketch, nodes): all but the first two are null for the empty set.

    nodes are those at depth ``DEPTH``, from full tokens; the sketch keeps 16 bits of each token, enough
    for the levels below, where nodes are small.
    """
    trees = _mix(np.arange(1, spec.trees + 1, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, SLICE):
                sets = shingles(b.column(1).slice(lo, SLICE).to_pylist(), spec.words)
                sizes = [len(x) for x in sets]
                keys, sketches, nodes = ([None] * len(sets) for _ in range(3))
                some = [i for i, x in enumerate(sets) if len(x)]
                if some:
                    tokens = np.array([minwise(sets[i]) for i in some])
                    node, who = branched(np.tile(trees, len(some)), np.repeat(np.arange(len(some)), spec.trees), tokens)
                    order = np.argsort(who, kind="stable")
                    node, cut = node[order], np.searchsorted(who[order], np.arange(len(some) + 1))
                    for k, i in enumerate(some):
                        keys[i] = xxhash.xxh3_128_digest(sets[i].tobytes())
                        sketches[i] = tokens[k].astype(np.uint16).tobytes()
                        nodes[i] = node[cut[k] : cut[k + 1]].tobytes()
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, SLICE), pa.array(sizes, pa.int64()), *[pa.array(x, pa.binary()) for x in (keys, sketches, nodes)]], names=["doc_id", "n_shingles", "set_key", "sketch", "nodes"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, set_key binary, sketch binary, nodes binary")


def _rows(node: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(node), 50_000):
        yield pa.RecordBatch.from_arrays([pa.array(node[lo : lo + 50_000].view(np.int64)), pa.array(ids[lo : lo + 50_000])], names=["bucket", "id"])


def _first_nodes(classes: DataFrame, some: KeyFilter | None = None) -> DataFrame:
    """(id, nodes) -> (bucket, id), of the buckets that pass ``some``."""
    shared = classes.sparkSession.sparkContext.broadcast(some)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = shared.value
        for b in batches:
            if b.num_rows:
                raw = b.column(1).to_pylist()
                node = np.frombuffer(b"".join(raw), np.uint64)
                ids = np.repeat(b.column(0).to_numpy(), [len(x) // 8 for x in raw])
                if some is not None:
                    keep = some.test(node)
                    node, ids = node[keep], ids[keep]
                yield from _rows(node, ids)

    return classes.select("id", "nodes").mapInArrow(run, "bucket long, id long")


def _next_nodes(rest: DataFrame) -> DataFrame:
    """(bucket, id, sketch) -> (bucket, id), ``DEPTH`` levels down."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 5_000):
                part = b.slice(lo, 5_000)
                tokens = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint16).reshape(-1, COORDS)
                node, who = branched(part.column(0).to_numpy().view(np.uint64), np.arange(part.num_rows), tokens)
                yield from _rows(node, part.column(1).to_numpy()[who])

    return rest.select("bucket", "id", "sketch").mapInArrow(run, "bucket long, id long")


def _far(pairs: DataFrame, sketches: DataFrame, threshold: int) -> DataFrame:
    """Drops the pairs whose sketches are far under the threshold."""
    t = threshold / 100
    least = COORDS * t - 6 * (COORDS * t * (1 - t)) ** 0.5
    side = lambda c: sketches.select(F.col("id").alias(c), F.col("sketch").alias(f"s{c}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint16).reshape(-1, COORDS) for i in (2, 3))
                yield b.filter(pa.array((x == y).sum(axis=1) >= least)).select(["a", "b"])

    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb")
    return joined.mapInArrow(run, "a long, b long")


def linked(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose full sets meet the threshold.  sets: (id, s), s sorted 64-bit numbers."""
    side = lambda c: sets.select(F.col("id").alias(c), F.col("s").alias(f"s{c}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = np.zeros(b.num_rows, bool)
            last, x = None, None
            for i in range(b.num_rows):
                raw = b.column(2)[i].as_py()
                if raw != last:
                    last, x = raw, np.frombuffer(raw, np.uint64)
                y = np.frombuffer(b.column(3)[i].as_py(), np.uint64)
                if 100 * min(len(x), len(y)) < threshold * max(len(x), len(y)):
                    continue
                at = np.searchsorted(x, y)
                at[at == len(x)] = 0
                both = int((x[at] == y).sum())
                keep[i] = 100 * both >= threshold * (len(x) + len(y) - both)
            yield b.filter(pa.array(keep)).select(["a", "b"])

    joined = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "sa", "sb")
    return joined.mapInArrow(run, "a long, b long")


class _Sets:
    """Full sets of the documents that were asked for so far, each made once."""

    def __init__(self, docs: DataFrame, spec: JoinSpec):
        self.docs, self.spec, self.parts = docs, spec, []

    def of(self, ids: DataFrame) -> DataFrame:
        """(id, s) for at least all these ids."""
        for part in self.parts:
            ids = ids.join(part.select("id"), "id", "left_anti")
        ids = materialize(ids, "nd-ids")
        n = ids.count()
        if n:
            words, named = self.spec.words, self.docs.where("doc_id is not null").select("doc_id", "text")
            few = n <= BROADCAST_IDS
            if few:  # of a checked size: other texts need not go to Python
                named = named.join(F.broadcast(ids), named["doc_id"] == ids["id"], "left_semi")
            some = self.docs.sparkSession.sparkContext.broadcast(KeyFilter(ids, "id"))

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                seen: set[tuple] = set()  # rows of one doc_id and text: one is enough
                for b in batches:
                    at = np.flatnonzero(some.value.test(b.column(0).to_numpy()))
                    for lo in range(0, len(at), SLICE):
                        part = b.take(pa.array(at[lo : lo + SLICE]))
                        ids, sets = [], []
                        for i, made in zip(part.column(0).to_pylist(), shingles(part.column(1).to_pylist(), words), strict=True):
                            s = made.tobytes()
                            key = (i, xxhash.xxh3_128_digest(s))
                            if s and key not in seen:
                                if len(seen) > 500_000:
                                    seen.clear()
                                seen.add(key)
                                ids.append(i)
                                sets.append(s)
                        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], names=["id", "s"])

            known = named.mapInArrow(run, "id long, s binary")
            self.parts.append(materialize(known if few else known.join(ids, "id", "left_semi"), "nd-sets"))
        discard(ids)
        out = self.parts[0]
        for part in self.parts[1:]:
            out = out.unionByName(part)
        return out


def similar(classes: DataFrame, docs: DataFrame, spec: JoinSpec) -> DataFrame | None:
    """(node, component) of the classes (id, sketch, nodes) that the threshold joins; None if it joins none."""
    sets, found, labels = _Sets(docs, spec), [], None
    empty = classes.sparkSession.createDataFrame([], "id long, label long")

    def verify(pairs: DataFrame) -> None:
        near = materialize(_far(pairs, classes, spec.threshold), "nd-near")
        if not near.isEmpty():
            ends = near.select(F.explode(F.array("a", "b")).alias("id")).distinct()
            found.append(materialize(linked(near, sets.of(ends), spec.threshold), "nd-links"))
        discard(near)

    def joined() -> DataFrame:
        links = found[0]
        for more in found[1:]:
            links = links.unionByName(more)
        return components(links)

    members = shared_members(_first_nodes(classes), "nd", lambda some: _first_nodes(classes, some))
    for k in range(1, spec.rounds + 1):
        if members.isEmpty():
            break
        before = len(found)
        pairs = materialize(star_pairs(members), "nd-pairs")
        verify(pairs)
        if len(found) > before:
            discard(labels)
            labels = joined()
        known = labels.withColumnsRenamed({"node": "id", "component": "label"}) if labels is not None else empty
        others, rest = rest_pairs(members, known, spec.small, "nd")
        verify(others)
        discard(pairs, others, members)
        if rest.isEmpty():
            break
        if k == spec.rounds:
            ids = materialize(rest.select("id").distinct(), "nd-ids")
            full = sets.of(ids).join(ids, "id", "left_semi").withColumn("size", (F.octet_length("s") / 8).cast("int"))
            full = materialize(full, "nd-hot")
            renamed = lambda: joined().withColumnsRenamed({"node": "id", "component": "label"}) if found else empty
            settle(prefix_pairs(full, known, spec.threshold, "nd"), verify, renamed, "nd")
            discard(ids, full)
        else:
            deeper = _next_nodes(rest.join(classes.select("id", "sketch"), "id"))
            named = materialize(deeper.join(known, "id", "left").select("bucket", "id", F.coalesce("label", "id").alias("label")), "nd-nodes")
            members = labelled_members(named, "nd")
            discard(named)
        discard(rest)
    discard(labels)
    out = joined() if found else None
    discard(*found, *sets.parts)
    return out


def near_duplicates(docs: DataFrame, spec: JoinSpec = JoinSpec()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for documents (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    profiles = materialize(profile(docs, spec), "nd-profiles")
    least = profiles.where("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("id"))
    groups = materialize(least, "nd-groups")
    # Rows of one class have one sketch; of several rows with the class's id, any one will do.
    own = profiles.where("set_key is not null").select("doc_id", "set_key", "sketch", "nodes")
    first = groups.where("id is not null").select(F.col("set_key").alias("key"), "id")
    classes = own.join(first, (own["set_key"] == first["key"]) & (own["doc_id"] == first["id"])).select("id", "sketch", "nodes")
    classes = materialize(classes.dropDuplicates(["id", "sketch"]), "nd-classes")
    merged = similar(classes, docs, spec)
    discard(classes)
    merged = merged if merged is not None else docs.sparkSession.createDataFrame([], "node long, component long")
    low = materialize(groups.join(merged, F.col("id") == F.col("node"), "left").select("set_key", F.coalesce("component", "id").alias("low")), "nd-low")
    discard(groups, merged)
    out = profiles.select("doc_id", "n_shingles", "set_key").join(low, "set_key", "left")
    component = F.coalesce("low", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))
