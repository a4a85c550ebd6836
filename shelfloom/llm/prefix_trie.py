"""Prefixes of conversations as double-array tries, with aggregates of every node and its subtree.

1. *Sequences.*  A conversation is the list of its turns' digests (16 bytes) and word counts; texts stay where
   they are.  Conversations with the same turns become one sequence with a count and a smallest member.
2. *Shards.*  A sequence goes to the shard of its shortest prefix under which at most ``limit`` turns stand
   (of distinct sequences), or that is its own alone.  All members of such a prefix meet in that shard, so its nodes from there on are
   whole; shorter prefixes, the *upper* nodes, are spread over shards.  A prompt that a third of all
   conversations begin with is an upper node, and what follows it is dealt out.
3. *Tries.*  A shard numbers its turns densely and packs a double array: the child of state s by turn c is
   BASE[s] + c, where CHECK holds s.  All sequences traverse it together, a depth at a time, and add up
   members and smallest ids; leaves and saved words are summed from the bottom to the top.
4. *Upper nodes* are merged by their path over all shards.  Each brings what its whole subtrees there gave;
   its own leaf and saved words go to all nodes on its path.
5. *Ends.*  The ids that end at a node are sorted by range over all tasks, written as parts of bounded size,
   and hashed as a stream, since SHA-256 has to see them in order.

A task holds one shard: about ``limit`` turns, or one conversation that is longer.

Cases: rows without conv_id belong to no conversation and go; null role or text is empty; a null turn comes
first; turns of one number stand in the order of role and digest, repeated rows after each other; an empty table
gives no node, not even the root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfloom.llm.common import carried, discard, materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Turns of a shard, and ids in a part of a hashed list.
LIMIT, PART_IDS = 20_000, 1 << 16

NODE = "conv_id long, depth int, parent_conv_id long, path binary, parent_path binary, n_convs long, n_children long, n_leaves long, saved_tokens long, words long, upper boolean"


def turn_lists(turns: DataFrame) -> DataFrame:
    """(conv_id, turns array<(turn, role, key, words)>) in order, of rows (conv_id, turn, role, text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    row = F.struct("turn", role.alias("role"), key.alias("key"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    return turns.where("conv_id is not null").select("conv_id", row.alias("r")).groupBy("conv_id").agg(F.sort_array(F.collect_list("r")).alias("turns"))


def rebuilt(turns: DataFrame, span: int = 20, share: int = 4) -> DataFrame:
    """The lists of conversations that begin with the first turns of the one that opens their block of ids.

    Of conversation c the first crc32(c) modulo ``share`` turns are those of c - c modulo ``span``.
    """
    own = materialize(turn_lists(turns), "trie-own")
    head = own.where(F.col("conv_id") % span == 0).select(F.col("conv_id").alias("opens"), F.slice("turns", 1, share).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % share).cast("int")
    both = own.withColumn("opens", F.col("conv_id") - F.col("conv_id") % span).join(head, "opens", "left")
    begins = F.coalesce(F.slice("head", F.lit(1), h), F.slice("turns", 1, 0))
    return carried(both.select("conv_id", F.concat(begins, F.slice("turns", h + 1, F.size("turns"))).alias("turns")), own)


def _chain(keys: list[bytes]) -> list[bytes]:
    """The path of each prefix: a digest of its own path before and its last turn."""
    out, at = [], b""
    for k in keys:
        at = hashlib.md5(at + k).digest()
        out.append(at)
    return out


def _ended(lists: DataFrame) -> DataFrame:
    """(conv_id, keys, words, path): with the path of the whole sequence, empty without turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            path = [x[-1] if (x := _chain(keys)) else b"" for keys in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(path, pa.binary())], names=["conv_id", "keys", "words", "path"])

    flat = lists.select("conv_id", F.col("turns.key").alias("keys"), F.col("turns.words").alias("words"))
    return flat.mapInArrow(run, "conv_id long, keys array<binary>, words array<long>, path binary")


def _prefixes(sequences: DataFrame) -> DataFrame:
    """(path, prefix, size): every prefix of every sequence, with the sequence's length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, keys in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if keys:
                    n = len(keys)
                    yield pa.RecordBatch.from_arrays([pa.array([path] * n, pa.binary()), pa.array(_chain(keys), pa.binary()), pa.array([n] * n, pa.int64())], names=["path", "prefix", "size"])

    return sequences.select("path", "keys").mapInArrow(run, "path binary, prefix binary, size long")


def _dealt(sequences: DataFrame, limit: int) -> DataFrame:
    """``sequences`` with ``top``, the depth of the shortest prefix that is not hot, and ``shard``, a number of it.

    A prefix is hot if several sequences of more than ``limit`` turns in all begin with it; so are its own then.
    """
    total = sequences.agg(F.sum(F.size("keys"))).first()[0] or 0
    shards = max(1, -(-2 * total // limit))
    found = _prefixes(sequences)
    hot = materialize(found.groupBy("prefix").agg(F.sum("size").alias("n"), F.count("*").alias("k")).where((F.col("n") > limit) & (F.col("k") > 1)).select("prefix"), "trie-hot")
    above = materialize(found.join(hot, "prefix").groupBy("path").agg(F.count("*").cast("int").alias("hot")), "trie-above")
    known = sequences.join(above, "path", "left").withColumn("top", F.coalesce("hot", F.lit(0)) + 1).drop("hot")
    names = [*known.columns, "dealt"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = zip(b.column("keys").to_pylist(), b.column("top").to_pylist(), strict=True)
            by = [x[-1] if (x := _chain(keys[:top])) else b"" for keys, top in pairs]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(by, pa.binary())], names=names)

    schema = "path binary, keys array<binary>, words array<long>, n_convs long, conv_id long, top int, dealt binary"
    out = known.mapInArrow(run, schema).withColumn("shard", F.pmod(F.xxhash64("dealt"), F.lit(shards))).drop("dealt", "path")
    return carried(out, above)


class DoubleArray:
    """BASE and CHECK over dense codes from 1 on; the root is state 0.

    Free places are found by pointers to the next one, which are shortened as they are followed.
    """

    def __init__(self):
        self.base, self.check, self.next = [0], [-1], [1]

    def _grow(self, size: int) -> None:
        for i in range(len(self.check), size + 1):
            self.base.append(0)
            self.check.append(-2)
            self.next.append(i)

    def free(self, at: int) -> int:
        """The first free place from ``at`` on."""
        self._grow(at)
        end = at
        while self.next[end] != end:
            end = self.next[end]
            self._grow(end)
        while self.next[at] != end and at != end:
            self.next[at], at = end, self.next[at]
        return end

    def open(self, state: int, codes: list[int]) -> list[int]:
        """Places for the children of ``state`` by ``codes`` (rising); returns their states."""
        at = self.free(codes[0])
        while True:
            base = at - codes[0]
            self._grow(base + codes[-1])
            if all(self.check[base + c] == -2 for c in codes[1:]):
                break
            at = self.free(at + 1)
        self.base[state] = base
        for c in codes:
            self.check[base + c] = state
            self.next[base + c] = base + c + 1
        return [base + c for c in codes]


def packed(sequences: list[np.ndarray]) -> DoubleArray:
    """The trie of sequences of codes, wider nodes of a depth first."""
    order = sorted(map(tuple, sequences))
    trie, level = DoubleArray(), [(0, 0, len(order))]
    depth = 0
    while level:
        opened = []
        for state, lo, hi in level:
            while lo < hi and len(order[lo]) == depth:
                lo += 1
            cuts = [i for i in range(lo, hi) if i == lo or order[i][depth] != order[i - 1][depth]]
            if cuts:
                opened.append((state, [order[i][depth] for i in cuts], [*cuts, hi]))
        opened.sort(key=lambda x: -len(x[1]))
        level = []
        for state, codes, cuts in opened:
            level += zip(trie.open(state, codes), cuts, cuts[1:], strict=False)
        depth += 1
    return trie


def shard_nodes(table: pa.Table) -> pa.Table:
    """The nodes of one shard's sequences (keys, words, n_convs, conv_id, top), as rows of NODE."""
    lists = table.column("keys").to_pylist()
    sizes = np.array([len(x) for x in lists], np.int64)
    digests = sorted({k for x in lists for k in x})
    code = {k: i for i, k in enumerate(digests, 1)}
    coded = [np.array([code[k] for k in x], np.int64) for x in lists]
    trie = packed(coded)
    base, check = np.array(trie.base), np.array(trie.check)
    n = len(base)
    conv, copies, top = (table.column(c).to_numpy().astype(np.int64) for c in ("conv_id", "n_convs", "top"))
    depth, convs, least = np.full(n, -1), np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max)
    words, upper, label = np.zeros(n, np.int64), np.zeros(n, bool), np.zeros(n, np.int64)
    depth[0], upper[0] = 0, True
    convs[0], least[0] = copies.sum(), conv.min()
    flat = np.concatenate([*coded, np.zeros(1, np.int64)])
    flat_words = np.concatenate([*(np.array(x, np.int64) for x in table.column("words").to_pylist()), np.zeros(1, np.int64)])
    starts = np.cumsum(sizes) - sizes
    going, state = np.arange(len(lists)), np.zeros(len(lists), np.int64)
    for d in range(int(sizes.max(initial=0))):
        on = sizes[going] > d
        going, state = going[on], state[on]
        at = base[state] + flat[starts[going] + d]
        assert (check[at] == state).all()
        np.add.at(convs, at, copies[going])
        np.minimum.at(least, at, conv[going])
        depth[at], words[at], label[at] = d + 1, flat_words[starts[going] + d], flat[starts[going] + d]
        upper[at] = d + 1 < top[going]
        state = at
    children, leaves, saved = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    order = np.argsort(-depth, kind="stable")
    for d in range(int(depth.max()), 0, -1):
        a, b = np.searchsorted(-depth[order], [-d, -d + 1])
        here, whole = order[a:b], ~upper[order[a:b]]
        own = here[whole]
        leaves[own[children[own] == 0]] = 1
        saved[own] += (convs[own] - 1) * words[own]
        np.add.at(children, check[own], 1)
        np.add.at(leaves, check[here], leaves[here])
        np.add.at(saved, check[here], saved[here])
    path: dict[int, bytes] = {0: b""}
    nodes = order[depth[order] >= 0][::-1]
    for s in nodes.tolist():
        if s:
            p = int(check[s])
            path[s] = hashlib.md5(path[p] + digests[label[s] - 1]).digest()
    parent = np.maximum(check[nodes], 0)
    known = (nodes > 0) & ~upper[parent]
    lists = [
        pa.array(least[nodes]),
        pa.array(depth[nodes].astype(np.int32)),
        pa.array(least[parent], mask=~known),
        pa.array([path[s] for s in nodes.tolist()], pa.binary()),
        pa.array([None if k or s == 0 else path[p] for k, s, p in zip(known.tolist(), nodes.tolist(), parent.tolist(), strict=True)], pa.binary()),
        *(pa.array(x[nodes]) for x in (convs, children, leaves, saved, words, upper)),
    ]
    names = [c.split()[0] for c in NODE.split(", ")]
    return pa.table(dict(zip(names, lists, strict=True)))


def _summed(nodes: DataFrame) -> DataFrame:
    """(path, leaf, own): sums over the subtrees of a forest (path, up, leaf, own), ``up`` being the parent.

    Each round adds what hangs below a node twice as far down and doubles how far ``up`` points: rounds are
    the logarithm of the depth, and a round's rows are the nodes.
    """
    at = materialize(nodes, "trie-sums")
    while not at.where("up is not null").isEmpty():
        below = at.groupBy(F.col("up").alias("path")).agg(F.sum("leaf").alias("leaf_below"), F.sum("own").alias("own_below"))
        ahead = at.select(F.col("path").alias("up"), F.col("up").alias("next"))
        more = at.join(below, "path", "left").join(ahead, "up", "left")
        sums = [(F.col(c) + F.coalesce(f"{c}_below", F.lit(0))).alias(c) for c in ("leaf", "own")]
        before, at = at, materialize(more.select("path", F.col("next").alias("up"), *sums), "trie-sums")
        discard(before)
    return carried(at.select("path", "leaf", "own"), at)


def _merged(upper: DataFrame) -> DataFrame:
    """Upper nodes, one row each, from what each shard knows of them."""
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    same = [F.first(c).alias(c) for c in ("depth", "words", "parent_path")]
    once = materialize(upper.groupBy("path").agg(F.min("conv_id").alias("conv_id"), *sums, *same), "trie-upper")
    more = once.where("depth > 0").groupBy(F.col("parent_path").alias("path")).agg(F.count("*").alias("more"))
    full = materialize(once.join(more, "path", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).drop("more"), "trie-upper")
    leaf: Column = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")
    given = _summed(full.select("path", F.col("parent_path").alias("up"), leaf.alias("leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("own")))
    out = full.join(given, "path").withColumn("n_leaves", F.col("n_leaves") + F.col("leaf")).withColumn("saved_tokens", F.col("saved_tokens") + F.col("own"))
    discard(once)
    return carried(out.drop("leaf", "own", "words"), full)


def _ends(ended: DataFrame) -> DataFrame:
    """(path, ends_sha256): the hash of the sorted ids of the conversations that end at a node."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids = None, []

        def part() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([ids[0]]), pa.array([",".join(map(str, ids))])], names=["path", "first", "ids"])

        for b in batches:
            for path, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if ids and (path != at or len(ids) == PART_IDS):
                    yield part()
                    ids = []
                at = path
                ids.append(i)
        if ids:
            yield part()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, h = None, None
        for b in batches:
            done_path, done_hash = [], []
            for path, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if h is not None and path == at:
                    h.update(b",")
                else:
                    if h is not None:
                        done_path.append(at)
                        done_hash.append(h.hexdigest())
                    at, h = path, hashlib.sha256()
                h.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(done_path, pa.binary()), pa.array(done_hash, pa.string())], names=["path", "ends_sha256"])
        if h is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([h.hexdigest()])], names=["path", "ends_sha256"])

    ids = ended.select("path", "conv_id").repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id").mapInArrow(parts, "path binary, first long, ids string")
    return ids.repartition("path").sortWithinPartitions("path", "first").mapInArrow(whole, "path binary, ends_sha256 string")


def prefix_trie(lists: DataFrame, limit: int = LIMIT) -> DataFrame:
    """lists: (conv_id, turns).  One row a node, see the module."""
    ended = materialize(_ended(lists), "trie-ended")
    sequences = materialize(ended.groupBy("path").agg(F.first("keys").alias("keys"), F.first("words").alias("words"), F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")), "trie-sequences")
    nodes = materialize(_dealt(sequences, limit).groupBy("shard").applyInArrow(shard_nodes, NODE), "trie-nodes")
    discard(sequences)
    upper = materialize(_merged(nodes.where("upper")), "trie-merged")
    columns = ["conv_id", "depth", "parent_conv_id", "path", "parent_path", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    both = nodes.where("not upper").select(columns).unionByName(upper.withColumn("parent_conv_id", F.lit(None).cast("long")).select(columns))
    top = upper.select(F.col("path").alias("parent_path"), F.col("conv_id").alias("top_conv_id"))
    both = both.join(top, "parent_path", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "top_conv_id"))
    out = both.join(materialize(_ends(ended), "trie-ends"), "path", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))
    return out.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
