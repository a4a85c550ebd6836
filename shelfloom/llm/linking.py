"""Links inside buckets, as far as they join components; no pair of a group is made that need not be.

Ids that share a bucket are candidates; a bucket may hold a group of any size.

1. *Stars*: each bucket names its least and greatest id and its centre, the id with most company in all its
   buckets (of edited copies, the least edited one).  Each id is compared with the one that most of its
   buckets name in each part: three pairs an id at most.  In a group of copies nearly all ids meet the
   same ones, so nearly all join.
2. *Rest*: a small bucket that still holds several components is compared exhaustively across them.
   Larger ones are given back with their members, for a finer method to part them.
3. *Prefixes*: what cannot be parted is compared by a prefix filter, which loses no similar pair.

Every table that a join meets on a hot bucket is a plain shuffled one, which adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfloom.llm.common import KeyFilter, discard, materialize

#: Elements that a task counts at once, and the counts from which they are common, more and more so.
HELD = 1 << 21
COMMON = (3, 8, 32, 128, 512)


def shared_members(nodes: DataFrame, tag: str, kept=None) -> DataFrame:
    """(bucket, id, lo, hi, mid): members of the buckets that hold several ids, with the bucket's ends and centre.

    nodes: (bucket, id).  kept(key_filter) gives the nodes whose bucket passes the filter, so that only
    they are shuffled again.
    """
    ends = nodes.groupBy("bucket").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n")).where("lo < hi")
    ends = materialize(ends, f"{tag}-ends")
    some = kept(KeyFilter(ends, "bucket")) if kept else nodes
    known = materialize(some.join(ends, "bucket").select("bucket", "id", "lo", "hi", "n").distinct(), f"{tag}-known")
    company = materialize(known.groupBy("id").agg(F.sum("n").alias("company")), f"{tag}-company")
    mid = known.join(company, "id").groupBy("bucket").agg(F.max(F.struct("company", "id")).alias("m")).select("bucket", F.col("m.id").alias("mid"))
    out = materialize(known.drop("n").join(materialize(mid, f"{tag}-mid"), "bucket"), f"{tag}-members")
    discard(ends, known, company)
    return out


def labelled_members(nodes: DataFrame, tag: str) -> DataFrame:
    """The same for (bucket, id, label): buckets of several labels, ends taken from different ones."""
    least = F.min(F.struct("label", "id")).alias("lo")
    most = F.max(F.struct("label", "id")).alias("hi")
    ends = materialize(nodes.groupBy("bucket").agg(least, most).where("lo.label < hi.label"), f"{tag}-ends")
    side = lambda c: F.when(F.col(f"{c}.label") != F.col("label"), F.col(f"{c}.id")).alias(c)
    out = materialize(nodes.join(ends, "bucket").select("bucket", "id", side("lo"), side("hi")).distinct(), f"{tag}-members")
    discard(ends)
    return out


def star_pairs(members: DataFrame) -> DataFrame:
    """(a, b), a < b: each id with the ends, and the centre, that most of its buckets name."""
    parts = [c for c in ("lo", "hi", "mid") if c in members.columns]
    other = lambda c: F.mode(F.when(F.col(c) != F.col("id"), F.col(c)), deterministic=True).alias(c)
    named = members.groupBy("id").agg(*map(other, parts))
    pairs = named.select("id", F.explode(F.array(*parts)).alias("other")).where("other is not null")
    return pairs.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()


def rest_pairs(members: DataFrame, labels: DataFrame, small: int, tag: str) -> tuple[DataFrame, DataFrame]:
    """(pairs (a, b), rest (bucket, id, label)).

    pairs: what buckets of at most ``small`` members still have to compare, which is everything across
    components.  rest: the members of larger buckets that hold several components.
    """
    label: Column = F.coalesce("label", "id").alias("label")
    here = materialize(members.select("bucket", "id").join(labels, "id", "left").select("bucket", "id", label), f"{tag}-here")
    divided = here.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n")).where("low < high")
    here = here.join(materialize(divided.select("bucket", "n"), f"{tag}-sizes"), "bucket")
    few = here.where(F.col("n") <= small).select("bucket", "id", "label")
    other = few.select("bucket", F.col("id").alias("other"), F.col("label").alias("other_label"))
    pairs = few.join(other, "bucket").where("label < other_label").select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()
    pairs = materialize(pairs, f"{tag}-pairs")
    return pairs, materialize(here.where(F.col("n") > small).select("bucket", "id", "label"), f"{tag}-rest")


def _frequent(sets: DataFrame) -> DataFrame:
    """(element, n): elements that tasks have met in several sets, and how often; single ones are not sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def counted() -> pa.RecordBatch:
            value, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(value[n > 1]), pa.array(n[n > 1])], names=["element", "n"])

        size = 0
        for b in batches:
            for raw in b.column(0).to_pylist():
                held.append(np.frombuffer(raw, np.int64))
                size += len(held[-1])
                if size >= HELD:
                    yield counted()
                    size = 0
        if held:
            yield counted()

    return sets.select("s").mapInArrow(run, "element long, n long").groupBy("element").agg(F.sum("n").alias("n"))


def _prefixes(sets: DataFrame, often: list[KeyFilter], threshold: int) -> DataFrame:
    """(id, element, size, pos): of each set the elements one of which any similar set must share."""
    shared = sets.sparkSession.sparkContext.broadcast(often)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, raw, size in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                s = np.frombuffer(raw, np.int64)
                rank = sum((f.test(s) for f in shared.value), np.zeros(len(s), np.int8))
                first = s[np.lexsort((s, rank))][: size - -(-size * threshold // 100) + 1]
                n = len(first)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, i)), pa.array(first), pa.array(np.full(n, size, np.int32)), pa.array(np.arange(n, dtype=np.int32))], names=["id", "element", "size", "pos"])

    return sets.select("id", "s", "size").mapInArrow(run, "id long, element long, size int, pos int")


def prefix_pairs(sets: DataFrame, labels: DataFrame, threshold: int, tag: str) -> DataFrame:
    """(a, b, shared): every pair of the sets that may meet the threshold and is not in one component yet.

    shared counts the elements of both prefixes that led to it.

    sets: (id, s, size): distinct 64-bit elements as binary, and the size of the set that they stand for
    (more than the elements where hashes coincide).  All sets order elements alike: by how common they
    are, in a few classes, then by value.  Of two similar sets each shares at least ``threshold`` per cent
    of its elements with the other, so their first common element stands within the rest of either and
    one more: only sets that meet there are compared.  Pairs that meet so late that what remains of
    either is too little go too, and so do pairs inside a component.  No similar pair is lost, whatever
    the order; the better it is, the fewer others are compared: sets around a common passage that are not
    similar have their own elements first, so they do not meet, however many they are.
    """
    common = materialize(_frequent(sets).where(f"n >= {COMMON[0]}"), f"{tag}-common")
    first = _prefixes(sets, [KeyFilter(common.where(f"n >= {n}"), "element") for n in COMMON], threshold)
    first = first.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    first = materialize(first, f"{tag}-prefixes")
    discard(common)
    sizes = first.groupBy("element", "label").agg(F.count("*").alias("c"))
    largest = sizes.groupBy("element").agg(F.max(F.struct("c", "label")).alias("m"), F.count("*").alias("labels")).where("labels > 1")
    largest = materialize(largest.select("element", F.col("m.label").alias("largest")), f"{tag}-largest")
    outside = first.join(largest, "element").where("label != largest").drop("largest")
    other = first.select("element", *[F.col(c).alias(f"other_{c}") for c in ("id", "label", "size", "pos")])
    enough = F.expr(f"{100 + threshold}L * least(size - pos, other_size - other_pos) >= {threshold}L * (size + other_size)")
    pairs = outside.join(other, (outside["element"] == other["element"]) & (F.col("label") != F.col("other_label")) & enough)
    pairs = pairs.groupBy(F.least("id", "other_id").alias("a"), F.greatest("id", "other_id").alias("b")).agg(F.count("*").alias("shared"))
    pairs = materialize(pairs, f"{tag}-pairs")
    discard(first, largest)
    return pairs


def best_pairs(pairs: DataFrame, k: int = 3) -> DataFrame:
    """(a, b): of each id the ``k`` pairs that share most, to be verified first."""
    both = pairs.select(F.col("a").alias("id"), F.col("b").alias("other"), "shared").unionByName(pairs.select(F.col("b").alias("id"), F.col("a").alias("other"), "shared"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("shared"), "other"))
    best = both.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()


def settle(candidates: DataFrame, verify, labels, tag: str) -> None:
    """Verifies all candidates (a, b, shared) that can still join two components, the likeliest first.

    verify(pairs) keeps the links that it finds; labels() gives (id, label) by all links so far.  Each id's
    best pairs go first, twice: most of the others are inside one component then.
    """
    left = candidates
    for k in (3, 6):
        best = materialize(best_pairs(left, k), f"{tag}-best")
        verify(best)
        known = labels()
        side = lambda c: known.select(F.col("id").alias(c), F.col("label").alias(f"{c}_label"))  # noqa: E731, B023
        found = left.join(best, ["a", "b"], "left_anti").join(side("a"), "a", "left").join(side("b"), "b", "left")
        found = found.where(F.coalesce("a_label", "a") != F.coalesce("b_label", "b")).select("a", "b", "shared")
        before, left = left, materialize(found, f"{tag}-left")
        discard(before, best)
    verify(left.select("a", "b"))
    discard(left)
