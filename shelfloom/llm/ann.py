"""Approximate nearest neighbours by a hierarchical k-means tree with best-bin-first search.

* The tree is fitted by recursive k-means on a bounded sample (``SAMPLE`` vectors, chosen by hash)
  until a leaf's share of the sample is at most ``leaf``.  Every vector is then indexed: it descends
  the tree to its leaf.
* The tree grows with the rows: leaves that hold more than ``leaf_rows`` of them are split in the same
  way, each on a bounded sample of its own rows, all at once and as often as needed, while the tree's
  centres take no more than ``TREE_BYTES``.
* A query walks the tree through a priority queue that is ordered by an upper bound of the inner
  product in each subtree: q.c + |q| * radius, for the centre and radius of the subtree's sample.
  Leaves leave the queue in the order in which they should be visited.
* The number of leaf visits is calibrated: sample queries are answered exactly, over all rows, and
  visits widen, one leaf at a time, until they reach the leaves of ``target`` of the true neighbours (all
  leaves, if need be, which is exact).
* Scores are inner products of the original vectors in double precision.

Index rows are split into blocks of about ``BLOCK_ROWS`` by a hash inside their leaf, so a leaf that
holds a third of all vectors is many tasks; each block gets its leaf's queries and
returns the best k of each, which are merged per query.  Blocks, parts of queries and the sample are bounded
in bytes, so that long vectors make smaller ones.  Only the tree (of at most ``TREE_BYTES``) is broadcast.

Cases: vectors that are null, zero, hold null, NaN or infinite components, or differ in length from
the most common length (the shortest of equally common ones) take no part, as rows or queries; equal vectors tie and rank by id;
repeated ids rank as separate rows, and a query skips every row with its own id; fewer rows than k
give fewer results; an empty table gives none.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfloom.llm.common import discard, materialize

#: Vectors, and bytes of them, that the first tree is fitted on.
SAMPLE, SAMPLE_BYTES = 20_000, 1 << 26
#: Rows of a large leaf that its own part of the tree is fitted on; bytes of centres up to which the tree grows.
LEAF_SAMPLE = 4_096
TREE_BYTES = 1 << 27
CALIBRATION = 64
#: Rows, and bytes, of one block of a leaf.
BLOCK_ROWS, BLOCK_BYTES = 4_096, 1 << 25
#: Queries, and bytes, of one part of a leaf's queries; more make more parts, and each reads the leaf once.
PART_QUERIES, PART_BYTES = 100_000, 1 << 26
#: Nodes up to which a query's bounds are taken of the whole tree at once; beyond, of those that it meets.
WHOLE = 4_096


def at_most(n: int, size: int, dimensions: int) -> int:
    """``n`` vectors of doubles, or as many as ``size`` bytes hold, but one at least."""
    return max(1, min(n, size // (8 * dimensions)))


@dataclass(frozen=True)
class TreeSpec:
    """branches of a node, sample vectors and rows of a leaf at most, and the recall that calibration asks for."""

    branches: int = 8
    leaf: int = 128
    leaf_rows: int = 16_384
    target: float = 0.95
    seed: int = 5


class Tree:
    """Nodes in arrays: centre, radius, children; leaves are numbered."""

    def __init__(self, sample: np.ndarray, spec: TreeSpec):
        self.centre, self.radius, self.children, self.leaf = [], [], [], []
        self.leaves = 0
        self.rng = np.random.default_rng(spec.seed)
        self.spec = spec
        self._grow(sample, 0)
        self.centre = np.array(self.centre)
        self.radius = np.array(self.radius)
        del self.rng

    def _add(self, rows: np.ndarray) -> int:
        c = rows.mean(axis=0) if len(rows) else np.zeros(rows.shape[1])
        self.centre.append(c)
        self.radius.append(float(np.sqrt(((rows - c) ** 2).sum(axis=1).max(initial=0.0))))
        self.children.append([])
        self.leaf.append(-1)
        return len(self.centre) - 1

    def _grow(self, rows: np.ndarray, depth: int) -> int:
        me = self._add(rows)
        groups = self._split(rows) if len(rows) > self.spec.leaf and depth < 24 else []
        if len(groups) < 2:
            self.leaf[me] = self.leaves
            self.leaves += 1
        else:
            self.children[me] = [self._grow(g, depth + 1) for g in groups]
        return me

    def _split(self, rows: np.ndarray) -> list[np.ndarray]:
        distinct = np.unique(rows, axis=0)
        k = min(self.spec.branches, len(distinct))
        if k < 2:
            return []
        centres = distinct[self.rng.choice(len(distinct), k, replace=False)]
        for _ in range(12):
            near = self._nearest(rows, centres)
            centres = np.array([rows[near == j].mean(axis=0) if (near == j).any() else centres[j] for j in range(k)])
        near = self._nearest(rows, centres)
        return [rows[near == j] for j in range(k) if (near == j).any()]

    @staticmethod
    def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
        return np.argmin((centres**2).sum(axis=1) - 2 * rows @ centres.T, axis=1)

    def graft(self, parts: dict[int, Tree]) -> None:
        """Puts trees in the place of leaves; all leaves get new numbers."""
        centre, radius = [self.centre], [self.radius]
        at = {number: i for i, number in enumerate(self.leaf) if number >= 0}
        for number, part in parts.items():
            node = at[number]
            shift = len(self.children) - 1  # the part's root is the leaf itself
            self.children[node] = [c + shift for c in part.children[0]]
            self.children += [[c + shift for c in kids] for kids in part.children[1:]]
            self.leaf += [-1] * (len(part.children) - 1)
            centre.append(part.centre[1:])
            radius.append(part.radius[1:])
        self.centre, self.radius = np.concatenate(centre), np.concatenate(radius)
        ends = [i for i, kids in enumerate(self.children) if not kids]
        self.leaf = [-1] * len(self.children)
        for number, node in enumerate(ends):
            self.leaf[node] = number
        self.leaves = len(ends)

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row: at every node, to the child with the nearest centre."""
        out = np.zeros(len(rows), np.int32)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            kids = self.children[node]
            if not kids:
                out[at] = self.leaf[node]
            else:
                near = self._nearest(rows[at], self.centre[kids])
                todo += [(kid, at[near == j]) for j, kid in enumerate(kids)]
        return out

    def visit(self, q: np.ndarray, visits: int) -> list[int]:
        """The first leaves of the best-bin-first order."""
        norm = np.linalg.norm(q)
        whole = self.centre @ q + norm * self.radius if len(self.centre) <= WHOLE else None
        heap, out = [(0.0, 0)], []
        while heap and len(out) < visits:
            _, node = heapq.heappop(heap)
            if kids := self.children[node]:
                bound = self.centre[kids] @ q + norm * self.radius[kids] if whole is None else whole[kids]
                for kid, b in zip(kids, bound.tolist(), strict=True):
                    heapq.heappush(heap, (-b, kid))
            else:
                out.append(self.leaf[node])
        return out


def usable(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, v): the vectors that take part, in their own type."""
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector).alias("v")).where("id is not null and v is not null")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.where(fine)
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("v") == (sizes[0]["n"] if sizes else 0))


def _matrix(column) -> np.ndarray:
    """Arrow list column -> rows x dimensions."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _best(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> pd.DataFrame:
    """The k best rows for each query, ties to the smaller id.

    A matrix product picks; scores come from one sum for each pair that is picked, so equal pairs get
    equal scores wherever they are met.
    """
    out = []
    for lo in range(0, len(q_ids), 256):
        qi_, q_ = q_ids[lo : lo + 256], q[lo : lo + 256]
        s = q_ @ rows.T
        s[qi_[:, None] == ids[None, :]] = -np.inf
        n = s.shape[1]
        level = np.partition(s, n - k, axis=1)[:, n - k] if n > k else np.full(len(s), -np.inf)
        slack = 1e-9 * np.maximum(1, np.abs(np.where(np.isfinite(level), level, 0)))
        qi, ri = np.nonzero((s >= (level - slack)[:, None]) & np.isfinite(s))
        score = np.einsum("ij,ij->i", rows[ri], q_[qi])
        order = np.lexsort((ids[ri], -score, qi))
        qi, ri, score = qi[order], ri[order], score[order]
        first = np.searchsorted(qi, qi)
        keep = np.arange(len(qi)) - first < k
        out.append(pd.DataFrame({"query_id": qi_[qi[keep]], "vec_id": ids[ri[keep]], "score": score[keep]}))
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})


FOUND = "query_id long, vec_id long, score double"


def _merge(found: DataFrame, k: int) -> DataFrame:
    """Best k of each query; the limit on the rank is taken before the shuffle, too."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def exact(rows: DataFrame, queries: pd.DataFrame, k: int) -> DataFrame:
    """A bounded set of queries against all rows, in blocks."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((queries["id"].to_numpy(np.int64), np.array(queries["v"].tolist(), np.float64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = shared.value
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_pandas(_best(ids, q, b.column(0).to_numpy(), _matrix(b.column(1)), k), preserve_index=False)

    return _merge(rows.mapInArrow(run, FOUND), k)


def visit_table(queries: DataFrame, tree, visits: int) -> DataFrame:
    """(leaf, id, v): a row for each leaf that a query visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tree.value
        for b in batches:
            q = _matrix(b.column(1))
            for lo in range(0, len(q), 256):
                leaves = [t.visit(x, visits) for x in q[lo : lo + 256]]
                at = np.repeat(np.arange(lo, lo + len(leaves)), [len(x) for x in leaves])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(leaves).astype(np.int32)), *[c.take(pa.array(at)) for c in b.columns]], names=["leaf", "id", "v"])

    return queries.select("id", "v").mapInArrow(run, f"leaf int, id long, v {queries.schema['v'].dataType.simpleString()}")


def _search(index: DataFrame, sizes: DataFrame, queries: DataFrame, tree, visits: int, k: int) -> DataFrame:
    """Joins queries with the blocks of the leaves that they visit.

    A leaf that many queries visit has them in several parts, each of which meets
    all its blocks; others are read once.
    """
    wanted = materialize(visit_table(queries, tree, visits).withColumnsRenamed({"id": "query_id", "v": "q"}), "ann-wanted")
    parts = wanted.groupBy("leaf").agg(F.ceil(F.count("*") / at_most(PART_QUERIES, PART_BYTES, tree.value.centre.shape[1])).cast("int").alias("parts"))
    plan = materialize(sizes.join(parts, "leaf"), "ann-plan")
    # A query goes to every block of the leaf.
    blocks = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    asked = wanted.join(plan, "leaf").select("leaf", blocks, F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int").alias("part"), "query_id", "q")
    rows = index.join(plan.select("leaf", "parts"), "leaf").select("leaf", "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "id", "v")

    def run(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(rows):
            return pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})
        return _best(asked["query_id"].to_numpy(), np.array(asked["q"].tolist(), np.float64), rows["id"].to_numpy(), np.array(rows["v"].tolist(), np.float64), k)

    keys = ["leaf", "block", "part"]
    return _merge(asked.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(run, FOUND), k)


def calibrated(tree: Tree, trial: pd.DataFrame, truth: pd.DataFrame, target: float) -> int:
    """The fewest leaf visits with which the trial queries find ``target`` of their true neighbours.

    truth: (query_id, leaf) of each true neighbour.  A query's whole visiting order is known from the
    tree, so no search has to be run.
    """
    needed = []
    for i, v in zip(trial["id"], trial["v"], strict=True):
        place = np.empty(tree.leaves, np.int64)
        place[tree.visit(np.array(v, np.float64), tree.leaves)] = np.arange(1, tree.leaves + 1)
        needed.append(place[truth.loc[truth["query_id"] == i, "leaf"].to_numpy(np.int64)])
    needed = np.sort(np.concatenate(needed)) if needed else np.empty(0, np.int64)
    return int(needed[min(len(needed) - 1, math.ceil(target * len(needed)))]) if len(needed) else 1


def _grown(rows: DataFrame, fitted: Tree, spec: TreeSpec):
    """(broadcast tree, (leaf, id, v) of all rows, (leaf, n, blocks)); splits ``fitted`` where leaves are large."""
    spark, kind, whole = rows.sparkSession, rows.schema["v"].dataType.simpleString(), set()
    dimensions = fitted.centre.shape[1]
    in_block, room = at_most(BLOCK_ROWS, BLOCK_BYTES, dimensions), TREE_BYTES // (8 * dimensions)
    # A part of LEAF_SAMPLE rows has about that many nodes.
    nodes = 2 * LEAF_SAMPLE // spec.leaf
    while True:
        tree = spark.sparkContext.broadcast(fitted)

        def place(batches: Iterator[pa.RecordBatch], tree=tree) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(tree.value.assign(_matrix(b.column(1)))), *b.columns], names=["leaf", "id", "v"])

        placed = materialize(rows.mapInArrow(place, f"leaf int, id long, v {kind}"), "ann-placed")
        counts = placed.groupBy("leaf").agg(F.count("*").alias("n"))
        sizes = materialize(counts.withColumn("blocks", F.ceil(F.col("n") / in_block).cast("int")), "ann-sizes")
        node = {number: i for i, number in enumerate(fitted.leaf) if number >= 0}
        # Leaves of equal vectors cannot be split; they are not asked again.
        large = [r["leaf"] for r in sizes.where(F.col("n") > spec.leaf_rows).orderBy(F.desc("n"), "leaf").collect() if node[r["leaf"]] not in whole]
        large = large[: max(0, (room - len(fitted.leaf)) // nodes)]
        if not large:
            return tree, placed, sizes

        def fit(group: pd.DataFrame) -> pd.DataFrame:
            made = Tree(np.array(group["v"].tolist(), np.float64), spec)
            return pd.DataFrame({"leaf": group["leaf"].iloc[:1], "tree": [pickle.dumps(made)]})

        chosen = F.row_number().over(Window.partitionBy("leaf").orderBy(F.xxhash64("id"), "id"))
        # No longer than the tree has leaves.
        split = F.broadcast(spark.createDataFrame([(n,) for n in large], "leaf int"))
        sample = placed.join(split, "leaf").withColumn("k", chosen).where(F.col("k") <= LEAF_SAMPLE).select("leaf", "v")
        parts = {r["leaf"]: pickle.loads(r["tree"]) for r in sample.groupBy("leaf").applyInPandas(fit, "leaf int, tree binary").collect()}
        whole |= {node[k] for k, part in parts.items() if not part.children[0]}
        fitted.graft({k: part for k, part in sorted(parts.items()) if part.children[0]})
        discard(placed, sizes)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, id_column: str = "vec_id", vector: str = "embedding", spec: TreeSpec = TreeSpec()) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each query, by inner product."""
    spark = vectors.sparkSession
    rows = materialize(usable(vectors, id_column, vector), "ann-rows")
    asked = queries.select(F.col(id_column).cast("long").alias("id")).distinct().join(rows, "id").select("id", "v")
    some = rows.first()
    if some is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(at_most(SAMPLE, SAMPLE_BYTES, len(some["v"]))).toPandas()
    fitted = Tree(np.array(sample["v"].tolist(), np.float64), spec)
    tree, placed, sizes = _grown(rows, fitted, spec)
    index = placed.join(sizes, "leaf").select("leaf", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), "id", "v")
    trial = sample.drop_duplicates("id").head(CALIBRATION)
    truth = exact(rows, trial, k).join(placed.select(F.col("id").alias("vec_id"), "leaf"), "vec_id").select("query_id", "leaf").toPandas()
    visits = calibrated(tree.value, trial, truth, spec.target)
    return _search(index, sizes, asked, tree, visits, k)
