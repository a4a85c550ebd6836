"""Boosted trees with quantile loss, one ensemble for each level, grown together.

1. Features are binned at quantiles that one sketch aggregate finds for all of them; rows become a narrow table
   of cells, and it is written once.  A cell is up to ``PIECE`` rows of a task with equal bins and start values: one
   byte a feature and the start value of each level, once, and the bytes of all targets.  All rows are in it.
2. A round adds one tree to each level.  The gradient of the pinball loss is level - [target < prediction].  Each
   depth is one aggregate: tasks sum gradients and counts by (level, node, feature, bin) in arrays of bounded
   size, which are then added up; the driver sees levels x nodes x features x bins numbers and chooses splits.
3. A leaf's value is the quantile of its residuals at its level (a sketch, all leaves in one aggregate), times
   the rate.  Of a leaf with w * ``KEPT`` rows, a task sorts the residuals by the chunk of ``CHUNK`` rows and hands the middle one of
   each w to the sketch: a chunk moves a rank by w / 2 at most, and the sketch takes no longer as the table grows.

The newest part of the rows grows no trees; a level keeps the rounds up to its least loss there, so one that
features do not help keeps its start values.  The start value is the segment's own quantile, so segments need no one-hot features.  A pass evaluates the trees
that there are so far on the cells' bytes, not on each row: no table of predictions is kept.

Cases: null features are 0, features that a table lacks too; rows without target do not train; a segment that
was not met starts from the quantiles of all rows; a table without rows gives a model that predicts 0; without newer rows all rounds go.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfloom.plans.kit import scratch

BINS, ACCURACY = 32, 10_000
#: Rows that a task takes together, rows of a cell, and up to how many rows of a leaf all go to the sketch.
CHUNK, PIECE, KEPT = 1 << 19, 256, 1 << 17


def same(columns: list[np.ndarray]) -> np.ndarray:
    """A number for each row, equal for rows that are equal in all columns."""
    code, n = np.zeros(len(columns[0]), np.int64), 1
    for x in columns:
        if (x == x[:1]).all():
            continue
        at, size = (x, int(x.max()) + 1) if x.dtype == np.uint8 else _ranked(x)
        if n * size > 1 << 62:
            code, n = _ranked(code)
        code, n = code * size + at, n * size
    return code


def _ranked(x: np.ndarray) -> tuple[np.ndarray, int]:
    values, at = np.unique(x, return_inverse=True)
    return at, len(values)


@dataclass
class Trees:
    """What rows are scored with: bounded by rounds, depth, levels, features and bins, not by data."""

    levels: tuple[float, ...]
    edges: list[np.ndarray]  # of each feature, ascending
    depth: int
    #: Of each round: (levels, inner nodes) features and last bins that go left, (levels, leaves) values.
    rounds: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def bins(self, columns: list[np.ndarray]) -> np.ndarray:
        """(rows, features) bytes: how many edges lie below each value."""
        return np.stack([np.searchsorted(e, np.nan_to_num(x), "left") for e, x in zip(self.edges, columns, strict=True)], axis=1).astype(np.uint8)

    def node(self, feature: np.ndarray, last: np.ndarray, bins: np.ndarray, depth: int) -> np.ndarray:
        """The node of each row at ``depth`` of one tree, numbered as in a heap."""
        at, flat, row = np.zeros(len(bins), np.int64), bins.reshape(-1), np.arange(len(bins)) * bins.shape[1]
        for _ in range(depth):
            at = 2 * at + 1 + (flat[row + feature[at]] > last[at])
        return at

    def steps(self, bins: np.ndarray, start: np.ndarray) -> Iterator[np.ndarray]:
        """(rows, levels): the start values, then with each round's trees added, in one array."""
        out = start.copy()
        inner = (1 << self.depth) - 1
        yield out
        for feature, last, values in self.rounds:
            for k in range(len(self.levels)):
                if values[k].any():
                    out[:, k] += values[k][self.node(feature[k], last[k], bins, self.depth) - inner]
            yield out

    def add(self, bins: np.ndarray, start: np.ndarray) -> np.ndarray:
        """(rows, levels): start values and what all trees add."""
        for out in self.steps(bins, start):
            pass
        return out


def _grown(table: DataFrame, trees: Trees, feature: np.ndarray, last: np.ndarray, depth: int, n_bins: int) -> tuple[np.ndarray, np.ndarray]:
    """(gradient sums, counts) by (level, node of this depth, feature, bin)."""
    n_levels, n_features, first = len(trees.levels), len(trees.edges), (1 << depth) - 1
    shape = (n_levels, 1 << depth, n_features, n_bins)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, n = np.zeros(shape).reshape(n_levels, -1), np.zeros(shape, np.int64).reshape(n_levels, -1)
        for rows, begin, y, bins, start in _cells(batches, n_features, n_levels):
            now = trees.add(bins, start)
            for k, level in enumerate(trees.levels):
                at = trees.node(feature[k], last[k], bins, depth) - first
                slope = level * rows - np.add.reduceat(y < np.repeat(now[:, k], rows), begin, dtype=np.int64)
                for j in range(n_features):
                    slot = (at * n_features + j) * n_bins + bins[:, j]
                    n[k] += np.bincount(slot, rows, n.shape[1]).astype(np.int64)
                    g[k] += np.bincount(slot, slope, n.shape[1])
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(g.reshape(-1)[used]), pa.array(n.reshape(-1)[used])], names=["slot", "g", "n"])

    sums = table.mapInArrow(run, "slot long, g double, n long").groupBy("slot").agg(F.sum("g").alias("g"), F.sum("n").alias("n")).toPandas()
    g, n = np.zeros(shape).reshape(-1), np.zeros(shape, np.int64).reshape(-1)
    g[sums["slot"]], n[sums["slot"]] = sums["g"], sums["n"]
    return g.reshape(shape), n.reshape(shape)


def _cells(batches: Iterator[pa.RecordBatch], n_features: int, n_levels: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Of the cells of each batch: how many rows, where they begin among the targets, the targets, bins, start values."""
    for b in batches:
        if b.num_rows:
            rows, bins, start = _arrays(b, n_features, n_levels)
            end = np.cumsum(rows)
            bytes_ = b.column(3)
            at = np.frombuffer(bytes_.buffers()[1], np.int32, 1, 4 * bytes_.offset)[0]
            yield rows, end - rows, np.frombuffer(bytes_.buffers()[2], np.float64, end[-1], at), bins, start


def _table(b: pa.RecordBatch) -> np.ndarray:
    """The rows of a batch of one column, lists of as many doubles: one list travels in half the time of several columns."""
    return b.column(0).flatten().to_numpy().reshape(b.num_rows, -1)


def _packed(newer: np.ndarray, segment: np.ndarray, y: np.ndarray, bins: np.ndarray) -> pa.RecordBatch:
    """Rows as cells; in each there are at most ``PIECE`` of one part and segment, with equal bins."""
    code = same([newer, segment, *bins.T])
    order = np.argsort(code)
    code, end = code[order], len(order)
    begin = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    place = np.arange(end) - np.repeat(begin, np.diff(np.r_[begin, end]))
    begin = np.flatnonzero(place % PIECE == 0)
    one, ends = order[begin], np.r_[begin, end]
    binary = lambda at, x: pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(x)])
    columns = [pa.array(np.diff(ends)), binary(np.arange(len(ends)) * bins.shape[1], bins[one]), pa.array(segment[one].astype(np.int64)), binary(8 * ends, y[order]), pa.array(newer[one] > 0)]
    return pa.RecordBatch.from_arrays(columns, names=["n", "bins", "__number", "y", "__newer"])


def _arrays(b: pa.RecordBatch, n_features: int, n_levels: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    y = b.column(0).to_numpy(zero_copy_only=False)
    # All values are as long as there are features: the column's own bytes serve, without an object a row.
    fixed = b.column(1).cast(pa.binary(n_features))
    bins = np.frombuffer(fixed.buffers()[1], np.uint8, len(fixed) * n_features, fixed.offset * n_features) if len(fixed) else np.empty(0, np.uint8)
    return y, bins.reshape(-1, n_features), b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, n_levels)


def best_split(g: np.ndarray, n: np.ndarray, least: int) -> tuple[int, int]:
    """(feature, last bin to the left) of the largest gain; a split that sends all rows left if none is allowed.

    g, n: (feature, bin) sums of one node.
    """
    gl, nl = g.cumsum(1)[:, :-1], n.cumsum(1)[:, :-1]
    gt, nt = g.sum(1, keepdims=True), n.sum(1, keepdims=True)
    nr = nt - nl
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = gl**2 / nl + (gt - gl) ** 2 / nr - gt**2 / nt
    gain = np.where((nl >= least) & (nr >= least), gain, 0.0)
    if not gain.size or gain.max() <= 1e-12:
        return 0, n.shape[1]
    at = int(gain.argmax())
    return at // gain.shape[1], at % gain.shape[1]


def _sizes(n: np.ndarray, feature: np.ndarray, last: np.ndarray) -> np.ndarray:
    """(levels, leaves): rows of each leaf, from the counts by (level, node above the leaves, feature, bin)."""
    n_levels, nodes = n.shape[:2]
    out = np.zeros((n_levels, 2 * nodes), np.int64)
    for k in range(n_levels):
        for i in range(nodes):
            f, at = feature[k, nodes - 1 + i], last[k, nodes - 1 + i]
            out[k, 2 * i], out[k, 2 * i + 1] = n[k, i, f, : at + 1].sum(), n[k, i, f, at + 1 :].sum()
    return out


def _thinned(e: np.ndarray, every: int) -> np.ndarray:
    """The middle one of each ``every`` in order; all for 1."""
    return e if every == 1 else np.sort(e)[every // 2 :: every]


def _leaves(table: DataFrame, trees: Trees, feature: np.ndarray, last: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(levels, leaves): the quantile of the residuals in each leaf, 0 in empty ones."""
    n_levels, n_features, first = len(trees.levels), len(trees.edges), (1 << trees.depth) - 1
    every = np.maximum(sizes // KEPT, 1)

    def residuals(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        rows, _, y, bins, start = (np.concatenate(x) for x in zip(*held, strict=True))
        now = trees.add(bins, start)
        for k in range(n_levels):
            at = np.repeat(trees.node(feature[k], last[k], bins, trees.depth) - first, rows)
            e = y - np.repeat(now[:, k], rows)
            parts = {leaf: _thinned(e[at == leaf], every[k, leaf]) for leaf in np.flatnonzero(sizes[k])}
            leaf = np.repeat([(k << trees.depth) + i for i in parts], [len(x) for x in parts.values()])
            yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int64()), pa.array(np.concatenate([np.zeros(0), *parts.values()]))], names=["leaf", "e"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for c in _cells(batches, n_features, n_levels):
            held.append(c)
            n += len(c[2])
            if n >= CHUNK:
                yield from residuals(held)
                held, n = [], 0
        if held:
            yield from residuals(held)

    levels = F.array(*map(F.lit, trees.levels))
    found = table.mapInArrow(run, "leaf long, e double").groupBy("leaf").agg(F.percentile_approx("e", levels, ACCURACY).alias("q")).collect()
    out = np.zeros((n_levels, 1 << trees.depth))
    for r in found:
        k, leaf = divmod(r["leaf"], 1 << trees.depth)
        out[k, leaf] = r["q"][k]
    return out


def _losses(table: DataFrame, trees: Trees) -> np.ndarray:
    """(rounds + 1, levels): sums of the pinball loss after each round, in one pass."""
    n_levels, n_features = len(trees.levels), len(trees.edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((len(trees.rounds) + 1, n_levels))
        for rows, _, y, bins, start in _cells(batches, n_features, n_levels):
            for i, now in enumerate(trees.steps(bins, start)):
                for k, level in enumerate(trees.levels):
                    e = y - np.repeat(now[:, k], rows)
                    out[i, k] += np.maximum(level * e, (level - 1) * e).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(out.size)), pa.array(out.reshape(-1))], names=["slot", "loss"])

    found = table.mapInArrow(run, "slot long, loss double").groupBy("slot").agg(F.sum("loss").alias("loss")).toPandas().sort_values("slot")
    return found["loss"].to_numpy().reshape(-1, n_levels) if len(found) else np.zeros((1, n_levels))


def _filled(df: DataFrame, features: list[str]) -> list[Column]:
    return [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) if c in df.columns else F.lit(0.0).alias(c) for c in features]


def fit(train: DataFrame, target: str, features: list[str], segment: str, levels: tuple[float, ...], rounds: int, depth: int, rate: float, least: int, newer: Column) -> tuple[Trees, DataFrame, list[float]]:
    """The trees, the start values (segment, __start) and those of all rows.

    Rows where ``newer`` holds do not grow trees: they say after how many rounds each level has its least loss.
    """
    levels = tuple(sorted(levels))
    at = F.array(*map(F.lit, levels))
    rows = train.where(F.col(target).isNotNull()).select(newer.alias("__newer"), F.col(segment).alias("__segment"), F.col(target).cast("double").alias("__y"), *_filled(train, features))
    cuts = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
    old = rows.where("not __newer")
    # One pass for all edges and the overall quantiles.
    one = old.agg(F.percentile_approx("__y", at, ACCURACY).alias("__q"), *[F.percentile_approx(c, cuts, ACCURACY).alias(c) for c in features]).first()
    overall = list(one["__q"] or [0.0] * len(levels))
    trees = Trees(levels, [np.unique(np.array(one[c] or [], float)) for c in features], depth)
    starts = old.groupBy("__segment").agg(F.percentile_approx("__y", at, ACCURACY).alias("__start"))
    spark = train.sparkSession
    place = scratch(spark, "quantile-starts")
    starts = starts.withColumn("__number", F.monotonically_increasing_id())
    starts.write.parquet(place)
    starts = spark.read.schema(starts.schema).parquet(place)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cells() -> pa.RecordBatch:
            return _packed(*(np.concatenate(c) for c in zip(*held, strict=True)))

        held, n = [], 0
        for b in batches:
            if b.num_rows:
                x = _table(b)
                held.append((x[:, 0], x[:, 1], x[:, 2], trees.bins(list(x[:, 3:].T))))
                n += len(x)
            if n >= CHUNK:
                yield cells()
                held, n = [], 0
        if held:
            yield cells()

    number = F.coalesce("__number", F.lit(-1))
    x = F.array(F.col("__newer").cast("double"), number.cast("double"), "__y", *features)
    cells = rows.join(starts, "__segment", "left").select(x.alias("x")).mapInArrow(pack, "n long, bins binary, __number long, y binary, __newer boolean")
    start = F.coalesce("__start", F.array(*map(F.lit, overall)))
    place = scratch(spark, "quantile-rows")
    cells.join(starts, "__number", "left").select("n", "bins", start.alias("start"), "y", "__newer").write.partitionBy("__newer").parquet(place)
    kind = "n long, bins binary, start array<double>, y binary, __newer boolean"
    both = spark.read.schema(kind).parquet(place)
    table, held = (both.where(c).drop("__newer") for c in ("not __newer", "__newer"))
    for _ in range(rounds):
        feature, last = np.zeros((len(levels), (1 << depth) - 1), np.int64), np.full((len(levels), (1 << depth) - 1), BINS)
        for d in range(depth):
            g, n = _grown(table, trees, feature, last, d, BINS)
            for k in range(len(levels)):
                for i in range(1 << d):
                    feature[k, (1 << d) - 1 + i], last[k, (1 << d) - 1 + i] = best_split(g[k, i], n[k, i], least)
        trees.rounds.append((feature, last, rate * _leaves(table, trees, feature, last, _sizes(n, feature, last))))
    best = _losses(held, trees).argmin(0)
    for i, (_, _, values) in enumerate(trees.rounds):
        values[i >= best] = 0.0
    return trees, starts.drop("__number"), overall


class QuantileForecaster:
    """M3, M5: quantiles of rows by trees of their own, in order and not negative."""

    def __init__(self, trees: Trees, starts: DataFrame, overall: list[float], features: list[str], segment: str):
        self.trees, self.starts, self.overall, self.features, self.segment = trees, starts, overall, features, segment
        self.levels = trees.levels

    def _scored(self, df: DataFrame) -> tuple[DataFrame, Column, Column]:
        """``df`` with its start values, the column of them, and the features as a struct."""
        starts = self.starts.withColumnRenamed("__segment", self.segment)
        start = F.coalesce("__start", F.array(*map(F.lit, self.overall)))
        return df.join(starts, self.segment, "left"), start, F.struct(*_filled(df, self.features))

    def predict(self, df: DataFrame) -> DataFrame:
        """Quantiles of each row, the interval between the outer ones and its centre."""
        from shelfloom.operators.ml import name

        trees = self.trees

        @F.pandas_udf("array<double>")
        def score(start: pd.Series, x: pd.DataFrame) -> pd.Series:
            if not len(start):
                return pd.Series([], dtype=object)
            found = trees.add(trees.bins([x[c].to_numpy() for c in x.columns]), np.stack(start.to_numpy()))
            return pd.Series(list(np.sort(np.maximum(found, 0.0), axis=1)))

        rows, start, x = self._scored(df)
        rows = rows.withColumn("__q", score(start, x))
        rows = rows.withColumns({name(q): F.col("__q")[i] for i, q in enumerate(self.levels)})
        low, high = F.col(name(self.levels[0])), F.col(name(self.levels[-1]))
        return rows.withColumns({"prediction_interval": high - low, "prediction_center": (high + low) / 2}).drop("__q", "__start")

    def exchanged(self, df: DataFrame, target: str, bucket: Column, order: Column, level: float = 0.5) -> DataFrame:
        """Parts of the sums (n, e array<double>) over rows with a target: how many, their absolute errors at ``level``,
        then those with each feature exchanged.

        A row takes the feature of the next one of its bucket in ``order``, a hash, the last one that of the first.  A task holds ``CHUNK``
        rows and a bucket at most; a bucket of more rows is one of several circles.
        """
        trees, k, n_levels = self.trees, self.levels.index(level), len(self.levels)

        def errors(x: np.ndarray, bins: np.ndarray) -> pa.RecordBatch:
            at = np.lexsort((x[:, 1], x[:, 0]))
            x, bins = x[at], bins[at]
            bucket, known, y, start = x[:, 0], x[:, 2] > 0, x[:, 3], x[:, 4 : 4 + n_levels]
            begin = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            other = np.arange(1, len(at) + 1)
            other[np.r_[begin[1:], len(at)] - 1] = begin
            segment = same(list(start.T))

            def error(bins: np.ndarray) -> float:
                # Rows of equal bins and start values have one forecast.
                _, one, at = np.unique(same([segment, *bins.T]), return_index=True, return_inverse=True)
                p = np.sort(np.maximum(trees.add(bins[one], start[one]), 0.0), axis=1)[:, k]
                return float(np.abs(y - p[at])[known].sum())

            out = [error(bins)]
            for j in range(bins.shape[1]):
                mixed = bins.copy()
                mixed[:, j] = bins[other, j]
                out.append(out[0] if (mixed == bins).all() else error(mixed))
            return pa.RecordBatch.from_arrays([pa.array([int(known.sum())]), pa.array([out], pa.list_(pa.float64()))], names=["n", "e"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, n = [], 0
            for b in batches:
                if b.num_rows:
                    x = _table(b)
                    held.append((x[:, : 4 + n_levels], trees.bins(list(x[:, 4 + n_levels :].T))))
                    n += len(x)
                if n >= CHUNK:
                    x, bins = (np.concatenate(c) for c in zip(*held, strict=True))
                    # Rows come by buckets; the last one may go on.
                    end = int(np.searchsorted(x[:, 0], x[-1, 0])) or n
                    yield errors(x[:end], bins[:end])
                    held, n = [(x[end:], bins[end:])], n - end
            if n:
                yield errors(*(np.concatenate(c) for c in zip(*held, strict=True)))

        rows, start, _ = self._scored(df)
        y = F.col(target).cast("double")
        # The first 53 bits of a hash are a double without loss.
        x = F.array(bucket.cast("double"), F.shiftright(order, 11).cast("double"), y.isNotNull().cast("double"), F.coalesce(y, F.lit(0.0)), *[start[i] for i in range(n_levels)], *_filled(df, self.features))
        return rows.select(bucket.alias("__bucket"), x.alias("x")).repartition("__bucket").sortWithinPartitions("__bucket").select("x").mapInArrow(run, "n long, e array<double>")
