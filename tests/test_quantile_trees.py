"""Quantile trees: splits and histograms by brute force, loss and coverage on rows not seen, odd tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfloom.operators import ml
from shelfloom.operators.metrics import quantile_metrics
from shelfloom.operators.quantile_trees import Trees, best_split
from shelfloom.spec import SeriesSpec

SPEC = SeriesSpec(keys=("k",), time="t", target="y", lags=(1,), windows=(2,))


def test_best_split_equals_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(30):
        g, n = rng.normal(size=(3, 8)), rng.integers(0, 6, (3, 8))
        n[:, -1] += n.sum(1).max() - n.sum(1)  # every feature sees the same rows
        g[:, -1] += g.sum(1).max() - g.sum(1)
        best, at = 1e-12, None
        for j in range(3):
            for b in range(7):
                gl, nl, gt, nt = g[j, : b + 1].sum(), n[j, : b + 1].sum(), g[j].sum(), n[j].sum()
                if min(nl, nt - nl) >= 3:
                    gain = gl**2 / nl + (gt - gl) ** 2 / (nt - nl) - gt**2 / nt
                    if gain > best + 1e-12:
                        best, at = gain, (j, b)
        assert best_split(g, n, 3) == (at or (0, 8))


def test_trees_add_what_their_leaves_say():
    trees = Trees((0.5,), [np.array([1.0, 2.0]), np.array([5.0])], 2)
    trees.rounds.append((np.array([[0, 1, 0]]), np.array([[0, 0, 1]]), np.array([[1.0, 2.0, 4.0, 8.0]])))
    bins = trees.bins([np.array([0.0, 1.0, 1.5, 9.0, np.nan]), np.array([9.0, 5.0, 0.0, 0.0, np.nan])])
    assert bins.tolist() == [[0, 1], [0, 0], [1, 0], [2, 0], [0, 0]]
    # left: by feature 1; right: by feature 0 again
    assert trees.add(bins, np.zeros((5, 1)))[:, 0].tolist() == [2.0, 1.0, 4.0, 8.0, 1.0]


@pytest.fixture(scope="module")
def wide(spark):
    """A target whose spread, not only its centre, depends on a feature: shifted residuals can't follow it."""
    u = lambda seed: (F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(10_000)) + 0.5) / 10_000
    rows = spark.range(24_000).select("id", F.pmod("id", F.lit(5)).alias("k"), (F.col("id") / 24).cast("int").alias("t"), u(1).alias("x"), u(2).alias("noise"), u(3).alias("u"))
    return rows.withColumn("y", F.when(F.col("x") < 0.5, 10 + F.col("u")).otherwise(20 + 60 * F.col("u") * F.col("x"))).cache()


def test_loss_and_coverage_beat_shifted_residuals(spark, wide):
    from shelfloom.operators.clean import time_split

    train, test = time_split(wide, "t", 0.8)
    columns = {q: ml.name(q) for q in ml.QUANTILES}
    names = ["x", "noise", "absent"]
    model = ml.quantile_train(train, SPEC, names, "k")
    ours, theirs = model.predict(test), ml.centred_train(train.withColumn("absent", F.lit(0.0)), SPEC, names, "k").predict(test)
    a, b = ({r.model: r for r in quantile_metrics(p, "y", columns).collect()} for p in (ours, theirs))
    # About the middle the target is symmetric: there a fine centre is as good or better (5 % here).
    assert all(a[m].pinball < b[m].pinball * (1.06 if m == "forecast_q50" else 0.95) for m in a), [(m, a[m].pinball, b[m].pinball) for m in a]
    assert abs(next(iter(a.values())).coverage - 0.9) < 0.02
    for q, c in columns.items():
        assert abs(ours.agg(F.avg((F.col("y") <= F.col(c)).cast("double"))).first()[0] - q) < 0.03
    rise = {r.feature: r.rise for r in ml.permutation_importance(model, test, [*names, "other"], "y", ["id"]).collect()}
    assert rise["absent"] == rise["other"] == 0.0 and rise["x"] > 50 * abs(rise["noise"])


def test_feature_of_no_use_leaves_the_segment_quantiles(spark, wide):
    model = ml.quantile_train(wide.withColumn("same", F.lit(3.0)), SPEC, ["same"], "k", max_iter=2)
    got = model.predict(wide.withColumn("same", F.lit(None).cast("double"))).groupBy("k").agg(F.count_distinct("forecast_q50").alias("n"))
    assert {r.n for r in got.collect()} == {1}


def test_odd_tables(spark):
    kind = "k string, t int, y double, x double, forecast_q50 string, bins int"
    none = spark.createDataFrame([], kind)
    model = ml.quantile_train(none, SPEC, ["x"], "k", max_iter=1, depth=1)
    rows = spark.createDataFrame([("a", 1, None, None, "clash", 0), ("a", 1, 4.0, 1.0, "clash", 0), (None, 2, 6.0, 2.0, "clash", 0), ("a", 1, 4.0, 1.0, "clash", 0)], kind)
    assert {r.forecast_q95 for r in model.predict(rows).collect()} == {0.0}
    assert model.predict(none).collect() == []
    got = ml.quantile_train(rows, SPEC, ["x"], "k", max_iter=2, depth=2, least=1).predict(rows.withColumn("k", F.coalesce("k", F.lit("new")))).collect()
    assert len(got) == 4 and all(0 <= r.forecast_q05 <= r.forecast_q95 for r in got)
    assert [r.rise for r in ml.permutation_importance(model, none, ["x"], "y", ["k"]).collect()] == [None]


def test_batches_are_read_without_an_object_for_each_row():
    import pyarrow as pa

    from shelfloom.operators import quantile_trees

    rng = np.random.default_rng(3)
    rows = rng.integers(0, 32, (50, 3)).astype(np.uint8)

    class Column:
        """Stands for the bytes; turns to Python objects only on pain of failure."""

        def __init__(self, column):
            self.column = column

        def __getattr__(self, name):
            assert name != "to_pylist", "one object for each row"
            return getattr(self.column, name)

        def __len__(self):
            return len(self.column)

    class Batch:
        def __init__(self, batch):
            self.batch = batch

        def column(self, i):
            return Column(self.batch.column(i)) if i == 1 else self.batch.column(i)

    whole = pa.RecordBatch.from_arrays([pa.array(np.arange(50.0)), pa.array([r.tobytes() for r in rows], pa.binary()), pa.array([[1.0, 2.0]] * 50)], names=["y", "bins", "start"])
    for lo, n in ((0, 50), (7, 20), (3, 0)):
        y, bins, start = quantile_trees._arrays(Batch(whole.slice(lo, n)), 3, 2)
        assert (y == np.arange(50.0)[lo : lo + n]).all() and (bins == rows[lo : lo + n]).all() and start.shape == (n, 2)


def test_passes_read_cells_not_rows(spark, wide, monkeypatch):
    from shelfloom.operators import quantile_trees

    seen, grown = [], quantile_trees._grown
    monkeypatch.setattr(quantile_trees, "_grown", lambda table, *a: (seen.append((table.count(), table.agg(F.sum("n")).first()[0])), grown(table, *a))[1])
    ml.quantile_train(wide.withColumn("few", F.col("id") % 3).coalesce(1), SPEC, ["few"], "k", max_iter=1, depth=1)
    # 5 segments, 3 values; all of the older rows are in cells
    assert seen == [(seen[0][0], wide.where("t < 750").count())] and seen[0][0] <= 15 * (18_000 // 15 // quantile_trees.PIECE + 1)


def test_cells_hold_each_row_once():
    from shelfloom.operators import quantile_trees

    rng = np.random.default_rng(5)
    newer, segment, y, bins = rng.integers(0, 2, 3000) * 1.0, rng.integers(-1, 3, 3000) * 1.0, rng.normal(size=3000), rng.integers(0, 2, (3000, 2)).astype(np.uint8)
    packed = quantile_trees._packed(newer, segment, y, bins)
    assert max(packed["n"].to_pylist()) <= quantile_trees.PIECE and packed.num_rows < 60
    got = [(r["__newer"], r["__number"], *r["bins"], x) for r in packed.to_pylist() for x in np.frombuffer(r["y"])]
    assert sorted(got) == sorted(zip(newer > 0, segment, *bins.T, y, strict=True))


def test_thinned_leaves_keep_their_quantiles(spark, wide, monkeypatch):
    from shelfloom.operators import quantile_trees

    whole = ml.quantile_train(wide, SPEC, ["x", "noise"], "k", max_iter=1, depth=1).trees.rounds[0]
    monkeypatch.setattr(quantile_trees, "KEPT", 500)
    monkeypatch.setattr(quantile_trees, "CHUNK", 4000)
    thinned = ml.quantile_train(wide, SPEC, ["x", "noise"], "k", max_iter=1, depth=1).trees.rounds[0]
    assert (whole[0] == thinned[0]).all() and (whole[1] == thinned[1]).all()
    # a leaf's rows spread over up to 60
    assert abs(whole[2] - thinned[2]).max() < 0.3 and (whole[2] != thinned[2]).any()


def test_importance_by_exchange_equals_a_window(spark, wide, monkeypatch):
    from pyspark.sql import Window

    from shelfloom.operators import quantile_trees

    rows = wide.withColumn("y", F.when(F.col("id") % 7 > 0, F.col("y")))
    model = ml.quantile_train(rows, SPEC, ["x", "noise"], "k", max_iter=3)
    monkeypatch.setattr(ml, "BUCKET_ROWS", 1000)
    monkeypatch.setattr(quantile_trees, "CHUNK", 3000)
    got = {r.feature: r.rise for r in ml.permutation_importance(model, rows, ["x", "noise"], "y", ["id"]).collect()}
    slot = Window.partitionBy(F.pmod(F.xxhash64("id"), F.lit(24))).orderBy(F.xxhash64("id", F.lit(1)))
    error = lambda t: model.predict(t).agg(F.avg(F.abs(F.col("y") - F.col("forecast_q50")))).first()[0]
    for c in ("x", "noise"):
        other = F.coalesce(F.lead(c).over(slot), F.first(c).over(slot))
        assert got[c] == pytest.approx(error(rows.withColumn(c, other)) - error(rows), abs=1e-9)


def test_importances_are_those_of_all_rows_from_few_cells(spark, wide, monkeypatch):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    rows = wide.select("y", F.floor(F.col("x") * 10).alias("tenth"), (F.floor(F.col("noise") * 4)).alias("quarter"), F.when(F.col("u") > 0.99, F.col("u")).otherwise(0.0).alias("rare"), F.lit(1).alias("same"))
    names, sizes, fit = ["tenth", "quarter", "rare"], [], GBTRegressor.fit
    plain = fit(GBTRegressor(labelCol="y", maxIter=10, maxDepth=4, seed=7), VectorAssembler(inputCols=names[:2], outputCol="features").transform(rows)).featureImportances.toArray()
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, df: (sizes.append(df.count()), fit(self, df))[1])
    got = {r.feature: r.importance for r in ml.select_by_importance(rows, [*names[:2], "same"], "y", 0.0).collect()}
    assert sizes == [40] and got == pytest.approx(dict(zip(names, plain / plain.max())), abs=1e-6)
    # A value that most rows have is apart from the few others.
    assert "rare" in {r.feature for r in ml.select_by_importance(rows, names, "y").collect()}
    assert ml.select_by_importance(rows, ["same"], "y").collect() == []
