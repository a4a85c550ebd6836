"""Merged profiles against one-pass ones and against the rows; quantiles of many columns at once."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfloom.functions.quantile import exact_quantiles_of
from shelfloom.operators import ml, profiles, quality
from shelfloom.spec import SeriesSpec

SCHEMA = "day string, v double, w double, c string"


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = [(f"d{rng.randrange(9)}", rng.choice([None, rng.gauss(1e6, 3), float("nan")]) if i % 4 == 0 else rng.gauss(1e6, 3), None, rng.choice(["a", "a", "b", "c", None])) for i in range(6000)]
    return spark.createDataFrame([*data, ("empty day", None, None, None)], SCHEMA).cache()


def described(p, by=()):
    return {(r.column, r.metric): r.value for r in profiles.describe(p, by).collect()}


def test_merged_profiles_equal_those_of_the_whole(spark, rows):
    parts = profiles.profile(rows, ["v", "w"], ["c"], ["day"])
    whole, merged = described(profiles.profile(rows, ["v", "w"], ["c"])), described(profiles.merge(parts))
    twice = described(profiles.merge(profiles.merge(parts.withColumn("half", F.col("day") < "d4"), ["half"])))
    v = np.array([r.v for r in rows.collect() if r.v is not None and r.v == r.v])
    for got in (whole, merged, twice):
        assert got["v", "mean"] == pytest.approx(v.mean(), abs=1e-6) and got["v", "std"] == pytest.approx(v.std(ddof=1), abs=1e-9)
        assert (got["v", "min"], got["v", "max"]) == (v.min(), v.max())
        assert got["v", "null_pct"] == pytest.approx(100 * (1 - len(v) / rows.count()))
        assert got["v", "distinct"] == pytest.approx(len(v), rel=0.03) and got["c", "distinct"] == 3 and got["w", "null_pct"] == 100
        for q in (25, 50, 75):
            assert abs((v <= got["v", f"q{q}"]).mean() - q / 100) < 0.0133
        assert ("w", "mean") not in got and ("c", "mean") not in got


def test_levels_merge_and_drift_reads_profiles_only(spark, rows):
    counts = {(r.column, r.level): r.n for r in profiles.merge_levels(profiles.levels(rows, ["c", "day"], ["day"])).collect()}
    want = {("c", r.c): r["count"] for r in rows.groupBy("c").count().collect() if r.c} | {("day", r.day): r["count"] for r in rows.groupBy("day").count().collect()}
    assert counts == want
    p = profiles.profile(rows, ["v", "w"], [], ["day"])
    base = profiles.describe(profiles.merge(p.where("day < 'd5'")))
    moved = profiles.describe(profiles.profile(rows.withColumn("v", F.col("v") + 10), ["v", "w"]))
    assert {r.column: r.drifted for r in quality.detect_drift(base, moved).collect()} == {"v": True, "w": False}
    assert {r.drifted for r in quality.detect_drift(base, profiles.describe(profiles.merge(p.where("day >= 'd5'")))).collect()} == {False}


def test_profile_of_an_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert profiles.profile(none, ["v"], ["c"]).collect() == [] and profiles.merge(profiles.profile(none, ["v"], ["c"], ["day"])).collect() == []


@pytest.mark.parametrize("small", [1, 50, 10**6])
def test_quantiles_of_many_columns_equal_numpy(spark, small):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=3000), np.round(rng.exponential(size=3000) * 3)
    data = [(float(x), None if i % 3 else float(y), 7.0, None) for i, (x, y) in enumerate(zip(a, b, strict=True))]
    df = spark.createDataFrame(data, "a double, b double, same double, none double").repartition(5)
    levels = [0.0, 0.05, 0.5, 0.95, 1.0]
    got = exact_quantiles_of(df, ["a", "b", "same", "none"], levels, small)
    assert got["a"] == pytest.approx(list(np.quantile(a, levels)), abs=1e-12) and got["b"] == pytest.approx(list(np.quantile(b[::3], levels)), abs=1e-12)
    assert got["same"] == [7.0] * 5 and got["none"] == [None] * 5
    assert exact_quantiles_of(df, [], levels) == {} and exact_quantiles_of(df.limit(0), ["a"], [0.5]) == {"a": [None]}


def test_walk_forward_equals_brute_force(spark):
    rng = random.Random(6)
    data = [(k, t, None if rng.random() < 0.05 else rng.random() * 10) for k in "abc" for t in range(30) if rng.random() < 0.8 for _ in range(rng.choice([1, 1, 2]))]
    df = spark.createDataFrame(data, "k string, t int, y double")
    got = ml.walk_forward(df, SeriesSpec(keys=("k",), time="t", target="y", lags=(1,), windows=(2,)), folds=10, train=4).first()
    last, maes, cover = max(t for _, t, _ in data), [], []
    for fold in range(last - 9, last + 1):
        e, inside = [], []
        for k, t, y in data:
            past = [v for kk, tt, v in data if kk == k and fold - 4 <= tt < fold and v is not None]
            if t == fold and past and y is not None:
                q = np.quantile(past, [0.05, 0.5, 0.95])
                e.append(abs(y - q[1]))
                inside.append(q[0] <= y <= q[2])
        if e:
            maes.append(np.mean(e))
            cover.append(np.mean(inside))
    assert got.folds == len(maes) and got.mae_mean == pytest.approx(np.mean(maes)) and got.mae_std == pytest.approx(np.std(maes, ddof=1))
    assert got.coverage_mean == pytest.approx(np.mean(cover))


def test_measures_of_lists_equal_those_of_windows(spark):
    from shelfloom.operators import advanced

    rng = random.Random(8)
    data = [(k, t, 4.5 if k == "flat" else float(rng.choice([0, 0, rng.random() * 9])), "x") for k, n in (("a", 60), ("b", 25), ("c", 12), ("flat", 30), ("short", 7), ("one", 1)) for t in range(n)]
    df = spark.createDataFrame(data, "k string, t int, y double, entropyless string").repartition(3)
    spec = SeriesSpec(keys=("k",), time="t", target="y", lags=(1,), windows=(2,))
    got = advanced.advanced_series(df, spec)
    assert got.columns == [*df.columns, "acf_1", "acf_4", "acf_12", "entropy", "hurst", "nonlinearity"]
    assert got.select(df.columns).exceptAll(df).count() == 0 and got.count() == df.count()
    plain = {}
    for part in (advanced.autocorrelation(df, spec), advanced.entropy(df, spec), advanced.hurst(df, spec), advanced.nonlinearity(df, spec)):
        for r in part.collect():
            plain.setdefault(r.k, {}).update(r.asDict())
    for r in got.collect():
        for c in got.columns[4:]:
            assert r[c] == pytest.approx(plain[r.k][c] if r.k not in ("short", "one") else 0.0, abs=1e-9), (r.k, c)
    holes = spark.createDataFrame([(None, t, None if t % 2 else float(t), "x") for t in range(14)], df.schema)
    assert advanced.advanced_series(holes, spec).count() == 14
    assert advanced.advanced_series(df.limit(0), spec).count() == 0
