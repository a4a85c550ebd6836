"""Quantile forecasts, ensembles, feature selection and their evaluation with Spark ML."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Bucketizer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfloom.operators import quantile_trees
from shelfloom.operators.metrics import r2
from shelfloom.operators.quantile_trees import BINS, QuantileForecaster
from shelfloom.spec import SeriesSpec

QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)
#: All that the ensemble has weights for.
SEVEN = (0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95)
ACCURACY = 1_000_000
#: The quantiles that bins for importances are made of: how many, and how fine.
CUTS, CUT_ACCURACY = 8 * BINS, 4_000
BUCKET_ROWS = 10_000
#: Weights of the quantiles in the ensemble.
WEIGHTS = {"q05": 0.1, "q10": 0.1, "q25": 0.2, "q50": 0.4, "q75": 0.15, "q90": 0.025, "q95": 0.025}


def name(q: float) -> str:
    return f"forecast_q{round(q * 100):02d}"


def quantile_baseline(train: DataFrame, spec: SeriesSpec, phase: Column, levels: tuple[float, ...] = QUANTILES) -> DataFrame:
    """M4: empirical quantiles of history by series and phase."""
    rows = train.groupBy(*spec.keys, phase.alias("phase")).agg(F.percentile(spec.target, F.array(*map(F.lit, levels))).alias("__q"))
    return rows.select(*spec.keys, "phase", *[F.col("__q")[i].alias(name(q)) for i, q in enumerate(levels)])


def encoder(categories: list[str]) -> Pipeline:
    """M2: levels frozen when fitted; later ones get a level of their own."""
    return Pipeline(stages=[StringIndexer(inputCols=categories, outputCols=[f"{c}_code" for c in categories], handleInvalid="keep")])


class CentredForecaster:
    """One boosted centre, and held-out residual quantiles by segment around it: all levels share a shape."""

    def __init__(self, centre: PipelineModel, residuals: DataFrame, features: list[str], segment: str, overall: list[float], levels: tuple[float, ...] = QUANTILES):
        self.centre, self.residuals, self.features, self.segment, self.overall = centre, residuals, features, segment, overall
        self.levels = tuple(sorted(levels))

    def predict(self, df: DataFrame) -> DataFrame:
        """Quantiles in order, not negative, with interval and centre; missing features are 0."""
        missing = [c for c in self.features if c not in df.columns]
        rows = df.withColumns({c: F.lit(0.0) for c in missing}).fillna(0, self.features)
        rows = self.centre.transform(rows).drop("features")
        # One row for each segment: the optimizer broadcasts it if it is small.
        rows = rows.join(self.residuals, self.segment, "left")
        shift = F.coalesce("__r", F.array(*map(F.lit, self.overall)))
        rows = rows.withColumn("__q", F.array_sort(F.transform(shift, lambda x: F.greatest(F.lit(0.0), x + F.col("prediction")))))
        rows = rows.withColumns({name(q): F.col("__q")[i] for i, q in enumerate(self.levels)})
        low, high = F.col(name(self.levels[0])), F.col(name(self.levels[-1]))
        return rows.withColumns({"prediction_interval": high - low, "prediction_center": (high + low) / 2}).drop("__q", "__r", "prediction", *missing)


def centred_train(train: DataFrame, spec: SeriesSpec, features: list[str], segment: str, max_iter: int = 20, depth: int = 4, calibrate: float = 0.75, levels: tuple[float, ...] = QUANTILES) -> CentredForecaster:
    """The simpler model: the centre from the older part of train, residual quantiles from the newer part."""
    from shelfloom.operators.clean import time_split

    old, new = time_split(train.fillna(0, features), spec.time, calibrate)
    stages = [VectorAssembler(inputCols=features, outputCol="features"), GBTRegressor(featuresCol="features", labelCol=spec.target, maxIter=max_iter, maxDepth=depth, seed=7)]
    centre = Pipeline(stages=stages).fit(old)
    left = centre.transform(new).withColumn("__e", F.col(spec.target) - F.col("prediction"))
    at = F.array(*map(F.lit, sorted(levels)))
    # Over all segments the residuals are as many as the rows: their quantiles are to one part in ACCURACY.
    overall = left.agg(F.percentile_approx("__e", at, ACCURACY).alias("q")).first()["q"] or [0.0] * len(levels)
    return CentredForecaster(centre, left.groupBy(segment).agg(F.percentile("__e", at).alias("__r")), features, segment, list(overall), levels)


def quantile_train(train: DataFrame, spec: SeriesSpec, features: list[str], segment: str, max_iter: int = 12, depth: int = 3, levels: tuple[float, ...] = QUANTILES, rate: float = 0.5, least: int = 100, calibrate: float = 0.75) -> QuantileForecaster:
    """M3: boosted trees with quantile loss, an ensemble for each level; ``least`` rows in a leaf.

    The part of train from the ``calibrate`` quantile of times on decides how many rounds each level keeps.
    """
    from shelfloom.operators.clean import is_newer

    newer = is_newer(train, spec.time, calibrate)
    trees, starts, overall = quantile_trees.fit(train, spec.target, features, segment, levels, max_iter, depth, rate, least, F.coalesce(newer, F.lit(False)))
    return QuantileForecaster(trees, starts, overall, features, segment)


def ensemble_forecast(df: DataFrame) -> DataFrame:
    """M6: weighted mean of the quantiles present; fewer than three are averaged plainly."""
    have = {q: f"forecast_{q}" for q in WEIGHTS if f"forecast_{q}" in df.columns}
    if len(have) < 3:
        value = sum((F.col(c) for c in have.values()), F.lit(0.0)) / max(len(have), 1)
    else:
        total = sum(WEIGHTS[q] for q in have)
        value = sum((F.col(c) * (WEIGHTS[q] / total) for q, c in have.items()), F.lit(0.0))
    return df.withColumn("ensemble_forecast", value)


def uncertainty_weighted(df: DataFrame) -> DataFrame:
    """The median times its sharpness, as a share of all sharpness.

    The share is of the whole table, as defined: the values shrink as rows grow.
    """
    sharp = 1 / (F.col("forecast_q95") - F.col("forecast_q05") + 1e-6)
    total = df.agg(F.sum(sharp).alias("__total"))
    return df.crossJoin(F.broadcast(total)).withColumn("uncertainty_weighted", F.col("forecast_q50") * sharp / F.col("__total")).drop("__total")


def share_of_total(df: DataFrame, column: str, out: str = "share") -> DataFrame:
    """W25."""
    total = df.agg(F.sum(column).alias("__total"))
    return df.crossJoin(F.broadcast(total)).withColumn(out, F.try_divide(F.col(column), F.col("__total"))).drop("__total")


def correlation_pairs(df: DataFrame, columns: list[str], method: str = "pearson") -> DataFrame:
    """(a, b, rho) of all pairs a < b; the matrix is as small as the list of columns."""
    vectors = VectorAssembler(inputCols=columns, outputCol="v", handleInvalid="skip").transform(df.select(*columns)).select("v")
    m = Correlation.corr(vectors, "v", method).first()[0].toArray()
    rows = [(a, b, float(m[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns) if a < b]
    return df.sparkSession.createDataFrame(rows, "a string, b string, rho double")


def _at_values(values: list[float]) -> list[float]:
    """Where the bins of a feature of few values begin, but for the first."""
    return np.unique(values)[1:].tolist()


def _at_quantiles(quantiles: list[float]) -> list[float]:
    """The same of one of many values: about ``BINS`` bins, of which each value that a whole one would not hold has its own.

    quantiles: in order, more of them than bins.
    """
    value, times = np.unique(quantiles, return_counts=True)
    heavy = value[times * BINS >= len(quantiles)]
    own = np.union1d(heavy, np.nextafter(heavy, np.inf))
    light = np.setdiff1d(value, heavy)
    left = max(BINS - 1 - len(own), 0)
    shares = np.repeat(light, times[np.isin(value, light)])
    at = (np.arange(1, left + 1) * len(shares)) // (left + 1)
    return np.union1d(own, np.nextafter(shares[at], np.inf) if len(shares) else []).tolist()


def select_by_importance(df: DataFrame, features: list[str], target: str, threshold: float = 0.005, max_features: int | None = None) -> DataFrame:
    """M8: (feature, importance) against the largest one; features of no variance are left out.

    Trees of squared loss take of rows whose features lie in equal bins no more than their number and mean target.
    So Spark's trees grow on the table of those, weighted, which all rows go into by one aggregate: its passes are over
    distinct combinations of bins, as many as there are rows at most.  Bins are cut at quantiles of all rows, and to both sides of a value
    that a bin's share of them has; each value of a feature that has few has its own.

    Cases: null features are 0; rows without target do not count.
    """
    x = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(0.0)) for c in features]
    rows = df.select(F.col(target).alias("__y"), *[v.alias(f"__x{i}") for i, v in enumerate(x)])
    cuts = F.array(*[F.lit(i / CUTS) for i in range(1, CUTS)])
    seen = df.agg(F.array(*[F.struct(F.var_samp(c).alias("spread"), F.approx_count_distinct(v).alias("n"), F.percentile_approx(v, cuts, CUT_ACCURACY).alias("q")) for c, v in zip(features, x, strict=True)]).alias("s")).first()["s"]
    alive = [i for i, s in enumerate(seen) if (s["spread"] or 0) > 0]
    few = [i for i in alive if seen[i]["n"] <= BINS]
    begins = {i: _at_quantiles(seen[i]["q"]) for i in alive}
    begins |= dict(zip(few, map(_at_values, rows.agg(*[F.collect_set(f"__x{i}") for i in few]).first()), strict=True)) if few else {}
    found = []
    if alive:
        b = [f"__b{i}" for i in alive]
        binned = Bucketizer(splitsArray=[[-math.inf, *begins[i], math.inf] for i in alive], inputCols=[f"__x{i}" for i in alive], outputCols=b).transform(rows)
        # As plain numbers: the bucketizer calls its bins nominal, and trees would split them in any order.
        cells = binned.groupBy(*[F.col(c).cast("int").alias(c) for c in b]).agg(F.count("__y").alias("__w"), F.avg("__y").alias("__y")).where("__w > 0")
        grown = GBTRegressor(featuresCol="features", labelCol="__y", weightCol="__w", maxIter=10, maxDepth=4, seed=7).fit(VectorAssembler(inputCols=b, outputCol="features").transform(cells))
        found = grown.featureImportances.toArray()
    top = max(found.max(), 1e-12) if len(found) else 1.0
    kept = sorted(((features[i], float(v / top)) for i, v in zip(alive, found, strict=True) if v / top >= threshold), key=lambda x: (-x[1], x[0]))
    return df.sparkSession.createDataFrame(kept[:max_features], "feature string, importance double")


def drop_correlated(df: DataFrame, features: list[str], limit: float = 0.95) -> list[str]:
    """M9: of two features that go together, the one with the larger variance stays."""
    spread = df.agg(*[F.var_samp(c).alias(c) for c in features]).first().asDict()
    gone: set[str] = set()
    for r in sorted(correlation_pairs(df, features).collect(), key=lambda r: (-abs(r.rho), r.a, r.b)):
        if abs(r.rho) >= limit and not {r.a, r.b} & gone:
            gone.add(r.a if (spread[r.a] or 0, r.a) < (spread[r.b] or 0, r.b) else r.b)
    return [c for c in features if c not in gone]


def feature_selection(train: DataFrame, features: list[str], target: str) -> list[str]:
    """On train only."""
    found = [r.feature for r in select_by_importance(train, features, target).collect()]
    return drop_correlated(train, found) if len(found) > 1 else found


def permutation_importance(model: QuantileForecaster, df: DataFrame, features: list[str], target: str, keys: list[str]) -> DataFrame:
    """(feature, rise): how much the absolute error rises when a feature is exchanged between rows.

    One permutation serves all features: inside hash buckets of about ``BUCKET_ROWS`` rows, so that no sort
    spans the table, each row takes the values of the next one in the order of a key hash.  All features of a
    row move together, and all are scored in one pass.

    Cases: features that the model does not know, or that are constant, rise by exactly 0; a table without rows
    has null rises; rows of equal keys follow each other.
    """
    buckets = -(-df.count() // BUCKET_ROWS) or 1
    parts = model.exchanged(df, target, F.pmod(F.xxhash64(*keys), F.lit(buckets)), F.xxhash64(*keys, F.lit(1)))
    mean = lambda i: F.try_divide(F.sum(F.col("e")[i]), F.sum("n"))
    at = {c: i + 1 for i, c in enumerate(model.features)}
    one = [F.struct(F.lit(c).alias("feature"), (mean(at[c]) - mean(0) if c in at else F.lit(0.0)).alias("rise")) for c in features]
    return parts.agg(F.array(*one).alias("o")).select(F.explode("o").alias("o")).select("o.*")


def walk_forward(df: DataFrame, spec: SeriesSpec, folds: int = 52, train: int = 4) -> DataFrame:
    """For each of the last ``folds`` weeks, quantiles of the ``train`` weeks before it, and their errors.

    The weeks before are a range of one window over the series, so rows are shuffled once and none is copied.
    Weeks without rows in reach of any series are no folds; null targets count in neither part.
    """
    t, y = F.col(spec.time), F.col(spec.target)
    before = Window.partitionBy(*spec.keys).orderBy(t).rangeBetween(-train, -1)
    rows = df.select(*spec.keys, t, y, F.percentile(y, F.array(*map(F.lit, QUANTILES))).over(before).alias("q"))
    q = lambda i: F.col("q")[i]
    by = rows.groupBy(t.alias("fold")).agg(
        F.count_if(q(2).isNotNull()).alias("n"),
        F.avg(F.abs(y - q(2))).alias("mae"),
        F.avg(((y >= q(0)) & (y <= q(4))).cast("double")).alias("coverage"),
        r2(y, q(2)).alias("r2"),
    )
    # One row for each week: a list of them is no longer than the time axis.
    weeks = by.agg(F.max("fold").alias("last"), F.collect_list(F.struct("fold", "n", "mae", "coverage", "r2")).alias("w"))
    kept = weeks.select("last", F.explode("w").alias("w")).where((F.col("w.n") > 0) & (F.col("w.fold") > F.col("last") - folds)).select("w.*")
    return kept.agg(F.count("*").alias("folds"), *[f(c).alias(f"{c}_{n}") for c in ("r2", "coverage", "mae") for n, f in (("mean", F.avg), ("std", F.stddev_samp))])
