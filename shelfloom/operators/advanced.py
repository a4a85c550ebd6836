"""Decomposition, autocorrelation, entropy, Hurst exponent and nonlinearity of series."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfloom.functions.expr import clip
from shelfloom.operators.series import order
from shelfloom.spec import SeriesSpec


def _numbered(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    keys = list(spec.keys)
    w = order(spec)
    return df.select(*keys, spec.time, F.col(spec.target).alias("y"), F.row_number().over(w).alias("pos"), F.count("*").over(Window.partitionBy(*keys)).alias("n"))


def decompose(df: DataFrame, spec: SeriesSpec, period: int = 52) -> DataFrame:
    """Additive trend, seasonal and residual; series shorter than two periods are 0.

    The trend is a centred mean over one period (weights 1/2 at both ends if the period is even),
    continued at either end by the line through its first or last ``period`` values.  All of it is windows
    over one series: one shuffle, and none if rows come by series.
    """
    keys = list(spec.keys)
    half = period // 2
    rows = _numbered(df, spec)
    w = Window.partitionBy(*keys).orderBy("pos")
    total = F.sum("y").over(w.rowsBetween(-half, half))
    edges = (F.lag("y", half).over(w) + F.lead("y", half).over(w)) / 2
    centred = (total - edges) / period if period % 2 == 0 else total / period
    inside = (F.col("pos") > half) & (F.col("pos") <= F.col("n") - half)
    rows = rows.withColumn("centred", F.when(inside & (F.col("n") >= 2 * period), centred))
    x = F.col("pos").cast("double")
    head = F.col("pos") <= half + period
    tail = F.col("pos") > F.col("n") - half - period
    line = lambda at: [f(F.when(at, F.col("centred")), F.when(at, x)) for f in (F.regr_slope, F.regr_intercept)]
    (hs, hi), (ts, ti) = line(head), line(tail)
    series = Window.partitionBy(*keys)
    rows = rows.withColumns({"hs": hs.over(series), "hi": hi.over(series), "ts": ts.over(series), "ti": ti.over(series)})
    trend = F.coalesce("centred", F.when(F.col("pos") <= half, F.col("hs") * x + F.col("hi")).otherwise(F.col("ts") * x + F.col("ti")))
    rows = rows.withColumns({"trend": trend, "phase": (F.col("pos") - 1) % period})
    same = Window.partitionBy(*keys, "phase")
    rows = rows.withColumns({"level": F.avg(F.col("y") - F.col("trend")).over(same), "m": F.count("trend").over(same)})
    # The mean over phases: a phase of m rows counts once.
    share = F.when(F.col("trend").isNotNull(), 1 / F.col("m"))
    rows = rows.withColumn("mean_level", F.sum(F.col("level") * share).over(series) / F.sum(share).over(series))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    seasonal = F.col("level") - F.col("mean_level")
    return rows.select(*keys, spec.time, zero(F.col("trend")).alias("trend"), zero(seasonal).alias("seasonal"), zero(F.col("y") - F.col("trend") - seasonal).alias("residual"))


def autocorrelation(df: DataFrame, spec: SeriesSpec, lags: tuple[int, ...] = (1, 4, 12)) -> DataFrame:
    """By series with more rows than the largest lag; 0 for a constant series."""
    keys = list(spec.keys)
    rows = _numbered(df, spec).withColumn("dev", F.col("y") - F.avg("y").over(Window.partitionBy(*keys)))
    w = Window.partitionBy(*keys).orderBy("pos")
    rows = rows.select(*keys, "n", "dev", *[F.lag("dev", k).over(w).alias(f"dev_{k}") for k in lags])
    square = F.sum(F.col("dev") * F.col("dev"))
    found = rows.groupBy(*keys).agg(F.max("n").alias("n"), *[F.try_divide(F.sum(F.col("dev") * F.col(f"dev_{k}")), square).alias(f"acf_{k}") for k in lags])
    return found.select(*keys, *[F.when(F.col("n") > max(lags), F.coalesce(f"acf_{k}", F.lit(0.0))).otherwise(0.0).alias(f"acf_{k}") for k in lags])


def entropy(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Of a histogram of min(10, n // 2) bins, in nats, for series of more than five rows."""
    keys = list(spec.keys)
    ends = df.groupBy(*keys).agg(F.min(spec.target).alias("lo"), F.max(spec.target).alias("hi"), F.count("*").alias("n"))
    rows = df.select(*keys, F.col(spec.target).alias("y")).join(ends, keys)
    bins = F.least(F.lit(10), F.floor(F.col("n") / 2)).cast("int")
    at = F.when(F.col("hi") > F.col("lo"), F.least(bins - 1, F.floor((F.col("y") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins).cast("int"))).otherwise(0)
    counts = rows.groupBy(*keys, "n", at.alias("bin")).agg(F.count("*").alias("c"))
    p = F.col("c") / F.col("n")
    return counts.groupBy(*keys).agg(F.when(F.max("n") > 5, -F.sum(p * F.log(p)) + F.lit(0.0)).otherwise(0.0).alias("entropy"))


def hurst(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Slope of log rescaled range against log block length, in [0.1, 0.9]; 0.5 if undecided."""
    keys = list(spec.keys)
    rows = _numbered(df, spec)
    lengths = F.sequence(F.lit(2), F.least(F.lit(20), F.floor(F.col("n") / 2)).cast("int") - 1)
    rows = rows.where("n >= 10").withColumn("len", F.explode(lengths))
    rows = rows.withColumn("block", F.floor((F.col("pos") - 1) / F.col("len"))).where("(block + 1) * len <= n")
    b = Window.partitionBy(*keys, "len", "block")
    rows = rows.withColumn("dev", F.col("y") - F.avg("y").over(b))
    rows = rows.withColumn("walk", F.sum("dev").over(b.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)))
    blocks = rows.groupBy(*keys, "len", "block").agg((F.max("walk") - F.min("walk")).alias("r"), F.stddev_pop("y").alias("s"))
    rs = blocks.groupBy(*keys, "len").agg(F.avg(F.when(F.col("s") > 0, F.col("r") / F.col("s")).otherwise(0.0)).alias("rs"))
    slope = rs.where("rs > 0").groupBy(*keys).agg(F.count("*").alias("__k"), F.regr_slope(F.log("rs"), F.log(F.col("len").cast("double"))).alias("slope"))
    found = df.select(*keys).distinct().join(slope, keys, "left")
    return found.select(*keys, F.when(F.col("__k") >= 2, F.coalesce(clip(F.col("slope"), 0.1, 0.9), F.lit(0.5))).otherwise(0.5).alias("hurst"))


def nonlinearity(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Deviation of second differences against that of first ones, 10 at most."""
    keys = list(spec.keys)
    w = order(spec)
    rows = df.select(*keys, spec.time, (F.col(spec.target) - F.lag(spec.target).over(w)).alias("d1"))
    rows = rows.select(*keys, "d1", (F.col("d1") - F.lag("d1").over(w)).alias("d2"))
    value = F.least(F.lit(10.0), F.try_divide(F.stddev_pop("d2"), F.stddev_pop("d1")))
    return rows.groupBy(*keys).agg(F.coalesce(value, F.lit(0.0)).alias("nonlinearity"))


def measures(y: np.ndarray, lags: tuple[int, ...] = (1, 4, 12)) -> list[float]:
    """Autocorrelations, entropy, Hurst exponent and nonlinearity of one series, as the operators above define them."""
    n, flat = len(y), y.max() == y.min()
    dev = y - y.mean()
    acf = [0.0 if flat or n <= max(lags) else float(dev[k:] @ dev[:-k] / (dev @ dev)) for k in lags]
    bins = min(10, n // 2)
    entropy = 0.0
    if n > 5 and not flat:
        at = np.minimum(bins - 1, np.floor((y - y.min()) / (y.max() - y.min()) * bins).astype(int))
        p = np.bincount(at)[np.unique(at)] / n
        entropy = float(-(p * np.log(p)).sum()) + 0.0
    points = []
    for size in range(2, min(20, n // 2)) if n >= 10 else ():
        blocks = y[: n // size * size].reshape(-1, size)
        walk = np.cumsum(blocks - blocks.mean(1, keepdims=True), axis=1)
        same = blocks.max(1) == blocks.min(1)
        ratio = np.where(same, 0.0, np.ptp(walk, axis=1) / np.where(same, 1.0, blocks.std(1)))
        if ratio.mean() > 0:
            points.append((np.log(size), np.log(ratio.mean())))
    hurst = 0.5
    if len(points) >= 2:
        x, z = np.array(points).T
        x = x - x.mean()
        hurst = float(np.clip(x @ z / (x @ x), 0.1, 0.9))
    d1 = np.diff(y)
    spread = d1.std() if len(d1) and np.ptp(d1) > 0 else 0.0
    return [*acf, entropy, hurst, min(10.0, float(np.diff(d1).std() / spread)) if spread else 10.0]


def advanced_series(df: DataFrame, spec: SeriesSpec, least: int = 12) -> DataFrame:
    """FE9: the measures of its series on every row; 0 for series of fewer than ``least`` rows.

    Rows of a series meet once, as a sorted list (no longer than the time axis); all measures are made of that
    list and the rows are unpacked again: one scan, one shuffle, no join.

    Cases: null targets are left out of the measures, rows keep them; ties of time are ordered by target;
    null keys are a series; an empty table gives none.
    """
    keys, names = list(spec.keys), ["acf_1", "acf_4", "acf_12", "entropy", "hurst", "nonlinearity"]
    rest = [c for c in df.columns if c not in (*keys, spec.time, spec.target)]
    row = F.struct(F.col(spec.time).alias("t"), F.col(spec.target).alias("y"), F.struct(F.lit(0), *rest).alias("r"))
    lists = df.groupBy(*keys).agg(F.sort_array(F.collect_list(row)).alias("__rows"))

    @F.pandas_udf("array<double>")
    def measured(values: pd.Series) -> pd.Series:
        return pd.Series([measures(v) if len(v) else [0.0] * len(names) for v in values])

    values = F.transform(F.filter("__rows", lambda x: x["y"].isNotNull()), lambda x: x["y"].cast("double"))
    found = lists.withColumn("__m", F.when(F.size("__rows") >= least, measured(values)).otherwise(F.array(*[F.lit(0.0)] * len(names))))
    out = found.select(*keys, "__m", F.explode("__rows").alias("__row"))
    place = {**{k: F.col(k) for k in keys}, spec.time: F.col("__row.t"), spec.target: F.col("__row.y"), **{c: F.col("__row.r")[c] for c in rest}}
    return out.select(*[place[c].alias(c) for c in df.columns], *[F.col("__m")[i].alias(c) for i, c in enumerate(names)])
