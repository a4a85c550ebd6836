"""Stockout features and recovery of latent demand; windows by series only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfloom.operators.series import order
from shelfloom.spec import SeriesSpec

#: Columns that look at later rows of the series, or are made from such; leave them out when training.
LOOKAHEAD = ("until_next_stockout", "latent_demand", "post_stockout_bounce", "stockout_severity")


def streak(flag: Column, spec: SeriesSpec, df: DataFrame, out: str) -> DataFrame:
    """Consecutive flagged rows that end here, by islands of a running count."""
    w = order(spec)
    df = df.withColumn("__island", F.sum(F.when(flag == 0, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    inside = Window.partitionBy(*spec.keys, "__island").orderBy(spec.time).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.when(flag == 1, F.sum(flag).over(inside)).otherwise(0).cast("int")).drop("__island")


def since_last(df: DataFrame, spec: SeriesSpec, flag: str = "is_stockout", out: str = "since_last_stockout") -> DataFrame:
    """Rows since the last event, 0 if none yet."""
    w = order(spec)
    rn = F.row_number().over(w)
    last = F.last(F.when(F.col(flag) == 1, F.col("__rn")), True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("__rn", rn).withColumn(out, F.coalesce(F.col("__rn") - last, F.lit(0))).drop("__rn")


def until_next(df: DataFrame, spec: SeriesSpec, flag: str = "is_stockout", out: str = "until_next_stockout") -> DataFrame:
    """Rows until the next event, 0 if none."""
    w = order(spec)
    first = F.first(F.when(F.col(flag) == 1, F.col("__rn")), True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return df.withColumn("__rn", F.row_number().over(w)).withColumn(out, F.coalesce(first - F.col("__rn"), F.lit(0))).drop("__rn")


def frequency(df: DataFrame, spec: SeriesSpec, flag: str = "is_stockout", out: str = "stockout_frequency") -> DataFrame:
    """Events in the last week of hours, or quarter of weeks."""
    n = 168 if spec.unit == "hour" else 12
    return df.withColumn(out, F.sum(flag).over(order(spec).rowsBetween(-(n - 1), 0)).cast("int"))


def expected_demand(df: DataFrame, spec: SeriesSpec, out: str = "expected_demand") -> DataFrame:
    """Mean of the last rows, from three on."""
    n = 24 if spec.unit == "hour" else max(spec.windows)
    w = order(spec).rowsBetween(-(n - 1), 0)
    return df.withColumn(out, F.when(F.count(spec.target).over(w) >= 3, F.avg(spec.target).over(w)))


def bounce(df: DataFrame, spec: SeriesSpec, out: str = "post_stockout_bounce") -> DataFrame:
    """First row in stock after a stockout, against the latent demand of the row before."""
    w = order(spec)
    before, latent = F.lag("is_stockout").over(w), F.lag("latent_demand").over(w)
    return df.withColumn(out, F.when((F.col("is_stockout") == 0) & (before == 1) & (latent > 0), F.col(spec.target) / latent).otherwise(0.0))


def severity(df: DataFrame, spec: SeriesSpec, out: str = "stockout_severity") -> DataFrame:
    """W13."""
    expected = F.nullif(F.col("expected_demand"), F.lit(0.0))
    short = F.when(F.col("is_stockout") == 1, F.col("latent_demand") / expected).when(F.col(spec.target) > 0, F.col(spec.target) / expected)
    return df.withColumn(out, F.coalesce(short, F.lit(0.0)))


def latent_demand(df: DataFrame, spec: SeriesSpec, out: str = "latent_demand") -> DataFrame:
    """Demand of stockout rows, by the first of four estimates that applies.

    (1) mean of the last ten in-stock rows of the series in the same hour of day, if it has three;
    (2) weighted mean of the last seven earlier in-stock sales, if there are three;
    (3) 0.8 of the series' in-stock mean; (4) 0.1.
    """
    y, keys = F.col(spec.target), list(spec.keys)
    stocked = F.col("is_stockout") == 0
    rows = df
    if spec.unit == "hour":
        rows = rows.withColumn("__phase", F.hour(spec.time))
        back = Window.partitionBy(*keys, "__phase").orderBy(F.desc(spec.time))
        ranked = rows.where(stocked).select(*keys, "__phase", spec.time, spec.target).withColumn("__rank", F.row_number().over(back))
        same = ranked.groupBy(*keys, "__phase").agg(F.count("*").alias("__n"), F.avg(F.when(F.col("__rank") <= 10, y)).alias("__same"))
        rows = rows.join(same.where("__n >= 3").drop("__n"), [*keys, "__phase"], "left").drop("__phase")
    else:
        rows = rows.withColumn("__same", F.lit(None).cast("double"))
    mean = df.where(stocked).groupBy(*keys).agg(F.avg(spec.target).alias("__mean"))
    rows = rows.join(mean, keys, "left")
    sold = stocked & (y > 0)
    own = Window.partitionBy(*keys, "__sold").orderBy(spec.time)
    rows = rows.withColumn("__sold", F.coalesce(sold, F.lit(False)))
    recent = F.array(y, *[F.lag(y, k).over(own) for k in range(1, 7)])
    rows = rows.withColumn("__recent", F.when(F.col("__sold"), F.array_compact(recent)))
    carried = F.last("__recent", True).over(order(spec).rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("__recent", carried)
    # Newest first; the weight falls from exp(0) to exp(-1) over n values.
    weighted = None
    for n in range(3, 8):
        weights = [math.exp(-k / (n - 1)) for k in range(n)]
        value = sum((F.col("__recent")[k] * w for k, w in enumerate(weights)), F.lit(0.0)) / sum(weights)
        weighted = F.when(F.size("__recent") == n, value) if weighted is None else weighted.when(F.size("__recent") == n, value)
    same, mean = F.col("__same"), F.col("__mean")
    estimate = F.when(same > 0, same).when(F.size("__recent") >= 3, weighted).when(mean > 0, 0.8 * mean).otherwise(0.1)
    return rows.withColumn(out, F.when(F.col("is_stockout") == 1, estimate).otherwise(0.0)).drop("__same", "__mean", "__sold", "__recent")


def stockout_features(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """FE11."""
    df = latent_demand(df, spec)
    df = streak(F.col("is_stockout"), spec, df, "stockout_streak")
    df = until_next(since_last(df, spec), spec)
    return severity(bounce(expected_demand(frequency(df, spec), spec), spec), spec)
