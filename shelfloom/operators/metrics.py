"""Forecast errors and summaries of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfloom.functions.expr import clip


def pinball(y: Column, q: Column, level: float) -> Column:
    return F.greatest((y - q) * level, (y - q) * (level - 1))


def r2(y: Column, p: Column) -> Column:
    """In one pass: the squares about the mean come from the population variance; null for a constant target.

    Rows without a forecast count in neither.
    """
    own = F.when(p.isNotNull(), y)
    return 1 - F.try_divide(F.sum((y - p) * (y - p)), F.var_pop(own) * F.count(own))


def quantile_metrics(df: DataFrame, target: str, quantiles: dict[float, str], floor: float = 0.1) -> DataFrame:
    """One row (model, pinball, mae, rmse, mape, n_mape, coverage, r2) for each quantile.

    MAPE only counts actuals above ``floor``.  Coverage is of the outer quantiles, R2 of each.
    """
    y = F.col(target)
    low, high = quantiles[min(quantiles)], quantiles[max(quantiles)]
    inside = F.avg(((y >= F.col(low)) & (y <= F.col(high))).cast("double"))
    aggs = []
    for level, c in quantiles.items():
        p = F.col(c)
        e = F.abs(y - p)
        aggs.append(
            F.struct(
                F.lit(c).alias("model"),
                F.avg(pinball(y, p, level)).alias("pinball"),
                F.avg(e).alias("mae"),
                F.sqrt(F.avg(e * e)).alias("rmse"),
                (F.avg(F.when(y > floor, e / y)) * 100).alias("mape"),
                F.count_if(y > floor).alias("n_mape"),
                inside.alias("coverage"),
                r2(y, p).alias("r2"),
            )
        )
    return df.agg(F.array(*aggs).alias("m")).select(F.explode("m").alias("m")).select("m.*")


def category_metrics(df: DataFrame, category: str, target: str, forecast: str, top: int = 10) -> DataFrame:
    """The ``top`` most frequent categories."""
    y, e = F.col(target), F.abs(F.col(target) - F.col(forecast))
    mae, mean = F.avg(e), F.avg(y)
    out = df.groupBy(category).agg(
        F.count("*").alias("n"),
        mae.alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.least(F.lit(1000.0), F.avg(F.when(y != 0, e / F.abs(y))) * 100).alias("mape"),
        clip(100 * (1 - mae / F.greatest(mean, F.lit(0.001))), 0.0, 100.0).alias("accuracy"),
    )
    return out.orderBy(F.desc("n"), category).limit(top)


def group_sensitivity(df: DataFrame, group: str, product: str, target: str, forecast: str) -> DataFrame:
    """A15."""
    y, p = F.col(target), F.col(forecast)
    return df.groupBy(group).agg(
        F.count_distinct(product).alias("n_products"),
        F.count("*").alias("n"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        r2(y, p).alias("r2"),
        F.avg(y).alias("avg_demand"),
    )


def region_sensitivity(df: DataFrame, store: str, target: str, forecast: str) -> DataFrame:
    """The region is the first character of the store id, unless a column says so."""
    y, e = F.col(target), F.abs(F.col(target) - F.col(forecast))
    region = F.col("region") if "region" in df.columns else F.substring(F.col(store).cast("string"), 1, 1)
    return df.groupBy(region.alias("region")).agg(F.count_distinct(store).alias("n_stores"), F.count("*").alias("n"), F.avg(e).alias("mae"), (F.avg(F.try_divide(e, F.abs(y))) * 100).alias("mape"), F.sum(y).alias("total_demand"))


def category_accuracy(df: DataFrame, category: str, target: str, forecast: str) -> DataFrame:
    """A17."""
    return df.groupBy(category).agg((1 - F.try_divide(F.avg(F.abs(F.col(target) - F.col(forecast))), F.avg(target))).alias("accuracy"))


def histogram(df: DataFrame, value: Column, bins: int) -> DataFrame:
    """(bin, n) of ``bins`` equal bins between the extremes, the maximum in the last.

    Empty bins are 0; equal extremes give one bin; nulls count nowhere; without values there is no row.
    """
    rows = df.select(value.cast("double").alias("v")).where("v is not null")
    ends = rows.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).where("lo is not null")
    at = F.when(F.col("hi") > F.col("lo"), F.least(F.lit(bins - 1), F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins).cast("int"))).otherwise(0)
    counts = rows.crossJoin(F.broadcast(ends)).groupBy(at.alias("bin")).agg(F.count("*").alias("n"))
    last = F.when(F.col("hi") > F.col("lo"), bins - 1).otherwise(0)
    every = ends.select(F.explode(F.sequence(F.lit(0), last)).alias("bin"))
    return every.join(counts, "bin", "left").fillna(0, ["n"])


def error_by_period(df: DataFrame, period: str, target: str, forecast: str) -> DataFrame:
    """A12."""
    return df.groupBy(period).agg(F.avg(F.abs(F.col(target) - F.col(forecast))).alias("mae"))


def attribution_summary(df: DataFrame) -> DataFrame:
    """(row_id, feature, value) -> measures by feature."""
    v = F.col("value")
    return df.groupBy("feature").agg(
        F.avg(F.abs(v)).alias("mean_abs"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"),
        (F.avg((v > 0).cast("double")) * 100).alias("pct_positive"), (F.avg((v < 0).cast("double")) * 100).alias("pct_negative"),
    )


#: What a feature's name says about it, in the order of asking.
FAMILIES = (("promo", "promotion"), ("price", "price"), ("lag", "history"), ("season", "season"), ("day", "calendar"), ("week", "calendar"), ("weather", "weather"))


def top_attributions(df: DataFrame, key: str, n: int = 3) -> DataFrame:
    """The n features with the largest |value| of each key, with their share; padded to n."""
    w = Window.partitionBy(key)
    size = F.abs("value")
    rows = df.withColumns({"rank": F.row_number().over(w.orderBy(F.desc(size), "feature")), "total": F.sum(size).over(w)})
    rows = rows.where(F.col("rank") <= n).withColumn("impact_pct", F.coalesce(F.try_divide(size, F.col("total")) * 100, F.lit(0.0)))
    family = F.lit("other")
    for word, label in reversed(FAMILIES):
        family = F.when(F.lower("feature").contains(word), label).otherwise(family)
    slots = df.select(key).distinct().select(key, F.explode(F.sequence(F.lit(1), F.lit(n))).alias("rank"))
    out = slots.join(rows.select(key, "rank", "feature", "impact_pct", family.alias("family")), [key, "rank"], "left")
    return out.select(key, "rank", F.coalesce("feature", F.concat(F.lit("factor_"), F.col("rank").cast("string"))).alias("feature"), F.coalesce("impact_pct", F.lit(0.0)).alias("impact_pct"), F.coalesce("family", F.lit("none")).alias("family"))
