"""Report tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfloom.operators.impute import interpolate
from shelfloom.operators.series import pct_change


def hourly_profile(df: DataFrame, time: str, target: str, forecast: str) -> DataFrame:
    """A10."""
    return df.groupBy(F.hour(time).alias("hour")).agg(F.avg(target).alias("demand_mean"), F.stddev_samp(target).alias("demand_std"), F.avg(forecast).alias("forecast_mean"))


def hourly_quantile_totals(df: DataFrame, time: str, target: str, quantiles: list[str]) -> DataFrame:
    """Totals of all 24 hours; missing hours are interpolated between their neighbours."""
    have = df.groupBy(F.hour(time).alias("hour")).agg(*[F.sum(c).alias(c) for c in (*quantiles, target)], F.count("*").alias("n"))
    hours = df.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"), F.lit(0).alias("__all"))
    full = hours.join(have, "hour", "left").fillna(0, ["n"])
    return interpolate(full, ["__all"], "hour", [*quantiles, target]).drop("__all")


def rollup_daily(df: DataFrame, time: str, keys: list[str], columns: list[str]) -> DataFrame:
    """A7."""
    return df.groupBy(*keys, F.to_date(time).alias("date")).agg(*[F.sum(c).alias(c) for c in columns])


def rollup_monthly(df: DataFrame, date: str, columns: list[str]) -> DataFrame:
    """A8."""
    return df.groupBy(F.date_format(date, "yyyy-MM").alias("month")).agg(*[F.sum(c).alias(c) for c in columns])


def market_growth(df: DataFrame, date: str, columns: list[str]) -> DataFrame:
    """Months with their growth against the month and the year before (a window over months)."""
    out = rollup_monthly(df, date, columns)
    for c in columns:
        out = pct_change(out, c, "month", (1, 12))
    return out


def market_summary(growth: DataFrame, column: str) -> DataFrame:
    """Means over the last twelve months."""
    last = growth.orderBy(F.desc("month")).limit(12)
    return last.agg(F.avg(f"{column}_change_1").alias("mom_mean"), F.avg(f"{column}_change_12").alias("yoy_mean"))


def inventory_report(df: DataFrame, risk: float = 0.1) -> DataFrame:
    """High risk is that of the unclipped probability; the clipped one never gets near the limit."""
    return df.agg(F.count("*").alias("products"), F.count_if("should_reorder").alias("reorders"), F.avg("days_until_reorder").alias("mean_days_until_reorder"), F.count_if(F.col("stockout_risk_raw") > risk).alias("high_risk"), F.sum("total_cost").alias("total_cost"))


def risk_histogram(df: DataFrame, column: str) -> DataFrame:
    """Right-closed quarters of 100; 0 belongs to none."""
    c = F.col(column)
    band = F.when((c > 0) & (c <= 25), "Low").when((c > 25) & (c <= 50), "Medium").when((c > 50) & (c <= 75), "High").when((c > 75) & (c <= 100), "Critical")
    return df.select(band.alias("band")).where("band is not null").groupBy("band").agg(F.count("*").alias("n"))


def headline_kpis(df: DataFrame, forecast: str, product: str, risk: Column) -> DataFrame:
    """A30."""
    return df.agg(F.avg(forecast).alias("mean_forecast"), F.count_distinct(product).alias("products"), F.count_if(risk > 50).alias("at_risk"))


def alert_summary(df: DataFrame, hours: int = 24) -> DataFrame:
    """Alerts of the last hours by severity and by type; grouping sets, one pass."""
    end = df.agg(F.max("timestamp").alias("__end"))
    recent = df.crossJoin(F.broadcast(end)).where(F.col("timestamp") >= F.col("__end") - F.expr(f"INTERVAL {hours} HOURS"))
    return recent.groupingSets([["severity"], ["type"]], "severity", "type").agg(F.count("*").alias("n"))


def operation_stats(df: DataFrame) -> DataFrame:
    """Durations by operation, and whether its mean is the largest."""
    d = F.col("duration_seconds")
    out = df.groupBy(F.col("type").alias("operation_name")).agg(F.count("*").alias("n"), F.sum(d).alias("total"), F.avg(d).alias("mean"), F.max(d).alias("max"), F.min(d).alias("min"), F.stddev_samp(d).alias("std"))
    slowest = out.agg(F.max_by("operation_name", F.struct("mean", "operation_name")).alias("__slow"))
    return out.crossJoin(F.broadcast(slowest)).withColumn("slowest", F.col("operation_name") == F.col("__slow")).drop("__slow")
