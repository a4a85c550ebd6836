"""Lags, rolling windows, trend and calendar of series.

All columns of one window specification are made in one ``select``: one shuffle by series, one sort.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfloom.spec import SeriesSpec


def order(spec: SeriesSpec):
    return Window.partitionBy(*spec.keys).orderBy(spec.time)


def lag_columns(spec: SeriesSpec, target: str | None = None, lags: tuple[int, ...] | None = None) -> list[Column]:
    """W1."""
    target = target or spec.target
    return [F.lag(target, k).over(order(spec)).alias(f"{target}_lag_{k}") for k in lags or spec.lags]


def rolling_columns(spec: SeriesSpec) -> list[Column]:
    """Over n rows that end ``base_lag`` rows back, so the present is never seen."""
    out = []
    for n in spec.windows:
        w = order(spec).rowsBetween(-(n - 1) - spec.base_lag, -spec.base_lag)
        out += [f(spec.target).over(w).alias(f"rolling_{name}_{n}") for name, f in (("mean", F.avg), ("std", F.stddev_samp), ("max", F.max), ("min", F.min))]
    return out


def with_lags(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    return df.select("*", *lag_columns(spec))


def with_lags_and_rolling(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    return df.select("*", *lag_columns(spec), *rolling_columns(spec))


def trend(df: DataFrame, target: str) -> DataFrame:
    """From lags 1 and 4 and the rolling windows of 4 and 8."""
    lag1, lag4 = F.col(f"{target}_lag_1"), F.col(f"{target}_lag_4")
    return df.withColumns(
        {
            "wow_change": lag1 - lag4,
            "wow_pct_change": (lag1 - lag4) / (lag4 + 1e-6),
            "momentum": F.col("rolling_mean_4") - F.col("rolling_mean_8"),
            "volatility": F.col("rolling_std_4") / (F.col("rolling_mean_4") + 1e-6),
        }
    )


def moving_average(df: DataFrame, keys: list[str], time: str, column: str, n: int = 7, out: str = "moving_average") -> DataFrame:
    """N rows, the present one included."""
    return df.withColumn(out, F.avg(column).over(Window.partitionBy(*keys).orderBy(time).rowsBetween(-(n - 1), 0)))


def pct_change(df: DataFrame, column: str, time: str, lags: tuple[int, ...] = (1, 12), keys: list[str] = ()) -> DataFrame:
    """Change against k rows before, in per cent.  Without keys only for small, aggregated tables."""
    w = Window.partitionBy(*keys).orderBy(time)
    return df.select("*", *[((F.try_divide(F.col(column).cast("double"), F.lag(column, k).over(w).cast("double")) - 1) * 100).alias(f"{column}_change_{k}") for k in lags])


def calendar_week(week: Column) -> dict[str, Column]:
    """FE2: from a running week number that starts at 1."""
    of_year = ((week - 1) % 52 + 1).cast("int")
    month = F.least(F.lit(12), F.floor((of_year - 1) / 4.33) + 1).cast("int")
    in_month = ((of_year - 1) % 4 + 1).cast("int")
    angle = of_year * (2 * math.pi / 52)
    return {
        "week_of_year": of_year,
        "month_proxy": month,
        "quarter": (F.floor((month - 1) / 3) + 1).cast("int"),
        "week_sin": F.sin(angle),
        "week_cos": F.cos(angle),
        "is_month_start": (in_month == 1).cast("int"),
        "is_month_end": (in_month == 4).cast("int"),
        "is_quarter_start": (of_year % 13 == 1).cast("int"),
        "is_quarter_end": (of_year % 13 == 0).cast("int"),
        "week_in_month": in_month,
    }


def calendar_hour(t: Column) -> dict[str, Column]:
    """FE3."""
    day = F.dayofyear(t)
    angle = day * (2 * math.pi / 365.25)
    return {"day_of_year": day, "month": F.month(t), "quarter": F.quarter(t), "day_sin": F.sin(angle), "day_cos": F.cos(angle)}


def intraday(t: Column) -> dict[str, Column]:
    """FE4."""
    hour, day = F.hour(t), F.weekday(t)
    within = lambda *h: hour.isin(*h).cast("int")
    return {
        "hour_of_day": hour,
        "day_of_week": day,
        "is_morning_peak": within(7, 8, 9),
        "is_evening_peak": within(17, 18, 19, 20),
        "is_overnight": within(23, 0, 1, 2, 3, 4, 5),
        "is_lunch": within(11, 12, 13, 14),
        "hour_sin": F.sin(hour * (2 * math.pi / 24)),
        "hour_cos": F.cos(hour * (2 * math.pi / 24)),
        "dow_sin": F.sin(day * (2 * math.pi / 7)),
        "dow_cos": F.cos(day * (2 * math.pi / 7)),
        "is_weekend": (day >= 5).cast("int"),
    }


def department_code(df: DataFrame, column: str = "department") -> DataFrame:
    """Dense number of the sorted distinct departments from 0; -1 for null.

    The window runs over the distinct values only.
    """
    names = df.select(column).where(F.col(column).isNotNull()).distinct()
    codes = names.withColumn("dept_code", (F.dense_rank().over(Window.orderBy(column)) - 1).cast("int"))
    return df.join(codes, column, "left").fillna(-1, ["dept_code"])


def interactions(df: DataFrame, target: str) -> DataFrame:
    """FE7: products of features that exist; nulls are 0."""
    have = set(df.columns)
    lag1 = f"{target}_lag_1"
    pairs = {
        "price_x_promo": ("base_price", "is_on_display"),
        "discount_x_display": ("discount_pct", "is_on_display"),
        "lag_1_x_week_sin": (lag1, "week_sin"),
        "lag_1_x_week_cos": (lag1, "week_cos"),
        "lag_1_x_wow": (lag1, "wow_pct_change"),
        "lag_1_x_momentum": (lag1, "momentum"),
        "trend_x_volatility": ("wow_change", "volatility"),
        "dept_x_month": ("dept_code", "month_proxy"),
        "momentum_x_sin": ("momentum", "week_sin"),
        "momentum_x_cos": ("momentum", "week_cos"),
        "qty_x_price": ("quantity_lag_1", "base_price"),
    }
    out = {name: F.coalesce(F.col(a) * F.col(b), F.lit(0.0)) for name, (a, b) in pairs.items() if a in have and b in have}
    if {"rolling_mean_4", "rolling_std_4"} <= have:
        out["mean_std_ratio"] = F.coalesce(F.col("rolling_mean_4") / (F.col("rolling_std_4") + 1e-6), F.lit(0.0))
    return df.withColumns(out)


def finished(out: DataFrame, spec: SeriesSpec, new: list[str], fill: bool) -> DataFrame:
    """What needs the row alone: trend and calendar beside the lags and rolling statistics (``new``); nulls of these are 0 if asked."""
    if {1, 4} <= set(spec.lags) and {4, 8} <= set(spec.windows):
        out = trend(out, spec.target)
        new = [*new, "wow_change", "wow_pct_change", "momentum", "volatility"]
    t = F.col(spec.time)
    out = out.withColumns(calendar_week(t) if spec.unit == "week" else {**calendar_hour(t), **intraday(t)})
    return out.fillna(0, new) if fill else out


def series_features(df: DataFrame, spec: SeriesSpec, fill: bool = True, advanced: bool = False) -> DataFrame:
    """FE8: lags, rolling statistics, trend, calendar; nulls are 0 if asked.

    ``advanced`` adds decomposition (as trend_component, seasonal, residual) and the measures of W21 to W24.
    """
    out = df.select("*", *lag_columns(spec), *rolling_columns(spec), *(lag_columns(spec, "quantity", (1, 4)) if spec.unit == "week" and "quantity" in df.columns else []))
    out = finished(out, spec, [c for c in out.columns if c not in df.columns], fill)
    if advanced:
        from shelfloom.operators.advanced import advanced_series, decompose

        parts = decompose(df, spec).withColumnRenamed("trend", "trend_component")
        out = advanced_series(out.join(parts, [*spec.keys, spec.time], "left"), spec)
    return out


def order_check(df: DataFrame, spec: SeriesSpec, *position: str) -> DataFrame:
    """(keys, n, n_backward, n_repeated): how often time goes back, or stays, from one row to the next.

    position: the columns that say in which order the rows came.  Rows without a time count in n only.
    """
    before = F.lag(spec.time).over(Window.partitionBy(*spec.keys).orderBy(*position))
    rows = df.select(*spec.keys, spec.time, before.alias("__before"))
    now, was = F.col(spec.time), F.col("__before")
    return rows.groupBy(*spec.keys).agg(F.count("*").alias("n"), F.count_if(now < was).alias("n_backward"), F.count_if(now == was).alias("n_repeated"))
