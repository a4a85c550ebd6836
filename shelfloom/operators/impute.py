"""Missing values, filled within each series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfloom.functions.expr import interpolate as line
from shelfloom.functions.quantile import exact_quantiles_of


def fill_forward_back(df: DataFrame, keys: list[str], time: str, columns: list[str], backward: bool = True) -> DataFrame:
    """The last known value, before the first one the next (null, if not ``backward``)."""
    w = Window.partitionBy(*keys).orderBy(time)
    past, future = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    last = lambda c: F.last(c, True).over(past)
    return df.withColumns({c: F.coalesce(last(c), F.first(c, True).over(future)) if backward else last(c) for c in columns})


def ffill_bfill_zero(df: DataFrame, keys: list[str], time: str, columns: list[str]) -> DataFrame:
    """W18."""
    return fill_forward_back(df, keys, time, columns).fillna(0, columns)


def rolling_median_fill(df: DataFrame, keys: list[str], time: str, columns: list[str], n: int = 7) -> DataFrame:
    """Median of the last n rows, then of the column."""
    w = Window.partitionBy(*keys).orderBy(time).rowsBetween(-(n - 1), 0)
    medians = {c: q[0] for c, q in exact_quantiles_of(df, columns, [0.5]).items()}
    return df.withColumns({c: F.coalesce(F.col(c), F.percentile(c, F.lit(0.5)).over(w), F.lit(medians[c]).cast("double")) for c in columns})


def interpolate(df: DataFrame, keys: list[str], time: str, columns: list[str]) -> DataFrame:
    """Linear between neighbours by row number, constant at the ends."""
    w = Window.partitionBy(*keys).orderBy(time)
    past, future = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    rows = df.withColumn("__rn", F.row_number().over(w))
    point = lambda c: F.when(F.col(c).isNotNull(), F.struct("__rn", F.col(c).alias("y")))
    rows = rows.withColumns({f"__b_{c}": F.last(point(c), True).over(past) for c in columns} | {f"__a_{c}": F.first(point(c), True).over(future) for c in columns})
    b, a = (lambda c: F.col(f"__b_{c}")), (lambda c: F.col(f"__a_{c}"))
    filled = {c: F.coalesce(F.col(c), line(b(c)["__rn"], b(c)["y"], a(c)["__rn"], a(c)["y"], F.col("__rn"))) for c in columns}
    return rows.withColumns(filled).drop("__rn", *[f"__b_{c}" for c in columns], *[f"__a_{c}" for c in columns])


def robust_impute(df: DataFrame, keys: list[str], time: str, columns: list[str], high: float = 0.7, middle: float = 0.3) -> DataFrame:
    """FE12: the treatment of a column follows from its share of nulls and its name.

    Above ``high`` the column goes; above ``middle`` it is interpolated; else lags are filled forwards
    and backwards, std and volatility by rolling medians, changes by 0, rolling means by
    interpolation.  ``<column>_was_missing`` marks what was null; what is left is 0.
    """
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns]).first()
    stay = [c for c in columns if (shares[c] or 0.0) <= high]
    out = df.drop(*[c for c in columns if c not in stay])
    holes = [c for c in stay if (shares[c] or 0.0) > 0]
    out = out.withColumns({f"{c}_was_missing": F.col(c).isNull().cast("int") for c in holes})
    proxies = [c for c in holes if shares[c] > middle]
    easy = [c for c in holes if c not in proxies]
    named = lambda *words: [c for c in easy if any(w in c for w in words)]
    medians = named("std", "volatility")
    lags = [c for c in named("lag") if c not in medians]
    means = [c for c in named("rolling_mean") if c not in medians + lags]
    if proxies + means:
        out = interpolate(out, keys, time, proxies + means)
    if lags:
        out = ffill_bfill_zero(out, keys, time, lags)
    if medians:
        out = rolling_median_fill(out, keys, time, medians)
    return out.fillna(0, stay)


def impute_after_split(train: DataFrame, test: DataFrame, numeric: list[str], categories: list[str], zero: tuple[str, ...] = ("lag", "rolling", "sales", "quantity", "frequency", "duration")) -> tuple[DataFrame, DataFrame]:
    """M1: what is filled is learned from train only: 0 for counts and history, medians for the rest."""
    to_zero = [c for c in numeric if any(k in c.lower() for k in zero)]
    rest = [c for c in numeric if c not in to_zero]
    medians = {c: q[0] for c, q in exact_quantiles_of(train, rest, [0.5]).items()}
    values = {**dict.fromkeys(to_zero, 0), **{c: (0 if v is None else v) for c, v in medians.items()}, **dict.fromkeys(categories, "Unknown")}
    return train.fillna(values), test.fillna(values)
