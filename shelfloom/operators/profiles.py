"""Profiles of columns as sketches that are stored and merged: no row is read again.

A profile has one row for each column (and each value of ``by``, such as a day): counts, sums of powers about a
common origin, extremes, and sketches: KLL for quantiles, HyperLogLog for distinct values, and space-saving counts of
the most frequent levels.  Profiles of parts are merged into that of the whole in any order; drift is read from
two of them.

Bounds: counts, means, extremes and shares are exact (sums in double precision); a KLL quantile with ``KLL`` = 400
misses its rank by under 0.7 % (99 % of the time) and is exact up to that many values; a HyperLogLog count with
2^14 registers by 0.8 % (one standard deviation); the levels of a column are exact as long as it has at most
``LEVELS`` in a group, else the kept ones are those that are commonest within each merged part.

Cases: nulls (and NaN, which counts as null) are in ``nulls`` alone; a column that is all null has null statistics;
an empty table has no profile; a column may not be named twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KLL, HLL, LEVELS = 400, 14, 1000


def _numeric(c: str) -> Column:
    x = F.nanvl(F.col(c).cast("double"), F.lit(None))
    return F.struct(
        F.lit(c).alias("column"),
        F.count("*").alias("n"),
        F.count_if(x.isNull()).alias("nulls"),
        F.sum(x).alias("sum"),
        F.var_pop(x).alias("var"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.kll_sketch_agg_double(x, F.lit(KLL)).alias("kll"),
        F.hll_sketch_agg(x.cast("string"), F.lit(HLL)).alias("hll"),
    )


def _categorical(c: str) -> Column:
    x = F.col(c).cast("string")
    none = F.lit(None).cast("double")
    return F.struct(
        F.lit(c).alias("column"),
        F.count("*").alias("n"),
        F.count_if(x.isNull()).alias("nulls"),
        *[none.alias(k) for k in ("sum", "var", "min", "max")],
        F.lit(None).cast("binary").alias("kll"),
        F.hll_sketch_agg(x, F.lit(HLL)).alias("hll"),
    )


def profile(df: DataFrame, numeric: list[str], categorical: list[str] = (), by: list[str] = ()) -> DataFrame:
    """(by..., column, n, nulls, sum, var, min, max, kll, hll): all columns in one pass over the rows."""
    parts = [*map(_numeric, numeric), *map(_categorical, categorical)]
    found = df.groupBy(*by).agg(F.count("*").alias("__n"), F.array(*parts).alias("p")).where("__n > 0")
    return found.select(*by, F.explode("p").alias("p")).select(*by, "p.*")


def merge(profiles: DataFrame, by: list[str] = ()) -> DataFrame:
    """Profiles of parts as those of their unions, by the columns that are kept.

    The variance of a union is that within its parts and that of their means about its own.
    """
    have = F.col("n") - F.col("nulls")
    group = Window.partitionBy(*by, "column")
    mean = F.try_divide(F.sum("sum").over(group), F.sum(have).over(group))
    squares = have * (F.col("var") + F.pow(F.try_divide("sum", have) - mean, 2))
    rows = profiles.withColumn("__s", squares)
    sums = [F.sum(c).alias(c) for c in ("n", "nulls", "sum")]
    var = F.try_divide(F.sum("__s"), F.sum(have)).alias("var")
    sketches = [F.kll_merge_agg_double("kll", F.lit(KLL)).alias("kll"), F.hll_union_agg("hll").alias("hll")]
    return rows.groupBy(*by, "column").agg(*sums, var, F.min("min").alias("min"), F.max("max").alias("max"), *sketches)


def levels(df: DataFrame, categorical: list[str], by: list[str] = (), most: int = LEVELS) -> DataFrame:
    """(by..., column, level, n): the commonest levels of each column, by counts of all rows."""
    pair = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in categorical]))
    counts = df.select(*by, pair.alias("p")).where("p.level is not null").groupBy(*by, "p.column", "p.level").agg(F.count("*").alias("n"))
    return _commonest(counts, by, most)


def merge_levels(parts: DataFrame, by: list[str] = (), most: int = LEVELS) -> DataFrame:
    return _commonest(parts.groupBy(*by, "column", "level").agg(F.sum("n").alias("n")), by, most)


def _commonest(counts: DataFrame, by: list[str], most: int) -> DataFrame:
    w = Window.partitionBy(*by, "column").orderBy(F.desc("n"), "level")
    return counts.withColumn("__k", F.row_number().over(w)).where(F.col("__k") <= most).drop("__k")


def describe(profiles: DataFrame, by: list[str] = (), quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(by..., column, metric, value) of stored profiles, as ``detect_drift`` takes it."""
    have = F.col("n") - F.col("nulls")
    filled = F.when(F.col("min").isNotNull(), F.col("kll"))  # a sketch of no values has no quantiles
    pairs = {
        "mean": F.try_divide("sum", have),
        "std": F.sqrt(F.try_divide(F.col("var") * have, have - 1)),
        "min": F.col("min"),
        "max": F.col("max"),
        "null_pct": F.try_divide(F.col("nulls") * 100.0, "n"),
        "distinct": F.hll_sketch_estimate("hll").cast("double"),
        **{f"q{round(q * 100):02d}": F.kll_sketch_get_quantile_double(filled, F.lit(q)) for q in quantiles},
    }
    rows = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value")) for m, v in pairs.items()]))
    return profiles.select(*by, "column", rows.alias("p")).select(*by, "column", "p.metric", "p.value").where("value is not null")
