"""Aggregation to series and the complete grid of series and periods."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from shelfloom.operators.clean import drop_zero_sales
from shelfloom.spec import SeriesSpec


def aggregate_series(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """A1: sums of target and measures, maxima of flags, by series and time; columns that exist."""
    have = set(df.columns)
    sums = [c for c in (spec.target, *spec.measures) if c in have]
    flags = [c for c in spec.flags if c in have]
    return df.groupBy(*spec.keys, spec.time).agg(*[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in flags])


def aggregate_rules(df: DataFrame, keys: list[str], rules: dict[str, str]) -> DataFrame:
    """A2: column -> sum, mean or count."""
    how = {"sum": F.sum, "mean": F.avg, "count": F.count}
    return df.groupBy(*keys).agg(*[how[rule](c).alias(f"{c}_{rule}") for c, rule in rules.items()])


def periods(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """The time axis: the spec's range, or the periods observed."""
    if spec.axis:
        return df.sparkSession.range(spec.axis[0], spec.axis[1] + 1).select(F.col("id").cast(df.schema[spec.time].dataType).alias(spec.time))
    return df.select(spec.time).distinct()


def grid_cross(df: DataFrame, spec: SeriesSpec, full: bool = False) -> DataFrame:
    """Active series (or all combinations of key values) times all periods.

    The product is the result itself: its size is series times periods, and the periods, a few
    thousand at most for years of hours, are the side that is replicated.
    """
    series = df.select(*spec.keys).distinct()
    if full:
        series = df.select(spec.keys[0]).distinct()
        for k in spec.keys[1:]:
            series = series.crossJoin(df.select(k).distinct())
    axis = periods(df, spec).agg(F.sort_array(F.collect_set(spec.time)).alias("__axis"))
    return series.crossJoin(F.broadcast(axis)).select(*spec.keys, F.explode("__axis").alias(spec.time))


def grid_fill(grid: DataFrame, values: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Values at their cells, 0 elsewhere."""
    keys = [*spec.keys, spec.time]
    fill = [c for c in values.columns if c not in keys]
    return grid.join(values, keys, "left").fillna(0, fill)


def complete(values: DataFrame, spec: SeriesSpec, fill: bool = True) -> DataFrame:
    """A row of every series for every period: the given one, or one of zeros (nulls, if not ``fill``).

    values has one row for each series and time.  They are shuffled once, to one list a series (as long
    as the axis at most), and what the list lacks is added to it: no grid is joined, and what follows by
    series needs no shuffle.  Rows without a time, or off the spec's axis, are left out; series stay.
    """
    keys = list(spec.keys)
    names = [c for c in values.columns if c not in (*keys, spec.time)]
    numeric = {f.name: isinstance(f.dataType, NumericType) for f in values.schema.fields}
    series = values.groupBy(*keys).agg(F.collect_list(F.struct(spec.time, *names)).alias("__rows"))
    kind = values.schema[spec.time].dataType.simpleString()
    if spec.axis:
        axis = F.transform(F.sequence(F.lit(spec.axis[0]), F.lit(spec.axis[1])), lambda t: t.cast(kind))
        series = series.withColumn("__axis", axis)
    else:
        times = series.select(F.explode(F.col("__rows")[spec.time]).alias("t")).agg(F.collect_set("t").alias("__axis"))
        series = series.crossJoin(F.broadcast(times))
    known = F.filter("__rows", lambda x: x[spec.time].between(*spec.axis)) if spec.axis else F.filter("__rows", lambda x: x[spec.time].isNotNull())
    blank = lambda c: (F.lit(0) if fill and numeric[c] else F.lit(None)).cast(values.schema[c].dataType).alias(c)
    missing = F.transform(F.array_except("__axis", F.col("__rows")[spec.time]), lambda t: F.struct(t.alias(spec.time), *[blank(c) for c in names]))
    out = series.select(*keys, F.inline(F.concat(known, missing)))
    return out.fillna(0, [c for c in names if numeric[c]]) if fill else out


def master_grid(df: DataFrame, spec: SeriesSpec, full: bool = False) -> DataFrame:
    """FE1: active series (or all combinations of keys) at all periods, 0 where nothing was sold."""
    values = drop_zero_sales(aggregate_series(df, spec.check()), spec)
    return grid_fill(grid_cross(values, spec, True), values, spec) if full else complete(values, spec)
