"""Checks, profiles, drift and scores of tables; each runs as one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfloom.functions.expr import clip, labels, ratio
from shelfloom.functions.quantile import exact_quantiles_of

LARGE_FORECAST, LARGE_PRICE, SMALL_PRICE = 1_000_000, 1_000_000, 0.01


def _sentences(*pairs: tuple[Column, str]) -> Column:
    return labels(*pairs)


def validate_forecast(df: DataFrame) -> DataFrame:
    """V1: from q50 and, where present, q05 and q95."""
    q50, q05, q95 = F.col("q50"), F.col("q05"), F.col("q95")
    errors = _sentences((q50.isNull(), "q50 missing"), (q50 < 0, "q50 negative"), (q05 < 0, "q05 negative"), (q95 < 0, "q95 negative"))
    warnings = _sentences((q50 > LARGE_FORECAST, "q50 very high"), (q05.isNull(), "q05 estimated"), (q05 > q50, "q05 above q50"), (q95.isNull(), "q95 estimated"), (q95 < q50, "q95 below q50"), (q50 == 0, "q50 zero"))
    df = df.withColumns({"errors": errors, "warnings": warnings, "q05": F.coalesce(q05, q50 * 0.7), "q95": F.coalesce(q95, q50 * 1.3)})
    df = df.withColumns({"is_valid": F.size("errors") == 0, "uncertainty": F.col("q95") - q50})
    df = df.withColumn("uncertainty_pct", F.when(q50 > 0, F.col("uncertainty") / q50 * 100).otherwise(0.0))
    u = F.col("uncertainty_pct")
    return df.withColumn("confidence_level", F.when(u < 10, "HIGH").when(u < 25, "MODERATE").otherwise("LOW"))


def validate_inventory(df: DataFrame) -> DataFrame:
    """V2."""
    stock, safety, rop = F.col("current_inventory"), F.col("safety_stock"), F.col("reorder_point")
    errors = _sentences((stock.isNull(), "current_inventory missing"), (stock < 0, "current_inventory negative"), (safety < 0, "safety_stock negative"), (rop < 0, "reorder_point negative"))
    warnings = _sentences((safety.isNull(), "safety_stock missing"), (rop.isNull(), "reorder_point missing"))
    df = df.withColumns({"errors": errors, "warnings": warnings, "safety_stock": F.coalesce(safety, F.lit(0.0)), "reorder_point": F.coalesce(rop, safety, F.lit(0.0))})
    return df.withColumns(
        {
            "is_valid": F.size("errors") == 0,
            "stockout_risk_pct": clip(F.col("stockout_risk_pct"), 0.0, 100.0),
            "overstock_risk_pct": clip(F.col("overstock_risk_pct"), 0.0, 100.0),
            "should_reorder": stock <= F.col("reorder_point"),
            "inventory_ratio": F.when(F.col("avg_demand") > 0, stock / F.col("avg_demand")),
        }
    )


def validate_pricing(df: DataFrame) -> DataFrame:
    """V3."""
    price, cost, new, off = F.col("current_price"), F.col("unit_cost"), F.col("recommended_price"), F.col("discount_pct")
    errors = _sentences((price.isNull(), "current_price missing"), (price < SMALL_PRICE, "current_price too low"), (cost < 0, "unit_cost negative"))
    warnings = _sentences((price > LARGE_PRICE, "current_price very high"), (cost.isNull(), "unit_cost estimated"), (new < SMALL_PRICE, "recommended_price too low"), ((off < 0) | (off > 1), "discount_pct out of range"), (new < cost, "sold at a loss"))
    df = df.withColumns({"errors": errors, "warnings": warnings, "unit_cost": F.coalesce(cost, price * 0.5), "recommended_price": F.when(new >= SMALL_PRICE, new).otherwise(price), "discount_pct": clip(off, 0.0, 1.0)})
    new, cost = F.col("recommended_price"), F.col("unit_cost")
    return df.withColumns({"is_valid": F.size("errors") == 0, "current_margin": F.coalesce(ratio(price - cost, price), F.lit(0.0)), "new_margin": F.coalesce(ratio(new - cost, new), F.lit(0.0)), "price_change_pct": F.coalesce(ratio(new - price, price) * 100, F.lit(0.0))})


def _tall(df: DataFrame, structs: list[Column]) -> DataFrame:
    return df.agg(F.array(*structs).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def range_check(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """V4: (column, below, above)."""
    return _tall(df, [F.struct(F.lit(c).alias("column"), F.count_if(F.col(c) < lo).alias("below"), F.count_if(F.col(c) > hi).alias("above")) for c, (lo, hi) in bounds.items()])


def consistency_check(df: DataFrame, rules: dict[str, tuple[Column, Column]], tolerance: float = 1e-6) -> DataFrame:
    """V5: (rule, max_diff, consistent) of columns against their definitions."""
    one = lambda name, a, b: F.struct(F.lit(name).alias("rule"), F.coalesce(F.max(F.abs(a - b)), F.lit(0.0)).alias("max_diff"), F.coalesce(F.max(F.abs(a - b)) <= tolerance, F.lit(True)).alias("consistent"))
    return _tall(df, [one(n, a, b) for n, (a, b) in rules.items()])


def missing_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, nulls, null_pct, mostly_missing)."""
    one = lambda c: F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("nulls"), F.coalesce(F.avg(F.col(c).isNull().cast("double")) * 100, F.lit(0.0)).alias("null_pct"))
    return _tall(df, [one(c) for c in columns or df.columns]).withColumn("mostly_missing", F.col("null_pct") > 50)


def duplicate_count(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that repeat an earlier one."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicates"))


def baseline_profile(df: DataFrame, numeric: list[str], categorical: list[str], top: int = 10) -> DataFrame:
    """Tidy (column, metric, value); the frequencies of the ``top`` levels are ``top:<level>``.

    Quantiles are exact, at the price of further passes; ``profiles`` has sketches of one pass that merge.
    """
    stats = []
    quantiles = exact_quantiles_of(df, numeric, [0.25, 0.5, 0.75])
    for c in numeric:
        x = F.col(c)
        q = dict(zip(("q25", "q50", "q75"), map(F.lit, quantiles[c]), strict=True))
        pairs = {"mean": F.avg(x), "std": F.stddev_samp(x), "min": F.min(x), "max": F.max(x), **q}
        stats += [F.struct(F.lit(c).alias("column"), F.lit(m).alias("metric"), v.cast("double").alias("value")) for m, v in pairs.items()]
    for c in [*numeric, *categorical]:
        stats += [F.struct(F.lit(c).alias("column"), F.lit("null_pct").alias("metric"), (F.avg(F.col(c).isNull().cast("double")) * 100).alias("value"))]
    stats += [F.struct(F.lit(c).alias("column"), F.lit("distinct").alias("metric"), F.count_distinct(c).cast("double").alias("value")) for c in categorical]
    out = _tall(df, stats)
    for c in categorical:
        levels = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n")).orderBy(F.desc("n"), c).limit(top)
        out = out.unionByName(levels.select(F.lit(c).alias("column"), F.concat(F.lit("top:"), F.col(c).cast("string")).alias("metric"), F.col("n").cast("double").alias("value")))
    return out


def detect_drift(base: DataFrame, now: DataFrame, sigmas: float = 2.0, null_points: float = 10.0) -> DataFrame:
    """Alerts where the mean or the share of nulls moved, from two baseline profiles."""
    wide = lambda p, s: p.groupBy("column").agg(*[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(f"{m}_{s}") for m in ("mean", "std", "null_pct")])
    both = wide(base, "base").join(wide(now, "now"), "column")
    moved = F.abs(F.col("mean_now") - F.col("mean_base")) > sigmas * F.col("std_base")
    holes = F.abs(F.col("null_pct_now") - F.col("null_pct_base")) > null_points
    alerts = labels((moved, "mean_drift"), (holes, "null_drift"))
    return both.select("column", F.col("mean_base"), F.col("mean_now"), alerts.alias("alerts")).withColumn("drifted", F.size("alerts") > 0)


def quality_score(df: DataFrame, required: list[str], keys: list[str], bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """V6: (score, grade, issues): 100 less what is wrong."""
    have = [c for c in required if c in df.columns]
    missing = len(required) - len(have)
    facts = df.agg(
        F.count("*").alias("n"),
        F.count_distinct(F.struct(*keys)).alias("distinct"),
        F.greatest(F.lit(0.0), *[F.coalesce(F.avg(F.col(c).isNull().cast("double")), F.lit(0.0)) for c in have]).alias("worst_null"),
        sum((F.when(F.count_if((F.col(c) < lo) | (F.col(c) > hi)) > 0, 1).otherwise(0) for c, (lo, hi) in bounds.items()), F.lit(0)).alias("out_of_range"),
    )
    copies = F.coalesce(F.try_divide(F.col("n") - F.col("distinct"), F.col("n")), F.lit(0.0)) > 0.01
    score = 100 - 10 * F.col("out_of_range") - 20 * missing - F.when(copies, 15).otherwise(0) - F.when(F.col("worst_null") > 0.5, 10).otherwise(0)
    out = facts.withColumns({"score": F.greatest(F.lit(0), score).cast("int"), "issues": labels((F.lit(missing > 0), "missing columns"), (copies, "duplicates"), (F.col("worst_null") > 0.5, "nulls"), (F.col("out_of_range") > 0, "out of range"))})
    s = F.col("score")
    return out.select("score", F.when(s >= 95, "excellent").when(s >= 85, "good").when(s >= 70, "fair").otherwise("poor").alias("grade"), "issues")


def expectations(df: DataFrame, checks: list[dict]) -> DataFrame:
    """V7: (check, success, observed) of all checks in one pass.

    Kinds: rows (min, max), exists, type, columns (count), not_null (mostly), between (min, max, mostly),
    unique (min share).
    """
    types, structs = dict(df.dtypes), []
    for c in checks:
        kind, col = c["kind"], c.get("column")
        label = F.lit(f"{kind}:{col}" if col else kind).alias("check")
        row = lambda ok, seen: F.struct(label, F.coalesce(ok, F.lit(False)).alias("success"), seen.cast("double").alias("observed"))  # noqa: E731, B023
        if kind == "rows":
            structs.append(row(F.count("*").between(c["min"], c["max"]), F.count("*")))
        elif kind in ("exists", "type", "columns"):
            ok = {"exists": col in types, "type": types.get(col) == c.get("type"), "columns": len(types) == c.get("count")}[kind]
            structs.append(row(F.lit(ok), F.lit(float(ok))))
        elif kind == "not_null":
            share = F.avg(F.col(col).isNotNull().cast("double"))
            structs.append(row(share >= c.get("mostly", 1.0), share))
        elif kind == "between":
            share = F.avg(F.when(F.col(col).isNotNull(), F.col(col).between(c["min"], c["max"]).cast("double")))
            structs.append(row(share >= c.get("mostly", 1.0), share))
        elif kind == "unique":
            share = F.try_divide(F.count_distinct(col), F.count(col))
            structs.append(row(share >= c["min"], share))
        else:
            raise ValueError(f"unknown check {kind}")
    return _tall(df, structs)


def expectation_summary(results: DataFrame) -> DataFrame:
    """V7: share of checks that hold, and the others."""
    return results.agg((F.avg(F.col("success").cast("double")) * 100).alias("success_pct"), F.sort_array(F.collect_list(F.when(~F.col("success"), F.col("check")))).alias("failed"))


def prediction_checks(df: DataFrame, columns: list[str]) -> DataFrame:
    """V8: (column, negatives, nulls, n, mean)."""
    one = lambda c: F.struct(F.lit(c).alias("column"), F.count_if(F.col(c) < 0).alias("negatives"), F.count_if(F.col(c).isNull()).alias("nulls"), F.count("*").alias("n"), F.avg(c).alias("mean"))
    return _tall(df, [one(c) for c in columns])


#: Bounds that metrics are held against: (metric, least, most).
METRIC_BOUNDS = (("mae", 0.0, 100.0), ("rmse", 0.0, 100.0), ("r2", 0.7, 1.0), ("coverage", 0.8, 1.0))


def metric_bounds(metrics: DataFrame, bounds=METRIC_BOUNDS) -> DataFrame:
    """V9: (model, metric, value) that lie outside."""
    table = metrics.sparkSession.createDataFrame(list(bounds), "metric string, least double, most double")
    rows = metrics.join(F.broadcast(table), "metric")
    return rows.where((F.col("value") < F.col("least")) | (F.col("value") > F.col("most"))).select("model", "metric", "value")


def quality_rollup(scores: DataFrame) -> DataFrame:
    """The latest score of each dataset, rolled up."""
    last = scores.groupBy("dataset").agg(F.max_by("score", "ts").alias("score"), F.max_by("issues", "ts").alias("issues"))
    return last.agg(F.count("*").alias("datasets"), F.avg("score").alias("avg_score"), F.min("score").alias("min_score"), F.max("score").alias("max_score"), F.sum("issues").alias("issues"))
