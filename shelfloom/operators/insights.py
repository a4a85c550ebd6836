"""Labels, causes, actions and priorities from forecasts, stock and prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfloom.functions.expr import labels, ratio
from shelfloom.operators.inventory import inventory_metrics
from shelfloom.operators.pricing import price_impact
from shelfloom.operators.quality import validate_forecast, validate_pricing
from shelfloom.operators.relational import combine_modules, lookup_default


def representative_row(df: DataFrame, key: str, order: str) -> DataFrame:
    """Per key the mean of numeric columns, and of the others the value of the first row."""
    numeric = ("int", "bigint", "double", "float", "smallint")
    means = [F.avg(c).alias(c) for c, t in df.dtypes if c != key and t in numeric]
    firsts = [F.min_by(c, order).alias(c) for c, t in df.dtypes if c != key and t not in numeric]
    return df.groupBy(key).agg(*means, *firsts)


def trend_labels(df: DataFrame) -> DataFrame:
    """From vs_yesterday, vs_last_week, q50, uncertainty_pct, both risks, stock, price and cost."""
    day, week = F.col("vs_yesterday"), F.col("vs_last_week")
    u, short, over = F.col("uncertainty_pct"), F.col("stockout_risk_pct"), F.col("overstock_risk_pct")
    level = lambda c: F.when(c >= 70, "CRITICAL").when(c >= 50, "HIGH").when(c >= 30, "MODERATE").otherwise("LOW")
    return df.withColumns(
        {
            "confidence_level": F.when(u < 10, "HIGH").when(u < 25, "MODERATE").otherwise("LOW"),
            "trend": F.when((day > 10) | (week > 10), "STRONG UPWARD").when((day > 5) | (week > 5), "UPWARD").when((day < -10) | (week < -10), "STRONG DOWNWARD").when((day < -5) | (week < -5), "DOWNWARD").otherwise("STABLE"),
            "stockout_level": level(short),
            "overstock_level": level(over),
            "stockout_status": F.when(short >= 70, "IMMEDIATE ACTION REQUIRED").when(short >= 50, "MONITOR CLOSELY").otherwise("MANAGEABLE"),
            "overstock_status": F.when(over >= 60, "URGENT CLEARANCE NEEDED").when(over >= 40, "CONSIDER MARKDOWNS").otherwise("ACCEPTABLE"),
            "days_of_stock": F.coalesce(ratio(F.col("current_inventory"), F.col("q50")), F.lit(0.0)),
            "margin": F.coalesce(ratio(F.col("current_price") - F.col("unit_cost"), F.col("current_price")), F.lit(0.0)),
        }
    )


def rule_insights(df: DataFrame) -> DataFrame:
    """Causes, impact and actions from labelled rows with features (array of attribution names), action and discount."""
    has = lambda word: F.exists("features", lambda f: F.lower(f).contains(word))
    causes = labels((has("promo"), "promotion"), (has("price"), "price"), (has("lag"), "history"))
    short, over = F.col("stockout_risk_pct"), F.col("overstock_risk_pct")
    actions = labels(
        (short > 50, "URGENT: reorder"),
        ((short <= 50) & F.col("should_reorder"), "HIGH: reorder"),
        (over > 50, "URGENT: markdown"),
        (F.col("action") != "maintain", "HIGH: adjust price"),
    )
    impact = F.when(F.col("trend").contains("UPWARD"), "growth").when(F.col("trend").contains("DOWNWARD"), "decline").otherwise("stable")
    return df.withColumns(
        {
            "causes": F.when(F.size(causes) > 0, causes).otherwise(F.array(F.lit("normal market"))),
            "impact": impact,
            "actions": F.when(F.size(actions) > 0, actions).otherwise(F.array(F.lit("MEDIUM: monitor"))),
            "insight_text": F.format_string("%s: demand %d, %s; stock %d", F.col("product_id").cast("string"), F.floor("q50").cast("long"), impact, F.floor("current_inventory").cast("long")),
        }
    )


def priority_insights(forecasts: DataFrame, inventory: DataFrame, pricing: DataFrame, key: str = "product_id", n: int = 20) -> DataFrame:
    """The n largest median forecasts with what to do about them."""
    top = forecasts.orderBy(F.desc("forecast_q50"), key).limit(n)
    top = lookup_default(top, inventory, key, {"current_inventory": 100.0, "reorder_point": 80.0, "stockout_risk_pct": 10.0})
    top = lookup_default(top, pricing, key, {"current_price": 10000.0, "recommended_price": 10000.0, "discount_pct": 0.0})
    q, short, off = F.col("forecast_q50"), F.col("stockout_risk_pct"), F.col("discount_pct")
    wide = F.coalesce(ratio(F.col("forecast_q95") - F.col("forecast_q05"), q) > 0.3, F.lit(False))
    low = F.col("current_inventory") < F.col("reorder_point")
    return top.withColumns(
        {
            "priority": F.when(short > 50, "CRITICAL").when(low | wide, "HIGH").otherwise("MEDIUM"),
            "actions": labels((short > 50, "reorder now"), ((short <= 50) & low, "reorder"), (off > 0.2, "discount"), ((off > 0) & (off <= 0.2), "consider discount")),
            "components": F.array(F.when(wide, "forecast uncertain").otherwise("forecast stable"), F.when(short > 50, "stockout likely").when(low, "stock low").otherwise("stock adequate"), F.when(off > 0.2, "large markdown").when(off > 0, "small markdown").otherwise("price kept")),
            "confidence": F.lit(0.85),
        }
    )


def validated_insights(df: DataFrame) -> DataFrame:
    """Forecasts checked, stock metrics, prices, and a status for each product.

    From q05, q50, q95, current_inventory, unit_cost, current_price and category.
    """
    rows = validate_forecast(df)
    rows = rows.withColumnsRenamed({"errors": "forecast_errors", "warnings": "forecast_warnings", "is_valid": "forecast_valid"})
    rows = rows.withColumns({"avg_daily_demand": F.col("q50"), "demand_std": F.greatest(F.lit(0.0), (F.col("q95") - F.col("q50")) / 1.645)})
    rows = inventory_metrics(rows).drop("reasoning")
    rows = rows.withColumns({"inventory_ratio": F.coalesce(ratio(F.col("current_inventory"), F.col("q50")), F.lit(0.0)), "demand_ratio": F.lit(1.0), "cost": F.col("unit_cost"), "demand": F.col("q50")})
    rows = validate_pricing(price_impact(rows).drop("reason"))
    status = F.when(~F.col("forecast_valid"), "error").when(~F.col("is_valid"), "price error").otherwise("ok")
    return rows.withColumn("status", status)


__all__ = ["combine_modules", "priority_insights", "representative_row", "rule_insights", "trend_labels", "validated_insights"]
