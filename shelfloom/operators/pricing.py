"""Discount and price rules as column expressions, and scenarios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfloom.functions.expr import labels, ratio

#: Price elasticity by category; any other is -1.
ELASTICITY = {"fresh_produce": -1.5, "dairy": -1.2, "packaged": -0.8}
#: Demand and price changes of the scenarios.
SCENARIOS = (("baseline", 0.0, 0.0), ("best_case", 0.2, -0.1), ("worst_case", -0.2, 0.1), ("promotion", 0.5, -0.3))


def pricing_inputs(forecasts: DataFrame, inventory: DataFrame, keys: list[str]) -> DataFrame:
    """Stock ratio by key and the forecast against mean sales; 1 where unknown."""
    from shelfloom.operators.relational import attach_inventory

    rows = attach_inventory(forecasts, inventory, keys)
    mean = forecasts.agg(F.avg("sales_quantity").alias("__mean"))
    return rows.crossJoin(F.broadcast(mean)).withColumns({"demand_ratio": F.coalesce(ratio(F.col("forecast_q50"), F.col("__mean")), F.lit(1.0)), "inventory_ratio": F.coalesce("inventory_ratio", F.lit(1.0))}).drop("__mean")


def discount_rule(stock: Column, demand: Column, at: Column | float = 0.5) -> dict[str, Column]:
    """A range of discounts for each case, taken at the share ``at`` of the range."""
    at = at if isinstance(at, Column) else F.lit(at)
    cases = [
        (stock >= 3.0, 0.40, 0.50, "clearance", "critical overstock"),
        ((stock >= 2.0) & (demand <= 0.8), 0.25, 0.40, "large_discount", "high stock, low demand"),
        ((stock >= 2.0) & (demand < 1.2), 0.15, 0.25, "medium_discount", "high stock"),
        (stock >= 2.0, 0.05, 0.15, "small_discount", "high stock, strong demand"),
        ((stock >= 1.0) & (demand <= 0.8), 0.05, 0.10, "small_discount", "weak demand"),
    ]
    out = {}
    for name, value, rest in (("discount_pct", lambda c: F.lit(c[1]) + at * (c[2] - c[1]), F.lit(0.0)), ("action", lambda c: F.lit(c[3]), F.lit("maintain")), ("reason", lambda c: F.lit(c[4]), F.lit("balanced or low stock"))):
        chain = F.when(cases[0][0], value(cases[0]))
        for c in cases[1:]:
            chain = chain.when(c[0], value(c))
        out[name] = chain.otherwise(rest)
    return out


def recommend_price(df: DataFrame, min_margin: float = 0.10, at: Column | float = 0.5) -> DataFrame:
    """The discounted price, not under cost plus margin; a floor above the price is not applied."""
    df = df.withColumns(discount_rule(F.col("inventory_ratio"), F.col("demand_ratio"), at))
    price, cost = F.col("current_price"), F.col("cost")
    floor = cost * (1 + min_margin)
    asked = price - price * F.col("discount_pct")
    df = df.withColumns({"floored": asked < floor, "recommended_price": F.greatest(asked, floor)})
    new = F.col("recommended_price")
    df = df.withColumn("discount_pct", F.when(F.col("floored"), F.coalesce(ratio(price - new, price), F.lit(0.0))).otherwise(F.col("discount_pct")))
    return df.withColumns({"discount_amount": price - new, "profit_per_unit": new - cost, "profit_margin": F.coalesce(ratio(new - cost, new), F.lit(0.0)), "should_apply": F.col("discount_pct") > 0})


def price_impact(df: DataFrame) -> DataFrame:
    """Fixed discounts, elasticity of demand, and what they do to revenue and profit."""
    stock, demand = F.col("inventory_ratio"), F.col("demand_ratio")
    price, cost, sold = F.col("current_price"), F.col("cost"), F.col("demand")
    cases = [(stock >= 3.0, 0.45, "clearance"), ((stock >= 2.0) & (demand <= 0.8), 0.30, "large_discount"), ((stock >= 2.0) & (demand < 1.2), 0.18, "medium_discount"), (stock >= 2.0, 0.08, "small_discount"), ((stock >= 1.5) & (demand <= 0.8), 0.08, "small_discount")]
    off, action = F.when(cases[0][0], cases[0][1]), F.when(cases[0][0], cases[0][2])
    for cond, d, a in cases[1:]:
        off, action = off.when(cond, d), action.when(cond, a)
    df = df.withColumns({"discount_pct": off.otherwise(0.0), "action": action.otherwise("maintain")})
    df = df.withColumn("recommended_price", F.greatest(price * (1 - F.col("discount_pct")), cost * 1.1))
    new = F.col("recommended_price")
    df = df.withColumn("discount_pct", F.when(price * (1 - F.col("discount_pct")) < cost * 1.1, ratio(price - new, price)).otherwise(F.col("discount_pct")))
    elasticity = F.lit(-1.0)
    for k, v in ELASTICITY.items():
        elasticity = F.when(F.col("category") == k, v).otherwise(elasticity)
    df = df.withColumn("price_change_pct", ratio(new - price, price) * 100)
    df = df.withColumn("demand_change_pct", elasticity * F.col("price_change_pct"))
    later = sold * (1 + F.col("demand_change_pct") / 100)
    d = F.col("discount_pct")
    df = df.withColumns(
        {
            "current_margin": ratio(price - cost, price),
            "new_margin": ratio(new - cost, new),
            "revenue_change": new * later - price * sold,
            "profit_change": (new - cost) * later - (price - cost) * sold,
            "priority": F.when(stock > 3.0, "CRITICAL").when((stock > 2.0) & (demand < 0.8), "HIGH").when(d > 0.15, "MEDIUM").otherwise("LOW"),
            "competitive_position": F.when(d > 0.3, "AGGRESSIVE").when(d > 0.1, "COMPETITIVE").otherwise("PREMIUM"),
        }
    )
    why = labels((stock > 2.5, "critical overstock"), ((stock > 1.8) & (stock <= 2.5), "high stock"), (demand < 0.8, "weak demand"), (demand > 1.2, "strong demand"), (F.col("profit_change") < 0, "profit falls"), (F.col("profit_change") > 0, "profit rises"))
    return df.withColumn("reason", F.when(F.size(why) > 0, F.array_join(why, " + ")).otherwise("balanced"))


def scenario_analysis(df: DataFrame, demand: str, price: str, scenarios=SCENARIOS) -> DataFrame:
    """Revenue change in per cent and mean demand of each scenario; one pass over the rows."""
    base = F.sum(F.col(demand) * F.col(price))
    out = df.agg(base.alias("base"), F.avg(demand).alias("mean"))
    rows = F.array(*[F.struct(F.lit(n).alias("scenario"), F.lit(d).alias("demand_change"), F.lit(p).alias("price_change")) for n, d, p in scenarios])
    out = out.select("base", "mean", F.explode(rows).alias("s")).select("s.*", "base", "mean")
    factor = (1 + F.col("demand_change")) * (1 + F.col("price_change"))
    return out.select("scenario", "demand_change", "price_change", F.when(F.col("base") > 0, (factor - 1) * 100).otherwise(0.0).alias("revenue_change_pct"), (F.col("mean") * (1 + F.col("demand_change"))).alias("avg_demand"))


def pricing_report(df: DataFrame) -> DataFrame:
    """One row of totals."""
    return df.agg(F.count("*").alias("products"), F.count_if(F.col("discount_pct") > 0).alias("discounted"), (F.avg(F.when(F.col("discount_pct") > 0, F.col("discount_pct"))) * 100).alias("mean_discount_pct"), F.avg("profit_margin").alias("mean_margin"))


def action_counts(df: DataFrame) -> DataFrame:
    """Recommendations by action."""
    return df.groupBy("action").agg(F.count("*").alias("n"))
