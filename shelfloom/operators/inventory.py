"""Stock rules as column expressions over one row per product (and store), and the stock ledger."""

from __future__ import annotations

from dataclasses import dataclass
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfloom.functions.expr import clip, hash_uniform, norm_cdf, ratio, steps
from shelfloom.operators.clean import head_per_series


@dataclass(frozen=True)
class InventoryConfig:
    service_level: float = 0.95
    lead_time: int = 7
    review_period: int = 1
    ordering_cost: float = 50.0
    holding_rate: float = 0.2
    unit_cost: float = 10.0
    shelf_life: int = 14

    @property
    def z(self) -> float:
        return NormalDist().inv_cdf(self.service_level)

    @property
    def holding(self) -> float:
        return self.unit_cost * self.holding_rate


C = InventoryConfig()


def safety_stock(std: Column, c: InventoryConfig = C) -> Column:
    """B1."""
    return F.greatest(F.lit(0.0), std * (c.z * (c.lead_time + c.review_period) ** 0.5))


def safety_stock_quantile(q50: Column, q95: Column) -> Column:
    """B1, without a distribution."""
    return q95 - q50


def reorder_point(demand: Column, stock: Column, c: InventoryConfig = C) -> Column:
    """B2."""
    return demand * c.lead_time + stock


def order_costs(annual: Column, quantity: Column, c: InventoryConfig = C) -> dict[str, Column]:
    """What follows from an order quantity."""
    orders = ratio(annual, quantity)
    return {
        "orders_per_year": orders,
        "ordering_cost": orders * c.ordering_cost,
        "holding_cost": quantity / 2 * c.holding,
        "total_cost": orders * c.ordering_cost + quantity / 2 * c.holding,
        "order_interval_days": ratio(F.lit(365.0), orders),
    }


def eoq(annual: Column, c: InventoryConfig = C, holding: Column | None = None) -> Column:
    """The economic order quantity."""
    return F.sqrt(ratio(annual * (2 * c.ordering_cost), holding if holding is not None else F.lit(c.holding)))


def eoq_shelf_life(df: DataFrame, annual: Column, daily: Column, c: InventoryConfig = C) -> DataFrame:
    """No more than what sells within the shelf life."""
    df = df.withColumns({"eoq_unconstrained": eoq(annual, c), "max_sellable": daily * c.shelf_life})
    df = df.withColumn("eoq", F.least("eoq_unconstrained", "max_sellable"))
    df = df.withColumns(order_costs(annual, F.col("eoq"), c))
    return df.withColumn("constraint_reason", F.when(F.col("eoq") < F.col("eoq_unconstrained"), "shelf_life_limited").otherwise("optimal_eoq"))


def stockout_probability(stock: Column, demand: Column, std: Column, horizon: int, service_level: float = 0.95, clipped: bool = True) -> Column:
    """Clipped to 0.6 to 1.4 of the accepted rate unless asked otherwise."""
    spread = std * horizon**0.5
    raw = 1 - norm_cdf(ratio(stock - demand * horizon, spread))
    out = clip(raw, (1 - service_level) * 0.6, (1 - service_level) * 1.4) if clipped else raw
    return F.when(spread == 0, F.when(stock < demand * horizon, 1.0).otherwise(0.0)).otherwise(out)


def optimize_inventory(forecasts: DataFrame, keys: list[str], time: str, c: InventoryConfig = C, horizon: int = 30, inventory: str | None = None) -> DataFrame:
    """All series at once, from the first ``horizon`` forecast rows of each.

    Stock on hand is the column ``inventory`` if there is one, else 1.5 times the reorder point.
    """
    rows = head_per_series(forecasts, keys, time, horizon)
    extra = [F.first(inventory, True).alias("current_inventory")] if inventory else []
    df = rows.groupBy(*keys).agg(F.avg("forecast_q05").alias("q05"), F.avg("forecast_q50").alias("avg_daily_demand"), F.avg("forecast_q95").alias("q95"), *extra)
    d = F.col("avg_daily_demand")
    df = df.withColumns({"demand_std": (F.col("q95") - F.col("q05")) / (2 * 1.645), "annual_demand": d * 365, "safety_stock": safety_stock_quantile(d, F.col("q95")), "lead_time_demand": d * c.lead_time})
    df = df.withColumn("reorder_point", reorder_point(d, F.col("safety_stock"), c))
    df = eoq_shelf_life(df, F.col("annual_demand"), d, c)
    if not inventory:
        df = df.withColumn("current_inventory", F.col("reorder_point") * 1.5)
    stock, rop = F.col("current_inventory"), F.col("reorder_point")
    over = norm_cdf(ratio(rop * 2 - stock, F.col("demand_std") * c.lead_time**0.5))
    return df.withColumns(
        {
            "days_until_reorder": F.greatest(F.lit(0.0), ratio(stock - rop, d)),
            "should_reorder": stock <= rop,
            "stockout_risk": stockout_probability(stock, d, F.col("demand_std"), c.lead_time, c.service_level),
            "stockout_risk_raw": stockout_probability(stock, d, F.col("demand_std"), c.lead_time, c.service_level, clipped=False),
            "overstock_risk": F.when(F.col("demand_std") > 0, over).otherwise(0.0),
        }
    )


def inventory_metrics(df: DataFrame, c: InventoryConfig = C) -> DataFrame:
    """From avg_daily_demand, demand_std, current_inventory and unit_cost."""
    d, s, stock, cost = (F.col(x) for x in ("avg_daily_demand", "demand_std", "current_inventory", "unit_cost"))
    root = c.lead_time**0.5
    df = df.withColumns({"safety_stock": F.greatest(F.lit(0.0), s * (c.z * root)), "lead_time_demand": d * c.lead_time, "annual_demand": d * 365, "holding_per_unit": cost * c.holding_rate})
    df = df.withColumns({"reorder_point": F.col("lead_time_demand") + F.col("safety_stock"), "eoq": eoq(F.col("annual_demand"), c, F.col("holding_per_unit"))})
    short = F.when(s > 0, (1 - norm_cdf(ratio(stock - F.col("lead_time_demand"), s * root))) * 100).otherwise(F.when(stock >= F.col("lead_time_demand"), 0.0).otherwise(100.0))
    df = df.withColumns({"stockout_risk_pct": short, "days_of_stock": F.coalesce(ratio(stock, d), F.lit(999.0)), "should_reorder": stock <= F.col("reorder_point")})
    df = df.withColumn("overstock_risk_pct", clip((F.coalesce(ratio(stock, d), F.lit(0.0)) - 10) * 10, 0.0, 100.0))
    risk, over = F.col("stockout_risk_pct"), F.col("overstock_risk_pct")
    level = 1 - risk / 100
    df = df.withColumns(
        {
            "service_level_actual": level,
            "inventory_turnover": F.coalesce(ratio(F.col("annual_demand"), F.col("eoq") / 2 + F.col("safety_stock")), F.lit(0.0)),
            "fill_rate_expected": F.least(F.lit(0.99), level * 1.02),
            "holding_cost_daily": stock * F.col("holding_per_unit") / 365,
            "ordering_cost_per_cycle": F.coalesce(ratio(F.col("annual_demand"), F.col("eoq")) * c.ordering_cost / 365, F.lit(0.0)),
        }
    )
    return df.withColumns(
        {
            "total_cost_daily": F.col("holding_cost_daily") + F.col("ordering_cost_per_cycle"),
            "reorder_urgency": F.when(risk > 70, "CRITICAL").when(risk > 50, "HIGH").when(F.col("should_reorder"), "MEDIUM").otherwise("LOW"),
            "risk_category": F.when((risk > 50) & (over > 50), "CRITICAL").when(risk > 50, "STOCKOUT_RISK").when(over > 60, "OVERSTOCK_RISK").otherwise("BALANCED"),
            "reasoning": F.when(risk > 70, F.format_string("reorder now: stockout risk %d%%", F.round(risk).cast("long")))
            .when(F.col("should_reorder"), F.format_string("reorder: stock %d is below %d", F.round(stock).cast("long"), F.round("reorder_point").cast("long")))
            .when(over > 60, F.format_string("consider markdowns: overstock risk %d%%", F.round(over).cast("long")))
            .otherwise("keep monitoring"),
        }
    )


def inventory_risk_view(df: DataFrame) -> DataFrame:
    """From avg_daily_demand, demand_std, lead_time_demand, safety_stock and current_inventory."""
    daily = F.nullif(F.col("avg_daily_demand"), F.lit(0.0))
    ltd, stock = F.col("lead_time_demand"), F.col("current_inventory")
    df = df.withColumn("lead_time_days", clip(F.coalesce(ltd / daily, F.lit(7.0)), 1.0, 30.0))
    spread = F.nullif(F.col("demand_std") * F.sqrt("lead_time_days"), F.lit(0.0))
    short = F.coalesce((1 - norm_cdf((stock - ltd) / spread)) * 100, F.when(stock >= ltd, 0.0).otherwise(5.0))
    df = df.withColumns({"stockout_risk_pct": F.round(clip(short, 0.0, 7.0), 2), "target_days": clip(F.coalesce((ltd + F.col("safety_stock")) / daily, F.col("lead_time_days")), 1.0, 60.0)})
    days = F.coalesce(stock / daily, F.col("target_days"))
    return df.withColumn("overstock_risk_pct", F.round(clip((days - F.col("target_days")) / F.col("target_days") * 100, 0.0, 95.0), 2))


def demand_stats(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """A6."""
    return df.groupBy(*keys).agg(F.avg(column).alias("avg_demand"), F.stddev_samp(column).alias("demand_std"))


def forecast_risk(df: DataFrame, uniform: Column | None = None) -> DataFrame:
    """By product, with stock of about 2.5 (+- 0.3) mean forecasts and a buffer of 0.3."""
    stats = demand_stats(df, ["product_id"], "forecast_q50")
    u = uniform if uniform is not None else hash_uniform(F.col("product_id"), seed=42)
    mean, std = F.col("avg_demand"), F.col("demand_std")
    stock = mean * F.greatest(F.lit(1.0), 2.2 + 0.6 * u) + mean * 0.3
    short = F.when(std > 0, 1 - norm_cdf((stock - mean * 2) / (std * 2**0.5))).otherwise(0.0)
    over = steps(stock / mean, [(3.0, 5.0), (4.0, 15.0), (6.0, 30.0), (8.0, 60.0)], 80.0)
    alive = F.coalesce(mean > 0, F.lit(False))
    return stats.withColumns({"stockout_risk_pct": F.when(alive, clip(short * 100, 0.0, 95.0)).otherwise(0.0), "overstock_risk_pct": F.when(alive, clip(over, 0.0, 95.0)).otherwise(0.0)})


def inventory_snapshot(df: DataFrame, uniform: Column | None = None) -> DataFrame:
    """Whole stock of 1.5 to 3 mean demands, and its ratio."""
    stats = demand_stats(df, ["product_id", "store_id"], "sales_quantity")
    u = uniform if uniform is not None else hash_uniform(F.col("product_id"), F.col("store_id"), seed=42)
    stats = stats.withColumn("current_inventory", F.floor(F.col("avg_demand") * (1.5 + 1.5 * u)).cast("long"))
    return stats.withColumn("inventory_ratio", ratio(F.col("current_inventory"), F.col("avg_demand")))


@dataclass(frozen=True)
class LedgerConfig:
    shelf_life: int = 14
    initial: float = 100.0
    unit_cost: float = 10.0
    unit_price: float = 15.0
    holding_cost: float = 0.1
    spoilage_penalty: float = 5.0
    stockout_penalty: float = 8.0


def ledger(df: DataFrame, keys: list[str], time: str, demand: str, order: str, c: LedgerConfig = LedgerConfig(), strict: bool = False) -> DataFrame:
    """Day by day stock of each series in closed form.

    Units age by day whatever is sold, so spoilage follows from the orders; stock after sales is a
    running sum less its running minimum.  ``strict`` keeps negative sales where spoilage exceeds stock.
    """
    w = Window.partitionBy(*keys).orderBy(time)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = df.withColumns({"__i": F.row_number().over(w) - 1, "__old": F.floor(F.coalesce(F.lag(order, c.shelf_life + 2).over(w), F.lit(0.0)))})
    rows = rows.withColumn("spoiled", F.col("__old") + F.when(F.col("__i") == c.shelf_life + 1, float(int(c.initial))).otherwise(0.0))
    rows = rows.withColumn("__in", F.when(F.col("__i") == 0, c.initial).otherwise(F.lag(order).over(w)))
    rows = rows.withColumn("__s", F.sum(F.col("__in") - F.col("spoiled") - F.col(demand)).over(run))
    rows = rows.withColumn("__post", F.col("__s") - F.least(F.lit(0.0), F.min("__s").over(run)))
    available = F.coalesce(F.lag("__post").over(w), F.lit(0.0)) + F.col("__in") - F.col("spoiled")
    rows = rows.withColumn("available", available)
    sold = F.least(F.col(demand), F.col("available"))
    rows = rows.withColumns({"sold": sold if strict else F.greatest(F.lit(0.0), sold), "stockout": F.greatest(F.lit(0.0), F.col(demand) - F.col("available")), "inventory": F.col("__post") + F.col(order)})
    rows = rows.withColumns(
        {
            "spoilage_cost": F.col("spoiled") * c.spoilage_penalty,
            "stockout_cost": F.col("stockout") * c.stockout_penalty,
            "holding_cost": F.col("inventory") * c.holding_cost,
            "revenue": F.col("sold") * c.unit_price,
            "cogs": F.col("sold") * c.unit_cost,
        }
    )
    return rows.withColumn("profit", F.col("revenue") - F.col("cogs") - F.col("spoilage_cost") - F.col("stockout_cost") - F.col("holding_cost")).drop("__i", "__old", "__in", "__s", "__post")


def backtest_kpis(rows: DataFrame, demand: str, by: str = "strategy") -> DataFrame:
    """A18."""
    s = lambda c: F.sum(c)
    pct = lambda a, b: F.coalesce(F.try_divide(a, b) * 100, F.lit(0.0))
    return rows.groupBy(by).agg(
        pct(s("spoiled"), s("sold") + s("spoiled")).alias("spoilage_rate_pct"),
        pct(s("stockout"), s(demand)).alias("stockout_rate_pct"),
        pct(s("sold"), s(demand)).alias("fill_rate_pct"),
        s("revenue").alias("total_revenue"),
        s("profit").alias("total_profit"),
        pct(s("profit"), s("revenue")).alias("profit_margin_pct"),
        F.avg("inventory").alias("avg_inventory"),
    )


def policies(df: DataFrame, keys: list[str], time: str, demand: str) -> DataFrame:
    """The orders of both policies: a 7-day mean of demand, or the median forecast."""
    w = Window.partitionBy(*keys).orderBy(time).rowsBetween(-6, 0)
    df = df.withColumn("__mean", F.avg(demand).over(w))
    both = F.array(*[F.struct(F.lit(n).alias("strategy"), F.col(c).cast("double").alias("order_quantity")) for n, c in (("baseline", "__mean"), ("forecast", "forecast_q50"))])
    return df.select("*", F.explode(both).alias("__p")).select("*", "__p.strategy", "__p.order_quantity").drop("__p", "__mean")


def backtest_compare(df: DataFrame, keys: list[str], time: str, demand: str, c: LedgerConfig = LedgerConfig()) -> DataFrame:
    """Both policies' rates and what the forecast improves; lower is better for losses."""
    rows = ledger(policies(df, keys, time, demand), [*keys, "strategy"], time, demand, "order_quantity", c)
    kpis = backtest_kpis(rows, demand)
    tall = kpis.unpivot("strategy", ["spoilage_rate_pct", "stockout_rate_pct", "profit_margin_pct"], "metric", "value")
    pick = lambda s: F.max(F.when(F.col("strategy") == s, F.col("value")))
    out = tall.groupBy("metric").agg(pick("baseline").alias("baseline"), pick("forecast").alias("forecast"))
    better = F.when(F.col("metric").startswith("profit"), F.col("forecast") - F.col("baseline")).otherwise(F.col("baseline") - F.col("forecast"))
    return out.withColumns({"improvement": better, "improvement_pct": F.when(F.col("baseline") > 0, better / F.col("baseline") * 100).otherwise(0.0)})
