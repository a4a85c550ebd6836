"""Enrichment joins.

A dimension is broadcast by the optimizer when its measured size allows; nothing is forced, so a
dimension that grows is shuffled instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(facts: DataFrame, dimension: DataFrame, key: str, categories: list[str]) -> DataFrame:
    """Left join of one row per key; absent categories are 'Unknown'."""
    one = dimension.groupBy(key).agg(*[F.min(c).alias(c) for c in categories])
    return facts.drop(*[c for c in categories if c in facts.columns]).join(one, key, "left").fillna("Unknown", categories)


def match_ratio(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Share of fact rows that have a dimension row, and what to think of it."""
    have = dimension.select(key, F.lit(1).alias("__hit")).distinct()
    got = facts.select(key).join(have, key, "left").agg(F.count("*").alias("n_rows"), F.coalesce(F.avg(F.col("__hit").isNotNull().cast("double")), F.lit(0.0)).alias("match_ratio"))
    return got.withColumn("status", F.when(F.col("match_ratio") == 0, "error").when(F.col("match_ratio") < 0.1, "warning").otherwise("ok"))


def attach_stockout(sales: DataFrame, labels: DataFrame, keys: list[str]) -> DataFrame:
    """Labels by key and time; 0 where none."""
    one = labels.groupBy(*keys).agg(F.max("is_stockout").alias("is_stockout"))
    return sales.drop("is_stockout").join(one, keys, "left").fillna(0, ["is_stockout"])


def attach_weather(series: DataFrame, weather: DataFrame, time: str, store: str = "store_id") -> DataFrame:
    """Daily weather by store and date (the values are filled by ``impute.fill_forward_back``)."""
    values = [c for c in ("temperature", "precipitation", "humidity") if c in weather.columns]
    daily = weather.groupBy(store, "date").agg(*[F.avg(c).alias(c) for c in values])
    return series.withColumn("date", F.to_date(time)).join(daily, [store, "date"], "left").drop("date")


def attach_promo(sales: DataFrame, causal: DataFrame, keys: list[str]) -> DataFrame:
    """Display and mailer flags; conflicting causal rows count as promoted, rows never multiply."""
    flag = lambda c: F.max((F.coalesce(F.col(c), F.lit("0")) != "0").cast("int"))
    one = causal.groupBy(*keys).agg(flag("display").alias("is_on_display"), flag("mailer").alias("is_on_mailer"))
    return sales.join(one, keys, "left").fillna(0, ["is_on_display", "is_on_mailer"])


def attach_behavior(facts: DataFrame, features: DataFrame, key: str) -> DataFrame:
    """Visitor features; 0 where none."""
    values = [c for c in features.columns if c != key]
    return facts.join(features, key, "left").fillna(0, values)


def attach_inventory(forecasts: DataFrame, inventory: DataFrame, keys: list[str]) -> DataFrame:
    """J11."""
    return forecasts.join(inventory.select(*keys, "inventory_ratio"), keys, "left")


def attach_forecast(demand: DataFrame, forecasts: DataFrame, keys: list[str]) -> DataFrame:
    """Forecast columns only, so that no name appears twice."""
    values = [c for c in forecasts.columns if c.startswith("forecast_")]
    return demand.join(forecasts.select(*keys, *values), keys, "left")


def combine_modules(forecasts: DataFrame, inventory: DataFrame, pricing: DataFrame, keys: list[str]) -> DataFrame:
    """Left joins with the modules' defaults where a product is absent; equal names get a suffix."""
    def side(df: DataFrame, suffix: str) -> DataFrame:
        clash = set(forecasts.columns) - set(keys)
        return df.select(*keys, *[F.col(c).alias(c + suffix if c in clash else c) for c in df.columns if c not in keys])

    out = forecasts.join(side(inventory, "_inv"), keys, "left").join(side(pricing, "_price"), keys, "left")
    return out.fillna({"current_inventory": 100.0, "reorder_point": 80.0, "safety_stock": 30.0, "stockout_risk_pct": 10.0, "current_price": 10000.0, "recommended_price": 10000.0, "discount_pct": 0.0, "action": "maintain"})


def lookup_default(left: DataFrame, right: DataFrame, key: str, defaults: dict) -> DataFrame:
    """Per-key lookup with defaults where absent."""
    return left.join(right.select(key, *defaults), key, "left").fillna(defaults)


def semi_topk(df: DataFrame, key: str, measure: str, k: int) -> DataFrame:
    """Rows of the k keys with the largest total."""
    top = df.groupBy(key).agg(F.sum(measure).alias("__m")).orderBy(F.desc("__m"), key).limit(k)
    return df.join(top, key, "left_semi")
