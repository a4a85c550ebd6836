"""Weather, price and visitor behaviour features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfloom.functions.expr import steps
from shelfloom.operators.relational import attach_behavior, attach_promo, attach_weather
from shelfloom.operators.series import order
from shelfloom.spec import SeriesSpec


def weather_lags(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Values of a day before and the change since; nulls are 0."""
    w = order(spec)
    df = df.select("*", F.lag("temperature", 24).over(w).alias("temp_lag_24"), F.lag("is_rainy", 24).over(w).alias("rain_lag_24"))
    df = df.withColumn("temp_change_24h", F.col("temperature") - F.col("temp_lag_24"))
    return df.fillna(0, ["temp_lag_24", "rain_lag_24", "temp_change_24h"])


def weather_features(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """FE6; a full humidity of 100 belongs to the last class."""
    t, p, h = F.col("temperature"), F.col("precipitation"), F.col("humidity")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    df = df.withColumns(
        {
            "temp_category": steps(t, [(10, "cold"), (25, "moderate")], "hot"),
            "is_rainy": flag(p > 0),
            "rain_intensity": F.when(p == 0, "none").otherwise(steps(p, [(5, "light"), (20, "moderate")], "heavy")),
            "is_extreme_heat": flag(t > 30),
            "is_extreme_cold": flag(t < 5),
            "is_high_humidity": flag(h > 80),
            "humidity_category": steps(h, [(40, "low"), (70, "medium")], "high"),
        }
    )
    return weather_lags(df, spec)


def with_weather(df: DataFrame, weather: DataFrame, spec: SeriesSpec, backward: bool = True) -> DataFrame:
    """Attached by date, filled forwards within the store, and backwards unless that would look ahead."""
    from shelfloom.operators.impute import fill_forward_back

    days = df.select("store_id", F.to_date(spec.time).alias("date")).distinct()
    values = [c for c in ("temperature", "precipitation", "humidity") if c in weather.columns]
    filled = fill_forward_back(days.join(weather, ["store_id", "date"], "left"), ["store_id"], "date", values, backward)
    return attach_weather(df, filled, spec.time)


def price_features(df: DataFrame) -> DataFrame:
    """FE5 without the promotion flags: discounts are negative amounts."""
    off = F.col("retail_disc") + F.col("coupon_disc")
    df = df.withColumns({"base_price": F.col("sales_value") - off, "total_discount": F.abs(off)})
    return df.withColumns(
        {
            "discount_pct": F.col("total_discount") / (F.col("base_price") + 1e-6),
            "is_on_retail_promo": (F.col("retail_disc") < 0).cast("int"),
            "is_on_coupon_promo": (F.col("coupon_disc") < 0).cast("int"),
        }
    )


def price_promo(df: DataFrame, causal: DataFrame) -> DataFrame:
    """FE5."""
    return attach_promo(price_features(df), causal, ["product_id", "store_id", "week_no"])


def funnel_pivot(clicks: DataFrame) -> DataFrame:
    """A3: events of each kind by visitor."""
    rows = clicks.where("visitorid is not null and itemid is not null")
    n = lambda kind: F.count_if(F.col("event") == kind)
    return rows.groupBy("visitorid").agg(n("view").alias("total_views"), n("addtocart").alias("total_addtocart"), n("transaction").alias("total_transactions"))


def funnel_rates(df: DataFrame) -> DataFrame:
    """A4."""
    v, a, t = F.col("total_views"), F.col("total_addtocart"), F.col("total_transactions")
    return df.withColumns({"rate_view_to_cart": a / (v + 1e-6), "rate_cart_to_buy": t / (a + 1e-6), "rate_view_to_buy": t / (v + 1e-6)})


def visitor_recency(clicks: DataFrame) -> DataFrame:
    """Days between a visitor's first and last action, and since the last one."""
    rows = clicks.where("visitorid is not null and itemid is not null")
    ends = rows.agg(F.max("timestamp").alias("__end"))
    by = rows.groupBy("visitorid").agg(F.min("timestamp").alias("__from"), F.max("timestamp").alias("__to"))
    day = 86_400_000
    return by.crossJoin(F.broadcast(ends)).select("visitorid", ((F.col("__to") - F.col("__from")) / day).alias("active_days"), ((F.col("__end") - F.col("__to")) / day).alias("days_since_last"))


def behavior_features(clicks: DataFrame) -> DataFrame:
    """A3 to A5 in one grouping each, joined on the visitor."""
    return funnel_rates(funnel_pivot(clicks)).join(visitor_recency(clicks), "visitorid")


def with_behavior(facts: DataFrame, clicks: DataFrame, key: str) -> DataFrame:
    """FE10."""
    return attach_behavior(facts, behavior_features(clicks).withColumnRenamed("visitorid", key), key)
