"""The whole enrichment as one lazy DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfloom.operators.context import price_promo, weather_features, with_behavior, with_weather
from shelfloom.operators.grid import master_grid
from shelfloom.operators.relational import enrich
from shelfloom.operators.series import series_features
from shelfloom.operators.stockout import LOOKAHEAD, stockout_features
from shelfloom.spec import SeriesSpec


def enrich_pipeline(tables: dict[str, DataFrame], spec: SeriesSpec, training: bool = False) -> DataFrame:
    """FE13: grid, products, stockouts, weather, series, behaviour, prices, as far as the tables go.

    ``training`` leaves out columns that look ahead, and fills weather forwards only.
    """
    df = master_grid(tables["sales"], spec)
    if "product" in tables:
        df = enrich(df, tables["product"], spec.keys[0], ["department"])
    if spec.has_stockout:
        df = stockout_features(df, spec)
    if spec.has_weather and "weather" in tables:
        df = weather_features(with_weather(df, tables["weather"], spec, backward=not training), spec)
    df = series_features(df, spec)
    if spec.has_behavior and "clicks" in tables and "visitorid" in df.columns:
        df = with_behavior(df, tables["clicks"], "visitorid")
    if spec.has_price and "causal" in tables:
        df = price_promo(df, tables["causal"])
    return df.drop(*LOOKAHEAD) if training else df
