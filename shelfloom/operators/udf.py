"""User functions over series, batches and columns."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def apply_per_series(df: DataFrame, keys: list[str], fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """A pandas function for each series; series are bounded by their time axis."""
    return df.groupBy(*keys).applyInPandas(fn, schema)


def apply_per_batch(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """A pandas function for each Arrow batch."""

    def run(batches):
        for b in batches:
            yield fn(b)

    return df.mapInPandas(run, schema)


def apply_per_column(df: DataFrame, columns: list[str], fn: Callable[[Column], Column]) -> DataFrame:
    """A column expression for each column."""
    return df.withColumns({c: fn(F.col(c)) for c in columns})
