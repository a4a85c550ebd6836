"""Helpers of the query modules."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfloom.functions.expr import r
from shelfloom.plans.testbed import sql


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Where the session names none, a temporary folder serves on a single machine; a cluster has to name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


class Book:
    """The queries of one module, with their oracles."""

    def __init__(self):
        self.queries: dict = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, query, oracle: str | None = None) -> None:
        self.queries[name] = query
        if oracle:
            self.oracles[name] = sql(oracle)


def out(df: DataFrame, keep: list[str], rounded: dict[str, int] | None = None) -> DataFrame:
    """Selected columns, some rounded; times as text."""
    rounded = rounded or {}
    types = dict(df.dtypes)

    def one(c: str) -> Column:
        if c in rounded:
            return r(F.col(c).cast("double"), rounded[c]).alias(c)
        if types[c] == "timestamp":
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
        if types[c] == "date":
            return F.col(c).cast("string").alias(c)
        return F.col(c)

    return df.select(*[one(c) for c in [*keep, *[c for c in rounded if c not in keep]]])


def R(x: str, digits: int) -> str:
    """DuckDB: rounded, with one zero only."""
    return f"(round(CAST({x} AS DOUBLE), {digits}) + 0.0)"


def TS(c: str = "hour_timestamp") -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"
