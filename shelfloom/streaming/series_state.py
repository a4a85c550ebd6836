"""Features of arriving periods from keyed state: history is never read again.

Each series keeps the number of its last period and the values of the periods before it, as many as the longest
lag or window reaches back.  What a batch brings is laid behind them, and lags and rolling statistics of the new
periods are made; Spark shuffles the batch by series and keeps the state beside it (RocksDB, with its changes
under the query's checkpoint), so a batch costs what it brings and a lost executor reads its share of the state.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from shelfloom.operators import series
from shelfloom.spec import SeriesSpec

HOUR = 3600
STATE = T.StructType([T.StructField("last", T.LongType()), T.StructField("tail", T.ArrayType(T.DoubleType()))])
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATS = ("mean", "std", "max", "min")


def reach(spec: SeriesSpec) -> int:
    """How many periods before the present the longest lag or window sees: the bound of a series' state."""
    return max([*spec.lags, *[n - 1 + spec.base_lag for n in spec.windows]])


def names(spec: SeriesSpec) -> list[str]:
    return [f"{spec.target}_lag_{k}" for k in spec.lags] + [f"rolling_{s}_{n}" for n in spec.windows for s in STATS]


def window_stats(x: np.ndarray) -> dict[str, np.ndarray]:
    """Of each row of values (NaN: none): nulls, as NaN, where SQL has them."""
    there = ~np.isnan(x)
    n = there.sum(1)
    with np.errstate(invalid="ignore", divide="ignore"):
        mean = np.where(there, x, 0.0).sum(1) / n
        off = np.where(there, x - mean[:, None], 0.0)
        std = np.sqrt((off * off).sum(1) / np.where(n > 1, n - 1.0, np.nan))
    none = n == 0
    most, least = np.where(there, x, -np.inf).max(1), np.where(there, x, np.inf).min(1)
    return {"mean": mean, "std": std, "max": np.where(none, np.nan, most), "min": np.where(none, np.nan, least)}


def behind(tail: np.ndarray, new: np.ndarray, spec: SeriesSpec) -> dict[str, np.ndarray]:
    """Lags and rolling statistics of ``new``, whose predecessors are ``tail``."""
    r, m = reach(spec), len(new)
    x = np.concatenate([np.full(r - len(tail), np.nan), tail, new])
    out = {f"{spec.target}_lag_{k}": x[r - k : r - k + m] for k in spec.lags}
    for n in spec.windows:
        first = r - spec.base_lag - n + 1
        rows = np.lib.stride_tricks.sliding_window_view(x, n)[first : first + m]
        out |= {f"rolling_{s}_{n}": v for s, v in window_stats(rows).items()}
    return out


def values_or_none(x: np.ndarray) -> list[float | None]:
    return [None if v != v else v for v in x.tolist()]


class Series(StatefulProcessor):
    """Input: keys, ``__t`` (number of the period), ``__y``; output: the same and the features."""

    #: Periods that are made at a time, so that a long silence is not held whole.
    SLICE = 8192

    def __init__(self, spec: SeriesSpec):
        self.spec = spec

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("series", STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802
        came: dict[int, float | None] = {}
        for row in rows:
            t, y = row[-2], row[-1]
            y = None if y is None or y != y else y
            was = came.get(t)
            came[t] = y if was is None else was if y is None else was + y
        old = self.state.get() if self.state.exists() else None
        begin, stop = min(came), max(came)
        out = Row(*self.spec.keys, "__t", "__y", *names(self.spec))
        last = old[0] if old else begin - 1
        tail = np.array([np.nan if v is None else v for v in old[1]] if old else [], np.float64)
        if begin <= last:
            raise ValueError(f"period {begin} of series {tuple(key)} came after features of periods up to {last} were made")
        for at in range(last + 1, stop + 1, self.SLICE):
            times = range(at, min(stop + 1, at + self.SLICE))
            new = np.array([came.get(t, 0.0) for t in times], np.float64)  # None becomes NaN
            made = behind(tail, new, self.spec)
            for made_row in zip(times, values_or_none(new), *[values_or_none(v) for v in made.values()], strict=True):
                yield out(*key, *made_row)
            tail = np.concatenate([tail, new])[-reach(self.spec) :]
        self.state.update((stop, values_or_none(tail)))

    def close(self) -> None:
        pass


def arriving_features(closed: DataFrame, spec: SeriesSpec, fill: bool = True) -> DataFrame:
    """ST1: ``series_features`` of a stream of closed periods (keys, time, target), by keyed state.

    A series has every period from its first to its last; those in which it has no row are zeros, as in the
    grid, and come out with the next one that has.  Periods of a series must come in the order of time over
    batches, as a watermark gives them, in any order within one; one that comes after a later one fails the
    query, as features that are out would be wrong.

    Cases: several rows of one period in a batch are summed; null targets stay null and count in no
    statistic, NaN likewise; null keys are a series; rows without a time are left out; other columns are not carried.
    """
    spec.check()
    number = F.floor(F.unix_seconds(spec.time) / HOUR) if spec.unit == "hour" else F.col(spec.time)
    rows = closed.select(*spec.keys, number.cast("long").alias("__t"), F.col(spec.target).cast("double").alias("__y")).where("__t is not null")
    keys = [closed.schema[k] for k in spec.keys]
    kind = T.StructType([*[T.StructField(f.name, f.dataType) for f in keys], T.StructField("__t", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in ("__y", *names(spec))]])
    made = rows.groupBy(*spec.keys).transformWithState(Series(spec), kind, "Append", "None")
    time = F.timestamp_seconds(F.col("__t") * HOUR) if spec.unit == "hour" else F.col("__t").cast(closed.schema[spec.time].dataType)
    out = made.select(*spec.keys, time.alias(spec.time), F.col("__y").alias(spec.target), *names(spec))
    return series.finished(out, spec, names(spec), fill)


@contextmanager
def rocksdb(spark: SparkSession):
    """Queries that start within keep their state in RocksDB, which keyed state of this kind needs."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def incremental_features(closed: DataFrame, spec: SeriesSpec, out: str, checkpoint: str, fill: bool = True) -> StreamingQuery:
    """Appends the features of what is new since the last run to a Parquet table."""
    with rocksdb(closed.sparkSession):
        made = arriving_features(closed, spec, fill)
        return made.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
