"""Features from keyed state against the batch features over the same periods."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from shelfloom.operators import series
from shelfloom.spec import SeriesSpec
from shelfloom.streaming.series_state import incremental_features, reach

SPEC = SeriesSpec(keys=("product", "store"), time="at", target="y", lags=(1, 3, 30), windows=(2, 24), base_lag=2)
WEEKS = SeriesSpec(keys=("product", "store"), time="at", target="y", lags=(1, 4), windows=(4, 8), unit="week")
START = dt.datetime(2024, 2, 28, tzinfo=dt.timezone.utc)
ROWS = "product string, store int, at timestamp, y double, extra string"


def arrive(spark, path, rows, schema=ROWS):
    spark.createDataFrame(rows, schema).repartition(3).write.mode("append").parquet(f"{path}/in")


def run(spark, path, spec=SPEC, schema=ROWS, fill=False):
    incremental_features(spark.readStream.schema(schema).parquet(f"{path}/in"), spec, f"{path}/out", f"{path}/cp", fill).awaitTermination()
    return spark.read.parquet(f"{path}/out")


def table(df):
    """Rows by key and time; floats to nine digits."""
    tidy = lambda v: round(v, 9) + 0.0 if isinstance(v, float) and math.isfinite(v) else v
    return {tuple(r[c] for c in ("product", "store", "at")): {c: tidy(v) for c, v in r.asDict().items()} for r in df.collect()}


def batch(spark, rows, spec=SPEC, schema=ROWS, fill=False):
    """The batch features of every series from its first period to its last."""
    df = spark.createDataFrame(rows, schema).where("at is not null")
    step = F.expr("interval 1 hour") if spec.unit == "hour" else F.lit(1)
    axis = df.groupBy("product", "store").agg(F.explode(F.sequence(F.min("at"), F.max("at"), step)).alias("at"))
    a, b = axis.alias("a"), df.withColumn("came", F.lit(True)).alias("b")
    same = F.col("a.product").eqNullSafe(F.col("b.product")) & F.col("a.store").eqNullSafe(F.col("b.store")) & (F.col("a.at") == F.col("b.at"))
    filled = a.join(b, same, "left").select("a.product", "a.store", "a.at", F.when(F.col("came"), F.col("y")).otherwise(0.0).alias("y"))
    return series.series_features(filled, spec, fill)


def made(rng, keys, hours, sparse):
    rows = []
    for i, (p, s) in enumerate(keys):
        for h in hours:
            if rng.random() < (sparse if i % 2 else 0.9):
                rows.append((p, s, START + dt.timedelta(hours=h), rng.choice([None, 0.0, 1.5, -2.0, 7.0, rng.random()]), "x"))
    return rows


KEYS = [("a", 1), ("a", 2), ("b", None), (None, 1), (None, None), ("", 1)]


def test_any_cut_into_batches_equals_the_batch_features(spark, tmp_path):
    rng = random.Random(5)
    whole = []
    for lo, hi in ((0, 1), (1, 40), (40, 41), (41, 200)):
        # Some series are silent for whole batches.
        part = made(rng, KEYS if lo != 40 else KEYS[:2], range(lo, hi), 0.2)
        whole += part
        arrive(spark, tmp_path, [*part, ("a", 1, None, 5.0, None)])
        found = run(spark, tmp_path)
    want = batch(spark, whole)
    assert set(found.columns) == set(want.columns)
    assert table(found) == table(want) and found.count() == want.count() > 600


def test_state_is_bounded_by_the_longest_lag_or_window(spark, tmp_path):
    assert reach(SPEC) == 30 and reach(WEEKS) == 8
    rows = [("a", 1, START + dt.timedelta(hours=h), float(h), None) for h in (0, 1, 2)] + [("b", 1, START, 1.0, None), ("b", 1, START + dt.timedelta(hours=20_000), 2.0, None)]
    arrive(spark, tmp_path, rows)
    assert run(spark, tmp_path).count() == 3 + 20_001
    state = spark.read.format("statestore").option("stateVarName", "series").load(f"{tmp_path}/cp").select("key.*", "value.*")
    assert {r.product: (r.last - int(START.timestamp()) // 3600, len(r.tail)) for r in state.collect()} == {"a": (2, 3), "b": (20_000, 30)}


def test_weeks_repeated_rows_nan_and_an_empty_batch(spark, tmp_path):
    schema = "product string, store int, at int, y double"
    whole = [("a", 1, w, float(w * w % 7)) for w in range(1, 30)]
    twice = [("a", 1, w, float(w * w % 7) / 2) for w in range(1, 11)] * 2
    arrive(spark, tmp_path, [], schema)
    assert run(spark, tmp_path, WEEKS, schema, True).count() == 0
    arrive(spark, tmp_path, [*twice, ("n", 1, 1, float("nan")), ("n", 1, 2, None)], schema)
    run(spark, tmp_path, WEEKS, schema, True)
    arrive(spark, tmp_path, whole[10:], schema)
    arrive(spark, tmp_path, [("n", 1, 3, 1.0)], schema)
    found = run(spark, tmp_path, WEEKS, schema, True)
    want = batch(spark, [*whole, ("n", 1, 1, None), ("n", 1, 2, None), ("n", 1, 3, 1.0)], WEEKS, schema, True)
    assert table(found) == table(want)


def test_a_period_that_comes_too_late_fails_and_changes_nothing(spark, tmp_path):
    arrive(spark, tmp_path, [("a", 1, START + dt.timedelta(hours=5), 1.0, None)])
    before = table(run(spark, tmp_path))
    arrive(spark, tmp_path, [("a", 1, START, 1.0, None)])
    with pytest.raises(Exception, match="came after features"):
        run(spark, tmp_path)
    assert table(spark.read.parquet(f"{tmp_path}/out")) == before
