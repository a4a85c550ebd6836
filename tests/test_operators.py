"""Hand-made cases: edges of series, empty tables, bounds and invariants."""

import random
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from shelfloom.functions.expr import norm_cdf
from shelfloom.operators import advanced, clean, grid, impute, inventory, ml, pricing, quality, relational, series, stockout
from shelfloom.spec import HOURLY, WEEKLY, SeriesSpec

SPEC = SeriesSpec(keys=("k",), time="t", target="y", lags=(1, 2), windows=(2,), unit="week")


def frame(spark, rows, schema="k string, t int, y double"):
    return spark.createDataFrame(rows, schema)


def test_spec_reports_each_problem():
    assert not WEEKLY.problems() and not HOURLY.problems()
    assert len(SeriesSpec(lags=(0,), windows=(1,), unit="day").problems()) == 3


def test_grid_keeps_all_series_and_fills(spark):
    df = frame(spark, [("a", 1, 2.0), ("a", 3, 1.0), ("b", 2, 5.0)])
    got = {(r.k, r.t): r.y for r in grid.master_grid(df, SPEC).collect()}
    assert len(got) == 6 and got["a", 2] == 0 and got["b", 2] == 5


def test_first_lag_is_null_and_rolling_does_not_see_the_present(spark):
    rows = series.with_lags_and_rolling(frame(spark, [("a", t, float(t)) for t in (1, 2, 3, 4)]), SPEC).orderBy("t").collect()
    assert rows[0].y_lag_1 is None and rows[3].y_lag_1 == 3 and rows[3].rolling_mean_2 == 2.5 and rows[0].rolling_mean_2 is None


def test_left_joins_keep_rows(spark):
    facts = frame(spark, [("a", 1, 1.0), ("z", 1, 1.0)])
    dim = spark.createDataFrame([("a", "x"), ("a", "x")], "k string, department string")
    got = {r.k: r.department for r in relational.enrich(facts, dim, "k", ["department"]).collect()}
    assert got == {"a": "x", "z": "Unknown"}


def test_time_split_does_not_overlap(spark):
    train, test = clean.time_split(frame(spark, [("a", t, 1.0) for t in range(100)]), "t")
    assert train.agg(F.max("t")).first()[0] < test.agg(F.min("t")).first()[0] and train.count() + test.count() == 100


def test_streak_and_distance(spark):
    df = spark.createDataFrame([("a", t, 0.0, f) for t, f in enumerate([0, 1, 1, 0, 1])], "k string, t int, y double, is_stockout int")
    got = stockout.since_last(stockout.streak(F.col("is_stockout"), SPEC, df, "s"), SPEC, out="d").orderBy("t").collect()
    assert [r.s for r in got] == [0, 1, 2, 0, 1] and [r.d for r in got] == [0, 0, 0, 1, 0]


def test_interpolate_ends_are_constant(spark):
    df = frame(spark, [("a", 1, None), ("a", 2, 2.0), ("a", 3, None), ("a", 4, 4.0), ("a", 5, None)])
    assert [r.y for r in impute.interpolate(df, ["k"], "t", ["y"]).orderBy("t").collect()] == [2, 2, 3, 4, 4]


def test_ledger_equals_day_loop(spark):
    rnd = random.Random(4)
    days = [("p", i, float(rnd.randrange(0, 60)), float(rnd.randrange(0, 60))) for i in range(60)]
    df = spark.createDataFrame(days, "k string, t int, demand double, orders double")
    got = inventory.ledger(df, ["k"], "t", "demand", "orders", strict=True).orderBy("t").collect()
    lots, stock = [(0, 100.0)], 100.0
    for (_, i, demand, order), r in zip(days, got, strict=True):
        spoiled = sum(int(n) for born, n in lots if i - born == (15 if born == 0 and n == 100.0 and lots[0] == (born, n) else 16))
        stock -= spoiled
        sold, short = min(demand, stock), max(0.0, demand - stock)
        stock = stock - sold + order
        lots.append((i, order))
        assert r.sold == pytest.approx(sold) and r.stockout == pytest.approx(short) and r.inventory == pytest.approx(stock)


def test_norm_cdf(spark):
    xs = [-40.0, -8.0, -1.5, 0.0, 0.3, 7.0, 9.0]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select(norm_cdf(F.col("x"))).collect()
    assert all(abs(r[0] - NormalDist().cdf(x)) < 1e-14 for x, r in zip(xs, got, strict=True))


def test_eoq_and_discounts(spark):
    one = spark.range(1).select(inventory.eoq(F.lit(36500.0)).alias("q"), pricing.discount_rule(F.lit(2.5), F.lit(0.7))["discount_pct"].alias("high"), pricing.discount_rule(F.lit(0.5), F.lit(1.0))["discount_pct"].alias("low")).first()
    assert one.q == pytest.approx(1350.9, abs=0.1) and one.high >= 0.25 and one.low == 0


def test_margin_floor(spark):
    df = spark.createDataFrame([("p", 10.0, 9.5, 3.5, 1.0)], "product_id string, current_price double, cost double, inventory_ratio double, demand_ratio double")
    r = pricing.recommend_price(df).first()
    assert r.recommended_price == pytest.approx(10.45) and not r.should_apply


def test_decompose_short_series_is_zero(spark):
    r = advanced.decompose(frame(spark, [("a", t, float(t)) for t in range(20)]), SPEC).agg(F.max(F.abs("trend")).alias("m")).first()
    assert r.m == 0


def test_quality_of_empty_table(spark):
    df = frame(spark, [])
    assert quality.missing_profile(df, ["y"]).first().nulls == 0 and quality.duplicate_count(df, ["k"]).first().duplicates == 0
    assert quality.quality_score(df, ["y"], ["k"], {"y": (0, 1)}).first().score == 100


def test_grade_and_issues_follow_the_score(spark):
    bounds, lines = {"t": (0, 150)}, [("a", i, float(i)) for i in range(200)]
    few = quality.quality_score(frame(spark, lines + lines[:1]), ["k", "absent"], ["k", "t"], bounds).first()
    many = quality.quality_score(frame(spark, lines + lines[:5]), ["k", "absent"], ["k", "t"], bounds).first()
    assert (few.score, few.grade, few.issues) == (70, "fair", ["missing columns", "out of range"])
    assert (many.score, many.grade, many.issues) == (55, "poor", ["missing columns", "duplicates", "out of range"])


def test_forecaster_orders_quantiles_and_covers(spark):
    rows = [("a" if i % 2 else "b", i, float((i * 37) % 23), float(i % 7)) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, t int, y double, x double")
    train, test = clean.time_split(df, "t")
    got = ml.quantile_train(train, SPEC, ["x"], "k", max_iter=3, depth=2).predict(test).collect()
    assert all(0 <= r.forecast_q05 <= r.forecast_q25 <= r.forecast_q50 <= r.forecast_q75 <= r.forecast_q95 for r in got)
    assert 0.8 <= sum(r.forecast_q05 <= r.y <= r.forecast_q95 for r in got) / len(got) <= 1


def test_selection_ranks_noise_last(spark):
    rows = [(float(i % 11), float((i * 7919) % 13), float(3 * (i % 11))) for i in range(500)]
    found = ml.select_by_importance(spark.createDataFrame(rows, "x double, noise double, y double"), ["x", "noise"], "y").collect()
    assert found[0].feature == "x"


def test_source_falls_back_to_csv(spark, tmp_path):
    from shelfloom.sources.tables import load_forecasts, scan_table, sink_csv, sink_parquet

    df = frame(spark, [("a", 1, 1.0)])
    sink_csv(df, f"{tmp_path}/x.csv", compress=False)
    assert scan_table(spark, str(tmp_path), "x").first().k == "a"
    sink_parquet(df, f"{tmp_path}/x.parquet", ["k"])
    assert scan_table(spark, str(tmp_path), "x").first().y == 1.0
    assert load_forecasts(spark, f"{tmp_path}/x.csv").count() == 1 and scan_table(spark, str(tmp_path), "none") is None


def test_stream_equals_batch_on_closed_hours_and_adds_nothing_twice(spark, tmp_path):
    from shelfloom.streaming.incremental import hourly_stream, incremental_aggregate

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(4).write.parquet(f"{tmp_path}/in")
    run = lambda: incremental_aggregate(hourly_stream(spark, f"{tmp_path}/in", events.schema), f"{tmp_path}/out", f"{tmp_path}/cp")
    q = run()
    q.awaitTermination()
    first = spark.read.parquet(f"{tmp_path}/out")
    n = first.count()
    assert n > 0
    run().awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == n
    whole = events.groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour_timestamp"), F.col("event_type").alias("product_id"), (F.col("user_id") % 10).cast("int").alias("store_id")).agg(F.sum(F.floor("value").cast("double")).alias("sales_quantity"))
    assert first.select(whole.columns).exceptAll(whole).count() == 0
