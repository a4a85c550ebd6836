"""Nulls, ties, repeated rows, empty tables, and invariants of the operators."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfloom.functions.expr import hash_uniform
from shelfloom.functions.quantile import exact_quantiles
from shelfloom.operators import advanced, clean, context, grid, inventory, metrics, ml, report, series, stockout
from shelfloom.plans import registry
from shelfloom.plans.enrich import enrich_pipeline
from shelfloom.spec import HOURLY, SeriesSpec

SPEC = SeriesSpec(keys=("k",), time="t", target="y", lags=(1, 2), windows=(2,), unit="week")
TABLES = "region nation customer supplier part orders lineitem events".split()


def frame(spark, rows, schema="k string, t int, y double"):
    return spark.createDataFrame(rows, schema)


def test_completed_series_equal_the_joined_grid(spark):
    rnd = random.Random(1)
    cells = {(rnd.choice("abc"), rnd.randrange(20)) for _ in range(25)}
    values = frame(spark, [(k, t, rnd.choice([None, 0.0, 2.5]), rnd.choice([None, 3])) for k, t in cells], "k string, t int, y double, f int")
    key = lambda r: (r.k, r.t)
    got = sorted((tuple(r) for r in grid.complete(values, SPEC).select("k", "t", "y", "f").collect()))
    want = sorted((tuple(r) for r in grid.grid_fill(grid.grid_cross(values, SPEC), values, SPEC).select("k", "t", "y", "f").collect()))
    assert got == want
    holes = sorted(grid.complete(values, SPEC, fill=False).collect(), key=key)
    known = {(r.k, r.t): r for r in values.collect()}
    assert all((r.y, r.f) == ((known[key(r)].y, known[key(r)].f) if key(r) in known else (None, None)) for r in holes)


def test_grid_of_null_keys_times_and_an_axis(spark):
    from dataclasses import replace

    df = frame(spark, [("a", 1, 1.0), ("a", None, 4.0), (None, 3, 2.0), ("b", 9, 5.0)])
    got = {(r.k, r.t): r.y for r in grid.complete(df, SPEC).collect()}
    assert got == {(k, t): {("a", 1): 1.0, (None, 3): 2.0, ("b", 9): 5.0}.get((k, t), 0.0) for k in ("a", None, "b") for t in (1, 3, 9)}
    got = {(r.k, r.t): r.y for r in grid.complete(df, replace(SPEC, axis=(1, 3))).collect()}
    assert len(got) == 9 and got["b", 1] == 0 and got[None, 3] == 2 and max(t for _, t in got) == 3
    assert grid.master_grid(df.limit(0), SPEC).count() == 0


@pytest.mark.parametrize("small", [3, 40, 10**6])
def test_exact_quantiles_equal_numpy(spark, small):
    rnd = random.Random(small)
    for values in ([rnd.choice([1.0, 2.0, rnd.random()]) for _ in range(301)], [5.0] * 50, [rnd.gauss(0, 9) for _ in range(1000)], [7.0]):
        df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
        levels = [0.0, 0.05, 0.5, 0.8, 0.95, 1.0]
        assert exact_quantiles(df, "v", levels, small) == pytest.approx(list(np.quantile(values, levels)), abs=1e-12)
    assert exact_quantiles(df.where("v is null"), "v", [0.5]) == [None]


def test_samples_do_not_depend_on_partitioning(spark):
    df = spark.range(3000).select("id", (F.col("id") % 7).alias("x"))
    one = {r.id for r in clean.sample_fraction(df, 0.2).collect()}
    assert one == {r.id for r in clean.sample_fraction(df.repartition(9), 0.2).collect()} and 500 < len(one) < 700
    draws = [r[0] for r in df.select(hash_uniform(F.col("id"), F.lit(None).cast("string"), seed=1)).collect()]
    assert 0 <= min(draws) and max(draws) < 1 and abs(np.mean(draws) - 0.5) < 0.03
    with pytest.raises(ValueError):
        clean.sample_fraction(df, 0)


def test_training_columns_do_not_change_with_later_rows(spark):
    rnd = random.Random(3)
    start = datetime(2024, 1, 1)
    hours = [(p, 1, start + timedelta(hours=h), float(rnd.randrange(9)), int(rnd.random() < 0.3)) for p in "ab" for h in range(60)]
    later = [r if i % 60 < 40 else (*r[:3], r[3] + 50, 1 - r[4]) for i, r in enumerate(hours)]
    weather = spark.createDataFrame([(1, (start + timedelta(days=2)).date(), 12.0, 1.0, 50.0)], "store_id int, date date, temperature double, precipitation double, humidity double")
    made = []
    for rows in (hours, later):
        sales = spark.createDataFrame(rows, "product_id string, store_id int, hour_timestamp timestamp, sales_quantity double, is_stockout int")
        df = enrich_pipeline({"sales": sales, "weather": weather}, HOURLY, training=True)
        assert not set(stockout.LOOKAHEAD) & set(df.columns)
        made.append(sorted(map(repr, df.where(F.col("hour_timestamp") < F.lit(start + timedelta(hours=40))).collect())))
    assert len(made[0]) == 80 and made[0] == made[1]


def test_order_check_counts_steps_back(spark):
    df = frame(spark, [("a", 1, 1.0, 1), ("a", 3, 1.0, 2), ("a", 3, 1.0, 3), ("a", 2, 1.0, 4), ("a", None, 1.0, 5), ("b", 5, 1.0, 1)], "k string, t int, y double, pos int")
    got = {r.k: (r.n, r.n_backward, r.n_repeated) for r in series.order_check(df, SPEC, "pos").collect()}
    assert got == {"a": (5, 1, 1), "b": (1, 0, 0)}


def test_histograms_have_all_bins(spark):
    df = frame(spark, [("a", 1, 0.0), ("a", 2, 10.0), ("a", 3, 10.0), ("a", 4, None)])
    assert {r.bin: r.n for r in metrics.histogram(df, F.col("y"), 5).collect()} == {0: 1, 1: 0, 2: 0, 3: 0, 4: 2}
    same = frame(spark, [("a", 1, 3.0), ("a", 2, 3.0)])
    assert [tuple(r) for r in metrics.histogram(same, F.col("y"), 5).collect()] == [(0, 2)]
    assert metrics.histogram(same.limit(0), F.col("y"), 5).count() == 0


def test_r2_in_one_pass(spark):
    rnd = random.Random(5)
    rows = [("a", i, 1e6 + rnd.random(), 1e6 + rnd.random()) for i in range(400)] + [("a", 0, 5.0, None), ("a", 0, None, 5.0)]
    got = frame(spark, rows, "k string, t int, y double, p double").agg(metrics.r2(F.col("y"), F.col("p"))).first()[0]
    y, p = (np.array([r[i] for r in rows[:400]]) for i in (2, 3))
    assert got == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum(), rel=1e-9)
    flat = frame(spark, [("a", 1, 2.0, 1.0), ("a", 2, 2.0, 1.0)], "k string, t int, y double, p double")
    assert flat.agg(metrics.r2(F.col("y"), F.col("p"))).first()[0] is None


def test_decomposition_adds_up_and_finds_the_season(spark):
    season = [(t % 4) - 1.5 for t in range(40)]
    rows = [("a", t, 2.0 * t + 10 * season[t]) for t in range(40)] + [("b", t, 1.0) for t in range(5)]
    got = sorted(advanced.decompose(frame(spark, rows), SPEC, period=4).collect(), key=lambda r: (r.k, r.t))
    assert all(r.trend + r.seasonal + r.residual == pytest.approx(y) for r, (_, _, y) in zip(got[:40], rows, strict=False))
    assert all(r.seasonal == pytest.approx(10 * s, abs=1.5) for r, s in zip(got, season, strict=False))
    assert all(r.trend == r.seasonal == r.residual == 0 for r in got[40:])


def test_advanced_measures_are_an_option_of_the_series_features(spark):
    df = frame(spark, [("a", t, float(t % 5)) for t in range(30)])
    out = series.series_features(df, SPEC, advanced=True)
    assert {"trend_component", "seasonal", "residual", "acf_1", "entropy", "hurst", "nonlinearity"} <= set(out.columns) and out.count() == 30


def test_risk_reports_use_the_unclipped_probability(spark):
    rows = [("p", t, 0.0, 10.0, 40.0 + t) for t in range(3)] + [("q", t, 9.9, 10.0, 10.1) for t in range(3)]
    f = spark.createDataFrame(rows, "product_id string, t int, forecast_q05 double, forecast_q50 double, forecast_q95 double").withColumn("stock", F.lit(60.0))
    df = inventory.optimize_inventory(f, ["product_id"], "t", inventory="stock")
    got = {r.product_id: r for r in df.collect()}
    assert got["p"].stockout_risk < 0.0701 < got["p"].stockout_risk_raw and report.inventory_report(df).first().high_risk == 2
    assert [r.product_id for r in clean.priority_reorders(df).collect()][0] == "q"


def test_seven_quantile_levels(spark):
    rows = [("a", i, float((i * 37) % 23), float(i % 7)) for i in range(300)]
    df = frame(spark, rows, "k string, t int, y double, x double")
    got = ml.quantile_train(df, SPEC, ["x"], "k", max_iter=2, depth=2, levels=ml.SEVEN).predict(df).first()
    q = [got[ml.name(level)] for level in ml.SEVEN]
    assert q == sorted(q) and "forecast_q90" in got.asDict()
    base = ml.quantile_baseline(df, SPEC, F.lit(0), ml.SEVEN).first()
    assert base.forecast_q10 <= base.forecast_q90


def test_weather_gaps_and_nulls(spark):
    start = datetime(2024, 1, 1)
    rows = [("p", s, start + timedelta(hours=24 * d), 1.0) for s in (1, None) for d in range(4)]
    df = spark.createDataFrame(rows, "product_id string, store_id int, hour_timestamp timestamp, sales_quantity double")
    weather = spark.createDataFrame([(1, (start + timedelta(days=1)).date(), None, 2.0, 100.0), (1, (start + timedelta(days=2)).date(), 5.0, 0.0, None), (1, (start + timedelta(days=2)).date(), 7.0, 0.0, None)], "store_id int, date date, temperature double, precipitation double, humidity double")
    got = context.weather_features(context.with_weather(df, weather, HOURLY), HOURLY)
    assert got.count() == 8
    one = {r.hour_timestamp: r for r in got.where("store_id = 1").collect()}
    assert one[start].temperature is not None and one[start].humidity_category == "high" and got.where("store_id is null and is_rainy = 1").count() == 0


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("empty"))
    for t in TABLES:
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").limit(0).write.parquet(f"{base}/{t}.parquet")
    return base


ON_EMPTY = """scan_region unpack_hours equal_width_category clip_weather limit_entities sample_fraction time_split semi_topk enrich_product attach_stockout attach_weather
attach_promo attach_behavior master_grid funnel visitor_recency lags trend calendar_week price_promo interactions series_features_weekly series_features_hourly order_check
stockout_streak latent_demand stockout_features weather_features enrich_pipeline_weekly enrich_pipeline_hourly rolling_median_fill autocorrelation entropy hurst
seasonal_decompose advanced_series quantile_baseline ensemble_forecast quantile_metrics category_metrics error_histogram top_attributions optimize_inventory inventory_metrics
inventory_ledger backtest_compare recommend_price price_impact rule_insights validate_forecast baseline_profile detect_drift quality_score market_growth headline_kpis operation_stats""".split()


@pytest.mark.parametrize("name", ON_EMPTY)
def test_empty_tables_give_a_result(spark, empty, name):
    registry.queries()[name](spark, empty).collect()
