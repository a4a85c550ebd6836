"""Queries: stockouts, weather, imputation, long-range measures, forecasts and their errors."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from shelfloom.operators import advanced, clean, context, impute, metrics, ml, series, stockout
from shelfloom.plans import testbed as tb
from shelfloom.plans.enrich import enrich_pipeline
from shelfloom.plans.kit import TS, Book, R, out
from shelfloom.plans.q_core import weekly_grid
from shelfloom.spec import HOURLY, WEEKLY, SeriesSpec

B = Book()
K = ["product_id", "store_id"]
HCELL = [*K, "hour_timestamp"]
P = "PARTITION BY product_id, store_id"
O = f"{P} ORDER BY hour_timestamp"  # noqa: E741
PAST, AHEAD = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW", "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
QS = ["forecast_q05", "forecast_q25", "forecast_q50", "forecast_q75", "forecast_q95"]
LEVELS = dict(zip((0.05, 0.25, 0.5, 0.75, 0.95), QS, strict=True))

B.add(
    "stockout_streak",
    lambda s, d: out(stockout.streak(F.col("is_stockout"), HOURLY, tb.hourly(s, d), "stockout_streak"), [*HCELL, "stockout_streak"]),
    f"""SELECT product_id, store_id, {TS()} AS hour_timestamp, CAST(CASE WHEN is_stockout = 1 THEN sum(is_stockout) OVER (PARTITION BY product_id, store_id, i ORDER BY hour_timestamp {PAST}) ELSE 0 END AS INTEGER) AS stockout_streak
FROM (SELECT *, sum(1 - is_stockout) OVER ({O} {PAST}) AS i FROM v_hourly)""",
)
B.add(
    "stockout_distance",
    lambda s, d: out(stockout.until_next(stockout.since_last(tb.hourly(s, d), HOURLY), HOURLY).withColumns({c: F.col(c).cast("long") for c in ("since_last_stockout", "until_next_stockout")}), [*HCELL, "since_last_stockout", "until_next_stockout"]),
    f"""SELECT product_id, store_id, {TS()} AS hour_timestamp, coalesce(k - last_value(CASE WHEN is_stockout = 1 THEN k END IGNORE NULLS) OVER ({O} {PAST}), 0) AS since_last_stockout,
  coalesce(first_value(CASE WHEN is_stockout = 1 THEN k END IGNORE NULLS) OVER ({O} {AHEAD}) - k, 0) AS until_next_stockout FROM (SELECT *, row_number() OVER ({O}) AS k FROM v_hourly)""",
)
B.add("stockout_frequency", lambda s, d: out(stockout.frequency(tb.hourly(s, d), HOURLY), [*HCELL, "stockout_frequency"]), f"SELECT product_id, store_id, {TS()} AS hour_timestamp, CAST(sum(is_stockout) OVER ({O} ROWS BETWEEN 167 PRECEDING AND CURRENT ROW) AS INTEGER) AS stockout_frequency FROM v_hourly")
B.add("expected_demand", lambda s, d: out(stockout.expected_demand(tb.hourly(s, d), HOURLY), [*HCELL, "expected_demand"]), f"SELECT product_id, store_id, {TS()} AS hour_timestamp, CASE WHEN count(*) OVER w >= 3 THEN avg(sales_quantity) OVER w END AS expected_demand FROM v_hourly WINDOW w AS ({O} ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)")
WEIGHTS = {n: [math.exp(-k / (n - 1)) for k in range(n)] for n in range(3, 8)}
CASES = " ".join(f"WHEN {n} THEN ({' + '.join(f'r[{k + 1}] * {w!r}' for k, w in enumerate(ws))}) / {sum(ws)!r}" for n, ws in WEIGHTS.items())
LATENT = f"""h AS (SELECT *, hour(hour_timestamp) AS ph FROM v_hourly),
same AS (SELECT product_id, store_id, ph, avg(sales_quantity) FILTER (k <= 10) AS same FROM (SELECT *, row_number() OVER (PARTITION BY product_id, store_id, ph ORDER BY hour_timestamp DESC) AS k FROM h WHERE is_stockout = 0) GROUP BY ALL HAVING count(*) >= 3),
mean AS (SELECT product_id, store_id, avg(sales_quantity) AS mean FROM h WHERE is_stockout = 0 GROUP BY ALL),
sold AS (SELECT product_id, store_id, hour_timestamp, list(sales_quantity) OVER ({O} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS r0 FROM h WHERE is_stockout = 0 AND sales_quantity > 0),
j AS (SELECT h.*, last_value(list_reverse(r0) IGNORE NULLS) OVER (PARTITION BY h.product_id, h.store_id ORDER BY h.hour_timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r, same, mean
  FROM h LEFT JOIN sold USING (product_id, store_id, hour_timestamp) LEFT JOIN same USING (product_id, store_id, ph) LEFT JOIN mean USING (product_id, store_id)),
latent AS (SELECT *, CASE WHEN is_stockout = 0 THEN 0.0 WHEN same > 0 THEN same WHEN len(r) >= 3 THEN (CASE len(r) {CASES} END) WHEN mean > 0 THEN 0.8 * mean ELSE 0.1 END AS latent_demand FROM j)"""
B.add("latent_demand", lambda s, d: out(stockout.latent_demand(tb.hourly(s, d), HOURLY), HCELL, {"latent_demand": 6}), f"WITH {LATENT} SELECT product_id, store_id, {TS()} AS hour_timestamp, {R('latent_demand', 6)} AS latent_demand FROM latent")
B.add(
    "stockout_features",
    lambda s, d: out(stockout.stockout_features(tb.hourly(s, d), HOURLY), [*HCELL, "stockout_streak", "stockout_frequency"], {"post_stockout_bounce": 8, "stockout_severity": 8}),
    f"""WITH {LATENT},
e AS (SELECT *, CASE WHEN count(*) OVER w >= 3 THEN avg(sales_quantity) OVER w END AS e, lag(is_stockout) OVER ({O}) AS b, lag(latent_demand) OVER ({O}) AS lb, sum(1 - is_stockout) OVER ({O} {PAST}) AS i FROM latent WINDOW w AS ({O} ROWS BETWEEN 23 PRECEDING AND CURRENT ROW))
SELECT product_id, store_id, {TS()} AS hour_timestamp, CAST(CASE WHEN is_stockout = 1 THEN sum(is_stockout) OVER (PARTITION BY product_id, store_id, i ORDER BY hour_timestamp {PAST}) ELSE 0 END AS INTEGER) AS stockout_streak,
  CAST(sum(is_stockout) OVER ({O} ROWS BETWEEN 167 PRECEDING AND CURRENT ROW) AS INTEGER) AS stockout_frequency,
  {R('CASE WHEN is_stockout = 0 AND b = 1 AND lb > 0 THEN sales_quantity / lb ELSE 0 END', 8)} AS post_stockout_bounce,
  {R('coalesce(CASE WHEN is_stockout = 1 THEN latent_demand / nullif(e, 0) WHEN sales_quantity > 0 THEN sales_quantity / nullif(e, 0) END, 0)', 8)} AS stockout_severity FROM e""",
)
FILLED = f"""days AS (SELECT s.store_id, x.date, temperature, precipitation, humidity FROM (SELECT DISTINCT store_id FROM v_hourly) s
  CROSS JOIN (SELECT DISTINCT CAST(hour_timestamp AS DATE) AS date FROM v_hourly) x LEFT JOIN v_weather USING (store_id, date)),
f AS (SELECT store_id, date, {', '.join(f"coalesce(last_value({c} IGNORE NULLS) OVER a, first_value({c} IGNORE NULLS) OVER b) AS {c}" for c in ('temperature', 'precipitation', 'humidity'))} FROM days
  WINDOW a AS (PARTITION BY store_id ORDER BY date {PAST}), b AS (PARTITION BY store_id ORDER BY date {AHEAD}))"""
B.add(
    "weather_features",
    lambda s, d: out(context.weather_features(context.with_weather(tb.hourly(s, d), tb.weather(s, d), HOURLY), HOURLY), [*HCELL, "temp_category", "is_rainy", "rain_intensity", "is_extreme_heat", "is_extreme_cold", "is_high_humidity", "humidity_category", "rain_lag_24"], {"temp_change_24h": 2}),
    f"""WITH {FILLED},
j AS (SELECT product_id, h.store_id, hour_timestamp, temperature AS t, precipitation AS p, humidity AS u FROM v_hourly h JOIN f ON h.store_id = f.store_id AND CAST(hour_timestamp AS DATE) = f.date)
SELECT product_id, store_id, {TS()} AS hour_timestamp, CASE WHEN t < 10 THEN 'cold' WHEN t < 25 THEN 'moderate' ELSE 'hot' END AS temp_category, CAST(p > 0 AS INTEGER) AS is_rainy,
  CASE WHEN p = 0 THEN 'none' WHEN p < 5 THEN 'light' WHEN p < 20 THEN 'moderate' ELSE 'heavy' END AS rain_intensity, CAST(t > 30 AS INTEGER) AS is_extreme_heat, CAST(t < 5 AS INTEGER) AS is_extreme_cold, CAST(u > 80 AS INTEGER) AS is_high_humidity,
  CASE WHEN u < 40 THEN 'low' WHEN u < 70 THEN 'medium' ELSE 'high' END AS humidity_category, coalesce(lag(CAST(p > 0 AS INTEGER), 24) OVER ({O}), 0) AS rain_lag_24, {R(f'coalesce(t - lag(t, 24) OVER ({O}), 0)', 2)} AS temp_change_24h FROM j""",
)
WK = f"{P} ORDER BY week_no"
B.add(
    "enrich_pipeline_weekly",
    lambda s, d: out(
        enrich_pipeline({"sales": tb.sales_weekly(s, d), "product": tb.product(s, d), "causal": tb.causal(s, d)}, WEEKLY),
        [*K, "week_no", "department", "sales_value", "quantity", *[f"sales_value_lag_{k}" for k in WEEKLY.lags], *[f"rolling_mean_{n}" for n in WEEKLY.windows], "quantity_lag_4", "week_of_year", "month_proxy", "base_price", "total_discount", "is_on_retail_promo", "is_on_coupon_promo", "is_on_display", "is_on_mailer"],
        {**{f"rolling_std_{n}": 2 for n in WEEKLY.windows}, "week_sin": 6, "momentum": 2, "discount_pct": 6},
    ),
    f"""SELECT product_id, store_id, week_no, coalesce(department, 'Unknown') AS department, sales_value, quantity, {', '.join(f'coalesce(lag(sales_value, {k}) OVER w, 0) AS sales_value_lag_{k}' for k in WEEKLY.lags)},
  {', '.join(f"coalesce(avg(sales_value) OVER ({WK} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING), 0) AS rolling_mean_{n}, coalesce({R(f'stddev_samp(sales_value) OVER ({WK} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)', 2)}, 0) AS rolling_std_{n}" for n in WEEKLY.windows)},
  coalesce(lag(quantity, 4) OVER w, 0) AS quantity_lag_4, CAST((week_no - 1) % 52 + 1 AS INTEGER) AS week_of_year, CAST(least(12, floor(((week_no - 1) % 52) / 4.33) + 1) AS INTEGER) AS month_proxy, {R(f'sin(CAST((week_no - 1) % 52 + 1 AS INTEGER) * {2 * math.pi / 52!r})', 6)} AS week_sin,
  {R(f'coalesce(avg(sales_value) OVER ({WK} ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) - avg(sales_value) OVER ({WK} ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING), 0)', 2)} AS momentum,
  sales_value - (retail_disc + coupon_disc) AS base_price, abs(retail_disc + coupon_disc) AS total_discount, {R('abs(retail_disc + coupon_disc) / (sales_value - (retail_disc + coupon_disc) + 1e-6)', 6)} AS discount_pct, CAST(retail_disc < 0 AS INTEGER) AS is_on_retail_promo, CAST(coupon_disc < 0 AS INTEGER) AS is_on_coupon_promo,
  CAST(coalesce(display, '0') <> '0' AS INTEGER) AS is_on_display, CAST(coalesce(mailer, '0') <> '0' AS INTEGER) AS is_on_mailer
FROM v_weekly_grid LEFT JOIN v_product USING (product_id) LEFT JOIN v_causal USING (product_id, store_id, week_no) WINDOW w AS ({WK})""",
)
HROLLS = [(x, n) for n in HOURLY.windows for x in ("mean", "max")]
B.add(
    "enrich_pipeline_hourly",
    lambda s, d: out(
        enrich_pipeline({"sales": tb.hourly(s, d), "weather": tb.weather(s, d)}, HOURLY),
        [*HCELL, "sales_quantity", "is_stockout", "stockout_streak", "stockout_frequency", "temp_category", "is_rainy", "rain_lag_24", *[f"sales_quantity_lag_{k}" for k in HOURLY.lags], *[f"rolling_{x}_{n}" for x, n in HROLLS], "hour_of_day", "is_weekend", "day_of_year"],
        {"latent_demand": 6, "stockout_severity": 8, "temperature": 2, "temp_change_24h": 2, "hour_sin": 6},
    ),
    f"""WITH {LATENT}, {FILLED},
e AS (SELECT *, CASE WHEN count(*) OVER w >= 3 THEN avg(sales_quantity) OVER w END AS e, sum(1 - is_stockout) OVER ({O} {PAST}) AS i FROM latent WINDOW w AS ({O} ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)),
b AS (SELECT e.*, temperature AS t, precipitation AS p FROM e JOIN f ON e.store_id = f.store_id AND CAST(hour_timestamp AS DATE) = f.date)
SELECT product_id, store_id, {TS()} AS hour_timestamp, sales_quantity, is_stockout, CAST(CASE WHEN is_stockout = 1 THEN sum(is_stockout) OVER (PARTITION BY product_id, store_id, i ORDER BY hour_timestamp {PAST}) ELSE 0 END AS INTEGER) AS stockout_streak,
  CAST(sum(is_stockout) OVER ({O} ROWS BETWEEN 167 PRECEDING AND CURRENT ROW) AS INTEGER) AS stockout_frequency, CASE WHEN t < 10 THEN 'cold' WHEN t < 25 THEN 'moderate' ELSE 'hot' END AS temp_category, CAST(p > 0 AS INTEGER) AS is_rainy, coalesce(lag(CAST(p > 0 AS INTEGER), 24) OVER ({O}), 0) AS rain_lag_24,
  {', '.join(f'coalesce(lag(sales_quantity, {k}) OVER ({O}), 0) AS sales_quantity_lag_{k}' for k in HOURLY.lags)}, {', '.join(f"coalesce({'avg' if x == 'mean' else x}(sales_quantity) OVER ({O} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING), 0) AS rolling_{x}_{n}" for x, n in HROLLS)},
  CAST(hour(hour_timestamp) AS INTEGER) AS hour_of_day, CAST(isodow(hour_timestamp) >= 6 AS INTEGER) AS is_weekend, CAST(dayofyear(hour_timestamp) AS INTEGER) AS day_of_year, {R('latent_demand', 6)} AS latent_demand,
  {R('coalesce(CASE WHEN is_stockout = 1 THEN latent_demand / nullif(e, 0) WHEN sales_quantity > 0 THEN sales_quantity / nullif(e, 0) END, 0)', 8)} AS stockout_severity, {R('t', 2)} AS temperature, {R(f'coalesce(t - lag(t, 24) OVER ({O}), 0)', 2)} AS temp_change_24h, {R(f'sin(hour(hour_timestamp) * {2 * math.pi / 24!r})', 6)} AS hour_sin FROM b""",
)

# Imputation
B.add("fill_forward_back", lambda s, d: out(impute.fill_forward_back(tb.gappy(s, d), K, "hour_timestamp", ["sales_lag_1"]), [*HCELL, "sales_lag_1"]), f"SELECT product_id, store_id, {TS()} AS hour_timestamp, coalesce(last_value(sales_lag_1 IGNORE NULLS) OVER ({O} {PAST}), first_value(sales_lag_1 IGNORE NULLS) OVER ({O} {AHEAD})) AS sales_lag_1 FROM v_gappy")
B.add("ffill_bfill_zero", lambda s, d: out(impute.ffill_bfill_zero(tb.gappy(s, d), K, "hour_timestamp", ["price"]), [*HCELL, "price"]), f"SELECT product_id, store_id, {TS()} AS hour_timestamp, coalesce(last_value(price IGNORE NULLS) OVER ({O} {PAST}), first_value(price IGNORE NULLS) OVER ({O} {AHEAD}), 0) AS price FROM v_gappy")
B.add("rolling_median_fill", lambda s, d: out(impute.rolling_median_fill(tb.gappy(s, d), K, "hour_timestamp", ["rolling_std_24"]), [*HCELL, "rolling_std_24"]), f"SELECT product_id, store_id, {TS()} AS hour_timestamp, coalesce(rolling_std_24, quantile_cont(rolling_std_24, 0.5) OVER ({O} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), (SELECT median(rolling_std_24) FROM v_gappy)) AS rolling_std_24 FROM v_gappy")
INTER = f"""(CASE WHEN x IS NOT NULL THEN x WHEN b IS NULL THEN a.y WHEN a IS NULL THEN b.y ELSE b.y + (a.y - b.y) * (k - b.k) / (a.k - b.k) END)"""
INTERPOLATED = lambda c: f"(SELECT *, last_value(CASE WHEN x IS NOT NULL THEN {{'k': k, 'y': x}} END IGNORE NULLS) OVER ({O} {PAST}) AS b, first_value(CASE WHEN x IS NOT NULL THEN {{'k': k, 'y': x}} END IGNORE NULLS) OVER ({O} {AHEAD}) AS a FROM (SELECT *, {c} AS x, row_number() OVER ({O}) AS k FROM v_gappy))"
B.add("interpolate", lambda s, d: out(impute.interpolate(tb.gappy(s, d), K, "hour_timestamp", ["rolling_mean_24"]), HCELL, {"rolling_mean_24": 5}), f"SELECT product_id, store_id, {TS()} AS hour_timestamp, {R(INTER, 5)} AS rolling_mean_24 FROM {INTERPOLATED('rolling_mean_24')}")
B.add(
    "robust_impute",
    lambda s, d: out(impute.robust_impute(tb.gappy(s, d), K, "hour_timestamp", ["sales_lag_1", "rolling_mean_24", "sales_change", "price"]), [*HCELL, "sales_lag_1", "sales_change", "rolling_mean_24_was_missing"], {"rolling_mean_24": 5}),
    f"SELECT product_id, store_id, {TS()} AS hour_timestamp, coalesce(last_value(sales_lag_1 IGNORE NULLS) OVER ({O} {PAST}), first_value(sales_lag_1 IGNORE NULLS) OVER ({O} {AHEAD}), 0) AS sales_lag_1, coalesce(sales_change, 0) AS sales_change, CAST(x IS NULL AS INTEGER) AS rolling_mean_24_was_missing, {R(INTER, 5)} AS rolling_mean_24 FROM {INTERPOLATED('rolling_mean_24')}",
)
B.add("impute_after_split", lambda s, d: _after_split(s, d), f"SELECT product_id, store_id, {TS()} AS hour_timestamp, coalesce(sales_lag_1, 0) AS sales_lag_1, coalesce(price, (SELECT median(price) FROM v_gappy WHERE epoch_us(hour_timestamp) < c)) AS price FROM v_gappy, (SELECT quantile_cont(epoch_us(hour_timestamp)::DOUBLE, 0.8) AS c FROM v_gappy) WHERE epoch_us(hour_timestamp) >= c")


def _after_split(s, d):
    train, test = clean.time_split(tb.gappy(s, d), "hour_timestamp")
    return out(impute.impute_after_split(train, test, ["sales_lag_1", "price"], [])[1], [*HCELL, "sales_lag_1", "price"])


# Long-range measures
PARTS: dict[str, str] = {}
N = f"(SELECT product_id, store_id, week_no, sales_value AS y, row_number() OVER ({P} ORDER BY week_no) AS pos, count(*) OVER ({P}) AS n FROM v_weekly_grid)"
PARTS["autocorrelation"] = f"""SELECT product_id, store_id, {', '.join(f"{R(f'CASE WHEN max(n) > 12 THEN coalesce(sum(dv * d{k}) / nullif(sum(dv * dv), 0), 0) ELSE 0 END', 6)} AS acf_{k}" for k in (1, 4, 12))}
FROM (SELECT *, {', '.join(f'lag(dv, {k}) OVER ({P} ORDER BY pos) AS d{k}' for k in (1, 4, 12))} FROM (SELECT *, y - avg(y) OVER ({P}) AS dv FROM {N})) GROUP BY ALL"""
B.add("autocorrelation", lambda s, d: out(advanced.autocorrelation(weekly_grid(s, d), WEEKLY), K, {"acf_1": 6, "acf_4": 6, "acf_12": 6}), PARTS["autocorrelation"])
PARTS["entropy"] = f"""SELECT product_id, store_id, {R('CASE WHEN max(n) > 5 THEN -sum(c / n * ln(c / n)) ELSE 0 END', 6)} AS entropy FROM (SELECT product_id, store_id, n, bin, count(*) AS c FROM (
  SELECT *, CASE WHEN hi > lo THEN least(b - 1, CAST(floor((y - lo) / (hi - lo) * b) AS INTEGER)) ELSE 0 END AS bin FROM (SELECT *, min(y) OVER ({P}) AS lo, max(y) OVER ({P}) AS hi, CAST(least(10, n // 2) AS INTEGER) AS b FROM {N})) GROUP BY ALL) GROUP BY product_id, store_id"""
B.add("entropy", lambda s, d: out(advanced.entropy(weekly_grid(s, d), WEEKLY), K, {"entropy": 6}), PARTS["entropy"])
PARTS["hurst"] = f"""WITH x AS (SELECT *, (pos - 1) // len AS block FROM (SELECT *, unnest(range(2, CAST(least(20, n // 2) AS BIGINT))) AS len FROM {N} WHERE n >= 10)),
y AS (SELECT *, y - avg(y) OVER (PARTITION BY product_id, store_id, len, block) AS dv FROM x WHERE (block + 1) * len <= n),
z AS (SELECT *, sum(dv) OVER (PARTITION BY product_id, store_id, len, block ORDER BY pos {PAST}) AS walk FROM y),
b AS (SELECT product_id, store_id, len, block, max(walk) - min(walk) AS r, stddev_pop(y) AS s FROM z GROUP BY ALL),
l AS (SELECT product_id, store_id, len, avg(CASE WHEN s > 0 THEN r / s ELSE 0 END) AS rs FROM b GROUP BY ALL),
h AS (SELECT product_id, store_id, count(*) AS k, regr_slope(ln(rs), ln(len)) AS slope FROM l WHERE rs > 0 GROUP BY ALL)
SELECT product_id, store_id, {R('CASE WHEN k >= 2 THEN greatest(0.1, least(0.9, slope)) ELSE 0.5 END', 6)} AS hurst FROM (SELECT DISTINCT product_id, store_id FROM v_weekly_grid) LEFT JOIN h USING (product_id, store_id)"""
B.add("hurst", lambda s, d: out(advanced.hurst(weekly_grid(s, d), WEEKLY), K, {"hurst": 6}), PARTS["hurst"])
PARTS["nonlinearity"] = f"SELECT product_id, store_id, {R('coalesce(least(10, stddev_pop(d2) / nullif(stddev_pop(d1), 0)), 0)', 6)} AS nonlinearity FROM (SELECT *, d1 - lag(d1) OVER ({P} ORDER BY week_no) AS d2 FROM (SELECT *, sales_value - lag(sales_value) OVER ({P} ORDER BY week_no) AS d1 FROM v_weekly_grid)) GROUP BY ALL"
B.add("nonlinearity", lambda s, d: out(advanced.nonlinearity(weekly_grid(s, d), WEEKLY), K, {"nonlinearity": 6}), PARTS["nonlinearity"])
B.add(
    "seasonal_decompose",
    lambda s, d: out(advanced.decompose(weekly_grid(s, d), WEEKLY), [*K, "week_no"], {"trend": 3, "seasonal": 3, "residual": 3}),
    f"""WITH a AS (SELECT *, CASE WHEN pos > 26 AND pos <= n - 26 AND n >= 104 THEN (sum(y) OVER (w ROWS BETWEEN 26 PRECEDING AND 26 FOLLOWING) - (lag(y, 26) OVER w + lead(y, 26) OVER w) / 2) / 52 END AS c FROM {N} WINDOW w AS ({P} ORDER BY pos)),
e AS (SELECT product_id, store_id, regr_slope(c, pos) FILTER (pos <= 78) AS hs, regr_intercept(c, pos) FILTER (pos <= 78) AS hi, regr_slope(c, pos) FILTER (pos > n - 78) AS ts, regr_intercept(c, pos) FILTER (pos > n - 78) AS ti FROM a WHERE c IS NOT NULL GROUP BY ALL),
t AS (SELECT a.*, (pos - 1) % 52 AS ph, coalesce(c, CASE WHEN pos <= 26 THEN hs * pos + hi ELSE ts * pos + ti END) AS tr FROM a LEFT JOIN e USING (product_id, store_id)),
p AS (SELECT product_id, store_id, ph, avg(y - tr) AS lv FROM t WHERE tr IS NOT NULL GROUP BY ALL), m AS (SELECT product_id, store_id, avg(lv) AS ml FROM p GROUP BY ALL)
SELECT product_id, store_id, week_no, {R('coalesce(tr, 0)', 3)} AS trend, {R('coalesce(lv - ml, 0)', 3)} AS seasonal, {R('coalesce(y - tr - (lv - ml), 0)', 3)} AS residual FROM t LEFT JOIN p USING (product_id, store_id, ph) LEFT JOIN m USING (product_id, store_id)""",
)
LONG = ("acf_1", "acf_4", "acf_12", "entropy", "hurst", "nonlinearity")
B.add(
    "advanced_series",
    lambda s, d: out(advanced.advanced_series(weekly_grid(s, d), WEEKLY), [*K, "week_no"], dict.fromkeys(LONG, 6)),
    f"WITH m1 AS ({PARTS['autocorrelation']}), m2 AS ({PARTS['entropy']}), m3 AS ({PARTS['hurst']}), m4 AS ({PARTS['nonlinearity']}) SELECT product_id, store_id, week_no, {', '.join(f'CASE WHEN count(*) OVER ({P}) >= 12 THEN {c} ELSE 0 END AS {c}' for c in LONG)} FROM v_weekly_grid JOIN m1 USING (product_id, store_id) JOIN m2 USING (product_id, store_id) JOIN m3 USING (product_id, store_id) JOIN m4 USING (product_id, store_id)",
)

# Forecasts
PRED = ", ".join(QS)
B.add("quantile_baseline", lambda s, d: out(tb.predictions(s, d), [*HCELL, *QS]), f"SELECT product_id, store_id, {TS()} AS hour_timestamp, {PRED} FROM v_predictions")
B.add("ensemble_forecast", lambda s, d: out(ml.ensemble_forecast(tb.predictions(s, d)), HCELL, {"ensemble_forecast": 5}), f"SELECT product_id, store_id, {TS()} AS hour_timestamp, {R('(forecast_q05 * 0.1 + forecast_q25 * 0.2 + forecast_q50 * 0.4 + forecast_q75 * 0.15 + forecast_q95 * 0.025) / 0.875', 5)} AS ensemble_forecast FROM v_predictions")
B.add("uncertainty_weighted", lambda s, d: out(ml.uncertainty_weighted(tb.predictions(s, d)), HCELL, {"uncertainty_weighted": 9}), f"SELECT product_id, store_id, {TS()} AS hour_timestamp, {R('forecast_q50 * (1 / (forecast_q95 - forecast_q05 + 1e-6)) / (SELECT sum(1 / (forecast_q95 - forecast_q05 + 1e-6)) FROM v_predictions)', 9)} AS uncertainty_weighted FROM v_predictions")
B.add("share_of_total", lambda s, d: out(ml.share_of_total(weekly_grid(s, d).groupBy("product_id").agg(F.sum("sales_value").alias("v")), "v"), ["product_id"], {"share": 9}), f"SELECT product_id, {R('sum(sales_value) / (SELECT sum(sales_value) FROM v_weekly_grid)', 9)} AS share FROM v_weekly_grid GROUP BY 1")
B.add("correlation_pairs", lambda s, d: out(ml.correlation_pairs(weekly_grid(s, d), ["sales_value", "quantity", "retail_disc"]), ["a", "b"], {"rho": 6}), f"SELECT 'quantity' AS a, 'sales_value' AS b, {R('corr(quantity, sales_value)', 6)} AS rho FROM v_weekly_grid UNION ALL SELECT 'quantity', 'retail_disc', {R('corr(quantity, retail_disc)', 6)} FROM v_weekly_grid UNION ALL SELECT 'retail_disc', 'sales_value', {R('corr(retail_disc, sales_value)', 6)} FROM v_weekly_grid")
B.add("correlation_spearman", lambda s, d: out(ml.correlation_pairs(weekly_grid(s, d), ["sales_value", "quantity"], "spearman"), ["a", "b"], {"rho": 6}), f"SELECT 'quantity' AS a, 'sales_value' AS b, {R('corr(q, v)', 6)} AS rho FROM (SELECT rank() OVER (ORDER BY quantity) + (count(*) OVER (PARTITION BY quantity) - 1) / 2.0 AS q, rank() OVER (ORDER BY sales_value) + (count(*) OVER (PARTITION BY sales_value) - 1) / 2.0 AS v FROM v_weekly_grid)")
B.add(
    "drop_correlated",
    lambda s, d: s.createDataFrame([(c,) for c in ml.drop_correlated(weekly_grid(s, d), ["sales_value", "quantity"], 0.9)], "feature string"),
    """SELECT unnest(CASE WHEN abs(corr(sales_value, quantity)) < 0.9 THEN ['sales_value', 'quantity'] WHEN var_samp(sales_value) > var_samp(quantity) THEN ['sales_value'] ELSE ['quantity'] END) AS feature FROM v_weekly_grid""",
)


def _features(s, d):
    rows = series.series_features(tb.hourly(s, d), HOURLY)
    return rows, ["sales_quantity_lag_1", "sales_quantity_lag_24", "rolling_mean_24", "hour_of_day", "day_of_week"]


def _trained(s, d):
    rows, names = _features(s, d)
    train, test = clean.time_split(rows, "hour_timestamp")
    return ml.quantile_train(train, HOURLY, names, "product_id"), test, names


B.add("quantile_train_predict", lambda s, d: _predicted(s, d))


def _predicted(s, d):
    model, test, _ = _trained(s, d)
    return out(model.predict(test), [*HCELL, *QS, "prediction_interval"])



def _held_out(s, d):
    """What has to hold on all rows that the model has not seen; shares may miss their level by two points."""
    model, test, _ = _trained(s, d)
    y, q = F.col("sales_quantity"), [F.col(c) for c in QS]
    ordered = F.lit(True)
    for low, high in zip(q, q[1:], strict=False):
        ordered = ordered & (low <= high)
    share = lambda c: F.avg(c.cast("double"))
    # Of a target with ties the level lies between the shares below and up to its quantile.
    fits = [(share(y < c) <= level + 0.02) & (share(y <= c) >= level - 0.02) for level, c in zip(LEVELS, q, strict=True)]
    return model.predict(test).agg(
        F.count("*").alias("rows"),
        F.bool_and(ordered).alias("in_order"),
        F.bool_and(q[0] >= 0).alias("not_negative"),
        F.bool_and(F.col("prediction_interval") == q[-1] - q[0]).alias("interval_is_outer"),
        F.bool_and(F.col("prediction_center") == (q[-1] + q[0]) / 2).alias("centre_is_middle"),
        *[f.alias(f"level_{c[-3:]}") for f, c in zip(fits, QS, strict=True)],
    )


B.add(
    "quantile_invariants",
    _held_out,
    f"SELECT count(*) AS rows, true AS in_order, true AS not_negative, true AS interval_is_outer, true AS centre_is_middle, {', '.join(f'true AS level_{c[-3:]}' for c in QS)} FROM v_hourly WHERE epoch_us(hour_timestamp) >= (SELECT quantile_cont(epoch_us(hour_timestamp)::DOUBLE, 0.8) FROM v_hourly)",
)


def _prices(s, d):
    """What order lines bring, by their price before discount; noise, a copy and a constant beside it."""
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    noise = F.pmod(F.xxhash64(*key), F.lit(1000)).cast("double")
    gross = F.col("l_extendedprice").cast("double")
    rows = s.read.parquet(f"{d}/lineitem.parquet")
    return rows.select(*key, F.lit("all").alias("kind"), F.datediff("l_shipdate", F.lit("1992-01-01")).alias("day"), (gross * (1 - F.col("l_discount").cast("double"))).alias("net"), gross.alias("gross"), (2 * gross).alias("twice"), noise.alias("noise"), F.lit(1.0).alias("same")), key


def _importance(s, d):
    rows, key = _prices(s, d)
    train, test = clean.time_split(rows, "day")
    names = ["noise", "gross", "same"]
    spec = SeriesSpec(keys=tuple(key), time="day", target="net", lags=(1,), windows=(2,))
    rise = {r.feature: r.rise for r in ml.permutation_importance(ml.quantile_train(train, spec, names, "kind", max_iter=5), test, [*names, "unknown"], "net", key).collect()}
    kept = {r.feature: r.importance for r in ml.select_by_importance(train, names, "net").collect()}
    chosen = ml.feature_selection(train, ["noise", "gross", "same", "twice"], "net")
    facts = {
        "M12 a constant rises by exactly 0": rise["same"] == 0 and rise["unknown"] == 0,
        "M12 gross rises most": max(rise, key=rise.get) == "gross",
        "M12 noise rises by under a hundredth of it": abs(rise["noise"]) < rise["gross"] / 100,
        "M8 the largest importance is 1": max(kept.values()) == 1.0 == kept["gross"],
        "M8 constants are left out": "same" not in kept,
        "M8 what is kept reaches the threshold": min(kept.values()) >= 0.005,
        "M10 one of two copies stays": len({"gross", "twice"} & set(chosen)) == 1,
    }
    return s.createDataFrame([(k, bool(v)) for k, v in facts.items()], "fact string, holds boolean")


B.add("importance_invariants", _importance, "SELECT unnest(['M12 a constant rises by exactly 0', 'M12 gross rises most', 'M12 noise rises by under a hundredth of it', 'M8 the largest importance is 1', 'M8 constants are left out', 'M8 what is kept reaches the threshold', 'M10 one of two copies stays']) AS fact, true AS holds")
B.add("select_by_importance", lambda s, d: ml.select_by_importance(*_features(s, d), "sales_quantity"))
B.add("feature_selection", lambda s, d: s.createDataFrame([(c,) for c in ml.feature_selection(*_features(s, d), "sales_quantity")], "feature string"))
B.add("permutation_importance", lambda s, d: _permuted(s, d))


def _permuted(s, d):
    model, test, names = _trained(s, d)
    return ml.permutation_importance(model, test, names, "sales_quantity", ["product_id", "store_id", "hour_timestamp"])


B.add("encode_categories", lambda s, d: _encoded(s, d), "SELECT product_id, CAST(row_number() OVER (ORDER BY n DESC, product_id) - 1 AS DOUBLE) AS product_id_code FROM (SELECT product_id, count(*) AS n FROM v_sales_weekly GROUP BY 1)")


def _encoded(s, d):
    rows = tb.sales_weekly(s, d).select("product_id")
    return ml.encoder(["product_id"]).fit(rows).transform(rows).select("product_id", "product_id_code").distinct()


B.add(
    "walk_forward",
    lambda s, d: out(ml.walk_forward(weekly_grid(s, d), WEEKLY), ["folds"], {f"{c}_{n}": 5 for c in ("r2", "coverage", "mae") for n in ("mean", "std")}),
    f"""WITH x AS (SELECT *, max(week_no) OVER () AS last FROM v_weekly_grid),
f AS (SELECT product_id, store_id, fold, quantile_cont(sales_value, [0.05, 0.25, 0.5, 0.75, 0.95]) AS q FROM (SELECT *, unnest([week_no + 1, week_no + 2, week_no + 3, week_no + 4]) AS fold FROM x) WHERE fold > last - 52 AND fold <= last GROUP BY ALL),
t AS (SELECT x.sales_value AS y, f.fold, q, avg(x.sales_value) OVER (PARTITION BY f.fold) AS m FROM x JOIN f ON x.week_no = f.fold AND x.product_id = f.product_id AND x.store_id = f.store_id),
s AS (SELECT fold, avg(abs(y - q[3])) AS mae, avg((y >= q[1] AND y <= q[5])::INT) AS coverage, 1 - sum((y - q[3]) ** 2) / nullif(sum((y - m) ** 2), 0) AS r2 FROM t GROUP BY 1)
SELECT count(*) AS folds, {', '.join(f"{R(f'{g}({c})', 5)} AS {c}_{n}" for c in ('r2', 'coverage', 'mae') for n, g in (('mean', 'avg'), ('std', 'stddev_samp')))} FROM s""",
)

# Errors
QM = " UNION ALL ".join(
    f"""SELECT '{c}' AS model, {R(f'avg(greatest((y - {c}) * {q}, (y - {c}) * {q - 1!r}))', 5)} AS pinball, {R(f'avg(abs(y - {c}))', 5)} AS mae, {R(f'sqrt(avg((y - {c}) ** 2))', 5)} AS rmse, {R(f'avg(abs(y - {c}) / y) FILTER (y > 0.1) * 100', 4)} AS mape,
  count(*) FILTER (y > 0.1) AS n_mape, {R('avg((y >= forecast_q05 AND y <= forecast_q95)::INT)', 5)} AS coverage, {R(f'1 - sum((y - {c}) ** 2) / sum((y - m) ** 2)', 5)} AS r2 FROM b"""
    for q, c in LEVELS.items()
)
B.add("quantile_metrics", lambda s, d: out(metrics.quantile_metrics(tb.predictions(s, d), "sales_quantity", LEVELS), ["model", "n_mape"], {"pinball": 5, "mae": 5, "rmse": 5, "mape": 4, "coverage": 5, "r2": 5}), f"WITH b AS (SELECT *, sales_quantity AS y, avg(sales_quantity) OVER () AS m FROM v_predictions) {QM}")
B.add(
    "tidy_metrics",
    lambda s, d: out(clean.tidy_metrics(metrics.quantile_metrics(tb.predictions(s, d), "sales_quantity", LEVELS).drop("n_mape")), ["model", "metric"], {"value": 5}),
    "WITH b AS (SELECT *, sales_quantity AS y FROM v_predictions) " + " UNION ALL ".join(f"SELECT '{c}' AS model, '{m}' AS metric, {R(x.format(c=c, q=q, p=repr(q - 1)), 5)} AS value FROM b" for q, c in LEVELS.items() for m, x in (("pinball", "avg(greatest((y - {c}) * {q}, (y - {c}) * {p}))"), ("mae", "avg(abs(y - {c}))"), ("rmse", "sqrt(avg((y - {c}) ** 2))"))),
)
E_ = "abs(sales_quantity - forecast_q50)"
B.add("category_metrics", lambda s, d: out(metrics.category_metrics(tb.predictions(s, d), "product_id", "sales_quantity", "forecast_q50"), ["product_id", "n"], {"mae": 5, "rmse": 5, "mape": 4, "accuracy": 4}), f"SELECT product_id, count(*) AS n, {R(f'avg({E_})', 5)} AS mae, {R(f'sqrt(avg({E_} ** 2))', 5)} AS rmse, {R(f'least(1000, avg({E_} / sales_quantity) FILTER (sales_quantity <> 0) * 100)', 4)} AS mape, {R(f'greatest(0, least(100, 100 * (1 - avg({E_}) / greatest(avg(sales_quantity), 0.001))))', 4)} AS accuracy FROM v_predictions GROUP BY 1")
B.add("group_sensitivity", lambda s, d: out(metrics.group_sensitivity(tb.predictions(s, d), "store_id", "product_id", "sales_quantity", "forecast_q50"), ["store_id", "n_products", "n"], {"mae": 5, "rmse": 5, "r2": 5, "avg_demand": 5}), f"SELECT store_id, count(DISTINCT product_id) AS n_products, count(*) AS n, {R(f'avg({E_})', 5)} AS mae, {R(f'sqrt(avg({E_} ** 2))', 5)} AS rmse, {R(f'1 - sum({E_} ** 2) / sum((sales_quantity - m) ** 2)', 5)} AS r2, {R('avg(sales_quantity)', 5)} AS avg_demand FROM (SELECT *, avg(sales_quantity) OVER (PARTITION BY store_id) AS m FROM v_predictions) GROUP BY 1")
B.add("region_sensitivity", lambda s, d: out(metrics.region_sensitivity(tb.predictions(s, d), "store_id", "sales_quantity", "forecast_q50"), ["region", "n_stores", "n", "total_demand"], {"mae": 5, "mape": 4}), f"SELECT substr(CAST(store_id AS VARCHAR), 1, 1) AS region, count(DISTINCT store_id) AS n_stores, count(*) AS n, sum(sales_quantity) AS total_demand, {R(f'avg({E_})', 5)} AS mae, {R(f'avg({E_} / nullif(sales_quantity, 0)) * 100', 4)} AS mape FROM v_predictions GROUP BY 1")
B.add("category_accuracy", lambda s, d: out(metrics.category_accuracy(tb.predictions(s, d), "product_id", "sales_quantity", "forecast_q50"), ["product_id"], {"accuracy": 6}), f"SELECT product_id, {R(f'1 - avg({E_}) / avg(sales_quantity)', 6)} AS accuracy FROM v_predictions GROUP BY 1")
B.add("error_by_period", lambda s, d: out(metrics.error_by_period(tb.predictions(s, d).withColumn("date", F.to_date("hour_timestamp")), "date", "sales_quantity", "forecast_q50"), ["date"], {"mae": 6}), f"SELECT CAST(CAST(hour_timestamp AS DATE) AS VARCHAR) AS date, {R(f'avg({E_})', 6)} AS mae FROM v_predictions GROUP BY 1")
B.add("error_histogram", lambda s, d: metrics.histogram(tb.hourly(s, d), F.col("sales_quantity"), 50), "SELECT CAST(b AS INTEGER) AS bin, coalesce(n, 0) AS n FROM range(50) r(b) LEFT JOIN (SELECT CAST(least(49, floor((sales_quantity - lo) / (hi - lo) * 50)) AS INTEGER) AS bin, count(*) AS n FROM v_hourly, (SELECT min(sales_quantity) AS lo, max(sales_quantity) AS hi FROM v_hourly) GROUP BY 1) ON bin = b")
ATTR = "(SELECT product_id AS row_id, unnest(['promo_x', 'price_y', 'lag_1', 'is_weekend']) AS feature, unnest([demand_ratio - 1, inventory_ratio - 1.5, (product_id % 11) - 5, (product_id % 7) / 10.0]) AS value FROM v_pricing)"


def _attributions(s, d):
    k = F.col("product_id")
    rows = F.array(*[F.struct(F.lit(n).alias("feature"), v.cast("double").alias("value")) for n, v in (("promo_x", F.col("demand_ratio") - 1), ("price_y", F.col("inventory_ratio") - 1.5), ("lag_1", k % 11 - 5), ("is_weekend", (k % 7) / 10))])
    return tb.pricing(s, d).select(k.alias("row_id"), F.explode(rows).alias("r")).select("row_id", "r.*")


B.add("attribution_summary", lambda s, d: out(metrics.attribution_summary(_attributions(s, d)), ["feature"], {c: 5 for c in ("mean_abs", "mean", "std", "min", "max", "pct_positive", "pct_negative")}), f"SELECT feature, {R('avg(abs(value))', 5)} AS mean_abs, {R('avg(value)', 5)} AS mean, {R('stddev_samp(value)', 5)} AS std, {R('min(value)', 5)} AS min, {R('max(value)', 5)} AS max, {R('avg((value > 0)::INT) * 100', 5)} AS pct_positive, {R('avg((value < 0)::INT) * 100', 5)} AS pct_negative FROM {ATTR} GROUP BY 1")
B.add("top_attributions", lambda s, d: out(metrics.top_attributions(_attributions(s, d), "row_id"), ["row_id", "rank", "feature", "family"], {"impact_pct": 4}), f"SELECT row_id, CAST(k AS INTEGER) AS rank, feature, CASE feature WHEN 'promo_x' THEN 'promotion' WHEN 'price_y' THEN 'price' WHEN 'lag_1' THEN 'history' ELSE 'calendar' END AS family, {R('coalesce(abs(value) / nullif(t, 0) * 100, 0)', 4)} AS impact_pct FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY abs(value) DESC, feature) AS k, sum(abs(value)) OVER (PARTITION BY row_id) AS t FROM {ATTR}) WHERE k <= 3")

QUERIES, ORACLES = B.queries, B.oracles
