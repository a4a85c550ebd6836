"""Queries: sources, cleaning, joins, grid, series features."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from shelfloom.functions.expr import hash_uniform_sql
from shelfloom.operators import clean, context, grid, relational, series
from shelfloom.plans import testbed as tb
from shelfloom.plans.kit import TS, Book, R, out
from shelfloom.sources.tables import as_json, peek, scan_table
from shelfloom.spec import HOURLY, WEEKLY

B = Book()
W = "OVER (PARTITION BY product_id, store_id ORDER BY week_no"
WH = "OVER (PARTITION BY product_id, store_id ORDER BY hour_timestamp"
CELL = ["product_id", "store_id", "week_no"]
HCELL = ["product_id", "store_id", "hour_timestamp"]


def weekly_grid(s, d):
    return grid.master_grid(tb.sales_weekly(s, d), WEEKLY)


# Sources
B.add("scan_region", lambda s, d: scan_table(s, d, "region"), "SELECT * FROM region")
B.add("peek_regions", lambda s, d: peek(s, f"{d}/region.parquet", ["R_REGIONKEY", "r_name", "absent"]), "SELECT r_regionkey, r_name FROM region LIMIT 10")
B.add(
    "unpack_hours",
    lambda s, d: _unpack(tb.hourly(s, d)),
    f"SELECT product_id, store_id, {TS()} AS hour_timestamp, sales_quantity FROM v_hourly",
)


def _unpack(hourly):
    from shelfloom.sources.tables import unpack_hours

    days = hourly.groupBy("product_id", "store_id", F.to_date("hour_timestamp").alias("dt")).agg(F.map_from_entries(F.collect_list(F.struct(F.hour("hour_timestamp"), "sales_quantity"))).alias("m"))
    days = days.select("product_id", "store_id", "dt", F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.try_element_at("m", h)).alias("hours_sale"))
    return out(unpack_hours(days).where("sales_quantity is not null"), [*HCELL, "sales_quantity"])


B.add("metrics_json", lambda s, d: tb.product(s, d).select(as_json("product_id", "department").alias("line")), """SELECT '{"product_id":"' || product_id || '","department":"' || department || '"}' AS line FROM v_product""")

# Projections and filters
B.add("standardize_columns", lambda s, d: clean.standardize_columns(scan_table(s, d, "nation"), True, {"n_name": "label"}), 'SELECT n_nationkey AS "N_NATIONKEY", n_name AS "LABEL", n_regionkey AS "N_REGIONKEY" FROM nation')
B.add("resolve_column", lambda s, d: _resolve(scan_table(s, d, "nation")), "SELECT n_name AS name FROM nation")


def _resolve(df):
    return df.select(F.col(clean.resolve_column(df, "name", "N_NAME")).alias("name"))


B.add("select_by_keyword", lambda s, d: clean.select_by_keyword(scan_table(s, d, "part"), ["size", "price"], ["p_partkey"]), "SELECT p_partkey, p_size, p_retailprice FROM part")
B.add("feature_list", lambda s, d: _features(s, d), f"SELECT product_id, week_no, sales_value_lag_1 FROM (SELECT product_id, store_id, week_no, lag(sales_value) {W}) AS sales_value_lag_1 FROM v_weekly_grid)")


def _features(s, d):
    df = series.with_lags(weekly_grid(s, d), WEEKLY)
    found, _ = clean.feature_list(df, WEEKLY)
    return df.select("product_id", "week_no", *[c for c in found if c.endswith("lag_1")])


B.add(
    "equal_width_category",
    lambda s, d: clean.equal_width_category(scan_table(s, d, "part").select("p_partkey", "p_size"), "p_size", ["low", "middle", "high"]),
    """SELECT p_partkey, p_size, list_element(['low', 'middle', 'high'], CAST(least(2, floor((p_size - lo) / (hi - lo) * 3)) AS INTEGER) + 1) AS category
FROM part, (SELECT min(p_size)::DOUBLE AS lo, max(p_size)::DOUBLE AS hi FROM part)""",
)
B.add("drop_negative", lambda s, d: clean.drop_negative(scan_table(s, d, "customer"), "c_acctbal").select("c_custkey", "c_acctbal"), "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0")
B.add(
    "clip_weather",
    lambda s, d: out(clean.clip_weather(tb.weather(s, d).withColumn("temperature", F.col("temperature") * 2).withColumn("humidity", F.col("humidity") * 2 - 20)), ["store_id", "date", "humidity", "n_clipped"], {"temperature": 2}),
    f"""SELECT store_id, CAST(date AS VARCHAR) AS date, {R('greatest(-20, least(50, t))', 2)} AS temperature, greatest(0.0, least(100.0, h)) AS humidity,
  CAST((t < -20 OR t > 50)::INT + (h < 0 OR h > 100)::INT AS INTEGER) AS n_clipped FROM (SELECT *, temperature * 2 AS t, humidity * 2 - 20 AS h FROM v_weather)""",
)
B.add("drop_zero_sales", lambda s, d: clean.drop_zero_sales(grid.aggregate_series(tb.sales_weekly(s, d), WEEKLY), WEEKLY).select(*CELL, "sales_value"), "SELECT product_id, store_id, week_no, sales_value FROM v_weekly WHERE sales_value > 0")
B.add("drop_null_keys", lambda s, d: clean.drop_null_keys(out(tb.gappy(s, d), [*HCELL, "price"]), "price"), f"SELECT product_id, store_id, {TS()} AS hour_timestamp, price FROM v_gappy WHERE price IS NOT NULL")
B.add("limit_entities", lambda s, d: clean.limit_entities(tb.sales_weekly(s, d), "product_id", 5).groupBy("product_id").agg(F.count("*").alias("n")), "SELECT product_id, count(*) AS n FROM v_sales_weekly WHERE product_id IN (SELECT DISTINCT product_id FROM v_sales_weekly ORDER BY 1 LIMIT 5) GROUP BY 1")
B.add("sample_fraction", lambda s, d: clean.sample_fraction(scan_table(s, d, "events").select("event_id", "event_type"), 0.1, ["event_id", "event_type"]), f"SELECT event_id, event_type FROM events WHERE {hash_uniform_sql('event_id', 'event_type', seed=42)} < 0.1")
B.add("sample_n", lambda s, d: clean.sample_n(scan_table(s, d, "events").select("event_id", "user_id"), 100, ["event_id"], (F.col("event_id") * 7919 + 42) % 1009), "SELECT event_id, user_id FROM events ORDER BY (event_id * 7919 + 42) % 1009, event_id LIMIT 100")
B.add(
    "stratified_sample",
    lambda s, d: clean.stratified_sample(tb.events(s, d).select("event_id", F.hour("ts").alias("hour")), F.col("hour"), 20, ["event_id"], (F.col("event_id") * 7919) % 1009),
    "SELECT event_id, hour FROM (SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, row_number() OVER (PARTITION BY hour(ts) ORDER BY (event_id * 7919) % 1009, event_id) AS k FROM events) WHERE k <= 20",
)
B.add(
    "time_split",
    lambda s, d: _split(tb.hourly(s, d)),
    f"SELECT product_id, store_id, {TS()} AS hour_timestamp, CASE WHEN epoch_us(hour_timestamp) < (SELECT quantile_cont(epoch_us(hour_timestamp)::DOUBLE, 0.8) FROM v_hourly) THEN 'train' ELSE 'test' END AS part FROM v_hourly",
)


def _split(df):
    train, test = clean.time_split(df, "hour_timestamp")
    return out(clean.union_all(train.withColumn("part", F.lit("train")), test.withColumn("part", F.lit("test"))), [*HCELL, "part"])


B.add("last_periods", lambda s, d: clean.last_periods(tb.market(s, d), "date", 30).select(F.col("date").cast("string").alias("date"), "revenue"), "SELECT CAST(date AS VARCHAR) AS date, revenue FROM v_market WHERE date IN (SELECT date FROM v_market ORDER BY 1 DESC LIMIT 30)")
B.add("null_fill", lambda s, d: out(clean.null_fill(tb.gappy(s, d), ["price", "sales_lag_1"]), [*HCELL, "price", "sales_lag_1"]), f"SELECT product_id, store_id, {TS()} AS hour_timestamp, coalesce(price, 0) AS price, coalesce(sales_lag_1, 0) AS sales_lag_1 FROM v_gappy")
B.add("series_filter", lambda s, d: clean.series_filter(weekly_grid(s, d), {"product_id": "Brand#2", "store_id": 3}, "week_no", [1, 5, 9]).select(*CELL, "sales_value"), "SELECT product_id, store_id, week_no, sales_value FROM v_weekly_grid WHERE product_id = 'Brand#2' AND store_id = 3 AND week_no IN (1, 5, 9)")
B.add("topk", lambda s, d: clean.topk(tb.predictions(s, d).groupBy("product_id", "store_id").agg(F.sum("forecast_q50").alias("q50")), "q50", 10, "product_id", "store_id"), "SELECT product_id, store_id, sum(forecast_q50) AS q50 FROM v_predictions GROUP BY ALL ORDER BY q50 DESC, product_id, store_id LIMIT 10")
B.add("head_per_series", lambda s, d: out(clean.head_per_series(tb.hourly(s, d), ["product_id", "store_id"], "hour_timestamp"), [*HCELL, "sales_quantity"]), f"SELECT product_id, store_id, {TS()} AS hour_timestamp, sales_quantity FROM (SELECT *, row_number() {WH}) AS k FROM v_hourly) WHERE k <= 30")
B.add("most_frequent", lambda s, d: clean.most_frequent(tb.sales_weekly(s, d), "product_id"), "SELECT product_id, count(*) AS n FROM v_sales_weekly GROUP BY 1 ORDER BY n DESC, 1 LIMIT 3")
B.add("latest", lambda s, d: out(clean.latest(tb.hourly(s, d), "hour_timestamp", 10, "product_id", "store_id"), [*HCELL, "sales_quantity"]), f"SELECT product_id, store_id, {TS()} AS hour_timestamp, sales_quantity FROM v_hourly ORDER BY hour_timestamp DESC, product_id, store_id LIMIT 10")
B.add("sort_series", lambda s, d: out(tb.hourly(s, d).orderBy(*HCELL), [*HCELL, "sales_quantity"]), f"SELECT product_id, store_id, {TS()} AS hour_timestamp, sales_quantity FROM v_hourly ORDER BY 1, 2, 3")
B.add("distinct_keys", lambda s, d: clean.distinct_keys(tb.sales_weekly(s, d), "product_id", "store_id"), "SELECT DISTINCT product_id, store_id FROM v_sales_weekly")
B.add("union_all", lambda s, d: clean.union_all(tb.product(s, d), tb.household(s, d).select(F.col("segment").alias("product_id"))), "SELECT product_id, department FROM v_product UNION ALL SELECT segment, NULL FROM v_household")

# Joins
B.add("enrich_product", lambda s, d: relational.enrich(tb.sales_weekly(s, d), tb.product(s, d), "product_id", ["department"]).groupBy("product_id", "department").agg(F.sum("sales_value").alias("sales_value"), F.count("*").alias("n")), "SELECT product_id, coalesce(department, 'Unknown') AS department, sum(sales_value) AS sales_value, count(*) AS n FROM v_sales_weekly LEFT JOIN v_product USING (product_id) GROUP BY ALL")
B.add("match_ratio", lambda s, d: relational.match_ratio(tb.sales_weekly(s, d), tb.product(s, d), "product_id"), "SELECT count(*) AS n_rows, avg((department IS NOT NULL)::INT) AS match_ratio, 'ok' AS status FROM v_sales_weekly LEFT JOIN v_product USING (product_id)")
B.add(
    "enrich_household",
    lambda s, d: relational.enrich(scan_table(s, d, "orders").withColumnRenamed("o_custkey", "household_key"), tb.household(s, d), "household_key", ["income_desc", "segment"]).select("o_orderkey", "income_desc", "segment"),
    "SELECT o_orderkey, coalesce(income_desc, 'Unknown') AS income_desc, coalesce(segment, 'Unknown') AS segment FROM orders LEFT JOIN v_household ON o_custkey = household_key",
)
# The labels list stockouts only: what they do not list is in stock.
B.add("attach_stockout", lambda s, d: out(relational.attach_stockout(tb.hourly(s, d).drop("is_stockout"), tb.hourly(s, d).where("is_stockout = 1").select(*HCELL, "is_stockout"), HCELL), [*HCELL, "is_stockout", "sales_quantity"]), f"SELECT product_id, store_id, {TS()} AS hour_timestamp, is_stockout, sales_quantity FROM v_hourly")
B.add(
    "attach_weather",
    lambda s, d: out(context.with_weather(tb.hourly(s, d), tb.weather(s, d), HOURLY), [*HCELL], {"temperature": 2, "precipitation": 2, "humidity": 2}),
    f"""WITH days AS (SELECT s.store_id, x.date, temperature, precipitation, humidity FROM (SELECT DISTINCT store_id FROM v_hourly) s
  CROSS JOIN (SELECT DISTINCT CAST(hour_timestamp AS DATE) AS date FROM v_hourly) x LEFT JOIN v_weather USING (store_id, date)),
f AS (SELECT store_id, date, {', '.join(f"coalesce(last_value({c} IGNORE NULLS) OVER a, first_value({c} IGNORE NULLS) OVER b) AS {c}" for c in ('temperature', 'precipitation', 'humidity'))} FROM days
  WINDOW a AS (PARTITION BY store_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), b AS (PARTITION BY store_id ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT product_id, h.store_id, {TS()} AS hour_timestamp, {R('temperature', 2)} AS temperature, {R('precipitation', 2)} AS precipitation, {R('humidity', 2)} AS humidity
FROM v_hourly h JOIN f ON h.store_id = f.store_id AND CAST(hour_timestamp AS DATE) = f.date""",
)
B.add("attach_promo", lambda s, d: relational.attach_promo(grid.aggregate_series(tb.sales_weekly(s, d), WEEKLY), tb.causal(s, d), CELL).select(*CELL, "sales_value", "is_on_display", "is_on_mailer"), "SELECT product_id, store_id, week_no, sales_value, CAST(coalesce(display, '0') <> '0' AS INTEGER) AS is_on_display, CAST(coalesce(mailer, '0') <> '0' AS INTEGER) AS is_on_mailer FROM v_weekly LEFT JOIN v_causal USING (product_id, store_id, week_no)")
B.add(
    "attach_behavior",
    lambda s, d: relational.attach_behavior(scan_table(s, d, "customer").select(F.col("c_custkey").alias("visitorid")), context.funnel_pivot(tb.clicks(s, d)), "visitorid"),
    "SELECT c_custkey AS visitorid, coalesce(v, 0) AS total_views, coalesce(a, 0) AS total_addtocart, coalesce(t, 0) AS total_transactions FROM customer LEFT JOIN (SELECT visitorid, count_if(event = 'view')::BIGINT AS v, count_if(event = 'addtocart')::BIGINT AS a, count_if(event = 'transaction')::BIGINT AS t FROM v_clicks GROUP BY 1) ON c_custkey = visitorid",
)
B.add("grid_cross", lambda s, d: grid.grid_cross(tb.sales_weekly(s, d), WEEKLY).groupBy("product_id", "store_id").agg(F.count("*").alias("n"), F.min("week_no").alias("first"), F.max("week_no").alias("last")), "SELECT product_id, store_id, count(*) AS n, min(week_no) AS first, max(week_no) AS last FROM (SELECT DISTINCT product_id, store_id FROM v_sales_weekly), (SELECT DISTINCT week_no FROM v_sales_weekly) GROUP BY ALL")
B.add("grid_full_axis", lambda s, d: _full(s, d), "SELECT product_id, count(*) AS n, sum(w)::BIGINT AS weeks FROM (SELECT DISTINCT product_id FROM v_sales_weekly), (SELECT DISTINCT store_id FROM v_sales_weekly), (SELECT unnest(range(1, 105)) AS w) GROUP BY 1")


def _full(s, d):
    from dataclasses import replace

    cells = grid.grid_cross(tb.sales_weekly(s, d), replace(WEEKLY, axis=(1, 104)), full=True)
    return cells.groupBy("product_id").agg(F.count("*").alias("n"), F.sum("week_no").alias("weeks"))


B.add(
    "combine_modules",
    lambda s, d: _combine(s, d),
    "SELECT product_id, demand_ratio, coalesce(CASE WHEN current_inventory > 0 THEN current_inventory END, 100.0) AS current_inventory, coalesce(CASE WHEN inventory_ratio >= 1 THEN current_price END, 10000.0) AS current_price FROM v_pricing JOIN v_stock USING (product_id)",
)


def _combine(s, d):
    from shelfloom.operators.insights import combine_modules

    p, k = tb.pricing(s, d), tb.stock(s, d)
    inv = k.where("current_inventory > 0").select("product_id", "current_inventory", F.lit(1.0).alias("reorder_point"), F.lit(1.0).alias("safety_stock"), F.lit(1.0).alias("stockout_risk_pct"))
    price = p.where("inventory_ratio >= 1").select("product_id", "current_price", F.lit(1.0).alias("recommended_price"), F.lit(0.0).alias("discount_pct"), F.lit("x").alias("action"))
    return combine_modules(p.select("product_id", "demand_ratio"), inv, price, ["product_id"]).select("product_id", "demand_ratio", "current_inventory", "current_price")


B.add("attach_forecast", lambda s, d: out(relational.attach_forecast(tb.hourly(s, d), tb.predictions(s, d).where("forecast_q50 > 0"), HCELL), [*HCELL, "sales_quantity", "forecast_q50"]), f"SELECT h.product_id, h.store_id, {TS('h.hour_timestamp')} AS hour_timestamp, h.sales_quantity, forecast_q50 FROM v_hourly h LEFT JOIN (SELECT * FROM v_predictions WHERE forecast_q50 > 0) p ON h.product_id = p.product_id AND h.store_id = p.store_id AND h.hour_timestamp = p.hour_timestamp")
B.add("lookup_default", lambda s, d: relational.lookup_default(tb.pricing(s, d).select("product_id", "category"), tb.stock(s, d).where("demand_std > 0"), "product_id", {"current_inventory": 100.0, "unit_cost": 5000.0}), "SELECT product_id, category, coalesce(CASE WHEN demand_std > 0 THEN current_inventory END, 100.0) AS current_inventory, coalesce(CASE WHEN demand_std > 0 THEN unit_cost END, 5000.0) AS unit_cost FROM v_pricing JOIN v_stock USING (product_id)")
B.add("semi_topk", lambda s, d: relational.semi_topk(grid.aggregate_series(tb.sales_weekly(s, d), WEEKLY), "product_id", "sales_value", 3).select(*CELL, "sales_value"), "SELECT product_id, store_id, week_no, sales_value FROM v_weekly WHERE product_id IN (SELECT product_id FROM v_weekly GROUP BY 1 ORDER BY sum(sales_value) DESC, 1 LIMIT 3)")

# Aggregation and grid
B.add("aggregate_series", lambda s, d: grid.aggregate_series(tb.sales_weekly(s, d), WEEKLY), "SELECT * FROM v_weekly")
B.add("aggregate_rules", lambda s, d: grid.aggregate_rules(tb.sales_weekly(s, d), ["product_id"], {"sales_value": "sum", "quantity": "mean", "week_no": "count"}), "SELECT product_id, sum(sales_value) AS sales_value_sum, avg(quantity) AS quantity_mean, count(week_no) AS week_no_count FROM v_sales_weekly GROUP BY 1")
B.add("master_grid", weekly_grid, "SELECT * FROM v_weekly_grid")
B.add(
    "master_grid_full",
    lambda s, d: grid.master_grid(tb.sales_weekly(s, d), WEEKLY, full=True).select("product_id", "store_id", "week_no", "sales_value", "quantity"),
    """SELECT p.product_id, s.store_id, w.week_no, coalesce(sales_value, 0) AS sales_value, coalesce(quantity, 0) AS quantity
FROM (SELECT DISTINCT product_id FROM v_weekly WHERE sales_value > 0) p CROSS JOIN (SELECT DISTINCT store_id FROM v_weekly WHERE sales_value > 0) s CROSS JOIN (SELECT DISTINCT week_no FROM v_weekly WHERE sales_value > 0) w
LEFT JOIN (SELECT * FROM v_weekly WHERE sales_value > 0) v ON v.product_id = p.product_id AND v.store_id = s.store_id AND v.week_no = w.week_no""",
)
B.add("funnel", lambda s, d: out(context.funnel_rates(context.funnel_pivot(tb.clicks(s, d))), ["visitorid", "total_views", "total_addtocart", "total_transactions"], {"rate_view_to_cart": 4, "rate_cart_to_buy": 4, "rate_view_to_buy": 4}), f"SELECT visitorid, v AS total_views, a AS total_addtocart, t AS total_transactions, {R('a / (v + 1e-6)', 4)} AS rate_view_to_cart, {R('t / (a + 1e-6)', 4)} AS rate_cart_to_buy, {R('t / (v + 1e-6)', 4)} AS rate_view_to_buy FROM (SELECT visitorid, count_if(event = 'view')::BIGINT AS v, count_if(event = 'addtocart')::BIGINT AS a, count_if(event = 'transaction')::BIGINT AS t FROM v_clicks GROUP BY 1)")
B.add("visitor_recency", lambda s, d: out(context.visitor_recency(tb.clicks(s, d)), ["visitorid"], {"active_days": 5, "days_since_last": 5}), f"SELECT visitorid, {R('(max(timestamp) - min(timestamp)) / 86400000', 5)} AS active_days, {R('((SELECT max(timestamp) FROM v_clicks) - max(timestamp)) / 86400000', 5)} AS days_since_last FROM v_clicks GROUP BY 1")
B.add("behavior_features", lambda s, d: context.with_behavior(scan_table(s, d, "customer").select("c_custkey"), tb.clicks(s, d), "c_custkey").select("c_custkey", "total_views", F.round("active_days", 5).alias("active_days")), "SELECT c_custkey, coalesce(v, 0) AS total_views, coalesce(a, 0) AS active_days FROM customer LEFT JOIN (SELECT visitorid, count_if(event = 'view')::BIGINT AS v, round((max(timestamp) - min(timestamp)) / 86400000, 5) AS a FROM v_clicks GROUP BY 1) ON c_custkey = visitorid")

# Series
LAGS = ", ".join(f"lag(sales_value, {k}) {W}) AS sales_value_lag_{k}" for k in WEEKLY.lags)
B.add("lags", lambda s, d: series.with_lags(weekly_grid(s, d), WEEKLY).select(*CELL, *[f"sales_value_lag_{k}" for k in WEEKLY.lags]), f"SELECT product_id, store_id, week_no, {LAGS} FROM v_weekly_grid")
ROLL = ", ".join(
    f"avg(sales_value) {W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS rolling_mean_{n}, {R(f'stddev_samp(sales_value) {W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)', 2)} AS rolling_std_{n}, "
    f"max(sales_value) {W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS rolling_max_{n}, min(sales_value) {W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS rolling_min_{n}"
    for n in WEEKLY.windows
)
STATS = [f"rolling_{x}_{n}" for n in WEEKLY.windows for x in ("mean", "max", "min")]
B.add("rolling_stats", lambda s, d: out(series.with_lags_and_rolling(weekly_grid(s, d), WEEKLY), [*CELL, *STATS], {f"rolling_std_{n}": 2 for n in WEEKLY.windows}), f"SELECT product_id, store_id, week_no, {ROLL} FROM v_weekly_grid")
B.add(
    "trend",
    lambda s, d: out(series.trend(series.with_lags_and_rolling(weekly_grid(s, d), WEEKLY), "sales_value"), [*CELL, "wow_change"], {"momentum": 2, "wow_pct_change": 1}),
    f"SELECT product_id, store_id, week_no, l1 - l4 AS wow_change, {R('m4 - m8', 2)} AS momentum, {R('(l1 - l4) / (l4 + 1e-6)', 1)} AS wow_pct_change FROM (SELECT *, lag(sales_value, 1) {W}) AS l1, lag(sales_value, 4) {W}) AS l4, avg(sales_value) {W} ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS m4, avg(sales_value) {W} ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING) AS m8 FROM v_weekly_grid)",
)
B.add("moving_average", lambda s, d: series.moving_average(tb.demand_daily(s, d), ["product_id"], "date", "actual_demand").select("product_id", F.col("date").cast("string").alias("date"), "moving_average"), "SELECT product_id, CAST(date AS VARCHAR) AS date, avg(actual_demand) OVER (PARTITION BY product_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS moving_average FROM v_demand_daily")
ANGLE = f"(w * {2 * math.pi / 52!r})"
B.add(
    "calendar_week",
    lambda s, d: out(s.range(1, 358).select(F.col("id").cast("int").alias("week_no")).join(tb.sales_weekly(s, d).select("week_no").distinct(), "week_no").withColumns(series.calendar_week(F.col("week_no"))), ["week_no", "week_of_year", "month_proxy", "quarter", "is_month_start", "is_month_end", "is_quarter_start", "is_quarter_end", "week_in_month"], {"week_sin": 6, "week_cos": 6}),
    f"""SELECT week_no, w AS week_of_year, m AS month_proxy, CAST(floor((m - 1) / 3) + 1 AS INTEGER) AS quarter, CAST((w - 1) % 4 = 0 AS INTEGER) AS is_month_start, CAST((w - 1) % 4 = 3 AS INTEGER) AS is_month_end,
  CAST(w % 13 = 1 AS INTEGER) AS is_quarter_start, CAST(w % 13 = 0 AS INTEGER) AS is_quarter_end, CAST((w - 1) % 4 + 1 AS INTEGER) AS week_in_month, {R(f'sin{ANGLE}', 6)} AS week_sin, {R(f'cos{ANGLE}', 6)} AS week_cos
FROM (SELECT *, CAST(least(12, floor((w - 1) / 4.33) + 1) AS INTEGER) AS m FROM (SELECT DISTINCT week_no, CAST((week_no - 1) % 52 + 1 AS INTEGER) AS w FROM v_sales_weekly))""",
)
B.add(
    "calendar_hour",
    lambda s, d: out(tb.hourly_raw(s, d).select("hour_timestamp").distinct().withColumns(series.calendar_hour(F.col("hour_timestamp"))), ["hour_timestamp", "day_of_year", "month", "quarter"], {"day_sin": 6, "day_cos": 6}),
    f"SELECT {TS()} AS hour_timestamp, CAST(dayofyear(hour_timestamp) AS INTEGER) AS day_of_year, CAST(month(hour_timestamp) AS INTEGER) AS month, CAST(quarter(hour_timestamp) AS INTEGER) AS quarter, {R(f'sin(dayofyear(hour_timestamp) * {2 * math.pi / 365.25!r})', 6)} AS day_sin, {R(f'cos(dayofyear(hour_timestamp) * {2 * math.pi / 365.25!r})', 6)} AS day_cos FROM (SELECT DISTINCT hour_timestamp FROM v_hourly_raw)",
)
B.add(
    "intraday",
    lambda s, d: out(tb.hourly_raw(s, d).select("hour_timestamp").distinct().withColumns(series.intraday(F.col("hour_timestamp"))), ["hour_timestamp", "hour_of_day", "day_of_week", "is_morning_peak", "is_evening_peak", "is_overnight", "is_lunch", "is_weekend"], {"hour_sin": 6, "hour_cos": 6, "dow_sin": 6, "dow_cos": 6}),
    f"""SELECT {TS()} AS hour_timestamp, h AS hour_of_day, w AS day_of_week, CAST(h BETWEEN 7 AND 9 AS INTEGER) AS is_morning_peak, CAST(h BETWEEN 17 AND 20 AS INTEGER) AS is_evening_peak, CAST(h = 23 OR h <= 5 AS INTEGER) AS is_overnight,
  CAST(h BETWEEN 11 AND 14 AS INTEGER) AS is_lunch, CAST(w >= 5 AS INTEGER) AS is_weekend, {R(f'sin(h * {2 * math.pi / 24!r})', 6)} AS hour_sin, {R(f'cos(h * {2 * math.pi / 24!r})', 6)} AS hour_cos, {R(f'sin(w * {2 * math.pi / 7!r})', 6)} AS dow_sin, {R(f'cos(w * {2 * math.pi / 7!r})', 6)} AS dow_cos
FROM (SELECT hour_timestamp, CAST(hour(hour_timestamp) AS INTEGER) AS h, CAST(isodow(hour_timestamp) - 1 AS INTEGER) AS w FROM (SELECT DISTINCT hour_timestamp FROM v_hourly_raw))""",
)
B.add(
    "price_promo",
    lambda s, d: out(context.price_promo(grid.aggregate_series(tb.sales_weekly(s, d), WEEKLY), tb.causal(s, d)), [*CELL, "base_price", "total_discount", "is_on_retail_promo", "is_on_coupon_promo", "is_on_display", "is_on_mailer"], {"discount_pct": 6}),
    f"""SELECT product_id, store_id, week_no, sales_value - (retail_disc + coupon_disc) AS base_price, abs(retail_disc + coupon_disc) AS total_discount, CAST(retail_disc < 0 AS INTEGER) AS is_on_retail_promo, CAST(coupon_disc < 0 AS INTEGER) AS is_on_coupon_promo,
  CAST(coalesce(display, '0') <> '0' AS INTEGER) AS is_on_display, CAST(coalesce(mailer, '0') <> '0' AS INTEGER) AS is_on_mailer, {R('abs(retail_disc + coupon_disc) / (sales_value - (retail_disc + coupon_disc) + 1e-6)', 6)} AS discount_pct
FROM v_weekly LEFT JOIN v_causal USING (product_id, store_id, week_no)""",
)
B.add(
    "interactions",
    lambda s, d: _interactions(s, d),
    f"""SELECT product_id, store_id, week_no, coalesce((sales_value - (retail_disc + coupon_disc)) * CAST(coalesce(display, '0') <> '0' AS INTEGER), 0.0) AS price_x_promo, coalesce(code, -1) * CAST(least(12, floor(((week_no - 1) % 52) / 4.33) + 1) AS INTEGER) AS dept_x_month,
  {R(f"coalesce(lag(sales_value) {W}) * sin(CAST((week_no - 1) % 52 + 1 AS INTEGER) * {2 * math.pi / 52!r}), 0.0)", 3)} AS lag_1_x_week_sin
FROM v_weekly_grid LEFT JOIN v_causal USING (product_id, store_id, week_no) LEFT JOIN (SELECT product_id, CAST(dense_rank() OVER (ORDER BY department) - 1 AS INTEGER) AS code FROM v_product) USING (product_id)""",
)


def _interactions(s, d):
    codes = series.department_code(tb.product(s, d)).select("product_id", "dept_code")
    df = context.price_promo(weekly_grid(s, d), tb.causal(s, d)).join(codes, "product_id", "left").fillna(-1, ["dept_code"])
    df = series.interactions(series.with_lags(df, WEEKLY).withColumns(series.calendar_week(F.col("week_no"))), "sales_value")
    return out(df.withColumn("dept_x_month", F.col("dept_x_month").cast("int")), [*CELL, "price_x_promo", "dept_x_month"], {"lag_1_x_week_sin": 3})


FLAGSHIP = ", ".join(f"coalesce(lag(sales_value, {k}) {W}), 0) AS sales_value_lag_{k}" for k in WEEKLY.lags)
FLAG_ROLL = ", ".join(f"coalesce(avg(sales_value) {W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING), 0) AS rolling_mean_{n}, coalesce({R(f'stddev_samp(sales_value) {W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)', 2)}, 0) AS rolling_std_{n}" for n in WEEKLY.windows)
B.add(
    "series_features_weekly",
    lambda s, d: out(series.series_features(weekly_grid(s, d), WEEKLY), [*CELL, "sales_value", "quantity", *[f"sales_value_lag_{k}" for k in WEEKLY.lags], *[f"rolling_mean_{n}" for n in WEEKLY.windows], "week_of_year", "quantity_lag_1"], {f"rolling_std_{n}": 2 for n in WEEKLY.windows}),
    f"SELECT product_id, store_id, week_no, sales_value, quantity, {FLAGSHIP}, {FLAG_ROLL}, CAST((week_no - 1) % 52 + 1 AS INTEGER) AS week_of_year, coalesce(lag(quantity) {W}), 0) AS quantity_lag_1 FROM v_weekly_grid",
)
HLAGS = ", ".join(f"coalesce(lag(sales_quantity, {k}) {WH}), 0) AS sales_quantity_lag_{k}" for k in HOURLY.lags)
HROLL = ", ".join(f"coalesce(avg(sales_quantity) {WH} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING), 0) AS rolling_mean_{n}, coalesce(max(sales_quantity) {WH} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING), 0) AS rolling_max_{n}" for n in HOURLY.windows)
B.add(
    "series_features_hourly",
    lambda s, d: out(series.series_features(tb.hourly(s, d), HOURLY), [*HCELL, *[f"sales_quantity_lag_{k}" for k in HOURLY.lags], *[f"rolling_{x}_{n}" for n in HOURLY.windows for x in ("mean", "max")], "hour_of_day", "is_weekend"]),
    f"SELECT product_id, store_id, {TS()} AS hour_timestamp, {HLAGS}, {HROLL}, CAST(hour(hour_timestamp) AS INTEGER) AS hour_of_day, CAST(isodow(hour_timestamp) >= 6 AS INTEGER) AS is_weekend FROM v_hourly",
)
B.add(
    "order_check",
    lambda s, d: series.order_check(tb.events(s, d).select(F.col("event_type").alias("product_id"), (F.col("user_id") % 10).cast("int").alias("store_id"), F.date_trunc("hour", "ts").alias("hour_timestamp"), "event_id"), HOURLY, "event_id"),
    """SELECT product_id, store_id, count(*) AS n, count(*) FILTER (t < b) AS n_backward, count(*) FILTER (t = b) AS n_repeated
FROM (SELECT *, lag(t) OVER (PARTITION BY product_id, store_id ORDER BY event_id) AS b FROM (SELECT event_type AS product_id, CAST(user_id % 10 AS INTEGER) AS store_id, date_trunc('hour', ts) AS t, event_id FROM events)) GROUP BY ALL""",
)
B.add("pct_change", lambda s, d: out(series.pct_change(grid.aggregate_series(tb.sales_weekly(s, d), WEEKLY), "sales_value", "week_no", (1,), ["product_id", "store_id"]), CELL, {"sales_value_change_1": 2}), f"SELECT product_id, store_id, week_no, {R(f'(sales_value / nullif(lag(sales_value) {W}), 0) - 1) * 100', 2)} AS sales_value_change_1 FROM v_weekly")

QUERIES, ORACLES = B.queries, B.oracles
