"""Queries: stock, price and insight rules, backtests, data quality and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfloom.functions.expr import hash_uniform_sql, norm_cdf, norm_cdf_sql
from shelfloom.operators import clean, insights, inventory, metrics, pricing, profiles, quality, report
from shelfloom.plans import testbed as tb
from shelfloom.plans.kit import TS, Book, R, out, scratch
from shelfloom.plans.q_core import weekly_grid
from shelfloom.sources.tables import scan_table

B = Book()
K = ["product_id", "store_id"]
C = inventory.C
Z = repr(C.z)
SS8, RT7 = repr(C.z * 8**0.5), repr(7**0.5)

B.add("norm_cdf", lambda s, d: out(scan_table(s, d, "part").select("p_partkey", norm_cdf((F.col("p_partkey") % 1600 - 800) / 100).alias("p")), ["p_partkey"], {"p": 12}), f"SELECT p_partkey, {R(norm_cdf_sql('((p_partkey % 1600 - 800) / 100)'), 12)} AS p FROM part")
B.add("safety_stock", lambda s, d: out(tb.stock(s, d).withColumn("safety_stock", inventory.safety_stock(F.col("demand_std"))), ["product_id"], {"safety_stock": 6}), f"SELECT product_id, {R(f'greatest(0, demand_std * {SS8})', 6)} AS safety_stock FROM v_stock")
B.add("reorder_point", lambda s, d: out(tb.stock(s, d).withColumn("reorder_point", inventory.reorder_point(F.col("avg_daily_demand"), inventory.safety_stock(F.col("demand_std")))), ["product_id"], {"reorder_point": 6}), f"SELECT product_id, {R(f'avg_daily_demand * 7 + greatest(0, demand_std * {SS8})', 6)} AS reorder_point FROM v_stock")
B.add(
    "eoq",
    lambda s, d: out(tb.stock(s, d).withColumn("eoq", inventory.eoq(F.col("avg_daily_demand") * 365)).withColumns(inventory.order_costs(F.col("avg_daily_demand") * 365, F.col("eoq"))), ["product_id"], {"eoq": 6, "orders_per_year": 6, "total_cost": 4, "order_interval_days": 6}),
    f"SELECT product_id, {R('q', 6)} AS eoq, {R('a / q', 6)} AS orders_per_year, {R('a / q * 50 + q / 2 * 2', 4)} AS total_cost, {R('365 / (a / q)', 6)} AS order_interval_days FROM (SELECT product_id, avg_daily_demand * 365 AS a, sqrt(avg_daily_demand * 365 * 100 / 2) AS q FROM v_stock)",
)
B.add("eoq_shelf_life", lambda s, d: out(inventory.eoq_shelf_life(tb.stock(s, d), F.col("avg_daily_demand") * 365, F.col("avg_daily_demand")), ["product_id", "constraint_reason", "max_sellable"], {"eoq": 6, "total_cost": 4}), f"SELECT product_id, CASE WHEN m < q THEN 'shelf_life_limited' ELSE 'optimal_eoq' END AS constraint_reason, m AS max_sellable, {R('least(m, q)', 6)} AS eoq, {R('a / least(m, q) * 50 + least(m, q) / 2 * 2', 4)} AS total_cost FROM (SELECT product_id, avg_daily_demand * 365 AS a, avg_daily_demand * 14 AS m, sqrt(avg_daily_demand * 365 * 100 / 2) AS q FROM v_stock)")
SP = norm_cdf_sql(f"((current_inventory - avg_daily_demand * 7) / nullif(demand_std * {RT7}, 0))")
B.add("stockout_probability", lambda s, d: out(tb.stock(s, d).withColumn("p", inventory.stockout_probability(F.col("current_inventory"), F.col("avg_daily_demand"), F.col("demand_std"), 7)), ["product_id"], {"p": 9}), f"SELECT product_id, {R(f'CASE WHEN demand_std = 0 THEN (current_inventory < avg_daily_demand * 7)::INT ELSE greatest({(1 - 0.95) * 0.6!r}, least({(1 - 0.95) * 1.4!r}, 1 - {SP})) END', 9)} AS p FROM v_stock")
F30 = "(SELECT product_id, store_id, avg(forecast_q05) AS q05, avg(forecast_q50) AS d, avg(forecast_q95) AS q95 FROM (SELECT *, row_number() OVER (PARTITION BY product_id, store_id ORDER BY hour_timestamp) AS k FROM v_predictions) WHERE k <= 30 GROUP BY ALL)"
OPT = f"(SELECT *, d * 7 + (q95 - d) AS rop, (q95 - q05) / (2 * 1.645) AS sd, d * 365 AS a, least(sqrt(d * 365 * 100 / 2), d * 14) AS q FROM {F30})"
B.add(
    "optimize_inventory",
    lambda s, d: out(inventory.optimize_inventory(tb.predictions(s, d), K, "hour_timestamp"), [*K, "should_reorder", "constraint_reason"], {"reorder_point": 5, "eoq": 5, "days_until_reorder": 5, "stockout_risk": 7, "overstock_risk": 7}),
    f"""SELECT product_id, store_id, rop * 1.5 <= rop AS should_reorder, CASE WHEN q < sqrt(a * 100 / 2) THEN 'shelf_life_limited' ELSE 'optimal_eoq' END AS constraint_reason, {R('rop', 5)} AS reorder_point, {R('q', 5)} AS eoq, {R('greatest(0, (rop * 1.5 - rop) / nullif(d, 0))', 5)} AS days_until_reorder,
  {R(f"CASE WHEN sd = 0 THEN (rop * 1.5 < d * 7)::INT ELSE greatest({(1 - 0.95) * 0.6!r}, least({(1 - 0.95) * 1.4!r}, 1 - {norm_cdf_sql(f'((rop * 1.5 - d * 7) / nullif(sd * {RT7}, 0))')})) END", 7)} AS stockout_risk,
  {R(f"CASE WHEN sd > 0 THEN {norm_cdf_sql(f'((rop * 2 - rop * 1.5) / nullif(sd * {RT7}, 0))')} ELSE 0 END", 7)} AS overstock_risk FROM {OPT}""",
)
IM = f"""(SELECT *, CASE WHEN demand_std > 0 THEN (1 - {norm_cdf_sql(f'((current_inventory - avg_daily_demand * 7) / nullif(demand_std * {RT7}, 0))')}) * 100 WHEN current_inventory >= avg_daily_demand * 7 THEN 0 ELSE 100 END AS risk,
  greatest(0, least(100, (current_inventory / avg_daily_demand - 10) * 10)) AS ov, greatest(0, demand_std * {C.z * 7**0.5!r}) AS ss, sqrt(avg_daily_demand * 365 * 100 / (unit_cost * 0.2)) AS q FROM v_stock)"""
B.add(
    "inventory_metrics",
    lambda s, d: out(inventory.inventory_metrics(tb.stock(s, d)), ["product_id", "should_reorder", "reorder_urgency", "risk_category"], {"stockout_risk_pct": 6, "overstock_risk_pct": 6, "eoq": 5, "inventory_turnover": 5, "fill_rate_expected": 6, "total_cost_daily": 5}),
    f"""SELECT product_id, current_inventory <= avg_daily_demand * 7 + ss AS should_reorder, CASE WHEN risk > 70 THEN 'CRITICAL' WHEN risk > 50 THEN 'HIGH' WHEN current_inventory <= avg_daily_demand * 7 + ss THEN 'MEDIUM' ELSE 'LOW' END AS reorder_urgency,
  CASE WHEN risk > 50 AND ov > 50 THEN 'CRITICAL' WHEN risk > 50 THEN 'STOCKOUT_RISK' WHEN ov > 60 THEN 'OVERSTOCK_RISK' ELSE 'BALANCED' END AS risk_category, {R('risk', 6)} AS stockout_risk_pct, {R('ov', 6)} AS overstock_risk_pct, {R('q', 5)} AS eoq,
  {R('avg_daily_demand * 365 / (q / 2 + ss)', 5)} AS inventory_turnover, {R('least(0.99, (1 - risk / 100) * 1.02)', 6)} AS fill_rate_expected, {R('current_inventory * (unit_cost * 0.2) / 365 + avg_daily_demand * 365 / q * 50 / 365', 5)} AS total_cost_daily FROM {IM}""",
)
B.add(
    "inventory_risk_view",
    lambda s, d: out(inventory.inventory_risk_view(tb.stock(s, d).withColumns({"lead_time_demand": F.col("avg_daily_demand") * 7, "safety_stock": F.col("demand_std") * 2})), ["product_id"], {"stockout_risk_pct": 2, "overstock_risk_pct": 2, "target_days": 6}),
    f"SELECT product_id, {R(f'greatest(0, least(7, coalesce((1 - p) * 100, CASE WHEN current_inventory >= l THEN 0 ELSE 5 END)))', 2)} AS stockout_risk_pct, {R('greatest(0, least(95, (current_inventory / avg_daily_demand - t) / t * 100))', 2)} AS overstock_risk_pct, {R('t', 6)} AS target_days FROM (SELECT *, greatest(1, least(60, (l + demand_std * 2) / avg_daily_demand)) AS t, {norm_cdf_sql('((current_inventory - l) / nullif(demand_std * sqrt(7.0), 0))')} AS p FROM (SELECT *, avg_daily_demand * 7 AS l FROM v_stock))",
)
B.add("demand_stats", lambda s, d: out(inventory.demand_stats(tb.hourly(s, d), K, "sales_quantity"), [*K, "avg_demand"], {"demand_std": 5}), f"SELECT product_id, store_id, avg(sales_quantity) AS avg_demand, {R('stddev_samp(sales_quantity)', 5)} AS demand_std FROM v_hourly GROUP BY ALL")
DRAW, DRAW2 = hash_uniform_sql("product_id", seed=42), hash_uniform_sql("product_id", "store_id", seed=42)
B.add(
    "forecast_risk",
    lambda s, d: out(inventory.forecast_risk(tb.predictions(s, d)), ["product_id", "overstock_risk_pct"], {"stockout_risk_pct": 6}),
    f"SELECT product_id, CAST(CASE WHEN m > 0 THEN CASE WHEN r < 3 THEN 5 WHEN r < 4 THEN 15 WHEN r < 6 THEN 30 WHEN r < 8 THEN 60 ELSE 80 END ELSE 0 END AS DOUBLE) AS overstock_risk_pct, {R(f'CASE WHEN m > 0 AND sd > 0 THEN greatest(0, least(95, (1 - {norm_cdf_sql(chr(40) + chr(40) + "st - m * 2) / (sd * 1.4142135623730951))")}) * 100)) ELSE 0 END', 6)} AS stockout_risk_pct FROM (SELECT *, st / nullif(m, 0) AS r FROM (SELECT product_id, avg(forecast_q50) AS m, stddev_samp(forecast_q50) AS sd, avg(forecast_q50) * greatest(1, 2.2 + 0.6 * {DRAW}) + avg(forecast_q50) * 0.3 AS st FROM v_predictions GROUP BY 1))",
)
B.add("inventory_snapshot", lambda s, d: out(inventory.inventory_snapshot(tb.hourly(s, d)), [*K, "current_inventory"], {"inventory_ratio": 6}), f"SELECT product_id, store_id, CAST(floor(m * (1.5 + 1.5 * {DRAW2})) AS BIGINT) AS current_inventory, {R(f'floor(m * (1.5 + 1.5 * {DRAW2})) / m', 6)} AS inventory_ratio FROM (SELECT product_id, store_id, avg(sales_quantity) AS m FROM v_hourly GROUP BY ALL)")
RAW = f"CASE WHEN sd = 0 THEN (rop * 1.5 < d * 7)::INT ELSE 1 - {norm_cdf_sql(f'((rop * 1.5 - d * 7) / nullif(sd * {RT7}, 0))')} END"
B.add("priority_reorders", lambda s, d: out(clean.priority_reorders(inventory.optimize_inventory(tb.predictions(s, d), K, "hour_timestamp"), 0.02), K, {"stockout_risk_raw": 7}), f"SELECT product_id, store_id, {R('raw', 7)} AS stockout_risk_raw FROM (SELECT *, {RAW} AS raw FROM {OPT}) WHERE rop * 1.5 <= rop OR raw > 0.02")
B.add(
    "inventory_report",
    lambda s, d: out(report.inventory_report(inventory.optimize_inventory(tb.predictions(s, d), K, "hour_timestamp"), 0.02), ["products", "reorders", "high_risk"], {"mean_days_until_reorder": 5, "total_cost": 3}),
    f"SELECT count(*) AS products, count(*) FILTER (rop * 1.5 <= rop) AS reorders, count(*) FILTER ({RAW} > 0.02) AS high_risk, {R('avg(greatest(0, (rop * 1.5 - rop) / nullif(d, 0)))', 5)} AS mean_days_until_reorder, {R('sum(a / nullif(q, 0) * 50 + q / 2 * 2)', 3)} AS total_cost FROM {OPT}",
)

# Ledger
LEDGER = """x AS (SELECT *, row_number() OVER w - 1 AS i, floor(coalesce(lag(ord, 16) OVER w, 0)) + CASE WHEN row_number() OVER w - 1 = 15 THEN 100 ELSE 0 END AS spoiled, CASE WHEN row_number() OVER w = 1 THEN 100.0 ELSE lag(ord) OVER w END AS inn FROM o WINDOW w AS (PARTITION BY product_id, strategy ORDER BY date)),
y AS (SELECT *, sum(inn - spoiled - actual_demand) OVER (PARTITION BY product_id, strategy ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM x),
z AS (SELECT *, s - least(0, min(s) OVER (PARTITION BY product_id, strategy ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS post FROM y),
v AS (SELECT *, coalesce(lag(post) OVER (PARTITION BY product_id, strategy ORDER BY date), 0) + inn - spoiled AS av FROM z),
l AS (SELECT *, greatest(0, least(actual_demand, av)) AS sold, greatest(0, actual_demand - av) AS stockout, post + ord AS inventory FROM v)"""
ORDERS = "o AS (SELECT *, 'forecast' AS strategy, forecast_q50 AS ord FROM v_demand_daily UNION ALL SELECT *, 'baseline', avg(actual_demand) OVER (PARTITION BY product_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) FROM v_demand_daily)"
B.add(
    "inventory_ledger",
    lambda s, d: out(inventory.ledger(tb.demand_daily(s, d).withColumn("date", F.col("date").cast("string")), ["product_id"], "date", "actual_demand", "forecast_q50"), ["product_id", "date"], {"spoiled": 3, "sold": 3, "stockout": 3, "inventory": 3, "profit": 3}),
    f"WITH {ORDERS}, {LEDGER} SELECT product_id, CAST(date AS VARCHAR) AS date, {R('spoiled', 3)} AS spoiled, {R('sold', 3)} AS sold, {R('stockout', 3)} AS stockout, {R('inventory', 3)} AS inventory, {R('sold * 15 - sold * 10 - spoiled * 5 - stockout * 8 - inventory * 0.1', 3)} AS profit FROM l WHERE strategy = 'forecast'",
)
KPI = "SELECT strategy, sum(spoiled) / nullif(sum(sold) + sum(spoiled), 0) * 100 AS sp, sum(stockout) / nullif(sum(actual_demand), 0) * 100 AS so, sum(sold) / nullif(sum(actual_demand), 0) * 100 AS fr, sum(sold * 15 - sold * 10 - spoiled * 5 - stockout * 8 - inventory * 0.1) / nullif(sum(sold * 15), 0) * 100 AS pm FROM l GROUP BY 1"
B.add("backtest_kpis", lambda s, d: out(inventory.backtest_kpis(inventory.ledger(inventory.policies(tb.demand_daily(s, d), ["product_id"], "date", "actual_demand"), ["product_id", "strategy"], "date", "actual_demand", "order_quantity"), "actual_demand"), ["strategy"], {"spoilage_rate_pct": 5, "stockout_rate_pct": 5, "fill_rate_pct": 5, "profit_margin_pct": 5}), f"WITH {ORDERS}, {LEDGER}, k AS ({KPI}) SELECT strategy, {R('sp', 5)} AS spoilage_rate_pct, {R('so', 5)} AS stockout_rate_pct, {R('fr', 5)} AS fill_rate_pct, {R('pm', 5)} AS profit_margin_pct FROM k")
B.add(
    "backtest_compare",
    lambda s, d: out(inventory.backtest_compare(tb.demand_daily(s, d), ["product_id"], "date", "actual_demand"), ["metric"], {"baseline": 5, "forecast": 5, "improvement": 5}),
    f"WITH {ORDERS}, {LEDGER}, k AS ({KPI}), j AS (SELECT b.sp AS bsp, b.so AS bso, b.pm AS bpm, f.sp AS fsp, f.so AS fso, f.pm AS fpm FROM k b, k f WHERE b.strategy = 'baseline' AND f.strategy = 'forecast') " + " UNION ALL ".join(f"SELECT '{m}' AS metric, {R('b' + c, 5)} AS baseline, {R('f' + c, 5)} AS forecast, {R(e, 5)} AS improvement FROM j" for m, c, e in (("spoilage_rate_pct", "sp", "bsp - fsp"), ("stockout_rate_pct", "so", "bso - fso"), ("profit_margin_pct", "pm", "fpm - bpm"))),
)
B.add("scenario_analysis", lambda s, d: out(pricing.scenario_analysis(tb.pricing(s, d), "demand", "current_price"), ["scenario"], {"revenue_change_pct": 6, "avg_demand": 6}), " UNION ALL ".join(f"SELECT '{n}' AS scenario, {R(f'((1 + {a}) * (1 + {b}) - 1) * 100', 6)} AS revenue_change_pct, {R(f'avg(demand) * (1 + {a})', 6)} AS avg_demand FROM v_pricing" for n, a, b in pricing.SCENARIOS))

# Prices
RULE = lambda k: f"CASE WHEN inventory_ratio >= 3 THEN {k[0]} WHEN inventory_ratio >= 2 AND demand_ratio <= 0.8 THEN {k[1]} WHEN inventory_ratio >= 2 AND demand_ratio < 1.2 THEN {k[2]} WHEN inventory_ratio >= 2 THEN {k[3]} WHEN inventory_ratio >= 1 AND demand_ratio <= 0.8 THEN {k[4]} ELSE {k[5]} END"
OFF, ACT = RULE(["0.45", "0.325", "0.2", "0.1", "0.075", "0.0"]), RULE(["'clearance'", "'large_discount'", "'medium_discount'", "'small_discount'", "'small_discount'", "'maintain'"])
PRICE = f"(SELECT *, greatest(a, cost * 1.1) AS np FROM (SELECT *, current_price - current_price * d AS a FROM (SELECT *, {OFF} AS d, {ACT} AS action FROM v_pricing)))"
B.add("discount_rule", lambda s, d: out(tb.pricing(s, d).withColumns(pricing.discount_rule(F.col("inventory_ratio"), F.col("demand_ratio"))), ["product_id", "action"], {"discount_pct": 6}), f"SELECT product_id, {ACT} AS action, {R(OFF, 6)} AS discount_pct FROM v_pricing")
B.add("recommend_price", lambda s, d: out(pricing.recommend_price(tb.pricing(s, d)), ["product_id", "action", "should_apply"], {"recommended_price": 6, "profit_margin": 6, "discount_pct": 6}), f"SELECT product_id, action, CASE WHEN a < cost * 1.1 THEN (current_price - np) / current_price ELSE d END > 0 AS should_apply, {R('np', 6)} AS recommended_price, {R('(np - cost) / np', 6)} AS profit_margin, {R('CASE WHEN a < cost * 1.1 THEN (current_price - np) / current_price ELSE d END', 6)} AS discount_pct FROM {PRICE}")
B.add("active_recommendations", lambda s, d: clean.active_recommendations(pricing.recommend_price(tb.pricing(s, d))).select("product_id", "action"), f"SELECT product_id, action FROM {PRICE} WHERE CASE WHEN a < cost * 1.1 THEN (current_price - np) / current_price ELSE d END > 0 ORDER BY product_id LIMIT 50")
B.add("pricing_report", lambda s, d: out(pricing.pricing_report(pricing.recommend_price(tb.pricing(s, d))), ["products", "discounted"], {"mean_discount_pct": 6, "mean_margin": 6}), f"SELECT count(*) AS products, count(*) FILTER (e > 0) AS discounted, {R('avg(e) FILTER (e > 0) * 100', 6)} AS mean_discount_pct, {R('avg((np - cost) / np)', 6)} AS mean_margin FROM (SELECT *, CASE WHEN a < cost * 1.1 THEN (current_price - np) / current_price ELSE d END AS e FROM {PRICE})")
B.add("action_counts", lambda s, d: pricing.action_counts(pricing.recommend_price(tb.pricing(s, d))), f"SELECT action, count(*) AS n FROM {PRICE} GROUP BY 1")
OFF2 = "CASE WHEN inventory_ratio >= 3 THEN 0.45 WHEN inventory_ratio >= 2 AND demand_ratio <= 0.8 THEN 0.3 WHEN inventory_ratio >= 2 AND demand_ratio < 1.2 THEN 0.18 WHEN inventory_ratio >= 2 THEN 0.08 WHEN inventory_ratio >= 1.5 AND demand_ratio <= 0.8 THEN 0.08 ELSE 0.0 END"
B.add(
    "price_impact",
    lambda s, d: out(pricing.price_impact(tb.pricing(s, d)), ["product_id", "priority", "competitive_position"], {"recommended_price": 6, "price_change_pct": 6, "demand_change_pct": 6, "revenue_change": 4, "profit_change": 4}),
    f"""SELECT product_id, CASE WHEN inventory_ratio > 3 THEN 'CRITICAL' WHEN inventory_ratio > 2 AND demand_ratio < 0.8 THEN 'HIGH' WHEN e > 0.15 THEN 'MEDIUM' ELSE 'LOW' END AS priority, CASE WHEN e > 0.3 THEN 'AGGRESSIVE' WHEN e > 0.1 THEN 'COMPETITIVE' ELSE 'PREMIUM' END AS competitive_position,
  {R('np', 6)} AS recommended_price, {R('pc', 6)} AS price_change_pct, {R('el * pc', 6)} AS demand_change_pct, {R('np * demand * (1 + el * pc / 100) - current_price * demand', 4)} AS revenue_change, {R('(np - cost) * demand * (1 + el * pc / 100) - (current_price - cost) * demand', 4)} AS profit_change
FROM (SELECT *, (np - current_price) / current_price * 100 AS pc, CASE WHEN current_price * (1 - d) < cost * 1.1 THEN (current_price - np) / current_price ELSE d END AS e, CASE category WHEN 'fresh_produce' THEN -1.5 WHEN 'dairy' THEN -1.2 WHEN 'packaged' THEN -0.8 ELSE -1.0 END AS el
  FROM (SELECT *, greatest(current_price * (1 - d), cost * 1.1) AS np FROM (SELECT *, {OFF2} AS d FROM v_pricing)))""",
)
B.add(
    "pricing_inputs",
    lambda s, d: out(pricing.pricing_inputs(tb.predictions(s, d), inventory.inventory_snapshot(tb.hourly(s, d)).where("current_inventory > 5"), K), [*K, "hour_timestamp"], {"demand_ratio": 6, "inventory_ratio": 6}),
    f"SELECT p.product_id, p.store_id, {TS('p.hour_timestamp')} AS hour_timestamp, {R('coalesce(forecast_q50 / (SELECT avg(sales_quantity) FROM v_predictions), 1)', 6)} AS demand_ratio, {R('coalesce(r, 1)', 6)} AS inventory_ratio FROM v_predictions p LEFT JOIN (SELECT product_id, store_id, c / m AS r FROM (SELECT *, floor(m * (1.5 + 1.5 * {DRAW2})) AS c FROM (SELECT product_id, store_id, avg(sales_quantity) AS m FROM v_hourly GROUP BY ALL)) WHERE c > 5) i ON p.product_id = i.product_id AND p.store_id = i.store_id",
)

# Insights
B.add("representative_row", lambda s, d: out(insights.representative_row(tb.pricing(s, d).select("brand", "product_id", "category", "demand_ratio"), "brand", "product_id"), ["brand", "category"], {"product_id": 4, "demand_ratio": 6}), f"SELECT brand, arg_min(category, product_id) AS category, {R('avg(product_id)', 4)} AS product_id, {R('avg(demand_ratio)', 6)} AS demand_ratio FROM v_pricing GROUP BY 1")


def _labelled(s, d):
    k = F.col("product_id")
    rows = tb.stock(s, d).join(tb.pricing(s, d).select("product_id", "current_price"), "product_id")
    rows = rows.select("*", ((k % 31) - 15.0).alias("vs_yesterday"), ((k % 29) - 14.0).alias("vs_last_week"), (k % 40).cast("double").alias("uncertainty_pct"), (k % 101).cast("double").alias("stockout_risk_pct"), ((k * 3) % 101).cast("double").alias("overstock_risk_pct"), F.col("avg_daily_demand").alias("q50"))
    return insights.trend_labels(rows)


LB = "(SELECT s.*, current_price, (product_id % 31) - 15.0 AS dy, (product_id % 29) - 14.0 AS wk, product_id % 40 AS u, product_id % 101 AS sr, (product_id * 3) % 101 AS os FROM v_stock s JOIN v_pricing USING (product_id))"
TREND = "CASE WHEN dy > 10 OR wk > 10 THEN 'STRONG UPWARD' WHEN dy > 5 OR wk > 5 THEN 'UPWARD' WHEN dy < -10 OR wk < -10 THEN 'STRONG DOWNWARD' WHEN dy < -5 OR wk < -5 THEN 'DOWNWARD' ELSE 'STABLE' END"
LEVEL = lambda c: f"CASE WHEN {c} >= 70 THEN 'CRITICAL' WHEN {c} >= 50 THEN 'HIGH' WHEN {c} >= 30 THEN 'MODERATE' ELSE 'LOW' END"
B.add(
    "trend_labels",
    lambda s, d: out(_labelled(s, d), ["product_id", "confidence_level", "trend", "stockout_level", "overstock_level", "stockout_status", "overstock_status"], {"days_of_stock": 6, "margin": 6}),
    f"""SELECT product_id, CASE WHEN u < 10 THEN 'HIGH' WHEN u < 25 THEN 'MODERATE' ELSE 'LOW' END AS confidence_level, {TREND} AS trend, {LEVEL('sr')} AS stockout_level, {LEVEL('os')} AS overstock_level,
  CASE WHEN sr >= 70 THEN 'IMMEDIATE ACTION REQUIRED' WHEN sr >= 50 THEN 'MONITOR CLOSELY' ELSE 'MANAGEABLE' END AS stockout_status, CASE WHEN os >= 60 THEN 'URGENT CLEARANCE NEEDED' WHEN os >= 40 THEN 'CONSIDER MARKDOWNS' ELSE 'ACCEPTABLE' END AS overstock_status,
  {R('current_inventory / avg_daily_demand', 6)} AS days_of_stock, {R('(current_price - unit_cost) / current_price', 6)} AS margin FROM {LB}""",
)


def _insights(s, d):
    k = F.col("product_id")
    rows = _labelled(s, d).withColumns({"should_reorder": k % 2 == 0, "action": F.when(k % 3 == 0, "maintain").otherwise("small_discount"), "features": F.when(k % 4 == 0, F.array(F.lit("promo_a"), F.lit("lag_1"))).otherwise(F.array(F.lit("other")))})
    return insights.rule_insights(rows).select("product_id", "impact", F.array_join("causes", "|").alias("causes"), F.array_join("actions", "|").alias("actions"))


B.add(
    "rule_insights",
    _insights,
    f"""SELECT product_id, CASE WHEN contains(t, 'UPWARD') THEN 'growth' WHEN contains(t, 'DOWNWARD') THEN 'decline' ELSE 'stable' END AS impact, CASE WHEN product_id % 4 = 0 THEN 'promotion|history' ELSE 'normal market' END AS causes,
  coalesce(nullif(concat_ws('|', CASE WHEN sr > 50 THEN 'URGENT: reorder' END, CASE WHEN sr <= 50 AND product_id % 2 = 0 THEN 'HIGH: reorder' END, CASE WHEN os > 50 THEN 'URGENT: markdown' END, CASE WHEN product_id % 3 <> 0 THEN 'HIGH: adjust price' END), ''), 'MEDIUM: monitor') AS actions FROM (SELECT *, {TREND} AS t FROM {LB})""",
)


def _priority(s, d):
    k = F.col("product_id")
    f = tb.pricing(s, d).select("product_id", F.col("demand").alias("forecast_q50"), (F.col("demand") * 0.9).alias("forecast_q05"), (F.col("demand") * (1 + (k % 5) / 10)).alias("forecast_q95"))
    inv = tb.stock(s, d).select("product_id", "current_inventory", F.lit(80.0).alias("reorder_point"), (k % 101).cast("double").alias("stockout_risk_pct"))
    price = pricing.recommend_price(tb.pricing(s, d)).select("product_id", "current_price", "recommended_price", "discount_pct")
    return insights.priority_insights(f, inv, price).select("product_id", "priority", F.array_join("actions", "|").alias("actions"))


B.add(
    "priority_insights",
    _priority,
    f"""SELECT product_id, CASE WHEN sr > 50 THEN 'CRITICAL' WHEN ci < 80 OR (demand * (1 + (product_id % 5) / 10) - demand * 0.9) / demand > 0.3 THEN 'HIGH' ELSE 'MEDIUM' END AS priority,
  concat_ws('|', CASE WHEN sr > 50 THEN 'reorder now' END, CASE WHEN sr <= 50 AND ci < 80 THEN 'reorder' END, CASE WHEN e > 0.2 THEN 'discount' END, CASE WHEN e > 0 AND e <= 0.2 THEN 'consider discount' END) AS actions
FROM (SELECT p.*, s.current_inventory AS ci, product_id % 101 AS sr, CASE WHEN a < cost * 1.1 THEN (current_price - np) / current_price ELSE d END AS e FROM {PRICE} p JOIN v_stock s USING (product_id)) ORDER BY demand DESC, product_id LIMIT 20""",
)
VF = "(SELECT product_id, CAST(product_id % 50 - 2 AS DOUBLE) AS q50, CASE WHEN product_id % 3 > 0 THEN product_id % 50 * 0.8 END AS q05, CASE WHEN product_id % 4 > 0 THEN product_id % 50 * 1.1 END AS q95 FROM v_pricing)"


def _forecasts(s, d):
    k = F.col("product_id")
    return tb.pricing(s, d).select("product_id", (k % 50 - 2).cast("double").alias("q50"), F.when(k % 3 > 0, (k % 50) * 0.8).alias("q05"), F.when(k % 4 > 0, (k % 50) * 1.1).alias("q95"))


B.add(
    "validate_forecast",
    lambda s, d: out(quality.validate_forecast(_forecasts(s, d)).withColumn("warnings", F.array_join("warnings", "|")), ["product_id", "is_valid", "confidence_level", "warnings"], {"uncertainty_pct": 6}),
    f"""SELECT product_id, NOT (q50 < 0 OR coalesce(q05 < 0, false) OR coalesce(q95 < 0, false)) AS is_valid, CASE WHEN u < 10 THEN 'HIGH' WHEN u < 25 THEN 'MODERATE' ELSE 'LOW' END AS confidence_level,
  concat_ws('|', CASE WHEN q05 IS NULL THEN 'q05 estimated' END, CASE WHEN q05 > q50 THEN 'q05 above q50' END, CASE WHEN q95 IS NULL THEN 'q95 estimated' END, CASE WHEN q95 < q50 THEN 'q95 below q50' END, CASE WHEN q50 = 0 THEN 'q50 zero' END) AS warnings, {R('u', 6)} AS uncertainty_pct
FROM (SELECT *, CASE WHEN q50 > 0 THEN (coalesce(q95, q50 * 1.3) - q50) / q50 * 100 ELSE 0 END AS u FROM {VF})""",
)
B.add(
    "validate_inventory",
    lambda s, d: out(quality.validate_inventory(tb.stock(s, d).withColumns({"current_inventory": F.col("current_inventory") - 20, "safety_stock": F.when(F.col("product_id") % 3 > 0, F.col("demand_std")), "reorder_point": F.when(F.col("product_id") % 5 > 0, F.col("avg_daily_demand") * 7), "stockout_risk_pct": (F.col("product_id") % 130 - 15).cast("double"), "overstock_risk_pct": F.lit(50.0), "avg_demand": F.col("avg_daily_demand")})), ["product_id", "is_valid", "should_reorder", "stockout_risk_pct"], {"inventory_ratio": 6}),
    f"SELECT product_id, i >= 0 AS is_valid, i <= coalesce(CASE WHEN product_id % 5 > 0 THEN avg_daily_demand * 7 END, CASE WHEN product_id % 3 > 0 THEN demand_std END, 0) AS should_reorder, greatest(0.0, least(100.0, CAST(product_id % 130 - 15 AS DOUBLE))) AS stockout_risk_pct, {R('i / avg_daily_demand', 6)} AS inventory_ratio FROM (SELECT *, current_inventory - 20 AS i FROM v_stock)",
)
B.add(
    "validate_pricing",
    lambda s, d: out(quality.validate_pricing(tb.pricing(s, d).select("product_id", "current_price", F.when(F.col("product_id") % 3 > 0, F.col("cost")).alias("unit_cost"), (F.col("current_price") * (F.col("product_id") % 7) / 5).alias("recommended_price"), ((F.col("product_id") % 14 - 2) / 10.0).alias("discount_pct"))).withColumn("warnings", F.array_join("warnings", "|")), ["product_id", "is_valid", "warnings"], {"discount_pct": 6, "current_margin": 6, "price_change_pct": 6}),
    f"""SELECT product_id, true AS is_valid, concat_ws('|', CASE WHEN c IS NULL THEN 'unit_cost estimated' END, CASE WHEN n < 0.01 THEN 'recommended_price too low' END, CASE WHEN o < 0 OR o > 1 THEN 'discount_pct out of range' END, CASE WHEN n < c THEN 'sold at a loss' END) AS warnings,
  {R('greatest(0, least(1, o))', 6)} AS discount_pct, {R('(current_price - coalesce(c, current_price * 0.5)) / current_price', 6)} AS current_margin, {R('(CASE WHEN n >= 0.01 THEN n ELSE current_price END - current_price) / current_price * 100', 6)} AS price_change_pct
FROM (SELECT *, CASE WHEN product_id % 3 > 0 THEN cost END AS c, current_price * (product_id % 7) / 5 AS n, (product_id % 14 - 2) / 10.0 AS o FROM v_pricing)""",
)
B.add("validated_insights", lambda s, d: insights.validated_insights(_forecasts(s, d).join(tb.stock(s, d).select("product_id", "current_inventory", "unit_cost"), "product_id").join(tb.pricing(s, d).select("product_id", "current_price", "category"), "product_id")).select("product_id", "status", "confidence_level", "action"), f"SELECT product_id, CASE WHEN q50 < 0 THEN 'error' ELSE 'ok' END AS status, CASE WHEN u < 10 THEN 'HIGH' WHEN u < 25 THEN 'MODERATE' ELSE 'LOW' END AS confidence_level, CASE WHEN r >= 3 THEN 'clearance' WHEN r >= 2 THEN 'medium_discount' ELSE 'maintain' END AS action FROM (SELECT *, CASE WHEN q50 > 0 THEN (coalesce(q95, q50 * 1.3) - q50) / q50 * 100 ELSE 0 END AS u, coalesce(current_inventory / nullif(q50, 0), 0) AS r FROM {VF} JOIN v_stock USING (product_id))")

# Data quality
B.add("range_check", lambda s, d: quality.range_check(scan_table(s, d, "lineitem"), {"l_quantity": (5, 45), "l_discount": (0.01, 0.09)}), "SELECT 'l_quantity' AS column, count(*) FILTER (l_quantity < 5) AS below, count(*) FILTER (l_quantity > 45) AS above FROM lineitem UNION ALL SELECT 'l_discount', count(*) FILTER (l_discount < 0.01), count(*) FILTER (l_discount > 0.09) FROM lineitem")
B.add("consistency_check", lambda s, d: quality.consistency_check(tb.pricing(s, d), {"cost": (F.col("cost"), F.col("current_price") * 0.6), "demand": (F.col("demand"), F.col("inventory_ratio") * 15 + 1)}).withColumn("max_diff", F.round("max_diff", 6)), "SELECT 'cost' AS rule, max(abs(cost - current_price * 0.6)) AS max_diff, true AS consistent FROM v_pricing UNION ALL SELECT 'demand', round(max(abs(demand - (inventory_ratio * 15 + 1))), 6), false FROM v_pricing")
B.add("missing_profile", lambda s, d: quality.missing_profile(tb.gappy(s, d), ["sales_lag_1", "price"]).withColumn("null_pct", F.round("null_pct", 6)), "SELECT 'sales_lag_1' AS column, count(*) - count(sales_lag_1) AS nulls, round((count(*) - count(sales_lag_1)) * 100 / count(*), 6) AS null_pct, (count(*) - count(sales_lag_1)) * 100 / count(*) > 50 AS mostly_missing FROM v_gappy UNION ALL SELECT 'price', count(*) - count(price), round((count(*) - count(price)) * 100 / count(*), 6), (count(*) - count(price)) * 100 / count(*) > 50 FROM v_gappy")
B.add("duplicate_count", lambda s, d: quality.duplicate_count(scan_table(s, d, "lineitem"), ["l_partkey", "l_suppkey"]), "SELECT CAST(count(*) - count(DISTINCT (l_partkey, l_suppkey)) AS BIGINT) AS duplicates FROM lineitem")
B.add(
    "baseline_profile",
    lambda s, d: out(quality.baseline_profile(tb.hourly(s, d), ["sales_quantity"], ["product_id"]), ["column", "metric"], {"value": 5}),
    f"WITH x AS (SELECT sales_quantity AS v, product_id AS p FROM v_hourly) " + " UNION ALL ".join(f"SELECT '{c}' AS column, '{m}' AS metric, {R(e, 5)} AS value FROM x" for c, m, e in (("sales_quantity", "mean", "avg(v)"), ("sales_quantity", "std", "stddev_samp(v)"), ("sales_quantity", "min", "min(v)"), ("sales_quantity", "max", "max(v)"), ("sales_quantity", "q25", "quantile_cont(v, 0.25)"), ("sales_quantity", "q50", "quantile_cont(v, 0.5)"), ("sales_quantity", "q75", "quantile_cont(v, 0.75)"), ("sales_quantity", "null_pct", "0.0 * count(*)"), ("product_id", "null_pct", "0.0 * count(*)"), ("product_id", "distinct", "count(DISTINCT p)"))) + " UNION ALL SELECT 'product_id', 'top:' || p, count(*)::DOUBLE FROM x GROUP BY p",
)


def _merged_profile(s, d):
    """Profiles of all order lines by month, stored, read back and merged; sketched values against their bounds."""
    rows = scan_table(s, d, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM").alias("month"), F.col("l_extendedprice").cast("double").alias("price"), "l_quantity", "l_returnflag")
    place = scratch(s, "profiles")
    profiles.profile(rows, ["price", "l_quantity"], ["l_returnflag"], ["month"]).write.parquet(place)
    found = profiles.describe(profiles.merge(s.read.parquet(place))).withColumnRenamed("value", "v")
    exact = {"mean", "std", "min", "max", "null_pct"}
    # A sketched quantile stands in for its rank: how far from it the rows really are.
    wide = found.where("column = 'price'").groupBy().pivot("metric", ["q25", "q50", "q75"]).agg(F.first("v"))
    share = rows.crossJoin(F.broadcast(wide)).agg(*[F.avg((F.col("price") <= F.col(q)).cast("double")).alias(q) for q in ("q25", "q50", "q75")])
    ranks = share.select(F.explode(F.array(*[F.struct(F.lit(q).alias("metric"), (F.abs(F.col(q) - p) <= 0.0133).cast("double").alias("value")) for q, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))])).alias("x"))
    ranks = ranks.select(F.lit("price").alias("column"), F.concat("x.metric", F.lit(" within bound")).alias("metric"), F.col("x.value").alias("value"))
    plain = found.where(F.col("metric").isin(*exact) | ((F.col("metric") == "distinct") & (F.col("column") != "price"))).select("column", "metric", F.col("v").alias("value"))
    return out(plain.unionByName(ranks), ["column", "metric"], {"value": 4})


B.add(
    "merged_profile",
    _merged_profile,
    "WITH x AS (SELECT l_extendedprice::DOUBLE AS price, l_quantity::DOUBLE AS l_quantity, l_returnflag FROM lineitem) "
    + " UNION ALL ".join(f"SELECT '{c}' AS column, '{m}' AS metric, {R(e.format(c), 4)} AS value FROM x" for c in ("price", "l_quantity") for m, e in (("mean", "avg({0})"), ("std", "stddev_samp({0})"), ("min", "min({0})"), ("max", "max({0})"), ("null_pct", "100.0 * count(*) FILTER ({0} IS NULL) / count(*)")))
    + " UNION ALL SELECT 'l_quantity', 'distinct', count(DISTINCT l_quantity)::DOUBLE FROM x UNION ALL SELECT 'l_returnflag', 'distinct', count(DISTINCT l_returnflag)::DOUBLE FROM x UNION ALL SELECT 'l_returnflag', 'null_pct', 100.0 * count(*) FILTER (l_returnflag IS NULL) / count(*) FROM x"
    + "".join(f" UNION ALL SELECT 'price', '{q} within bound', 1.0" for q in ("q25", "q50", "q75")),
)
OLD = "epoch_us(hour_timestamp) < (SELECT quantile_cont(epoch_us(hour_timestamp)::DOUBLE, 0.5) FROM v_hourly)"
B.add("detect_drift", lambda s, d: _drift(s, d), f"SELECT 'sales_quantity' AS column, {R(f'avg(sales_quantity) FILTER ({OLD})', 5)} AS mean_base, {R(f'avg(sales_quantity) FILTER (NOT {OLD})', 5)} AS mean_now, abs(avg(sales_quantity) FILTER (NOT {OLD}) - avg(sales_quantity) FILTER ({OLD})) > 2 * stddev_samp(sales_quantity) FILTER ({OLD}) AS drifted FROM v_hourly")


def _drift(s, d):
    before, now = clean.time_split(tb.hourly(s, d), "hour_timestamp", 0.5)
    found = quality.detect_drift(quality.baseline_profile(before, ["sales_quantity"], []), quality.baseline_profile(now, ["sales_quantity"], []))
    return out(found, ["column", "drifted"], {"mean_base": 5, "mean_now": 5})


B.add("quality_score", lambda s, d: quality.quality_score(scan_table(s, d, "lineitem"), ["l_orderkey", "absent"], ["l_partkey", "l_suppkey"], {"l_quantity": (1, 45)}).withColumn("issues", F.array_join("issues", "|")), "SELECT CAST(100 - 10 * (count(*) FILTER (l_quantity < 1 OR l_quantity > 45) > 0)::INT - 20 - 15 * (1 - count(DISTINCT (l_partkey, l_suppkey)) / count(*) > 0.01)::INT AS INTEGER) AS score, 'poor' AS grade, 'missing columns|duplicates|out of range' AS issues FROM lineitem")
CHECKS = [{"kind": "rows", "min": 1, "max": 10**12}, {"kind": "exists", "column": "absent"}, {"kind": "columns", "count": 11}, {"kind": "not_null", "column": "l_tax"}, {"kind": "between", "column": "l_quantity", "min": 1, "max": 45, "mostly": 0.95}, {"kind": "unique", "column": "l_orderkey", "min": 0.9}, {"kind": "type", "column": "l_tax", "type": "double"}]
B.add(
    "expectations",
    lambda s, d: out(quality.expectations(scan_table(s, d, "lineitem"), CHECKS), ["check", "success"], {"observed": 6}),
    f"SELECT 'rows' AS check, true AS success, count(*) + 0.0 AS observed FROM lineitem UNION ALL SELECT 'exists:absent', false, 0.0 UNION ALL SELECT 'columns', true, 1.0 UNION ALL SELECT 'not_null:l_tax', true, 1.0 UNION ALL SELECT 'between:l_quantity', avg((l_quantity BETWEEN 1 AND 45)::INT) >= 0.95, {R('avg((l_quantity BETWEEN 1 AND 45)::INT)', 6)} FROM lineitem UNION ALL SELECT 'unique:l_orderkey', count(DISTINCT l_orderkey) / count(*) >= 0.9, {R('count(DISTINCT l_orderkey) / count(*)', 6)} FROM lineitem UNION ALL SELECT 'type:l_tax', true, 1.0",
)
B.add("expectation_summary", lambda s, d: quality.expectation_summary(quality.expectations(scan_table(s, d, "lineitem"), CHECKS[:4])).select("success_pct", F.array_join("failed", "|").alias("failed")), "SELECT CAST(75 AS DOUBLE) AS success_pct, 'exists:absent' AS failed")
B.add("prediction_checks", lambda s, d: out(quality.prediction_checks(tb.predictions(s, d), ["forecast_q50"]), ["column", "negatives", "nulls", "n"], {"mean": 5}), f"SELECT 'forecast_q50' AS column, count(*) FILTER (forecast_q50 < 0) AS negatives, count(*) FILTER (forecast_q50 IS NULL) AS nulls, count(*) AS n, {R('avg(forecast_q50)', 5)} AS mean FROM v_predictions")
B.add("metric_bounds", lambda s, d: out(quality.metric_bounds(metrics.quantile_metrics(tb.predictions(s, d), "sales_quantity", {0.05: "forecast_q05", 0.5: "forecast_q50"}).select("model", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("mae", "r2")])).alias("x")).select("model", "x.*")), ["model", "metric"], {"value": 5}), "WITH b AS (SELECT *, sales_quantity AS y, avg(sales_quantity) OVER () AS m FROM v_predictions), r AS (" + " UNION ALL ".join(f"SELECT '{c}' AS model, 'mae' AS metric, avg(abs(y - {c})) AS value FROM b UNION ALL SELECT '{c}', 'r2', 1 - sum((y - {c}) ** 2) / sum((y - m) ** 2) FROM b" for c in ("forecast_q05", "forecast_q50")) + f") SELECT model, metric, {R('value', 5)} AS value FROM r WHERE (metric = 'mae' AND (value < 0 OR value > 100)) OR (metric = 'r2' AND (value < 0.7 OR value > 1))")
B.add("quality_rollup", lambda s, d: out(quality.quality_rollup(tb.log(s, d).select(F.col("type").alias("dataset"), F.struct("timestamp", "event_id").alias("ts"), F.col("duration_seconds").alias("score"), (F.col("event_id") % 3).alias("issues"))), ["datasets", "min_score", "max_score", "issues"], {"avg_score": 5}), f"SELECT count(*) AS datasets, min(s) AS min_score, max(s) AS max_score, CAST(sum(i) AS BIGINT) AS issues, {R('avg(s)', 5)} AS avg_score FROM (SELECT arg_max(duration_seconds, (timestamp, event_id)) AS s, arg_max(event_id % 3, (timestamp, event_id)) AS i FROM v_log GROUP BY type)")

# Reports
B.add("hourly_profile", lambda s, d: out(report.hourly_profile(tb.predictions(s, d), "hour_timestamp", "sales_quantity", "forecast_q50"), ["hour", "demand_mean"], {"demand_std": 5, "forecast_mean": 5}), f"SELECT CAST(hour(hour_timestamp) AS INTEGER) AS hour, avg(sales_quantity) AS demand_mean, {R('stddev_samp(sales_quantity)', 5)} AS demand_std, {R('avg(forecast_q50)', 5)} AS forecast_mean FROM v_predictions GROUP BY 1")
B.add("hourly_quantile_totals", lambda s, d: out(report.hourly_quantile_totals(tb.predictions(s, d), "hour_timestamp", "sales_quantity", ["forecast_q50"]), ["hour", "n", "sales_quantity"], {"forecast_q50": 4}), f"SELECT CAST(hour(hour_timestamp) AS INTEGER) AS hour, count(*) AS n, sum(sales_quantity) AS sales_quantity, {R('sum(forecast_q50)', 4)} AS forecast_q50 FROM v_predictions GROUP BY 1")
B.add("rollup_daily", lambda s, d: out(report.rollup_daily(tb.predictions(s, d), "hour_timestamp", ["product_id"], ["sales_quantity", "forecast_q50"]), ["product_id", "date", "sales_quantity"], {"forecast_q50": 4}), f"SELECT product_id, CAST(date AS VARCHAR) AS date, actual_demand AS sales_quantity, {R('forecast_q50', 4)} AS forecast_q50 FROM v_demand_daily")
B.add("period_rollup_r2", lambda s, d: _daily_r2(s, d), f"SELECT {R('1 - sum((actual_demand - forecast_q50) ** 2) / sum((actual_demand - m) ** 2)', 6)} AS r2 FROM (SELECT *, avg(actual_demand) OVER () AS m FROM v_demand_daily)")


def _daily_r2(s, d):
    rows = tb.demand_daily(s, d)
    return out(rows.agg(metrics.r2(F.col("actual_demand"), F.col("forecast_q50")).alias("r2")), [], {"r2": 6})


B.add("rollup_monthly", lambda s, d: report.rollup_monthly(tb.market(s, d), "date", ["transaction_count", "revenue"]), "SELECT strftime(date, '%Y-%m') AS month, CAST(sum(transaction_count) AS BIGINT) AS transaction_count, sum(revenue) AS revenue FROM v_market GROUP BY 1")
MG = "(SELECT month, revenue, (revenue / nullif(lag(revenue) OVER (ORDER BY month), 0) - 1) * 100 AS c1, (revenue / nullif(lag(revenue, 12) OVER (ORDER BY month), 0) - 1) * 100 AS c12 FROM (SELECT strftime(date, '%Y-%m') AS month, sum(revenue) AS revenue FROM v_market GROUP BY 1))"
B.add("market_growth", lambda s, d: out(report.market_growth(tb.market(s, d), "date", ["revenue"]), ["month", "revenue"], {"revenue_change_1": 6, "revenue_change_12": 6}), f"SELECT month, revenue, {R('c1', 6)} AS revenue_change_1, {R('c12', 6)} AS revenue_change_12 FROM {MG}")
B.add("market_summary", lambda s, d: out(report.market_summary(report.market_growth(tb.market(s, d), "date", ["revenue"]), "revenue"), [], {"mom_mean": 6, "yoy_mean": 6}), f"SELECT {R('avg(c1)', 6)} AS mom_mean, {R('avg(c12)', 6)} AS yoy_mean FROM (SELECT * FROM {MG} ORDER BY month DESC LIMIT 12)")
B.add("risk_histogram", lambda s, d: report.risk_histogram(inventory.inventory_metrics(tb.stock(s, d)), "overstock_risk_pct"), f"SELECT CASE WHEN ov <= 25 THEN 'Low' WHEN ov <= 50 THEN 'Medium' WHEN ov <= 75 THEN 'High' ELSE 'Critical' END AS band, count(*) AS n FROM {IM} WHERE ov > 0 GROUP BY 1")
B.add("headline_kpis", lambda s, d: out(report.headline_kpis(tb.predictions(s, d), "forecast_q50", "product_id", F.col("sales_quantity")), ["products", "at_risk"], {"mean_forecast": 6}), f"SELECT count(DISTINCT product_id) AS products, count(*) FILTER (sales_quantity > 50) AS at_risk, {R('avg(forecast_q50)', 6)} AS mean_forecast FROM v_predictions")
B.add("alert_summary", lambda s, d: report.alert_summary(tb.log(s, d)), "SELECT severity, type, count(*) AS n FROM v_log WHERE timestamp >= (SELECT max(timestamp) FROM v_log) - INTERVAL 24 HOURS GROUP BY GROUPING SETS ((severity), (type))")
B.add("operation_stats", lambda s, d: out(report.operation_stats(tb.log(s, d)), ["operation_name", "n", "total", "mean", "max", "min", "slowest"], {"std": 5}), f"SELECT type AS operation_name, count(*) AS n, sum(duration_seconds) AS total, avg(duration_seconds) AS mean, max(duration_seconds) AS max, min(duration_seconds) AS min, avg(duration_seconds) = max(avg(duration_seconds)) OVER () AS slowest, {R('stddev_samp(duration_seconds)', 5)} AS std FROM v_log GROUP BY 1")

# User functions
B.add("apply_per_series", lambda s, d: _per_series(s, d), "SELECT product_id, store_id, max(sales_quantity) - min(sales_quantity) AS spread FROM v_hourly GROUP BY ALL")
B.add("apply_per_batch", lambda s, d: _per_batch(s, d), "SELECT event_id, floor(value) * 2 AS twice FROM events")
B.add("apply_per_column", lambda s, d: _per_column(s, d), "SELECT product_id, store_id, week_no, sales_value * 2 AS sales_value, quantity * 2 AS quantity FROM v_weekly_grid")


def _per_series(s, d):
    import pandas as pd

    from shelfloom.operators.udf import apply_per_series

    def spread(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"product_id": rows["product_id"].iloc[:1], "store_id": rows["store_id"].iloc[:1], "spread": [rows["sales_quantity"].max() - rows["sales_quantity"].min()]})

    return apply_per_series(tb.hourly(s, d).select(*K, "sales_quantity"), K, spread, "product_id string, store_id int, spread double")


def _per_batch(s, d):
    from shelfloom.operators.udf import apply_per_batch

    return apply_per_batch(tb.events(s, d).select("event_id", F.floor("value").cast("double").alias("twice")), lambda b: b.assign(twice=b["twice"] * 2), "event_id long, twice double")


def _per_column(s, d):
    from shelfloom.operators.udf import apply_per_column

    return apply_per_column(weekly_grid(s, d), ["sales_value", "quantity"], lambda c: c * 2).select("product_id", "store_id", "week_no", "sales_value", "quantity")


QUERIES, ORACLES = B.queries, B.oracles
