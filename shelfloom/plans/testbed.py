"""Views of the given tables in the shape of retail data, for Spark and (as text) for DuckDB.

Measures are whole numbers, so that sums and means are the same in any order of summation.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfloom.sources.tables import scan_table

#: DuckDB text of each view.
SQL = {
    "v_sales_weekly": """SELECT p_brand AS product_id, s_nationkey AS store_id,
  CAST(floor(date_diff('day', DATE '1995-01-02', CAST(l_shipdate AS DATE)) / 7.0) + 1 AS INTEGER) AS week_no,
  floor(l_extendedprice * (1 - l_discount)) AS sales_value, l_quantity AS quantity,
  -floor(l_extendedprice * l_discount) AS retail_disc, -floor(l_extendedprice * l_tax) AS coupon_disc, l_returnflag, l_linenumber
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""",
    "v_weekly": """SELECT product_id, store_id, week_no, sum(sales_value) AS sales_value, sum(quantity) AS quantity,
  sum(retail_disc) AS retail_disc, sum(coupon_disc) AS coupon_disc FROM v_sales_weekly GROUP BY ALL""",
    "v_weekly_grid": """SELECT s.product_id, s.store_id, w.week_no, coalesce(sales_value, 0) AS sales_value, coalesce(quantity, 0) AS quantity,
  coalesce(retail_disc, 0) AS retail_disc, coalesce(coupon_disc, 0) AS coupon_disc
FROM (SELECT DISTINCT product_id, store_id FROM v_weekly WHERE sales_value > 0) s
CROSS JOIN (SELECT DISTINCT week_no FROM v_weekly WHERE sales_value > 0) w
LEFT JOIN (SELECT * FROM v_weekly WHERE sales_value > 0) v USING (product_id, store_id, week_no)""",
    "v_product": """SELECT p_brand AS product_id, min(p_type) AS department FROM part
GROUP BY p_brand HAVING avg(p_retailprice) <= (SELECT avg(p_retailprice) FROM part)""",
    "v_household": """SELECT c_custkey AS household_key, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'middle' ELSE 'high' END AS income_desc,
  c_mktsegment AS segment FROM customer WHERE c_acctbal >= 0""",
    "v_causal": """SELECT product_id, store_id, week_no, CAST(CAST(sum(l_linenumber) AS BIGINT) % 3 AS VARCHAR) AS display, CAST(count(*) % 2 AS VARCHAR) AS mailer
FROM v_sales_weekly WHERE l_returnflag = 'R' GROUP BY ALL""",
    "v_clicks": """SELECT user_id AS visitorid, CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'addtocart' WHEN 'purchase' THEN 'transaction' ELSE event_type END AS event,
  epoch_us(ts) // 1000 AS timestamp, event_id AS itemid FROM events""",
    "v_hourly_raw": """SELECT event_type AS product_id, CAST(user_id % 10 AS INTEGER) AS store_id, date_trunc('hour', ts) AS hour_timestamp,
  sum(floor(value)) AS sales_quantity FROM events GROUP BY ALL""",
    "v_hourly": """SELECT s.product_id, s.store_id, h.hour_timestamp, coalesce(sales_quantity, 0) AS sales_quantity,
  CAST(CASE WHEN sales_quantity IS NULL AND (hour(h.hour_timestamp) + s.store_id) % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) AS is_stockout
FROM (SELECT DISTINCT product_id, store_id FROM v_hourly_raw) s CROSS JOIN (SELECT DISTINCT hour_timestamp FROM v_hourly_raw) h
LEFT JOIN v_hourly_raw USING (product_id, store_id, hour_timestamp)""",
    "v_weather": """SELECT CAST(user_id % 10 AS INTEGER) AS store_id, CAST(ts AS DATE) AS date, floor((sum(floor(value)) - 35 * count(*)) * 4 / count(*)) / 4 AS temperature,
  round(greatest(0, max(floor(value)) - 150) / 10, 2) AS precipitation, CAST(least(100, (count(*) * 7) % 111) AS DOUBLE) AS humidity
FROM events GROUP BY ALL HAVING arg_min(event_type, (ts, event_id)) <> 'error'""",
    "v_predictions": """SELECT v.*, q[1] AS forecast_q05, q[2] AS forecast_q25, q[3] AS forecast_q50, q[4] AS forecast_q75, q[5] AS forecast_q95
FROM v_hourly v JOIN (SELECT product_id, store_id, hour(hour_timestamp) AS h, quantile_cont(sales_quantity, [0.05, 0.25, 0.5, 0.75, 0.95]) AS q
  FROM v_hourly WHERE epoch_us(hour_timestamp) < (SELECT quantile_cont(epoch_us(hour_timestamp)::DOUBLE, 0.8) FROM v_hourly) GROUP BY ALL) p
ON v.product_id = p.product_id AND v.store_id = p.store_id AND hour(v.hour_timestamp) = p.h""",
    "v_demand_daily": """SELECT product_id, CAST(hour_timestamp AS DATE) AS date, sum(sales_quantity) AS actual_demand, sum(forecast_q50) AS forecast_q50, sum(forecast_q95) AS forecast_q95
FROM v_predictions GROUP BY ALL""",
    "v_pricing": """SELECT p_partkey AS product_id, p_brand AS brand, p_retailprice AS current_price, p_retailprice * 0.6 AS cost, p_size / 15.0 AS inventory_ratio,
  (p_partkey % 17) / 10.0 AS demand_ratio, CASE p_partkey % 4 WHEN 0 THEN 'fresh_produce' WHEN 1 THEN 'dairy' WHEN 2 THEN 'packaged' ELSE 'other' END AS category,
  CAST(p_size AS DOUBLE) AS demand FROM part""",
    "v_stock": """SELECT p_partkey AS product_id, CAST(p_size AS DOUBLE) AS avg_daily_demand, (p_partkey % 9) * 1.5 AS demand_std,
  CAST((p_partkey * 7) % 500 AS DOUBLE) AS current_inventory, p_retailprice * 0.6 AS unit_cost FROM part""",
    "v_market": """SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS transaction_count, sum(floor(o_totalprice)) AS revenue FROM orders GROUP BY ALL""",
    "v_log": """SELECT event_id, event_type AS type, CASE WHEN value > 80 THEN 'critical' WHEN value > 50 THEN 'error' WHEN value > 20 THEN 'warning' ELSE 'info' END AS severity,
  ts AS timestamp, floor(value) AS duration_seconds FROM events""",
    "v_gappy": """SELECT product_id, store_id, hour_timestamp, CASE WHEN g % 100 >= 15 THEN sales_quantity END AS sales_lag_1, CASE WHEN g % 100 >= 40 THEN sales_quantity END AS rolling_mean_24,
  CASE WHEN g % 100 >= 15 THEN sales_quantity * 2 END AS rolling_std_24, CASE WHEN g % 100 >= 20 THEN sales_quantity - 5 END AS sales_change, CASE WHEN g % 100 >= 80 THEN sales_quantity END AS price
FROM (SELECT *, (epoch_ms(hour_timestamp) // 3600000) * 7 + store_id AS g FROM v_hourly)""",
}


def sql(body: str) -> str:
    """The body with the views that it names, in order of need."""
    found: list[str] = []

    def need(text: str) -> None:
        for name in SQL:
            if name not in found and re.search(rf"\b{name}\b", text):
                need(SQL[name])
                if name not in found:
                    found.append(name)

    need(body)
    views = ",\n".join(f"{n} AS MATERIALIZED ({SQL[n]})" for n in found)
    head = body.lstrip()
    if not views:
        return body
    if head.upper().startswith("WITH "):
        return f"WITH {views},\n{head[5:]}"
    return f"WITH {views}\n{head}"


def sales_weekly(spark: SparkSession, d: str) -> DataFrame:
    lines = scan_table(spark, d, "lineitem")
    lines = lines.join(scan_table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("product_id")), "l_partkey")
    lines = lines.join(scan_table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("store_id")), "l_suppkey")
    days = F.datediff(F.to_date("l_shipdate"), F.to_date(F.lit("1995-01-02")))
    price = F.col("l_extendedprice")
    whole = lambda c: F.floor(c).cast("double")
    return lines.select(
        "product_id",
        "store_id",
        (F.floor(days / 7) + 1).cast("int").alias("week_no"),
        whole(price * (1 - F.col("l_discount"))).alias("sales_value"),
        F.col("l_quantity").alias("quantity"),
        (-whole(price * F.col("l_discount"))).alias("retail_disc"),
        (-whole(price * F.col("l_tax"))).alias("coupon_disc"),
        "l_returnflag",
        "l_linenumber",
    )


def product(spark: SparkSession, d: str) -> DataFrame:
    """Departments are known for brands of at most the average price."""
    part = scan_table(spark, d, "part")
    average = part.agg(F.avg("p_retailprice").alias("average"))
    brands = part.groupBy(F.col("p_brand").alias("product_id")).agg(F.min("p_type").alias("department"), F.avg("p_retailprice").alias("price"))
    return brands.crossJoin(F.broadcast(average)).where("price <= average").select("product_id", "department")


def household(spark: SparkSession, d: str) -> DataFrame:
    income = F.when(F.col("c_acctbal") < 0, "debt").when(F.col("c_acctbal") < 5000, "middle").otherwise("high")
    return scan_table(spark, d, "customer").where("c_acctbal >= 0").select(F.col("c_custkey").alias("household_key"), income.alias("income_desc"), F.col("c_mktsegment").alias("segment"))


def causal(spark: SparkSession, d: str) -> DataFrame:
    rows = sales_weekly(spark, d).where("l_returnflag = 'R'")
    return rows.groupBy("product_id", "store_id", "week_no").agg((F.sum("l_linenumber") % 3).cast("string").alias("display"), (F.count("*") % 2).cast("string").alias("mailer"))


def events(spark: SparkSession, d: str) -> DataFrame:
    return scan_table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def clicks(spark: SparkSession, d: str) -> DataFrame:
    names = F.when(F.col("event_type") == "click", "addtocart").when(F.col("event_type") == "purchase", "transaction").otherwise(F.col("event_type"))
    return events(spark, d).select(F.col("user_id").alias("visitorid"), names.alias("event"), F.unix_millis("ts").alias("timestamp"), F.col("event_id").alias("itemid"))


def hourly_raw(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).groupBy(F.col("event_type").alias("product_id"), (F.col("user_id") % 10).cast("int").alias("store_id"), F.date_trunc("hour", "ts").alias("hour_timestamp")).agg(F.sum(F.floor("value").cast("double")).alias("sales_quantity"))


def hourly(spark: SparkSession, d: str) -> DataFrame:
    from shelfloom.operators.grid import complete
    from shelfloom.spec import HOURLY

    cells = complete(hourly_raw(spark, d), HOURLY, fill=False)
    empty = F.col("sales_quantity").isNull() & ((F.hour("hour_timestamp") + F.col("store_id")) % 3 == 0)
    return cells.withColumn("is_stockout", F.when(empty, 1).otherwise(0)).fillna(0, ["sales_quantity"])


def weather(spark: SparkSession, d: str) -> DataFrame:
    whole = F.floor("value").cast("double")
    # A store has no weather on days that begin with an error.
    rows = events(spark, d).groupBy((F.col("user_id") % 10).cast("int").alias("store_id"), F.to_date("ts").alias("date"))
    begins = F.min_by("event_type", F.struct("ts", "event_id")).alias("begins")
    found = rows.agg(begins, (F.floor((F.sum(whole) - 35 * F.count("*")) * 4 / F.count("*")) / 4).alias("temperature"), F.round(F.greatest(F.lit(0.0), F.max(whole) - 150) / 10, 2).alias("precipitation"), F.least(F.lit(100), (F.count("*") * 7) % 111).cast("double").alias("humidity"))
    return found.where("begins <> 'error'").drop("begins")


def predictions(spark: SparkSession, d: str) -> DataFrame:
    from shelfloom.operators.ml import quantile_baseline
    from shelfloom.operators.clean import time_split
    from shelfloom.spec import HOURLY

    rows = hourly(spark, d)
    train, _ = time_split(rows, "hour_timestamp")
    table = quantile_baseline(train, HOURLY, F.hour("hour_timestamp"))
    return rows.withColumn("phase", F.hour("hour_timestamp")).join(table, ["product_id", "store_id", "phase"]).drop("phase")


def demand_daily(spark: SparkSession, d: str) -> DataFrame:
    return predictions(spark, d).groupBy("product_id", F.to_date("hour_timestamp").alias("date")).agg(F.sum("sales_quantity").alias("actual_demand"), F.sum("forecast_q50").alias("forecast_q50"), F.sum("forecast_q95").alias("forecast_q95"))


def pricing(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    kind = F.when(k % 4 == 0, "fresh_produce").when(k % 4 == 1, "dairy").when(k % 4 == 2, "packaged").otherwise("other")
    return scan_table(spark, d, "part").select(k.alias("product_id"), F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("current_price"), (F.col("p_retailprice") * 0.6).alias("cost"), (F.col("p_size") / 15.0).alias("inventory_ratio"), ((k % 17) / 10.0).alias("demand_ratio"), kind.alias("category"), F.col("p_size").cast("double").alias("demand"))


def stock(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    return scan_table(spark, d, "part").select(k.alias("product_id"), F.col("p_size").cast("double").alias("avg_daily_demand"), ((k % 9) * 1.5).alias("demand_std"), ((k * 7) % 500).cast("double").alias("current_inventory"), (F.col("p_retailprice") * 0.6).alias("unit_cost"))


def market(spark: SparkSession, d: str) -> DataFrame:
    return scan_table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count("*").alias("transaction_count"), F.sum(F.floor("o_totalprice").cast("double")).alias("revenue"))


def log(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("value")
    severity = F.when(v > 80, "critical").when(v > 50, "error").when(v > 20, "warning").otherwise("info")
    return events(spark, d).select("event_id", F.col("event_type").alias("type"), severity.alias("severity"), F.col("ts").alias("timestamp"), F.floor(v).cast("double").alias("duration_seconds"))


def gappy(spark: SparkSession, d: str) -> DataFrame:
    rows = hourly(spark, d)
    g = F.floor(F.unix_seconds("hour_timestamp") / 3600) * 7 + F.col("store_id")
    q = F.col("sales_quantity")
    kept = lambda least, c: F.when(g % 100 >= least, c)
    return rows.select("product_id", "store_id", "hour_timestamp", kept(15, q).alias("sales_lag_1"), kept(40, q).alias("rolling_mean_24"), kept(15, q * 2).alias("rolling_std_24"), kept(20, q - 5).alias("sales_change"), kept(80, q).alias("price"))
