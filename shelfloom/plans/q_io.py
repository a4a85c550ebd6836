"""Queries: readers and writers as round trips, and incremental processing."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from shelfloom.operators import clean, metrics
from shelfloom.plans import testbed as tb
from shelfloom.plans.kit import TS, Book, R, out, scratch
from shelfloom.sources import arrivals, tables
from shelfloom.spec import HOURLY
from shelfloom.streaming import incremental, series_state
from shelfloom.streaming.keyed import KeyedTable

B = Book()
HCELL = ["product_id", "store_id", "hour_timestamp"]
LEVELS = {0.05: "forecast_q05", 0.5: "forecast_q50", 0.95: "forecast_q95"}


def _hourly_bundle(s, d):
    """Sales under their raw names, stockout labels and weather, written and loaded."""
    base = scratch(s, "hourly")
    cells = tb.hourly(s, d)
    raw = cells.select(F.col("product_id").alias("PRODUCT_ID"), "store_id", F.date_format("hour_timestamp", "yyyy-MM-dd HH:mm:ss").alias("dt"), F.col("sales_quantity").alias("sale_amount"))
    tables.sink_parquet(raw, f"{base}/freshretail_train.parquet")
    tables.sink_parquet(cells.where("is_stockout = 1").select(*HCELL, "is_stockout"), f"{base}/stockout_labels.parquet")
    found = tables.load_hourly_bundle(s, base)
    return out(found["sales"], [*HCELL, "sales_quantity", "is_stockout"])


B.add("load_hourly_bundle", _hourly_bundle, f"SELECT product_id, store_id, {TS()} AS hour_timestamp, sales_quantity, is_stockout FROM v_hourly")


def _weekly_bundle(s, d):
    base = scratch(s, "weekly")
    tables.sink_parquet(tb.sales_weekly(s, d), f"{base}/transaction_data.parquet")
    tables.sink_parquet(tb.product(s, d), f"{base}/product.parquet")
    tables.sink_parquet(tb.household(s, d), f"{base}/hh_demographic.parquet")
    tables.sink_parquet(tb.causal(s, d), f"{base}/causal_data.parquet")
    tables.sink_parquet(tb.clicks(s, d), f"{base}/clickstream_log.parquet")
    found = tables.load_weekly_bundle(s, base)
    # All five tables, each row as text beside its table's name.
    rows = [t.select(F.lit(name).alias("name"), F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in WEEKLY_COLUMNS[name]])).alias("row")) for name, t in sorted(found.items())]
    return clean.union_all(*rows)


WEEKLY_COLUMNS = {
    "sales": ["product_id", "store_id", "week_no"],
    "product": ["product_id", "department"],
    "hh_demographic": ["household_key", "income_desc", "segment"],
    "causal_data": ["product_id", "store_id", "week_no", "display", "mailer"],
    "clickstream_log": ["visitorid", "event", "timestamp", "itemid"],
}
WEEKLY_VIEWS = {"sales": "v_sales_weekly", "product": "v_product", "hh_demographic": "v_household", "causal_data": "v_causal", "clickstream_log": "v_clicks"}
B.add(
    "load_weekly_bundle",
    _weekly_bundle,
    " UNION ALL ".join(f"SELECT '{n}' AS name, concat('{{', {', '.join(f"""'{',' if i else ''}"{c}":"', CAST({c} AS VARCHAR), '"'""" for i, c in enumerate(cols))}, '}}') AS row FROM {WEEKLY_VIEWS[n]}" for n, cols in WEEKLY_COLUMNS.items()),
)


def _weather(s, d):
    path = f"{scratch(s, 'weather')}/weather_data.csv"
    tables.sink_csv(tb.weather(s, d).select("store_id", "date", "temperature", "precipitation", "humidity"), path, compress=False)
    return out(tables.load_weather(s, path), ["store_id", "date", "temperature", "precipitation", "humidity"])


B.add("load_weather", _weather, "SELECT store_id, CAST(date AS VARCHAR) AS date, temperature, precipitation, humidity FROM v_weather")


def _forecasts(s, d, suffix):
    path, rows = f"{scratch(s, 'forecasts')}/predictions{suffix}", out(tb.predictions(s, d), [*HCELL, "forecast_q50"])
    if suffix == ".parquet":
        tables.sink_parquet(rows, path, ["store_id"])
        return tables.load_forecasts(s, path).select(*rows.columns)
    tables.sink_csv(rows, path)
    return tables.load_forecasts(s, path, rows.schema)


FORECASTS = f"SELECT product_id, store_id, {TS()} AS hour_timestamp, forecast_q50 FROM v_predictions"
B.add("sink_parquet_partitioned", lambda s, d: _forecasts(s, d, ".parquet"), FORECASTS)
B.add("load_forecasts_csv", lambda s, d: _forecasts(s, d, ".csv"), FORECASTS)


def _metrics(s, d):
    path = f"{scratch(s, 'metrics')}/metrics.json"
    tables.sink_metrics(clean.tidy_metrics(metrics.quantile_metrics(tb.predictions(s, d), "sales_quantity", LEVELS).select("model", "pinball", "mae")), path)
    return out(s.read.schema("model string, metric string, value double").json(path), ["model", "metric"], {"value": 5})


B.add("sink_metrics", _metrics, " UNION ALL ".join(f"SELECT '{c}' AS model, '{m}' AS metric, {R(e, 5)} AS value FROM v_predictions" for q, c in LEVELS.items() for m, e in (("pinball", f"avg(greatest((sales_quantity - {c}) * {q}, (sales_quantity - {c}) * {q - 1!r}))"), ("mae", f"avg(abs(sales_quantity - {c}))"))))


def _damaged(s, d):
    """All events in three arrivals: as they are; as CSV with bad values; with a column retyped and one missing."""
    base = scratch(s, "arrivals")
    rows = s.read.parquet(f"{d}/events.parquet").select("event_id", "user_id", "event_type", "value")
    of = lambda k: rows.where(F.col("user_id") % 3 == k)
    of(0).write.parquet(f"{base}/a")
    of(1).withColumn("value", F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))).select("value", "event_type", "user_id", "event_id").write.option("header", True).csv(f"{base}/b")
    of(2).withColumn("value", F.when(F.col("value") > 90, "oops").otherwise(F.col("value").cast("string"))).drop("event_type").withColumn("note", F.lit("new")).write.parquet(f"{base}/c")
    found = arrivals.load_arrivals(s, {"a": (f"{base}/a", "parquet"), "b": (f"{base}/b", "csv"), "c": (f"{base}/c", "parquet"), "none": (f"{base}/none", "csv")}, rows.schema, ["event_id"])
    good = found.good.select("arrival", "event_id", "event_type", F.floor("value").cast("double").alias("value"), F.lit(None).cast("string").alias("reason"))
    bad = found.quarantine.select("arrival", F.get_json_object("record", "$.event_id").cast("long").alias("event_id"), F.lit(None).cast("string").alias("event_type"), F.lit(None).cast("double").alias("value"), F.array_join("reasons", ", ").alias("reason"))
    changes = found.drift.select("arrival", F.lit(None).cast("long").alias("event_id"), F.col("column").alias("event_type"), F.lit(None).cast("double").alias("value"), F.col("kind").alias("reason"))
    return good.unionByName(bad).unionByName(changes)


B.add(
    "damaged_arrivals",
    _damaged,
    """SELECT CASE user_id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS arrival, event_id, CASE WHEN user_id % 3 < 2 AND NOT bad THEN event_type END AS event_type,
  CASE WHEN NOT bad THEN floor(value) END AS value, CASE WHEN bad THEN 'bad value' END AS reason
FROM (SELECT *, (user_id % 3 = 1 AND event_type = 'error') OR (user_id % 3 = 2 AND value > 90) AS bad FROM events)
UNION ALL SELECT 'c', NULL, x, NULL, y FROM (VALUES ('event_type', 'missing'), ('note', 'extra'), ('value', 'retyped')) AS t(x, y)""",
)


# Streaming
def _closed_hours(s, d):
    """The closed hours of the events table, read as a stream."""
    base = scratch(s, "stream")
    hours = incremental.hourly_stream(s, f"{d}/events.parque[t]", s.read.parquet(f"{d}/events.parquet").schema)
    incremental.incremental_aggregate(hours, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return out(s.read.parquet(f"{base}/out"), [*HCELL, "sales_quantity"])


B.add("incremental_aggregate", _closed_hours, f"SELECT product_id, store_id, {TS()} AS hour_timestamp, sales_quantity FROM v_hourly_raw WHERE hour_timestamp + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOURS")


def _arriving_features(s, d):
    """Features of the closed hours: the events come in four spans of time, each to a stream that is started anew."""
    base = scratch(s, "features")
    events = s.read.parquet(f"{d}/events.parquet")
    cuts = [None, *events.select(F.percentile_approx("ts", [0.25, 0.5, 0.75])).first()[0], None]
    for low, high in zip(cuts, cuts[1:], strict=False):
        span = [*([F.col("ts") >= low] if low else []), *([F.col("ts") < high] if high else [])]
        events.where(reduce(and_, span)).write.mode("append").parquet(f"{base}/in")
        hours = incremental.hourly_stream(s, f"{base}/in", events.schema)
        series_state.incremental_features(hours, HOURLY, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    found = s.read.parquet(f"{base}/out")
    return out(found, [*HCELL, "sales_quantity", *[f"sales_quantity_lag_{k}" for k in HOURLY.lags], "hour_of_day", "day_of_week", "is_weekend"], {c: 6 for c in series_state.names(HOURLY) if c.startswith("rolling")})


def _rolling_sql():
    found = []
    for n in HOURLY.windows:
        w = f"OVER (PARTITION BY product_id, store_id ORDER BY hour_timestamp ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        found += [f"{R(f'coalesce({f}(sales_quantity) {w}, 0)', 6)} AS rolling_{name}_{n}" for name, f in (("mean", "avg"), ("std", "stddev_samp"), ("max", "max"), ("min", "min"))]
    return ", ".join(found)


B.add(
    "incremental_features",
    _arriving_features,
    f"""WITH closed AS (SELECT * FROM v_hourly_raw WHERE hour_timestamp + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOURS),
ends AS (SELECT product_id, store_id, min(hour_timestamp) AS first, max(hour_timestamp) AS last FROM closed GROUP BY ALL),
axis AS (SELECT product_id, store_id, unnest(generate_series(first, last, INTERVAL 1 HOUR)) AS hour_timestamp FROM ends),
filled AS (SELECT product_id, store_id, hour_timestamp, coalesce(sales_quantity, 0) AS sales_quantity FROM axis LEFT JOIN closed USING (product_id, store_id, hour_timestamp))
SELECT product_id, store_id, {TS()} AS hour_timestamp, sales_quantity,
  {", ".join(f"coalesce(lag(sales_quantity, {k}) OVER (PARTITION BY product_id, store_id ORDER BY hour_timestamp), 0) AS sales_quantity_lag_{k}" for k in HOURLY.lags)},
  CAST(hour(hour_timestamp) AS INTEGER) AS hour_of_day, CAST(isodow(hour_timestamp) - 1 AS INTEGER) AS day_of_week, CAST(isodow(hour_timestamp) > 5 AS INTEGER) AS is_weekend,
  {_rolling_sql()} FROM filled""",
)

#: Batches that the events arrive in; each holds rows of every day.
ARRIVALS = 4
#: Rows of one file: a larger batch is several files, which as many tasks read.
FILE_ROWS = 250_000


def _arriving(s, d, base):
    rows = s.read.parquet(f"{d}/events.parquet").withColumn("day", F.to_date("ts").cast("string"))
    files = max(1, -(-rows.count() // (ARRIVALS * FILE_ROWS)))
    rows.repartition(ARRIVALS * files).write.parquet(f"{base}/in")
    return s.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(f"{base}/in")


def _events_table(s, rows, base):
    return KeyedTable(s, f"{base}/table", rows.schema, ["event_id"], ["ts"], "day")


def _upserted(s, d):
    """Days come in several batches, and every batch twice, by two runs that know nothing of each other."""
    base = scratch(s, "upsert")
    rows = _arriving(s, d, base)
    table = _events_table(s, rows, base)
    for run in (1, 2):
        incremental.incremental_upsert(rows, table, f"{base}/checkpoint{run}").awaitTermination()
    return table.read().select("event_id", "user_id", "event_type", "value", "day")


B.add("incremental_upsert", _upserted, "SELECT event_id, user_id, event_type, value, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events")


def _stats(s, d):
    base = scratch(s, "stats")
    rows = _arriving(s, d, base)
    ledger = incremental.ProgressLedger(s, f"{base}/progress")
    incremental.incremental_upsert(rows, _events_table(s, rows, base), f"{base}/checkpoint", ledger, "events", "ts").awaitTermination()
    return out(incremental.incremental_stats(ledger, "events"), ["dataset", "batches", "rows", "first_time", "last_time"])


B.add("incremental_stats", _stats, f"SELECT 'events' AS dataset, {ARRIVALS} AS batches, count(*) AS rows, {TS('min(ts)')} AS first_time, {TS('max(ts)')} AS last_time FROM events")

QUERIES, ORACLES = B.queries, B.oracles
