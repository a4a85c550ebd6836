"""Readers and writers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfloom.operators.clean import resolve_column, standardize_columns


def scan_table(spark: SparkSession, directory: str, stem: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The Parquet table; where it is missing or unreadable the CSV of the same name; else None.

    The schema comes from the Parquet footer; a CSV needs ``schema``, or is read as text columns.
    """
    try:
        return spark.read.parquet(f"{directory}/{stem}.parquet")
    except AnalysisException:
        try:
            read = spark.read.option("header", True)
            return (read.schema(schema) if schema else read).csv(f"{directory}/{stem}.csv")
        except AnalysisException:
            return None


def load_hourly_bundle(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """Sales with aliases resolved, and what there is of labels, weather and products."""
    sales = scan_table(spark, directory, "sales_hourly")
    sales = scan_table(spark, directory, "freshretail_train") if sales is None else sales
    if sales is None:
        raise FileNotFoundError(f"no hourly sales under {directory}")
    sales = standardize_columns(sales).withColumn("hour_timestamp", F.to_timestamp("hour_timestamp"))
    out = {"sales": sales}
    for name in ("stockout_labels", "weather", "products"):
        table = scan_table(spark, directory, name)
        if table is not None:
            out[name] = standardize_columns(table)
    if "stockout_labels" in out:
        from shelfloom.operators.relational import attach_stockout

        out["sales"] = attach_stockout(sales, out["stockout_labels"], ["product_id", "store_id", "hour_timestamp"])
    return out


def load_weekly_bundle(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """S3: the five weekly tables that exist; transactions are called sales."""
    names = {"transaction_data": "sales", "product": "product", "hh_demographic": "hh_demographic", "causal_data": "causal_data", "clickstream_log": "clickstream_log"}
    found = {new: scan_table(spark, directory, old) for old, new in names.items()}
    return {k: v for k, v in found.items() if v is not None}


WEATHER = T.StructType([T.StructField("store_id", T.IntegerType()), T.StructField("date", T.StringType()), T.StructField("temperature", T.DoubleType()), T.StructField("precipitation", T.DoubleType()), T.StructField("humidity", T.DoubleType())])


def load_weather(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header."""
    return spark.read.option("header", True).schema(WEATHER).csv(path).withColumn("date", F.to_date("date"))


def load_forecasts(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Parquet or CSV by suffix.  A CSV is read once if its schema is given, else once more to infer it."""
    if path.endswith((".csv", ".csv.gz")):
        read = spark.read.option("header", True)
        return (read.schema(schema) if schema else read.option("inferSchema", True)).csv(path)
    return spark.read.parquet(path)


def peek(spark: SparkSession, path: str, columns: list[str], n: int = 10) -> DataFrame:
    """A few rows of some columns; the rest is not read."""
    df = spark.read.parquet(path)
    found = [resolve_column(df, c) for c in columns]
    return df.select(*[c for c in found if c]).limit(n)


def unpack_hours(df: DataFrame, array: str = "hours_sale", day: str = "dt", out: str = "sales_quantity") -> DataFrame:
    """One row per hour of a daily row that holds an array of hourly sales."""
    others = [c for c in df.columns if c not in (array, day)]
    rows = df.select(*others, day, F.posexplode(array).alias("__hour", out))
    at = F.to_timestamp(F.to_date(day)) + F.make_dt_interval(hours=F.col("__hour"))
    return rows.select(*others, at.alias("hour_timestamp"), out)


def sink_parquet(df: DataFrame, path: str, partition_by: list[str] = ()) -> None:
    """S8."""
    writer = df.write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def sink_csv(df: DataFrame, path: str, compress: bool = True) -> None:
    """S9."""
    df.write.mode("overwrite").option("header", True).option("compression", "gzip" if compress else "none").csv(path)


def sink_metrics(df: DataFrame, path: str) -> None:
    """A tidy table of metrics as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)


def as_json(*columns: str) -> Column:
    return F.to_json(F.struct(*columns))
