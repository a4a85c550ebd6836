"""Incremental processing of arriving files with Structured Streaming."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfloom.streaming import files
from shelfloom.streaming.keyed import KeyedTable

PROGRESS = "dataset string, stream string, batch long, rows long, first_time timestamp, last_time timestamp"


def hourly_stream(spark: SparkSession, path: str, schema, late: str = "2 hours") -> DataFrame:
    """ST1: hourly sums of each series from Parquet files of events, with late rows up to ``late``."""
    rows = spark.readStream.schema(schema).parquet(path).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    by = rows.groupBy(F.window("ts", "1 hour"), F.col("event_type").alias("product_id"), (F.col("user_id") % 10).cast("int").alias("store_id"))
    return by.agg(F.sum(F.floor("value").cast("double")).alias("sales_quantity")).select(F.col("window.start").alias("hour_timestamp"), "product_id", "store_id", "sales_quantity")


def incremental_aggregate(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """ST1: what is new since the last run; windows that may still change stay in the state."""
    return stream.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class ProgressLedger:
    """ST3: what each batch of each dataset's streams has brought, one small file a batch.

    A stream is known by its checkpoint: a batch that is replayed writes its file anew, so it counts once, and
    a restarted stream goes on.  Cases: an empty batch is a row with 0 rows and no times; without batches the
    table is empty.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def record(self, dataset: str, stream: str, batch_id: int, batch: DataFrame, time: str | None) -> None:
        ends = [F.min(time).cast("string"), F.max(time).cast("string")] if time else [F.lit(None), F.lit(None)]
        rows, first, last = batch.agg(F.count("*"), *ends).first()
        where = hashlib.sha256(f"{dataset}\x00{stream}".encode()).hexdigest()[:32]
        files.put(self.spark, f"{self.path}/{where}-{batch_id:012d}.json", {"dataset": dataset, "stream": stream, "batch": batch_id, "rows": rows, "first_time": first, "last_time": last}, replace=True)

    def batches(self) -> DataFrame:
        """dataset, stream, batch, rows, first_time, last_time."""
        if not files.names(self.spark, self.path):
            return self.spark.createDataFrame([], PROGRESS)
        return self.spark.read.schema(PROGRESS).json(self.path)

    def stats(self) -> DataFrame:
        """dataset, batches, rows, first_time, last_time over all its streams."""
        return self.batches().groupBy("dataset").agg(F.count("*").alias("batches"), F.sum("rows").alias("rows"), F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"))


def each_batch(stream: DataFrame, write: Callable[[DataFrame, int], object], checkpoint: str, ledger: ProgressLedger | None = None, dataset: str = "", time: str | None = None) -> StreamingQuery:
    """Writes what is new since the last run, batch by batch, and then the batch's line in the ledger.

    A run that dies in between replays the batch: ``write`` has to bear that.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        if ledger:
            ledger.record(dataset, checkpoint, batch_id, batch, time)

    return stream.writeStream.foreachBatch(run).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def incremental_upsert(stream: DataFrame, table: KeyedTable, checkpoint: str, ledger: ProgressLedger | None = None, dataset: str = "", time: str | None = None) -> StreamingQuery:
    """ST2: each batch is merged by key into the partitions that it touches.

    Partitions may come in any number of batches, batches any number of times.
    """
    return each_batch(stream, lambda batch, i: table.merge(batch, i, checkpoint), checkpoint, ledger, dataset, time)


def incremental_stats(ledger: ProgressLedger, dataset: str) -> DataFrame:
    """ST3: (dataset, batches, rows, first_time, last_time) of a dataset, over all runs."""
    return ledger.stats().where(F.col("dataset") == dataset)
