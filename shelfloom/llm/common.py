"""Shared helpers of the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_PLACE = "_scratch_place"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the session names none, a temporary folder is set on a single machine; a cluster has to name one.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Cuts the lineage: writes ``df`` to the shared folder and reads it back.

    A lost executor costs a task then, not the whole chain before it.  The shuffle files of the write go
    at its end.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, tag), spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    setattr(out, _PLACE, path)
    return out


def carried(df: DataFrame, table: DataFrame) -> DataFrame:
    """``df``, a view of the materialized ``table``: to discard it deletes the table."""
    setattr(df, _PLACE, getattr(table, _PLACE, None))
    return df


def discard(*tables: DataFrame | None) -> None:
    """Deletes materialized tables that nothing needs any more; others are left alone."""
    for t in tables:
        path = getattr(t, _PLACE, None) if t is not None else None
        if path:
            jvm, conf = t.sparkSession._jvm, t.sparkSession._jsc.hadoopConfiguration()
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class KeyFilter:
    """A bitmap over 64-bit keys: no key of the table is refused, few others pass.

    16 bits a key, between 2^16 and 2^27 (16 MB) in all: beyond that more keys pass, and the exact join
    that follows has more to drop.
    """

    def __init__(self, keys: DataFrame, column: str):
        self.bits = 1 << min(max((16 * keys.count()).bit_length(), 16), 27)
        folded = F.expr(f"(`{column}` ^ shiftrightunsigned(`{column}`, 21) ^ shiftrightunsigned(`{column}`, 43)) & {self.bits - 1}L")
        words = keys.select(folded.alias("at")).select(F.expr("int(shiftright(at, 6))").alias("w"), F.expr("shiftleft(1L, int(at & 63))").alias("bit"))
        found = words.groupBy("w").agg(F.bit_or("bit").alias("bits")).toPandas()
        self.words = np.zeros(self.bits >> 6, np.uint64)
        self.words[found["w"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)

    def test(self, keys: np.ndarray) -> np.ndarray:
        """Which of the keys (64-bit numbers) pass."""
        k = keys.view(np.uint64)
        at = (k ^ (k >> np.uint64(21)) ^ (k >> np.uint64(43))) & np.uint64(self.bits - 1)
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
