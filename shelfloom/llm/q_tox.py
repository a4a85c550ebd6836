"""op10: toxicity of every document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfloom.llm import toxicity
from shelfloom.llm.common import table


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def op10_toxicity_weak(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", held_out().alias("held_out"), "text")
    labels = table(spark, sf_dir, "labels").where(~held_out())
    return toxicity.score(docs, labels)


QUERIES = {"op10_toxicity_weak": op10_toxicity_weak}
ORACLES: dict[str, str] = {}
