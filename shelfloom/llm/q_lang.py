"""op3: the language of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfloom.llm import language_id
from shelfloom.llm.common import table


def op3_language_hd(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "text", "lang")
    langs, prototypes = language_id.train(docs.where("not held_out"))
    return language_id.predict(docs.drop("lang"), langs, prototypes)


QUERIES = {"op3_language_hd": op3_language_hd}
ORACLES: dict[str, str] = {}
