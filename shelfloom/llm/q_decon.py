"""op1: benchmark items in the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfloom.llm.common import table
from shelfloom.llm.decontaminate import matches


def op1_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: how many regions match, which items, and whether it is contaminated."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = matches(docs, table(spark, sf_dir, "benchmark"))
    by_doc = found.groupBy("doc_id").agg(F.count("*").alias("n_matches"), F.array_sort(F.collect_set("item_id")).alias("items"))
    return docs.select("doc_id").join(by_doc, "doc_id", "left").select(
        "doc_id",
        F.coalesce("n_matches", F.lit(0).cast("long")).alias("n_matches"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
        F.col("n_matches").isNotNull().alias("contaminated"),
    )


QUERIES = {"op1_qgram_decontamination": op1_qgram_decontamination}
ORACLES: dict[str, str] = {}
