"""op5: near-duplicate groups of the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfloom.llm.common import table
from shelfloom.llm.near_dup import near_duplicates


def op5_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op5_chosen_path": op5_chosen_path}
ORACLES: dict[str, str] = {}
