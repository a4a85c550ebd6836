"""op7: documents without repeated or nearly repeated lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfloom.llm.common import table
from shelfloom.llm.line_dedup import dedup_lines


def op7_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs)


QUERIES = {"op7_fuzzy_lines": op7_fuzzy_lines}
ORACLES: dict[str, str] = {}
