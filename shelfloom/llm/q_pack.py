"""op12: all documents packed into sequences of 1024 tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfloom.llm import packing
from shelfloom.llm.common import table

#: The ranks of the vocabulary byte_bpe_50k.json.
VOCABULARY = "byte_bpe_50k.tiktoken"


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, VOCABULARY).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


QUERIES = {"op12_best_fit_packing": op12_best_fit_packing}
ORACLES: dict[str, str] = {}
