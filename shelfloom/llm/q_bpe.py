"""op6: BPE encoding and decoding of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfloom.llm import bpe
from shelfloom.llm.common import table


#: Executors find the file by its name; callers may give the path of any other file of its kind.
VOCABULARY = "word_bpe_49k.json"


def op6_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode(docs, VOCABULARY).drop("text")
    both = bpe.decode(ids, VOCABULARY)
    return both.select("doc_id", *bpe.digests(both))


QUERIES = {"op6_bpe_automaton": op6_bpe_automaton}
ORACLES: dict[str, str] = {}
