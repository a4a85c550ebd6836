"""op9: nearest neighbours among the embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfloom.llm.ann import nearest
from shelfloom.llm.common import table


def op9_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"), 20)


QUERIES = {"op9_kmeans_tree": op9_kmeans_tree}
ORACLES: dict[str, str] = {}
