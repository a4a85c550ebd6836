"""op8: personal data in every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfloom.llm import pii
from shelfloom.llm.common import materialize, table


def op8_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    shapes = pii.revealing(pii.secret_shapes(docs))
    terms = materialize(pii.disclosing_terms(docs, shapes=shapes), "pii-terms")
    found = pii.detect(docs, terms, shapes=shapes).drop("text")
    spans = F.col("spans")
    number = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    counts = [number(kind).alias(f"n_{kind}") for kind in (*pii.KINDS, pii.SECRET)]
    base = F.filter(spans, lambda s: s["kind"].isin(*pii.KINDS))
    method = F.filter(spans, lambda s: ~s["kind"].isin(*pii.KINDS))
    return found.select("doc_id", *counts, F.sha2(pii.joined(base).cast("binary"), 256).alias("base_sha256"), pii.joined(spans).alias("spans"), F.size(method).cast("long").alias("n_method"), (F.size(spans) > 0).cast("int").alias("private"))


QUERIES = {"op8_pii_disclosure": op8_pii_disclosure}
ORACLES: dict[str, str] = {}
