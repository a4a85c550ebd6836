"""op4: pages to WARC archives and back, one row per capture."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfloom.llm import warc
from shelfloom.llm.common import materialize, scratch_path, table


def op4_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    records = materialize(warc.read_records(spark, path, block=False), "warc-records")
    captures = warc.assemble(records)
    rows = materialize(
        captures.select(
            "capture_id",
            warc.field("page-id").cast("long").alias("page_id"),
            warc.field("payload-length").cast("long").alias("payload_bytes"),
            F.col("capture.payload_digest").alias("payload_digest"),
            F.col("capture.type").alias("record_type"),
            F.col("capture.refers_to").alias("target"),
        ),
        "warc-captures",
    )
    named = rows.where("record_type = 'response'").select(F.col("capture_id").alias("target"), F.col("page_id").alias("refers_to"))
    return rows.join(named, "target", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)"""

QUERIES = {"op4_warc_transactions": op4_warc_transactions}
ORACLES = {"op4_warc_transactions": ORACLE}
