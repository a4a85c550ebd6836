"""A corpus pipeline of five training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's docs.  All stages but the last return the columns of documents; columns of
any name besides doc_id and text pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfloom.llm import bpe, decontaminate, line_dedup, near_dup, toxicity
from shelfloom.llm.common import discard, materialize, table
from shelfloom.llm.q_bpe import VOCABULARY
from shelfloom.llm.q_tox import held_out

_REST = "__rest"


def _packed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, one struct of the other columns): their names cannot meet an operator's own."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*rest, F.lit(0).alias(_REST)).alias(_REST))


def _unpacked(packed: DataFrame, docs: DataFrame, changed: dict | None = None) -> DataFrame:
    own = {c: F.col(c) for c in ("doc_id", "text")} | (changed or {})
    return packed.select(*[own.get(c, F.col(_REST)[c]).alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised classifier calls toxic go.

    Null and empty texts have the base score; repeated rows stay or go alike; rows without doc_id are
    judged by their text; without labels of both classes nothing is learned and all stay; an empty table
    stays empty.
    """
    labels = table(spark, sf_dir, "labels").where(~held_out())
    packed = _packed(docs)
    model, learned = toxicity.fit(packed.select("doc_id", "text"), labels)
    if learned is None:
        return docs
    discard(learned)
    return _unpacked(toxicity.predict(packed, model).where("predicted = 0"), docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of each group of similar lines stays; n_chars follows the text.

    Every row stays, if only with blank lines; null texts stay null; rows that share a doc_id keep the
    same line numbers; rows without doc_id stay as they are; an empty table stays empty.
    """
    cut = line_dedup.dedup_lines(_packed(docs))
    changed = {}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return _unpacked(cut, docs, changed)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest doc_id.

    Null and blank texts are in no group and stay; a doc_id's rows stay or go together; rows without
    doc_id stay; an empty table stays empty.
    """
    gone = near_dup.near_duplicates(docs.select("doc_id", "text")).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null texts match nothing; a doc_id's rows stay or go together; rows without doc_id stay; an empty
    table, or an empty benchmark, changes nothing.
    """
    found = decontaminate.matches(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests that show the way back.

    Every row stays; a null text has no token and decodes to the empty text.
    """
    both = bpe.decode(bpe.encode(docs.select("doc_id", "text"), VOCABULARY), VOCABULARY)
    return both.select("doc_id", "text", "ids", *bpe.digests(both))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_copies),
    ("decontamination", drop_leaks),
    ("bpe", tokenize),
]

#: The stages are iterative and run table-driven Python: SQL cannot express them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
