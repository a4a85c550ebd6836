"""Arrivals: folders of one dataset whose files may be damaged and whose schemas may drift.

Each arrival (a day's delivery, say) is read with the columns that it has, as Parquet or as CSV with a header.
Columns are found by name and cast with a check: what the wanted schema lacks is left out, what the arrival lacks
is null.  A row goes to quarantine, with its file, its reasons and its record, if its line has too many or too few
fields, if a value cannot be cast, or if a required column is null.  Nothing is dropped silently: good rows and
quarantine together are all rows.

Cases: an arrival without files or without rows adds nothing; a Parquet file that cannot be read fails the load (its
rows are unknown); empty CSV fields are null; names are matched without case; wanted columns may not be named
``arrival``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROKEN = "__broken"


@dataclass
class Loaded:
    """good: arrival and the wanted columns; quarantine: arrival, file, reasons, record; drift: arrival, column, kind."""

    good: DataFrame
    quarantine: DataFrame
    drift: DataFrame


def _raw(spark: SparkSession, path: str, kind: str) -> DataFrame | None:
    try:
        if kind == "parquet":
            return spark.read.option("mergeSchema", True).parquet(path)
        read = spark.read.option("header", True)
        names = read.csv(path).columns
        if not names:
            return None
        fields = [T.StructField(n, T.StringType()) for n in names]
        # Without pruning all fields of a line are parsed, so that all damage shows.
        read = read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BROKEN).option("columnPruning", False)
        return read.schema(T.StructType([*fields, T.StructField(BROKEN, T.StringType())])).csv(path)
    except AnalysisException:
        return None


def _checked(raw: DataFrame, arrival: str, schema: T.StructType, required: list[str]) -> DataFrame:
    """arrival, the wanted columns, file, reasons, record."""
    have = {c.lower(): c for c in raw.columns if c != BROKEN}
    values: list[Column] = []
    reasons: list[Column] = [F.when(F.col(BROKEN).isNotNull(), "malformed line")] if BROKEN in raw.columns else []
    for f in schema.fields:
        if f.name.lower() in have:
            old = F.col(have[f.name.lower()])
            new = old.try_cast(f.dataType)
            reasons.append(F.when(old.isNotNull() & new.isNull(), f"bad {f.name}"))
            if f.name in required:
                reasons.append(F.when(old.isNull(), f"no {f.name}"))
        else:
            new = F.lit(None).cast(f.dataType)
            if f.name in required:
                reasons.append(F.lit(f"no {f.name}"))
        values.append(new.alias(f.name))
    whole = F.to_json(F.struct(*[F.col(c) for c in have.values()]))
    record = F.coalesce(BROKEN, whole) if BROKEN in raw.columns else whole
    found = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
    return raw.select(F.lit(arrival).alias("arrival"), *values, F.col("_metadata.file_path").alias("file"), found.alias("reasons"), record.alias("record"))


def load_arrivals(spark: SparkSession, places: dict[str, tuple[str, str]], schema: T.StructType, required: list[str]) -> Loaded:
    """places: arrival -> (path, parquet or csv)."""
    parts, drift = [], []
    for arrival, (path, kind) in sorted(places.items()):
        raw = _raw(spark, path, kind)
        if raw is None:
            continue
        have = {f.name.lower(): f.dataType for f in raw.schema.fields if f.name != BROKEN}
        want = {f.name.lower(): f.dataType for f in schema.fields}
        drift += [(arrival, c, "missing") for c in want if c not in have] + [(arrival, c, "extra") for c in have if c not in want]
        drift += [(arrival, c, "retyped") for c in want if kind == "parquet" and c in have and have[c] != want[c]]
        parts.append(_checked(raw, arrival, schema, required))
    changes = spark.createDataFrame(drift, "arrival string, column string, kind string")
    out = T.StructType([T.StructField("arrival", T.StringType()), *schema.fields, T.StructField("file", T.StringType()), T.StructField("reasons", T.ArrayType(T.StringType())), T.StructField("record", T.StringType())])
    rows = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], out)
    fine = F.size("reasons") == 0
    return Loaded(rows.where(fine).select("arrival", *schema.fieldNames()), rows.where(~fine).select("arrival", "file", "reasons", "record"), changes)
