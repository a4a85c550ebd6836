"""Connected components of an edge table, by repeated contraction.

Every round, each vertex points at the smallest vertex among itself and its neighbours (a grouping
with partial minima, so a hub is no burden), pointers are followed once more, and the edges move to
what their ends point at; loops and repeats go.  Vertices that are left have their least vertex; the
rounds' pointers are then composed backwards.  Each round at least halves the vertices that have
edges, and every round's tables are written to the shared folder.

Cases: loops and repeated edges do not matter; an empty table gives an empty result; null ends are
dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfloom.llm.common import carried, discard, materialize


def components(edges: DataFrame) -> DataFrame:
    """edges: (a, b).  Returns (node, component) for every vertex with an edge to another vertex.

    component is the smallest vertex that can be reached.
    """
    kind = edges.schema["a"].dataType
    left = materialize(edges.select("a", "b").where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-edges")
    rounds = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low")).select(F.col("a").alias("node"), "low")
        up = low.select(F.col("node").alias("low"), F.col("low").alias("lower"))
        point = materialize(low.join(up, "low").select("node", F.col("lower").alias("low")), "cc-point")
        rounds.append(point)
        end = lambda c: point.select(F.col("node").alias(c), F.col("low").alias(f"{c}_low"))  # noqa: E731, B023
        moved = left.join(end("a"), "a").join(end("b"), "b").select(F.greatest("a_low", "b_low").alias("a"), F.least("a_low", "b_low").alias("b"))
        before, left = left, materialize(moved.where("a != b").distinct(), "cc-edges")
        discard(before)
    discard(left)
    if not rounds:
        return edges.sparkSession.createDataFrame([], f"node {kind.simpleString()}, component {kind.simpleString()}")
    out = rounds[-1]
    for earlier in reversed(rounds[:-1]):
        later = out.select(F.col("node").alias("low"), F.col("low").alias("lower"))
        before, out = out, materialize(earlier.join(later, "low", "left").select("node", F.coalesce("lower", "low").alias("low")), "cc-out")
        discard(before, earlier)
    return carried(out.withColumnRenamed("low", "component"), out)
