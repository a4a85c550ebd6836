"""Exact quantiles of columns of any length, all columns and levels together."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Values of one bracket for the last step, and the sketch's accuracy.
SMALL = 1_000_000
ACCURACY = 10_000


@dataclass
class _Bracket:
    """Where the rank of one level of one column lies: ``inside`` values of [low, high], ``below`` before them."""

    column: int
    rank: float
    low: float
    high: float
    below: int
    inside: int
    slack: int = 3

    def open(self, small: int) -> bool:
        # A bracket that even its own ends do not narrow is left as it is: its distinct values are counted.
        return self.inside > small and self.low < self.high and self.slack < ACCURACY

    def share(self) -> float:
        p = (self.rank - self.below) / (self.inside - 1) if self.inside > 1 else 0.0
        return min(max(p, 0.0), 1.0)


def exact_quantiles_of(df: DataFrame, columns: list[str], levels: list[float], small: int = SMALL) -> dict[str, list[float | None]]:
    """Interpolated quantiles of the values of each column that are not null; None if there is none.

    No task ever holds a column.  A bounded sketch brackets each wanted rank, what lies below is counted, and
    the brackets of all columns and levels are narrowed together: two aggregates a round, however many they
    are.  A bracket that misses its rank is sketched again more widely.  In the end the brackets' distinct
    values are counted and the quantile is taken from the counts.
    """
    if not columns or not levels:
        return {c: [] for c in columns}
    rows = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    v = [F.col(f"v{i}") for i in range(len(columns))]
    facts = rows.agg(F.array(*[F.struct(F.count(x).alias("n"), F.min(x).alias("low"), F.max(x).alias("high")) for x in v]).alias("f")).first()["f"]
    brackets = [_Bracket(i, q * (f["n"] - 1), f["low"], f["high"], 0, f["n"]) for i, f in enumerate(facts) if f["n"] for q in levels]
    while todo := [b for b in brackets if b.open(small)]:
        here = [F.when(v[b.column].between(b.low, b.high), v[b.column]) for b in todo]
        ends = [[F.lit(max(0.0, b.share() - b.slack / ACCURACY)), F.lit(min(1.0, b.share() + b.slack / ACCURACY))] for b in todo]
        found = rows.agg(F.array(*[F.percentile_approx(x, F.array(*e), ACCURACY) for x, e in zip(here, ends, strict=True)]).alias("f")).first()["f"]
        counts = rows.agg(F.array(*[F.struct(F.count_if(x < a).alias("under"), F.count_if(x.between(a, z)).alias("between")) for x, (a, z) in zip(here, found, strict=True)]).alias("f")).first()["f"]
        for b, (a, z), (under, between) in zip(todo, found, counts, strict=True):
            # Both neighbours of the rank have to be inside.
            holds = under <= b.rank - b.below and b.rank - b.below + 1 <= under + between
            if holds and between < b.inside:
                b.low, b.high, b.below, b.inside, b.slack = a, z, b.below + under, between, 3
            else:
                b.slack *= 4
    # A value counts for each bracket that holds it.
    parts = [F.when(v[b.column].between(b.low, b.high), F.struct(F.lit(i).alias("at"), v[b.column].alias("v"))) for i, b in enumerate(brackets)]
    if not parts:
        return {c: [None] * len(levels) for c in columns}
    counts = rows.select(F.explode(F.array_compact(F.array(*parts))).alias("x")).groupBy("x.at", "x.v").agg(F.count("*").alias("n"))
    shares = sorted({b.share() for b in brackets})
    got = {r["at"]: r["q"] for r in counts.groupBy("at").agg(F.percentile("v", F.array(*map(F.lit, shares)), F.col("n")).alias("q")).collect()}
    out: dict[str, list[float | None]] = {c: [None] * len(levels) for c, f in zip(columns, facts, strict=True) if not f["n"]}
    for i, b in enumerate(brackets):
        out.setdefault(columns[b.column], []).append(got[i][shares.index(b.share())])
    return out


def exact_quantiles(df: DataFrame, column: str, levels: list[float], small: int = SMALL) -> list[float | None]:
    """The same for one column."""
    return exact_quantiles_of(df, [column], levels, small)[column]
