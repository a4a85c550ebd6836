"""Column expressions made of built-in functions; each stays in generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of West's rational approximation of the normal distribution, highest power first.
NUMERATOR = (3.52624965998911e-2, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376)
DENOMINATOR = (8.83883476483184e-2, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)


def r(c: Column, digits: int = 4) -> Column:
    """Rounded, with one zero only."""
    return F.round(c, digits) + F.lit(0.0)


def clip(c: Column, low: float | Column, high: float | Column) -> Column:
    """Null stays null."""
    low, high = (x if isinstance(x, Column) else F.lit(x) for x in (low, high))
    return F.when(c.isNotNull(), F.greatest(low, F.least(high, c)))


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return F.try_divide(a, b)


def norm_cdf(x: Column) -> Column:
    """The normal distribution function, to 2e-16."""
    z = F.abs(x)
    e = F.exp(-z * z / 2)
    horner = lambda cs: reduce(lambda acc, c: acc * z + c, cs[1:], F.lit(cs[0]))
    t = z + 0.65
    for k in (4, 3, 2, 1):
        t = z + F.lit(float(k)) / t
    tail = F.when(z > 37, 0.0).when(z < 7.07106781186547, e * horner(NUMERATOR) / horner(DENOMINATOR)).otherwise(e / t / 2.506628274631)
    return F.when(x > 0, 1 - tail).otherwise(tail)


def norm_cdf_sql(x: str) -> str:
    """The same as text."""
    z = f"abs({x})"
    horner = lambda cs: reduce(lambda acc, c: f"({acc} * {z} + {c!r})", cs[1:], repr(cs[0]))
    t = f"({z} + 0.65)"
    for k in (4, 3, 2, 1):
        t = f"({z} + {float(k)} / {t})"
    e = f"exp(-{z} * {z} / 2)"
    tail = f"(CASE WHEN {z} > 37 THEN 0.0 WHEN {z} < 7.07106781186547 THEN {e} * {horner(NUMERATOR)} / {horner(DENOMINATOR)} ELSE {e} / {t} / 2.506628274631 END)"
    return f"(CASE WHEN {x} > 0 THEN 1 - {tail} ELSE {tail} END)"


def hash_uniform(*cols: Column, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the columns (as text, nulls left out) and the seed only.

    Taken from an MD5 digest, so any engine can make it.
    """
    digest = F.md5(F.concat_ws("|", *cols, F.lit(seed)))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def hash_uniform_sql(*cols: str, seed: int = 0) -> str:
    """The same as DuckDB text."""
    return f"(CAST('0x' || substr(md5(concat_ws('|', {', '.join(cols)}, {seed})), 1, 13) AS UBIGINT) / {float(1 << 52)!r})"


def steps(c: Column, bounds: list[tuple[float, object]], otherwise: object) -> Column:
    """The value of the first bound that c is below; ``otherwise`` for the rest, null for null."""
    out = F.when(c < bounds[0][0], bounds[0][1])
    for high, value in bounds[1:]:
        out = out.when(c < high, value)
    return F.when(c.isNotNull(), out.otherwise(otherwise))


def labels(*pairs: tuple[Column, str]) -> Column:
    """The texts whose conditions hold, in order."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(text)) for cond, text in pairs]))


def equal_width_bin(c: Column, low: Column, high: Column, n: int) -> Column:
    """0-based bin between low and high; the maximum falls in the last bin, a constant column in bin 0."""
    return F.when(high > low, F.least(F.lit(n - 1), F.floor((c - low) / (high - low) * n).cast("int"))).otherwise(F.when(c.isNotNull(), 0))


def interpolate(before_x: Column, before_y: Column, after_x: Column, after_y: Column, x: Column) -> Column:
    """Linear between neighbours; at the ends the only neighbour's value."""
    line = before_y + (after_y - before_y) * (x - before_x) / (after_x - before_x)
    return F.when(before_y.isNull(), after_y).when(after_y.isNull(), before_y).otherwise(line)
