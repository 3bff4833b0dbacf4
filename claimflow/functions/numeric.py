"""Exact decimal rounding of doubles, as Python's ``round(x, d)`` does it.

Spark's ``round`` is HALF_UP on the shortest decimal text of the double, so
65612.305 (stored as 65612.30499999...) becomes 65612.31, while the source's
Python agents get 65612.3. ``pyround`` reproduces the exact-binary result with
native expressions: x is split (Veltkamp) into two halves whose products with
10^d are exact, the fractional part of the exact product decides the
direction, and exact ties go to the even neighbour.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0  # 2^27 + 1


def pyround(x: Column, digits: int) -> Column:
    s = float(10 ** digits)
    t = x * _SPLIT
    hi = t - (t - x)
    lo = x - hi
    a = hi * s
    b = lo * s
    fa = F.floor(a).cast("double")
    r = (a - fa) + b
    fr_floor = F.floor(r).cast("double")
    n0 = fa + fr_floor
    fr = r - fr_floor
    half_even = F.when(F.pmod(n0, F.lit(2.0)) == 0, n0).otherwise(n0 + 1)
    n = F.when(fr > 0.5, n0 + 1).when(fr < 0.5, n0).otherwise(half_even)
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(n / s)


def pyround_sql(x: str, digits: int) -> str:
    """The same arithmetic as DuckDB SQL (IEEE doubles give identical results)."""
    s = f"{float(10 ** digits)}::DOUBLE"
    t = f"(({x}) * {_SPLIT}::DOUBLE)"
    hi = f"({t} - ({t} - ({x})))"
    lo = f"(({x}) - {hi})"
    a, b = f"({hi} * {s})", f"({lo} * {s})"
    fa = f"CAST(floor({a}) AS DOUBLE)"
    r = f"(({a} - {fa}) + {b})"
    ff = f"CAST(floor({r}) AS DOUBLE)"
    n0 = f"({fa} + {ff})"
    fr = f"({r} - {ff})"
    n = (f"(CASE WHEN {fr} > 0.5 THEN {n0} + 1 WHEN {fr} < 0.5 THEN {n0} "
         f"WHEN {n0} - 2 * floor({n0} / 2) = 0 THEN {n0} ELSE {n0} + 1 END)")
    return f"(CASE WHEN ({x}) IS NULL THEN NULL ELSE {n} / {s} END)"
