"""Aggregate helpers.

``exact_mean``: mean of a DECIMAL column, or of one of whole units, from its exact sum. A double
``avg`` depends on summation order, so two runs with different partitionings
(or a partition recomputed after an executor loss) can differ in the last
bits; an exact sum cannot. The sum is converted to double once per group
through its decimal text, which is correctly rounded on every engine, then
divided by the count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Bits of the lower limb of a sum of units.
LIMB_BITS = 30


def in_units(col: Column, scale: int, name: str) -> Column:
    """A long that counts units of 10^-scale, marked as such in the column's metadata."""
    return col.cast("long").alias(name, metadata={"units_scale": scale})


def units_scale(df: DataFrame, name: str) -> int | None:
    """Scale of a column made by ``in_units``; None for any other."""
    return df.schema[name].metadata.get("units_scale")


def exact_sum(units: Column) -> Column:
    """Exact decimal(38,0) sum of longs, from two long sums (no decimal buffer).

    A long is cut into its lower 30 bits and the rest; the rests carry the sign. Both sums of longs up to 2^60 in size fit for
    up to 2^33 rows a group; beyond that the sum raises an error (ANSI) and is never wrong. Null if there is no value.
    """
    low = F.sum(units.bitwiseAND(F.lit((1 << LIMB_BITS) - 1)))
    high = F.sum(F.shiftright(units, LIMB_BITS))
    return (high.cast("decimal(19,0)") * F.lit(1 << LIMB_BITS).cast("decimal(10,0)") + low.cast("decimal(19,0)")).cast("decimal(38,0)")


def exact_mean(col: Column | str, exact: bool = True, scale: int | None = None) -> Column:
    """Mean from the exact sum; ``scale`` says that ``col`` counts units of 10^-scale (``in_units``)."""
    c = F.col(col) if isinstance(col, str) else col
    if not exact:
        return F.avg(c.cast("double")) / F.lit(10.0 ** (scale or 0))
    if scale is None:
        return F.sum(c).cast("string").cast("double") / F.count(c)
    # read as text, as the decimal sum is: correctly rounded once
    return F.concat(exact_sum(c).cast("string"), F.lit(f"E-{scale}")).cast("double") / F.count(c)


def sql_exact_mean(expr: str) -> str:
    return f"(CAST(CAST(sum({expr}) AS VARCHAR) AS DOUBLE) / count({expr}))"


def lookup(col: Column, mapping: dict) -> Column:
    """Map fixed keys to fixed values as a CASE expression (null elsewhere)."""
    out = None
    for k, v in mapping.items():
        out = (F.when(col == F.lit(k), F.lit(v)) if out is None
               else out.when(col == F.lit(k), F.lit(v)))
    return out


def round_sig(col: Column | str, digits: int = 9) -> Column:
    """Round to ``digits`` significant digits (for comparing large or tiny statistics).

    Only exact powers of ten (10^n, n >= 0) are used as scale factors.
    """
    c = F.col(col) if isinstance(col, str) else col
    k = F.floor(F.log10(F.abs(c)))
    up, down = F.pow(F.lit(10.0), k), F.pow(F.lit(10.0), -k)
    return (F.when(c == F.lit(0.0), F.lit(0.0))
            .when(k >= 0, F.round(c / up, digits - 1) * up)
            .otherwise(F.round(c * down, digits - 1) / down))


def sql_round_sig(expr: str, digits: int = 9) -> str:
    expr = f"({expr})"
    k = f"floor(log10(abs({expr})))"
    return (f"(CASE WHEN {expr} = 0 THEN 0.0 "
            f"WHEN {k} >= 0 THEN round({expr} / pow(10.0, {k}), {digits - 1}) * pow(10.0, {k}) "
            f"ELSE round({expr} * pow(10.0, -{k}), {digits - 1}) / pow(10.0, -{k}) END)")


#: Fixed point: steps in one unit. A power of two, so scaling a double loses nothing.
FIXED_STEPS = 1 << 24


def fixed(col: Column) -> Column:
    """A double as a whole number of steps, halves up; |value| up to 5e11 fits a long. Sums of these are exact."""
    return F.floor(col.cast("double") * F.lit(float(FIXED_STEPS)) + F.lit(0.5)).cast("long")


def sql_fixed(expr: str) -> str:
    return f"CAST(floor(CAST({expr} AS DOUBLE) * {float(FIXED_STEPS)!r} + 0.5e0) AS HUGEINT)"
