"""Air-quality sub-index as native Column expressions (no UDF).

The sub-index of a concentration ``v`` for a pollutant with breakpoints
``G[0..n-1]`` against index levels ``A`` is piecewise linear:

* ``G[i-1] <= v < G[i]``: interpolate between ``(G[i-1], A[i-1])`` and
  ``(G[i], A[i])``; bands meet without a gap.
* ``v >= G[n-1]``: the saturated value ``A[n-1] - 1``.
* ``v < G[0]``: the band wraps to the last level, i.e. the line through
  ``(G[n-1], A[-1])`` and ``(G[0], A[0])``.
* null or NaN: null.

Every pollutant's expression is one CASE chain, so a whole table is scored in
a single codegen'd projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S
from .stats import lookup


def bands(param: str):
    """[(upper_bound or None, lower_g, lower_a, slope_num, slope_den)] in test order.

    The first entry is the saturation case, flagged by ``upper_bound is None``.
    """
    g = [float(x) for x in S.CONCENTRATION_LEVELS[param]]
    a = S.AQI_LEVELS
    n = len(g)
    out = [(None, g[n - 1], float(a[n - 1] - 1), 0.0, 1.0)]
    # below the first breakpoint: line through (g[n-1], a[-1]) and (g[0], a[0])
    out.append((g[0], g[n - 1], float(a[-1]), float(a[0] - a[-1]), g[0] - g[n - 1]))
    for i in range(1, n):
        out.append((g[i], g[i - 1], float(a[i - 1]), float(a[i] - a[i - 1]), g[i] - g[i - 1]))
    return out


def subindex(value: Column, param: str) -> Column:
    """Sub-index of ``value`` for one pollutant code."""
    v = value.cast("double")
    expr = F.when(v.isNull() | F.isnan(v), F.lit(None).cast("double"))
    for upper, g0, a0, num, den in bands(param):
        if upper is None:
            expr = expr.when(v >= F.lit(g0), F.lit(a0))
        else:
            expr = expr.when(v < F.lit(upper), (v - F.lit(g0)) * F.lit(num) / F.lit(den) + F.lit(a0))
    return expr


def subindex_by_param(value: Column, param: Column) -> Column:
    """Sub-index in long form: the breakpoint table is chosen by the ``param`` column."""
    expr = None
    for p in S.POLLUTANTS:
        expr = (F.when(param == F.lit(p), subindex(value, p)) if expr is None
                else expr.when(param == F.lit(p), subindex(value, p)))
    return expr


def global_index(*cols: Column) -> Column:
    """Row-wise maximum of sub-indices (nulls skipped)."""
    return F.greatest(*cols)


def wide_subindices(df, params=None, value_col=S.forecast_column, keep=True):
    """Add ``aqi_<code>`` for each pollutant's value column and ``global_aqi``."""
    params = params or S.POLLUTANTS
    cols = [subindex(F.col(value_col(p)), p).alias(S.aqi_column(p)) for p in params]
    base = [F.col(c) for c in df.columns] if keep else []
    out = df.select(*base, *cols)
    return out.withColumn("global_aqi", global_index(*[F.col(S.aqi_column(p)) for p in params]))


#: Slots of a pollutant in the bound arrays; the search halves them.
SLOTS = 8


def search_arrays() -> dict[str, list[float]]:
    """``bound`` and the line (``g0``, ``a0``, ``num``, ``den``) of every pollutant's bands, ``SLOTS`` entries a pollutant.

    Slot k of ``bound`` is the pollutant's k-th breakpoint, NaN (which Spark orders last) beyond its last one. Slot k of
    the lines holds for values with k breakpoints at or below them. Values at or above the last one need no slot.
    """
    out = {name: [] for name in ("bound", "g0", "a0", "num", "den")}
    for p in S.POLLUTANTS:
        _, *rest = bands(p)
        if len(rest) > SLOTS:
            raise ValueError(f"{p}: more than {SLOTS} breakpoints")
        out["bound"] += [b[0] for b in rest] + [float("nan")] * (SLOTS - len(rest))
        for i, name in enumerate(("g0", "a0", "num", "den"), 1):
            out[name] += [b[i] for b in rest] + [float("nan")] * (SLOTS - len(rest))
    return out


def subindex_long(df, value_col: str, param_col: str = "param", out: str = "aqi"):
    """Sub-index in long form: a binary search over the sorted breakpoints of the row's pollutant.

    Same values as ``subindex_by_param`` bit for bit. A reading costs one look at its pollutant's last breakpoint and
    three at the halves before it, all array reads in generated code; no join, and no six nested CASE chains
    (whose generated code is too large for the JIT). Unknown pollutants, null and NaN give null.
    """
    at = {name: F.lit(xs) for name, xs in search_arrays().items()}
    tops = [bands(p)[0] for p in S.POLLUTANTS]
    last, full = F.lit([t[1] for t in tops]), F.lit([t[2] for t in tops])
    kept = [F.col(f"`{c.replace('`', '``')}`") for c in df.columns if c != out]
    which = lookup(F.col(param_col), {p: i for i, p in enumerate(S.POLLUTANTS)})
    v, p, k = F.col("__value"), F.col("__pollutant"), F.col("__slot")
    d = df.select(*kept, F.when(which.isNotNull(), F.col(value_col).cast("double")).alias("__value"),
                  F.coalesce(which, F.lit(0)).alias("__pollutant"))
    d = d.withColumn("__slot", p * F.lit(SLOTS))
    for half in (SLOTS // 2, SLOTS // 4, SLOTS // 8):  # one projection a step, as a step reads the one before twice
        d = d.withColumn("__slot", k + F.when(at["bound"][k + F.lit(half - 1)] <= v, F.lit(half)).otherwise(F.lit(0)))
    line = (F.when(v.isNull() | F.isnan(v), F.lit(None).cast("double"))
            .when(v >= last[p], full[p])
            .otherwise((v - at["g0"][k]) * at["num"][k] / at["den"][k] + at["a0"][k]))
    return d.select(*kept, line.alias(out))
