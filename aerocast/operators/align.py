"""Putting forecasts on the prediction grid (C3, C5) and history + forecast.

Two semantics for the grid's outer chain (SURVEY D1):

``mode="merge"`` (default): each arm is reduced to one row per key and the
keys coalesce, i.e. ``grid FULL JOIN a USING (k) FULL JOIN b USING (k) ...``.
Built as one union of the grid keys and every arm in long form followed by
one conditional aggregation -- a single shuffle however many arms there are.

``mode="reference"``: ``grid t FULL JOIN a ON t.k = a.k FULL JOIN b ON t.k =
b.k ...``: only the grid's key columns are returned, so an arm row absent
from the grid becomes its own row with null keys, never merged with another
arm's. Built as left joins of the grid with the arms, plus the arm rows that match no
grid row: the null keys of such rows never travel through another join.

Keys are expected non-null in merge mode (grouping would put null keys of
different arms together, where ``USING`` would keep them apart).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ARM = "_arm"
_VAL = "_v"


def _fill(df: DataFrame, cols, fill):
    return df if fill is None else df.fillna(float(fill), subset=list(cols))


def merge_long(grid: DataFrame, long: DataFrame, keys, name_col: str, value_col: str,
               columns: dict, fill=0.0) -> DataFrame:
    """Merge-mode outer chain from a long table of arms.

    ``columns`` maps an arm name (value of ``name_col``) to its output column.
    """
    base = grid.select(*keys, F.lit(None).cast("string").alias(_ARM), F.lit(None).cast("double").alias(_VAL))
    arms = long.select(*keys, F.col(name_col).cast("string").alias(_ARM), F.col(value_col).cast("double").alias(_VAL))
    u = base.unionByName(arms.where(F.col(_ARM).isin(list(columns))))
    out = u.groupBy(*keys).agg(*[F.avg(F.when(F.col(_ARM) == F.lit(n), F.col(_VAL))).alias(c)
                                 for n, c in columns.items()])
    return _fill(out, columns.values(), fill)


def outer_chain(grid: DataFrame, arms: dict, keys, mode: str = "merge", fill=0.0) -> DataFrame:
    """Outer chain of ``grid`` with ``arms`` (output column -> DataFrame(keys + that column))."""
    if mode == "merge":
        long = reduce(DataFrame.unionByName, [
            a.select(*keys, F.lit(c).alias(_ARM), F.col(c).cast("double").alias(_VAL)) for c, a in arms.items()])
        return merge_long(grid, long, keys, _ARM, _VAL, {c: c for c in arms}, fill)
    if mode != "reference":
        raise ValueError(f"unknown mode {mode!r}")
    long = reduce(DataFrame.unionByName, [
        a.select(*keys, F.lit(c).alias(_ARM), F.col(c).cast("double").alias(_VAL)) for c, a in arms.items()])
    return reference_long(grid, long, keys, _ARM, _VAL, {c: c for c in arms}, fill)


def reference_long(grid: DataFrame, long: DataFrame, keys, name_col: str, value_col: str,
                   columns: dict, fill=0.0) -> DataFrame:
    """Reference-mode outer chain from a long table of arms, which is read once for each arm: pass a stored table."""
    value = F.col(value_col).cast("double")
    grid = grid.select(*keys)
    out = grid
    for n, c in columns.items():
        out = out.join(long.where(F.col(name_col) == F.lit(n)).select(*keys, value.alias(c)), list(keys), "left")
    lost = long.where(F.col(name_col).isin(list(columns))).join(grid, list(keys), "left_anti").select(
        *[F.lit(None).cast(grid.schema[k].dataType).alias(k) for k in keys],
        *[F.when(F.col(name_col) == F.lit(n), value).alias(c) for n, c in columns.items()])
    return _fill(out.unionByName(lost), columns.values(), fill)


def combine_long(grid: DataFrame, long: DataFrame, keys, name_col: str, value_col: str,
                 columns: dict, mode: str = "merge", fill=0.0) -> DataFrame:
    fn = merge_long if mode == "merge" else reference_long
    if mode not in ("merge", "reference"):
        raise ValueError(f"unknown mode {mode!r}")
    return fn(grid, long, keys, name_col, value_col, columns, fill)


def history_and_forecast(history: DataFrame, forecast: DataFrame, value_col: str = "value") -> DataFrame:
    """C7 (U3): one series of observed and forecast values, aligned by name, with ``kind``."""
    h = history.withColumn("kind", F.lit("history"))
    f = forecast.withColumn("kind", F.lit("forecast"))
    return h.unionByName(f)
