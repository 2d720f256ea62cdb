"""Least squares per group on any number of features (M2, M5), cross-fitting (M6) and keyed folds (M7).

One aggregate gathers the normal equations of every group: counts, sums and products of features and label, in fixed
point (steps of ``2^-24``) and exact. Exact sums add and subtract without loss, whatever the partitioning, so the equations of
"all but one fold" are the total's less the fold's, and every fold of every group is fitted from one pass. The equations
are solved in each group's row by elimination over arrays of Column expressions; no fit loop, nothing on the driver.

A feature that the ones before it explain (its pivot is ``RANK_TOL`` of its variance or less: constant, collinear, or more
features than rows) gets the coefficient 0, so every group with a label has a fit; a single row's is its label.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import FIXED_STEPS, fixed

RANK_TOL = 1e-9
_EXACT = "decimal(38,0)"


def _names(size: int) -> list[str]:
    """Columns of the equations of ``size`` variables, the label last."""
    return ["n", *[f"s{i}" for i in range(size)], *[f"p{i}_{j}" for i in range(size) for j in range(i, size)]]


def equations(rows: DataFrame, group_cols: Sequence[str], features: Sequence[str], label: str) -> DataFrame:
    """Normal equations of each group: ``n``, sums ``s<i>``, products ``p<i>_<j>``; rows lacking a value don't count.

    Mergeable: equations of parts add up column by column.
    """
    z = [fixed(F.col(c)).cast("decimal(19,0)").alias(f"z{i}") for i, c in enumerate([*features, label])]
    r = rows.select(*group_cols, *z).dropna(subset=[f"z{i}" for i in range(len(z))])
    k = range(len(z))
    return r.groupBy(*group_cols).agg(
        F.count("*").alias("n"), *[F.sum(f"z{i}").cast(_EXACT).alias(f"s{i}") for i in k],
        *[F.sum(F.col(f"z{i}") * F.col(f"z{j}")).cast(_EXACT).alias(f"p{i}_{j}") for i in k for j in k if i <= j])


def all_but(parts: DataFrame, group_cols: Sequence[str], part_col: str, size: int) -> DataFrame:
    """Equations of each group without each of its parts: the group's total less the part."""
    names = _names(size)
    total = parts.groupBy(*group_cols).agg(*[F.sum(c).alias(f"t_{c}") for c in names])
    left = parts.join(total, list(group_cols))
    return left.select(*group_cols, part_col, *[(F.col(f"t_{c}") - F.col(c)).cast("long" if c == "n" else _EXACT).alias(c) for c in names]) \
        .where("n > 0")


def _double(exact: Column) -> Column:
    return exact.cast("string").cast("double")  # through its digits: correctly rounded


def solve(eq: DataFrame, features: Sequence[str], use: Sequence[int] | None = None, prefix: str = "") -> DataFrame:
    """``eq`` with ``<prefix>fit``: (slopes, means of the features, mean of the label) over the features ``use`` (places in ``features``)."""
    size, use = len(features) + 1, list(range(len(features))) if use is None else list(use)
    cols = [*use, size - 1]

    def centred(i: int, j: int) -> Column:
        a, b = min(i, j), max(i, j)
        return _double(F.col("n").cast("decimal(19,0)") * F.col(f"p{a}_{b}") - F.col(f"s{i}") * F.col(f"s{j}"))

    def mean(i: int) -> Column:
        return _double(F.col(f"s{i}")) / (F.col("n").cast("double") * F.lit(float(FIXED_STEPS)))

    if use:
        start = F.array(*[F.array(*[centred(i, j) for j in cols]) for i in use])
        spread = F.array(*[centred(i, i) for i in use])

        def step(m: Column, at: Column) -> Column:
            own = F.get(m, at)
            pivot = F.get(own, at)
            scaled = F.when(pivot > F.lit(RANK_TOL) * F.get(F.col("_spread"), at), F.transform(own, lambda v: v / pivot)) \
                .otherwise(F.transform(own, lambda v: F.lit(0.0)))
            # the pivot row travels as the last row, so that it is worked out once
            held = F.concat(m, F.array(scaled))
            return F.transform(F.slice(held, 1, len(use)), lambda row, r: F.when(r == at, F.element_at(held, -1)).otherwise(
                F.zip_with(row, F.element_at(held, -1), lambda a, b: a - F.get(row, at) * b)))

        solved = F.aggregate(F.sequence(F.lit(0), F.lit(len(use) - 1)), F.col("_start"), step)
        slopes = F.transform(solved, lambda row: F.element_at(row, -1))
        eq = eq.withColumns({"_start": start, "_spread": spread})
    else:
        slopes = F.array().cast("array<double>")
    fit = F.struct(slopes.alias("slopes"), (F.array(*[mean(i) for i in use]) if use else F.array().cast("array<double>")).alias("means"),
                   mean(size - 1).alias("level"))
    return eq.withColumn(f"{prefix}fit", fit).drop("_start", "_spread")


def fitted(fit: Column, features: Sequence[str]) -> Column:
    """The fit's value at the row's features."""
    terms = [fit["slopes"][i] * (F.col(c).cast("double") - fit["means"][i]) for i, c in enumerate(features)]
    return reduce(lambda a, b: a + b, terms, fit["level"])


def fit(train: DataFrame, group_cols: Sequence[str], features: Sequence[str], label: str) -> DataFrame:
    """``group_cols, n, fit``: one least-squares fit a group."""
    return solve(equations(train, group_cols, features, label), features).select(*group_cols, "n", "fit")


def forecast(fits: DataFrame, score: DataFrame, group_cols: Sequence[str], key_cols: Sequence[str], features: Sequence[str],
             pred_col: str = "prediction") -> DataFrame:
    """``group_cols, year, month, prediction`` of every row of ``score`` (its key's every group); null where a feature is null."""
    out = score.join(fits, list(key_cols))
    return out.select(*group_cols, "year", "month", fitted(F.col("fit"), features).alias(pred_col))


def hash_rank(rows: DataFrame, group_cols: Sequence[str], key_cols: Sequence[str], seed: int = 42) -> DataFrame:
    """``rows`` with ``_rank`` (from 0) and ``_size``: the places of a group's rows by the md5 of seed and key.

    The order depends on the rows' own keys alone, never on partitions. Rows with equal keys stand next to each other, in any order.
    A group is a monthly series, so a window holds its months.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in [*group_cols, *key_cols]])
    w = Window.partitionBy(*group_cols)
    return rows.withColumn("_hash", F.md5(text)).withColumns({
        "_rank": F.row_number().over(w.orderBy("_hash", *key_cols)) - 1, "_size": F.count("*").over(w)}).drop("_hash")


def split_by_hash(rows: DataFrame, group_cols: Sequence[str], key_cols: Sequence[str], test_percent: int = 20,
                  seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test): of every group exactly ``floor(size * test_percent / 100)`` rows are for the test."""
    ranked = hash_rank(rows, group_cols, key_cols, seed)
    test = F.col("_rank") < F.floor(F.col("_size") * F.lit(test_percent) / F.lit(100))
    return ranked.where(~test).drop("_rank", "_size"), ranked.where(test).drop("_rank", "_size")


def cross_fit(rows: DataFrame, group_cols: Sequence[str], key_cols: Sequence[str], models: dict[str, Sequence[str]], label: str,
              folds: int = 5, seed: int = 42) -> DataFrame:
    """``group_cols, model, mse, n_test``: every row scored by fits on the other folds of its group.

    ``models`` maps a name to its features. All models and folds come from one aggregate over the rows. A row lacking a feature
    of any model or its label takes no part; a group of one row has no other fold, and no score.
    """
    every = list(dict.fromkeys(c for f in models.values() for c in f))
    whole = rows.dropna(subset=[*every, label])
    folded = hash_rank(whole, group_cols, key_cols, seed).withColumn("fold", F.pmod(F.col("_rank"), F.lit(folds)))
    eq = all_but(equations(folded, [*group_cols, "fold"], every, label), group_cols, "fold", len(every) + 1)
    for name, features in models.items():
        eq = solve(eq, every, [every.index(c) for c in features], f"{name}_")
    scored = folded.join(eq.select(*group_cols, "fold", *[f"{m}_fit" for m in models]), [*group_cols, "fold"])
    y = F.col(label).cast("double")
    error = {m: fitted(F.col(f"{m}_fit"), f) - y for m, f in models.items()}
    square = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), (e * e).alias("square")) for m, e in error.items()])).alias("e")
    return scored.select(*group_cols, square).groupBy(*group_cols, "e.model").agg(
        F.avg("e.square").alias("mse"), F.count("*").alias("n_test"))
