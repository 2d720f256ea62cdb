"""Grouped linear forecasts from sufficient statistics.

One model per group (key × variable or key × pollutant) is fitted by a
single ``groupBy`` -- the statistics are algebraic aggregates, so Spark
combines them map-side and the shuffle carries one small row per group and
map task, however skewed the groups are. The fitted table has one row per
group and is joined to the prediction grid on the key.

* ``trend``: ``value ~ t`` with the month index ``t = (year - base) * 12 + month``
  (``regr_slope`` / ``regr_intercept``).
* ``ols2``: ``value ~ month + year`` (the weather models' features), solved
  in closed form from population (co)variances; a singular or near-singular
  design (one year or one month only, or month and year almost collinear:
  ``1 - corr^2 <= RANK_TOL``) gives null rather than an unstable fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S

RANK_TOL = 1e-6


def month_index(base_year: int = S.BASE_YEAR) -> Column:
    return (F.col("year") - F.lit(base_year)) * F.lit(12) + F.col("month")


def trend_fit(train: DataFrame, group_cols, value_col: str = "value",
              base_year: int = S.BASE_YEAR) -> DataFrame:
    t = month_index(base_year).cast("double")
    y = F.col(value_col).cast("double")
    return train.groupBy(*group_cols).agg(
        F.regr_slope(y, t).alias("slope"), F.regr_intercept(y, t).alias("intercept"),
        F.count(y).alias("n_train"))


def trend_predict(fit: DataFrame, grid: DataFrame, key_cols, pred_col: str = "prediction",
                  base_year: int = S.BASE_YEAR) -> DataFrame:
    names = [c for c in fit.columns if c not in ("slope", "intercept", "n_train") and c not in key_cols]
    t = month_index(base_year).cast("double")
    return (grid.join(fit, list(key_cols))
            .select(*names, *key_cols, "year", "month",
                    (F.col("intercept") + F.col("slope") * t).alias(pred_col)))


def ols2_fit(train: DataFrame, group_cols, value_col: str = "value",
             x1: str = "month", x2: str = "year") -> DataFrame:
    a, b, y = F.col(x1).cast("double"), F.col(x2).cast("double"), F.col(value_col).cast("double")
    s = train.groupBy(*group_cols).agg(
        F.avg(a).alias("m1"), F.avg(b).alias("m2"), F.avg(y).alias("my"),
        F.var_pop(a).alias("v1"), F.var_pop(b).alias("v2"), F.covar_pop(a, b).alias("c12"),
        F.covar_pop(a, y).alias("c1y"), F.covar_pop(b, y).alias("c2y"), F.count(y).alias("n_train"))
    det = F.col("v1") * F.col("v2") - F.col("c12") * F.col("c12")
    # rank tolerance: a (near-)collinear design, 1 - corr(x1, x2)^2 <= RANK_TOL, is singular
    ok = det > F.lit(RANK_TOL) * F.col("v1") * F.col("v2")
    b1 = F.when(ok, (F.col("c1y") * F.col("v2") - F.col("c2y") * F.col("c12")) / det)
    b2 = F.when(ok, (F.col("c2y") * F.col("v1") - F.col("c1y") * F.col("c12")) / det)
    return (s.withColumn("b1", b1).withColumn("b2", b2)
            .select(*group_cols, "b1", "b2", "m1", "m2", "my", "n_train"))


def ols2_predict(fit: DataFrame, grid: DataFrame, key_cols, pred_col: str = "prediction",
                 x1: str = "month", x2: str = "year") -> DataFrame:
    names = [c for c in fit.columns if c not in ("b1", "b2", "m1", "m2", "my", "n_train") and c not in key_cols]
    pred = (F.col("my") + F.col("b1") * (F.col(x1).cast("double") - F.col("m1"))
            + F.col("b2") * (F.col(x2).cast("double") - F.col("m2")))
    return grid.join(fit, list(key_cols)).select(*names, *key_cols, "year", "month", pred.alias(pred_col))


def sql_trend(train: str, group_cols, value_col: str = "value", base_year: int = S.BASE_YEAR) -> str:
    g = ", ".join(group_cols)
    t = f"CAST((year - {base_year}) * 12 + month AS DOUBLE)"
    return (f"SELECT {g}, regr_slope(CAST({value_col} AS DOUBLE), {t}) AS slope, "
            f"regr_intercept(CAST({value_col} AS DOUBLE), {t}) AS intercept, count({value_col}) AS n_train "
            f"FROM {train} GROUP BY {g}")


def sql_trend_value(base_year: int = S.BASE_YEAR, fit: str = "f", grid: str = "g") -> str:
    return f"({fit}.intercept + {fit}.slope * CAST(({grid}.year - {base_year}) * 12 + {grid}.month AS DOUBLE))"


def sql_ols2(train: str, group_cols, value_col: str = "value") -> str:
    g = ", ".join(group_cols)
    y = f"CAST({value_col} AS DOUBLE)"
    inner = (f"SELECT {g}, avg(CAST(month AS DOUBLE)) AS m1, avg(CAST(year AS DOUBLE)) AS m2, avg({y}) AS my, "
             f"var_pop(CAST(month AS DOUBLE)) AS v1, var_pop(CAST(year AS DOUBLE)) AS v2, "
             f"covar_pop(CAST(month AS DOUBLE), CAST(year AS DOUBLE)) AS c12, "
             f"covar_pop(CAST(month AS DOUBLE), {y}) AS c1y, covar_pop(CAST(year AS DOUBLE), {y}) AS c2y, "
             f"count({y}) AS n_train FROM {train} GROUP BY {g}")
    det = "(v1 * v2 - c12 * c12)"
    ok = f"{det} > {RANK_TOL!r} * v1 * v2"
    return (f"SELECT {g}, CASE WHEN {ok} THEN (c1y * v2 - c2y * c12) / {det} END AS b1, "
            f"CASE WHEN {ok} THEN (c2y * v1 - c1y * c12) / {det} END AS b2, m1, m2, my, n_train "
            f"FROM ({inner})")


def sql_ols2_value(fit: str = "f", grid: str = "g") -> str:
    return (f"({fit}.my + {fit}.b1 * (CAST({grid}.month AS DOUBLE) - {fit}.m1) "
            f"+ {fit}.b2 * (CAST({grid}.year AS DOUBLE) - {fit}.m2))")
