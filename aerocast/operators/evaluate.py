"""Forecast evaluation: holdout split (M7), mean squared error (A5), model
choice (M6 / C9) and the forecast-error report (C8: A4, J4, F6).

Everything is grouped long-form SQL over monthly tables: all candidate models
of all groups are scored by one aggregation, and the winner per group is
``min_by(model, (mse, model))`` -- smallest error, ties by name.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.stats import exact_mean
from . import baselines, linear


def holdout(df: DataFrame, test_year: int, first_year: int | None = None):
    """(train, test): years before ``test_year`` (from ``first_year``) against ``test_year``."""
    train = df.where(F.col("year") < F.lit(test_year))
    if first_year is not None:
        train = train.where(F.col("year") >= F.lit(first_year))
    return train, df.where(F.col("year") == F.lit(test_year))


def random_holdout(df: DataFrame, fraction: float = 0.8, seed: int = 42):
    """The latent 80/20 random split with a fixed seed. It differs when partitions do; ``ols.split_by_hash`` does not."""
    return df.randomSplit([fraction, 1.0 - fraction], seed=seed)


def candidate_predictions(monthly_long: DataFrame, name_cols, key_cols, test_year: int,
                          first_year: int | None = None, value_col: str = "value") -> DataFrame:
    """Predictions of the relational candidates for every test row, long form.

    ``linear``: trend on the month index; ``mean``: the group's training mean;
    ``seasonal_naive``: the same month one year earlier.
    """
    groups = [*name_cols, *key_cols]
    train, test = holdout(monthly_long, test_year, first_year)
    test = test.select(*groups, "year", "month", F.col(value_col).cast("double").alias("label"))
    lin = linear.trend_predict(linear.trend_fit(train, groups, value_col),
                               test.select(*groups, "year", "month"), groups, "prediction")
    mean = (test.select(*groups, "year", "month")
            .join(baselines.group_mean(train, groups, value_col, "prediction"), groups))
    naive = baselines.seasonal_naive(train.where(F.col("year") == F.lit(test_year - 1)),
                                     name_cols, key_cols, value_col, "prediction")
    preds = reduce(DataFrame.unionByName, [
        lin.withColumn("model", F.lit("linear")),
        mean.withColumn("model", F.lit("mean")),
        naive.withColumn("model", F.lit("seasonal_naive"))])
    return test.join(preds, [*groups, "year", "month"])


def mse_by_model(scored: DataFrame, group_cols, label: str = "label", pred: str = "prediction") -> DataFrame:
    """A5 grouped: mean squared error per (group, model)."""
    err = F.col(pred) - F.col(label)
    return scored.groupBy(*group_cols, "model").agg(F.avg(err * err).alias("mse"), F.count("*").alias("n_test"))


def best_model(mse: DataFrame, group_cols) -> DataFrame:
    """M6: the model with the smallest mse per group, ties broken by model name."""
    order = F.struct(F.col("mse").alias("m"), F.col("model").alias("n"))
    return mse.where(F.col("mse").isNotNull()).groupBy(*group_cols).agg(
        F.min_by("model", order).alias("best_model"), F.min("mse").alias("best_mse"))


def forecast_error(observed_daily: DataFrame, forecast: DataFrame, key_cols, name_cols=(),
                   value_col: str = "arithmetic_mean", pred_col: str = "prediction",
                   match_year: bool = False, exact: bool = True) -> DataFrame:
    """Observed means per (month, key) against forecasts, ``diff = predicted - observed``.

    A4 averages the observed daily rows per (names, month, key), year included
    (``year_x``). J4 joins on (names, key, month) -- not on the year unless
    ``match_year`` (D17) -- keeping the forecast's year as ``year_y``.
    """
    obs = (observed_daily.withColumn("year", F.year("date_local")).withColumn("month", F.month("date_local"))
           .groupBy(*name_cols, "month", *key_cols)
           .agg(exact_mean(value_col, exact).alias("observed"), F.avg(F.col("year").cast("double")).alias("year_x")))
    return error_report(obs, forecast, key_cols, name_cols, pred_col, match_year)


def error_report(observed: DataFrame, forecast: DataFrame, key_cols, name_cols=(), pred_col: str = "prediction",
                 match_year: bool = False) -> DataFrame:
    """Observed means (names, month, keys, ``observed``, ``year_x``) against forecasts."""
    fc = forecast.select(*name_cols, *key_cols, "month", F.col("year").alias("year_y"),
                         F.col(pred_col).alias("predicted"))
    out = observed.join(fc, [*name_cols, "month", *key_cols])
    if match_year:
        out = out.where(F.col("year_x") == F.col("year_y").cast("double"))
    return out.withColumn("diff", F.col("predicted") - F.col("observed"))


def observed_daily_index(pollutant_daily: DataFrame, key_cols) -> DataFrame:
    """Observed daily index per (key, date): the largest sub-index of that day's readings."""
    from ..functions.aqi import subindex_long
    scored = subindex_long(pollutant_daily.select("param", *key_cols, "date_local", "max_value"), "max_value")
    return scored.groupBy(*key_cols, "date_local").agg(F.max("aqi").alias("aqi"))


def compare_models(train: DataFrame, test: DataFrame, name_col: str, names, key_cols, feature_cols,
                   kinds=("linear", "rf", "dt", "gbt"), label_col: str = "value") -> DataFrame:
    """C9 with model candidates: pooled fits of each kind on ``train``, scored
    on ``test``; mse per (name, model) and the winner per name."""
    from . import forecast
    feats = [c for c in feature_cols if c not in (*key_cols, "year", "month")]
    grid = test.select(*key_cols, "year", "month", *feats).distinct()  # one row per scored point
    train = forecast.stable(forecast.training_frame(train, name_col, key_cols, feature_cols, label_col))
    grid = forecast.stable(grid)
    scored = []
    for kind in kinds:
        fit = forecast.within_linear_forecast if kind == "linear" else partial(forecast.pooled_forecast, kind=kind)
        p = fit(train, grid, name_col, names, key_cols, feature_cols, label_col, prepared=True)
        scored.append(p.withColumn("model", F.lit(kind)))
    preds = reduce(DataFrame.unionByName, scored)
    lab = test.select(name_col, *key_cols, "year", "month", F.col(label_col).cast("double").alias("label"))
    mse = mse_by_model(preds.join(lab, [name_col, *key_cols, "year", "month"]), [name_col])
    return mse.join(best_model(mse, [name_col]), [name_col])
