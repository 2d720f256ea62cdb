"""Pipeline stages shared by the registered queries and the end-to-end plan.

Long-form monthly series: ``weather_long`` (variable, keys, year, month,
value) and ``pollutant_long`` (param, keys, year, month, value = mean daily
max value). Training uses every month before the prediction grid's year.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as X
from .. import schema as S
from ..operators import baselines, linear, monthly, topk
from ..sources import writers

STATE = S.KEYS_STATE


def weather_long(spark: SparkSession, sf: str, keys=STATE, first: int | None = None, last: int | None = None) -> DataFrame:
    return monthly.monthly_weather_long(X.weather_units(spark, sf, first, last), keys)


def pollutant_long(spark: SparkSession, sf: str, keys=STATE, first: int | None = None, last: int | None = None) -> DataFrame:
    m = monthly.monthly_pollutant(X.pollutant_units(spark, sf, first, last), keys, measures=["max_value"])
    return m.select("param", *keys, "year", "month", F.col("max_value").alias("value"))


def in_training(df: DataFrame, first: int | None = None, last: int = S.TRAIN_LAST_YEAR) -> DataFrame:
    """Rows up to ``last``, the year before the grid's; ``first`` adds a recency bound (P10)."""
    df = df.where(F.col("year") <= F.lit(last))
    return df if first is None else df.where(F.col("year") >= F.lit(first))


def weather_training(wl: DataFrame, keys=STATE, truncate_label: bool = False, months: int | None = None) -> DataFrame:
    """Training rows of the weather models: every month before the grid's year.

    ``months`` keeps the first so many months of each series, as the source does (O2).

    ``truncate_label`` reproduces the source's cast of the label to int (D3).
    """
    t = in_training(wl)
    if months is not None:
        t = topk.first_n_per_group(t, ["variable", *keys], ["year", "month"], months)
    if truncate_label:
        t = t.withColumn("value", F.col("value").cast("int").cast("double"))
    return t


def weather_linear_forecast(spark: SparkSession, sf: str, keys=STATE, wl: DataFrame | None = None,
                            truncate_label: bool = False) -> DataFrame:
    """C2, linear form: value ~ month + year per (variable, key), scored on the grid."""
    wl = wl if wl is not None else weather_long(spark, sf, keys, last=S.TRAIN_LAST_YEAR)
    fit = linear.ols2_fit(weather_training(wl, keys, truncate_label), ["variable", *keys])
    return linear.ols2_predict(fit, X.grid(spark, sf, keys), keys)


def pollutant_linear_forecast(spark: SparkSession, sf: str, keys=STATE, pl: DataFrame | None = None) -> DataFrame:
    """C4, linear form: trend of the monthly mean max value per (param, key)."""
    pl = pl if pl is not None else pollutant_long(spark, sf, keys, last=S.TRAIN_LAST_YEAR)
    fit = linear.trend_fit(in_training(pl), ["param", *keys])
    return linear.trend_predict(fit, X.grid(spark, sf, keys), keys)


def weather_naive_arms(spark: SparkSession, sf: str, keys=STATE) -> DataFrame:
    """Seasonal-naive weather forecasts for every year after an observed one (long form)."""
    return baselines.seasonal_naive(weather_long(spark, sf, keys), ["variable"], keys)


def pollutant_naive_arms(spark: SparkSession, sf: str, keys=STATE) -> DataFrame:
    return baselines.seasonal_naive(pollutant_long(spark, sf, keys), ["param"], keys)


@dataclass(frozen=True)
class FeatureForecasts:
    """C1-C4 with a model of its own for every group: each fact table is read once."""

    weather: DataFrame  # long training series
    features: DataFrame  # pollutant training rows
    weather_forecast: DataFrame
    grid: DataFrame  # with the forecast weather
    pollutant_forecast: DataFrame


def feature_forecasts(spark: SparkSession, sf: str, keys=STATE, trees: int = 0, depth: int = 5) -> FeatureForecasts:
    """Weather of each (variable, region) by month and year, C3, pollutants of each (param, region) by the six features (M2-M5).

    Least squares, or with ``trees`` that many (boosted) regression trees of ``depth`` a group.
    """
    from ..operators import align, ols
    from ..operators import trees as T

    def ahead(train, score, name, features, label):
        by = [name, *keys]
        if trees:
            return T.fit_and_forecast(train, score, by, keys, features, label, trees, depth)
        return ols.forecast(ols.fit(train, by, features, label), score, by, keys, features)

    wl = writers.stage(weather_long(spark, sf, keys, last=S.TRAIN_LAST_YEAR), "weather-monthly")
    grid = X.grid(spark, sf, keys)
    weather = writers.stage(ahead(in_training(wl), grid, "variable", S.WEATHER_FEATURES, "value"), "weather-forecast")
    gw = writers.stage(align.combine_long(grid, weather, [*keys, "year", "month"], "variable", "prediction", WEATHER_ARM_COLUMNS), "grid-with-weather")
    pollutants = monthly.monthly_pollutant(X.pollutant_units(spark, sf, last=S.TRAIN_LAST_YEAR), keys, measures=["max_value"])
    features = writers.stage(in_training(monthly.join_features(pollutants, monthly.spread_weather(wl, keys), keys)), "features")
    return FeatureForecasts(wl, features, weather, gw, ahead(features, gw, "param", S.POLLUTANT_FEATURES, "max_value"))


WEATHER_ARM_COLUMNS = dict(S.WEATHER_COLUMNS)
POLLUTANT_ARM_COLUMNS = {p: S.forecast_column(p) for p in S.POLLUTANTS}


# -- model forms (pyspark.ml) ---------------------------------------------------------

@dataclass(frozen=True)
class ModelForecasts:
    """The tables of C1-C4 with model forecasts: each fact table is read once."""

    weather: DataFrame  # long training series
    features: DataFrame  # pollutant training rows
    weather_forecast: DataFrame
    grid: DataFrame  # with the forecast weather
    pollutant_forecast: DataFrame


def model_forecasts(spark: SparkSession, sf: str, keys=STATE, kind: str = "gbt") -> ModelForecasts:
    """C1-C4 (M1-M5): monthly tables, weather models, grid with weather, pollutant models on the six features.

    ``kind``: a tree model of ``forecast.ESTIMATORS``, or ``linear`` (least squares, an intercept for each key).
    """
    from ..operators import align, forecast

    def fit(train, score, name_col, names, feature_cols):
        if kind == "linear":
            return forecast.within_linear_forecast(train, score, name_col, names, keys, feature_cols, prepared=True)
        return forecast.pooled_forecast(train, score, name_col, names, keys, feature_cols, kind=kind, prepared=True)

    def stored_training(df, name_col, feature_cols, label):
        return forecast.stable(forecast.training_frame(df, name_col, keys, feature_cols, label))

    wl = writers.stage(weather_long(spark, sf, keys, last=S.TRAIN_LAST_YEAR), "weather-monthly")
    grid = writers.stage(X.grid(spark, sf, keys), "grid")
    pollutants = monthly.monthly_pollutant(X.pollutant_units(spark, sf, last=S.TRAIN_LAST_YEAR), keys)
    with ThreadPoolExecutor(max_workers=1) as pool:  # the one does not depend on the other
        features = pool.submit(stored_training, monthly.join_features(pollutants, monthly.spread_weather(wl, keys), keys),
                               "param", S.POLLUTANT_FEATURES, "max_value")
        weather = fit(stored_training(weather_training(wl, keys), "variable", S.WEATHER_FEATURES, "value"),
                      grid, "variable", S.WEATHER_VARIABLES, S.WEATHER_FEATURES)
        features = features.result()
    weather = writers.stage(weather, "weather-forecast")
    gw = writers.stage(align.combine_long(grid, weather, [*keys, "year", "month"], "variable", "prediction",
                                          WEATHER_ARM_COLUMNS), "grid-with-weather")
    return ModelForecasts(wl, features, weather, gw, fit(features, gw, "param", S.POLLUTANTS, S.POLLUTANT_FEATURES))


def model_chain(spark: SparkSession, sf: str, keys=STATE, kind: str = "gbt") -> DataFrame:
    """C1-C6 with model forecasts: weather -> grid with weather -> pollutants -> combine -> index."""
    from ..operators import align, index
    k = [*keys, "year", "month"]
    m = model_forecasts(spark, sf, keys, kind)
    comb = align.combine_long(m.grid.select(*k), m.pollutant_forecast, k, "param", "prediction", POLLUTANT_ARM_COLUMNS)
    return m.grid.join(index.air_quality_index(comb), k)
