"""Temp views for users who prefer SQL text.

``register_views`` exposes the daily inputs, the grid and the monthly stage
tables under stable names, so a stage can be written as ``spark.sql(...)``
over the same plans the DataFrame API builds (Catalyst optimizes both alike).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .. import fixtures as X
from .. import schema as S
from ..operators import monthly

VIEWS = ("pollutant_daily", "weather_daily", "grid", "monthly_features", "weather_monthly", "pollutant_monthly")


def register_views(spark: SparkSession, sf_dir: str, keys=S.KEYS_STATE, grid_year: int = S.GRID_YEAR) -> tuple:
    pdaily, wdaily = X.pollutant_daily(spark, sf_dir), X.weather_daily(spark, sf_dir)
    pdaily.createOrReplaceTempView("pollutant_daily")
    wdaily.createOrReplaceTempView("weather_daily")
    X.grid(spark, sf_dir, keys, grid_year).createOrReplaceTempView("grid")
    monthly.monthly_features(pdaily, wdaily, keys).createOrReplaceTempView("monthly_features")
    monthly.monthly_weather_long(wdaily, keys).createOrReplaceTempView("weather_monthly")
    monthly.monthly_pollutant(pdaily, keys).createOrReplaceTempView("pollutant_monthly")
    return VIEWS
