"""Reference forecasts that need no fitting: used as model candidates (M6) and as
stand-in forecast arms whose values the SQL oracle can reproduce.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def seasonal_naive(monthly_long: DataFrame, name_cols, key_cols, value_col: str = "value",
                   pred_col: str = "prediction", lag_years: int = 1) -> DataFrame:
    """Forecast for (year + lag, month) = observed mean of (year, month)."""
    return monthly_long.select(*name_cols, *key_cols, (F.col("year") + F.lit(lag_years)).alias("year"),
                               "month", F.col(value_col).cast("double").alias(pred_col))


def group_mean(train: DataFrame, group_cols, value_col: str = "value", out: str = "mean") -> DataFrame:
    """Mean of the training values per group (the constant model)."""
    return train.groupBy(*group_cols).agg(F.avg(F.col(value_col).cast("double")).alias(out))
