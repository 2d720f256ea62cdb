"""Air-quality index of combined forecasts (C6): F4 per pollutant, F5, A6.

Wide form: one projection adds ``aqi_<code>`` for every pollutant column and
``global_aqi`` (row-wise maximum, nulls skipped). Long form: per key, the
maximum sub-index and the pollutant that reaches it (ties go to the smallest
code), as one aggregation with partial aggregation -- no window, no sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.aqi import subindex_long, wide_subindices


def air_quality_index(combined: DataFrame, params=None, keep_inputs: bool = True) -> DataFrame:
    """``combined`` carries ``max_value_pred_<code>`` columns (C5's output)."""
    return wide_subindices(combined, params or S.POLLUTANTS, S.forecast_column, keep_inputs)


def long_subindex(long: DataFrame, param_col: str = "param", value_col: str = "value") -> DataFrame:
    return subindex_long(long, value_col, param_col, "aqi")


def dominant_pollutant(long: DataFrame, keys, param_col: str = "param", value_col: str = "value") -> DataFrame:
    """Per key: ``global_aqi`` = max sub-index, ``dominant_param`` = its pollutant."""
    scored = long_subindex(long, param_col, value_col).where(F.col("aqi").isNotNull())
    order = F.struct((-F.col("aqi")).alias("neg_aqi"), F.col(param_col).alias("p"))
    return scored.groupBy(*keys).agg(F.max("aqi").alias("global_aqi"),
                                     F.min_by(F.col(param_col), order).alias("dominant_param"))
