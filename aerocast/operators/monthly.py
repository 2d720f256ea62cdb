"""Monthly feature tables (C1): daily readings averaged to (key, year, month).

All six pollutants are averaged in one pass (``param`` stays a column), and the
four weather series in one pass with conditional aggregation -- one shuffle
each, with map-side partial aggregation, so a hot key is combined before the
exchange. The join of the two monthly tables is between aggregates whose size
is bounded by keys × months (× params), never by the number of daily rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.stats import exact_mean, units_scale


def with_year_month(df: DataFrame, date_col: str = "date_local", drop: bool = True) -> DataFrame:
    """calendar year and month of a date column, as ints."""
    out = df.withColumn("year", F.year(date_col)).withColumn("month", F.month(date_col))
    return out.drop(date_col) if drop else out


def monthly_pollutant(daily: DataFrame, keys=("state_code",), measures=S.MEASURES,
                      exact: bool = True) -> DataFrame:
    """A1: unweighted mean of each measure per (param, keys, year, month).

    ``max_value`` stays the *mean* of daily first maxima, as in the source.
    """
    return (with_year_month(daily.select("param", *keys, "date_local", *measures))
            .groupBy("param", *keys, "year", "month")
            .agg(*[exact_mean(m, exact, units_scale(daily, m)).alias(m) for m in measures]))


def monthly_weather_long(daily: DataFrame, keys=("state_code",), variable_filter=None,
                         exact: bool = True) -> DataFrame:
    """A2 in long form: mean per (variable, keys, year, month) as ``value``.

    ``variable_filter`` (D10) optionally restricts the rows averaged; by default
    every row of a series counts, as in the source.
    """
    d = daily if variable_filter is None else daily.where(variable_filter)
    return (with_year_month(d.select("variable", *keys, "date_local", "arithmetic_mean"))
            .groupBy("variable", *keys, "year", "month")
            .agg(exact_mean("arithmetic_mean", exact, units_scale(daily, "arithmetic_mean")).alias("value")))


def monthly_weather(daily: DataFrame, keys=("state_code",), exact: bool = True) -> DataFrame:
    """A2 + pivot: one row per (keys, year, month), columns am_wind, am_temp, am_rh, am_press.

    Conditional aggregation instead of ``pivot``: one aggregation (one shuffle),
    where pivot plans a second aggregate over the pivoted groups.
    """
    v, scale = F.col("variable"), units_scale(daily, "arithmetic_mean")
    aggs = [exact_mean(F.when(v == F.lit(name), F.col("arithmetic_mean")), exact, scale).alias(S.WEATHER_COLUMNS[name])
            for name in S.WEATHER_VARIABLES]
    return (with_year_month(daily.select("variable", *keys, "date_local", "arithmetic_mean"))
            .groupBy(*keys, "year", "month").agg(*aggs))


def spread_weather(long: DataFrame, keys=("state_code",)) -> DataFrame:
    """The table of ``monthly_weather`` from that of ``monthly_weather_long`` (one row a series and month)."""
    aggs = [F.max(F.when(F.col("variable") == F.lit(n), F.col("value"))).alias(S.WEATHER_COLUMNS[n])
            for n in S.WEATHER_VARIABLES]
    return long.groupBy(*keys, "year", "month").agg(*aggs)


def join_features(pollutant_months: DataFrame, weather_months: DataFrame, keys=("state_code",)) -> DataFrame:
    """Pollutant months with their four weather means; months lacking one are dropped."""
    return pollutant_months.join(weather_months.dropna(subset=list(S.WEATHER_COLUMNS.values())),
                                 [*keys, "year", "month"], "inner")


def monthly_features(pollutant_daily: DataFrame, weather_daily: DataFrame,
                     keys=("state_code",), state: int | None = None, exact: bool = True) -> DataFrame:
    """Pollutant months joined with the four weather means.

    Months lacking any of the four weather series are dropped (inner join).
    ``state`` restricts both inputs to one state before anything else (P3), the
    county-level variant's filter; the comparison is on a typed int column and
    reaches the scan.
    """
    if state is not None:
        pollutant_daily = pollutant_daily.where(F.col("state_code") == F.lit(state))
        weather_daily = weather_daily.where(F.col("state_code") == F.lit(state))
    return join_features(monthly_pollutant(pollutant_daily, keys, exact=exact),
                         monthly_weather(weather_daily, keys, exact=exact), keys)


def sort_for_output(df: DataFrame, keys=("state_code",)) -> DataFrame:
    """O1: the reference's (key, year, month) order, applied once at the sink."""
    cols = [c for c in ("param", "variable") if c in df.columns]
    return df.orderBy(*cols, *keys, "year", "month")
