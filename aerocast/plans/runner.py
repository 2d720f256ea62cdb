"""Staged batch pipeline: the reference's chain of scripts as one Spark application.

Stages and the tables they publish under ``warehouse`` (each a versioned
keyed table, see ``sources.writers.upsert``):

1. ``weather_monthly``   A2 long form (history for C7, training for C2)
2. ``monthly_features``  C1: pollutant months joined with weather means, from stage 1
3. ``weather_forecast``  C2 on the grid (linear or a tree model)
4. ``grid_with_weather`` C3
5. ``pollutant_forecast`` C4 (long form)
6. ``combined``          C5
7. ``air_quality_index`` C6

The daily tables are scanned once: stage 1 and 2 are written, then every later
stage reads the small monthly tables back, so a failure or an executor loss
after stage 2 never re-scans the daily data.

    python -m aerocast.plans.runner --input /root/testdata/sf0.01 --warehouse <shared folder> --keys state
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as X
from .. import schema as S
from ..operators import align, index, linear, monthly
from ..sources import readers, writers
from . import stages as ST

KEYSETS = {"state": S.KEYS_STATE, "county": S.KEYS_COUNTY}


def _publish(spark: SparkSession, df: DataFrame, warehouse: str, name: str, keys) -> DataFrame:
    """Publish a stage table as a new keyed version; rows are clustered by key
    within each task (no shuffle) so Parquet statistics prune later key filters."""
    path = writers.upsert(spark, df.sortWithinPartitions(*keys), list(keys), f"{warehouse}/{name}")
    return readers.read_table(spark, path)


def run(spark: SparkSession, input_dir: str, warehouse: str, keys=S.KEYS_STATE, model: str = "linear",
        grid_year: int = S.GRID_YEAR) -> dict[str, DataFrame]:
    k = [*keys, "year", "month"]
    out: dict[str, DataFrame] = {}

    wl = _publish(spark, ST.weather_long(spark, input_dir, keys), warehouse, "weather_monthly", ["variable", *k])
    pollutants = monthly.monthly_pollutant(X.pollutant_units(spark, input_dir), keys)
    feats = monthly.join_features(pollutants, monthly.spread_weather(wl, keys), keys)
    out["monthly_features"] = _publish(spark, feats, warehouse, "monthly_features", ["param", *k])
    out["weather_monthly"] = wl
    feats = out["monthly_features"]
    grid = X.grid(spark, input_dir, keys, grid_year)

    if model == "linear":
        wfit = linear.ols2_fit(ST.weather_training(wl, keys), ["variable", *keys])
        wf = linear.ols2_predict(wfit, grid, keys)
    else:
        from ..operators import forecast
        wf = forecast.pooled_forecast(ST.weather_training(wl, keys), grid, "variable", S.WEATHER_VARIABLES,
                                      keys, S.WEATHER_FEATURES, "value", model)
    out["weather_forecast"] = _publish(spark, wf, warehouse, "weather_forecast", ["variable", *k])

    gw = align.combine_long(grid, out["weather_forecast"], k, "variable", "prediction", ST.WEATHER_ARM_COLUMNS)
    out["grid_with_weather"] = _publish(spark, gw, warehouse, "grid_with_weather", k)

    if model == "linear":
        pl = feats.select("param", *keys, "year", "month", F.col("max_value").alias("value"))
        pf = linear.trend_predict(linear.trend_fit(ST.in_training(pl), ["param", *keys]), grid, keys)
    else:
        from ..operators import forecast
        pf = forecast.pooled_forecast(ST.in_training(feats), out["grid_with_weather"], "param", S.POLLUTANTS, keys,
                                      S.POLLUTANT_FEATURES, "max_value", model)
    out["pollutant_forecast"] = _publish(spark, pf, warehouse, "pollutant_forecast", ["param", *k])

    comb = align.combine_long(grid, out["pollutant_forecast"], k, "param", "prediction",
                              ST.POLLUTANT_ARM_COLUMNS)
    out["combined"] = _publish(spark, comb, warehouse, "combined", k)
    out["air_quality_index"] = _publish(spark, index.air_quality_index(out["combined"]), warehouse,
                                        "air_quality_index", k)
    return out


def main(argv=None):
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--input", required=True)
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--keys", choices=sorted(KEYSETS), default="state")
    ap.add_argument("--model", choices=["linear", "gbt", "rf", "dt"], default="linear")
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    from ..session import build_session
    spark = build_session(a.master)
    tables = run(spark, a.input, a.warehouse, KEYSETS[a.keys], a.model)
    for name, df in tables.items():
        print(name, df.count())


if __name__ == "__main__":
    main()
