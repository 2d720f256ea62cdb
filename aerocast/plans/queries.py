"""Registered queries: one Spark plan per operator of the inventory, each with
the equivalent DuckDB SQL (``None`` where only a rows check applies).

Numeric conventions shared by both sides: daily measures are exact decimals
and monthly means come from exact sums, so they agree bit for bit without
rounding; row-level arithmetic runs in the same operation order on both
sides. Statistics fitted on monthly means (regressions, errors) are rounded
to 6 places, or to 9 significant digits where values are large (weather
~1e5) or span magnitudes (mse). ``year``/``month`` are INTEGER; dates leave
as ``YYYY-MM-DD``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixtures as X
from .. import schema as S
from ..functions import aqi
from ..functions.stats import round_sig, sql_exact_mean, sql_round_sig
from ..operators import align, evaluate, index, monthly, topk
from ..operators.linear import sql_trend, sql_trend_value
from ..session import scratch_path
from ..sources import incremental, readers, tables, writers
from . import oracle as Q
from . import stages as ST

AGG_PLACES = 6

STATE = ("state_code",)
COUNTY = ("state_code", "county_code")


@dataclass(frozen=True)
class Registered:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doc: str = ""


REGISTRY: dict[str, Registered] = {}


def register(name: str, sql: str | None, doc: str = ""):
    def deco(fn):
        REGISTRY[name] = Registered(fn, sql, doc)
        return fn
    return deco


def rounded(df: DataFrame, places: int = AGG_PLACES, cols=None) -> DataFrame:
    """Round every double column (or ``cols``) to ``places``."""
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    todo = doubles if cols is None else set(cols)
    return df.select(*[F.round(F.col(c), places).alias(c) if c in todo else F.col(c) for c in df.columns])


SIG = 9  # significant digits kept for fitted values of large magnitude (weather ~1e5)


def sig(df: DataFrame, cols) -> DataFrame:
    return df.select(*[round_sig(F.col(c), SIG).alias(c) if c in cols else F.col(c) for c in df.columns])


def sql_sig(expr: str) -> str:
    return sql_round_sig(expr, SIG)


# -- C1 pieces ---------------------------------------------------------------

@register("monthly_pollutant", Q.with_ctes(Q.pollutant_daily(), Q.monthly_pollutant()) + f"""
SELECT param, state_code, year, month, {", ".join(S.MEASURES)} FROM monthly_pollutant""",
          "P1, F1, A1: monthly means of the five pollutant measures, all six pollutants in one pass")
def q_monthly_pollutant(spark, sf):
    return monthly.monthly_pollutant(X.pollutant_units(spark, sf), STATE)


_W = list(S.WEATHER_COLUMNS.values())


@register("monthly_weather_pivot", Q.with_ctes(Q.weather_daily(), Q.monthly_weather()) + f"""
SELECT state_code, year, month, {", ".join(_W)} FROM monthly_weather""",
          "P2, A2: four weather series averaged and spread to am_* columns in one aggregation")
def q_monthly_weather_pivot(spark, sf):
    return monthly.monthly_weather(X.weather_units(spark, sf), STATE)


@register("monthly_features_state",
          Q.with_ctes(Q.pollutant_daily(), Q.weather_daily(), Q.monthly_pollutant(), Q.monthly_weather(),
                      Q.monthly_features()) + f"""
SELECT param, state_code, year, month, {", ".join(S.MEASURES + _W)} FROM monthly_features""",
          "C1 (J1, O1): monthly pollutant means joined with the four weather means, state key")
def q_monthly_features_state(spark, sf):
    return monthly.monthly_features(X.pollutant_units(spark, sf), X.weather_units(spark, sf), STATE)


@register("monthly_features_county",
          Q.with_ctes(Q.pollutant_daily(), Q.weather_daily(), Q.monthly_pollutant(COUNTY),
                      Q.monthly_weather(COUNTY), Q.monthly_features(COUNTY)) + f"""
SELECT param, state_code, county_code, year, month, {", ".join(S.MEASURES + _W)} FROM monthly_features""",
          "C1 county variant: (state, county) key over every state")
def q_monthly_features_county(spark, sf):
    return monthly.monthly_features(X.pollutant_units(spark, sf), X.weather_units(spark, sf), COUNTY)


@register("region_list", Q.with_ctes(Q.pollutant_daily()) + """
SELECT DISTINCT state_code FROM pollutant_daily""",
          "A3: distinct region codes (kept distributed, no collect)")
def q_region_list(spark, sf):
    return X.pollutant_daily(spark, sf).select("state_code").distinct()


@register("prediction_grid", Q.with_ctes(Q.grid()) + """
SELECT state_code, month, year FROM grid""",
          "S3: prediction grid, every state × 12 months of the grid year")
def q_prediction_grid(spark, sf):
    return X.grid(spark, sf, STATE)


# -- F4: sub-index at row level -------------------------------------------------

@register("aqi_subindex", Q.with_ctes(Q.pollutant_daily()) + f"""
SELECT param, state_code, county_code, CAST(date_local AS VARCHAR) AS date_local,
       CAST(max_value AS DOUBLE) AS max_value,
       {Q.sql_subindex_by_param("CAST(max_value AS DOUBLE)", "param")} AS aqi
FROM pollutant_daily""",
          "F4: breakpoint sub-index of every daily max value (all bands, saturation)")
def q_aqi_subindex(spark, sf):
    d = X.pollutant_daily(spark, sf).select(
        "param", "state_code", "county_code", F.col("date_local").cast("string").alias("date_local"),
        F.col("max_value").cast("double").alias("max_value"))
    return aqi.subindex_long(d, "max_value")


@register("aqi_monthly", Q.with_ctes(Q.pollutant_daily(), Q.monthly_pollutant()) + f"""
SELECT param, state_code, year, month, max_value,
       {Q.sql_subindex_by_param("max_value", "param")} AS aqi
FROM monthly_pollutant""",
          "F4 on monthly mean max values (flagship)")
def q_aqi_monthly(spark, sf):
    m = monthly.monthly_pollutant(X.pollutant_units(spark, sf), STATE, measures=["max_value"])
    return aqi.subindex_long(m, "max_value")


# -- stages: top-k, linear forecasts, grid alignment ---------------------------------


_WL = Q.with_ctes(Q.weather_daily(), Q.monthly_weather_long())
_PL = [Q.pollutant_daily(), Q.monthly_pollutant(), Q.pollutant_long()]
_WF = [Q.weather_daily(), Q.monthly_weather_long(), Q.grid(), Q.weather_train(), Q.weather_forecast()]
_PF = [*_PL, Q.grid(), Q.pollutant_forecast()]


@register("first_60_months", _WL + f"""
SELECT variable, state_code, year, month, value FROM (
  SELECT *, row_number() OVER (PARTITION BY variable, state_code ORDER BY year, month) AS rn
  FROM weather_long) WHERE rn <= {S.WEATHER_TRAINING_MONTHS}""",
          "O2: first 60 months per (variable, state) in (year, month) order")
def q_first_60_months(spark, sf):
    return topk.first_n_per_group(ST.weather_long(spark, sf), ["variable", "state_code"],
                                  ["year", "month"], S.WEATHER_TRAINING_MONTHS)


@register("forecast_linear_weather", Q.with_ctes(*_WF) + f"""
SELECT variable, state_code, year, month, {sql_sig("prediction")} AS prediction FROM weather_forecast""",
          "C2 linear form (M1 features month, year): one closed-form fit per (variable, state)")
def q_forecast_linear_weather(spark, sf):
    return sig(ST.weather_linear_forecast(spark, sf), ["prediction"])


@register("forecast_linear_pollutant", Q.with_ctes(*_PF) + f"""
SELECT param, state_code, year, month, {sql_sig("prediction")} AS prediction FROM pollutant_forecast""",
          "C4 linear form: trend of monthly mean max value per (param, state)")
def q_forecast_linear_pollutant(spark, sf):
    return sig(ST.pollutant_linear_forecast(spark, sf), ["prediction"])


_WA = [Q.weather_daily(), Q.monthly_weather_long(), Q.grid(), Q.naive("weather_long", "variable", "warms")]
_PA = [*_PL, Q.grid(), Q.naive("pollutant_long", "param", "parms")]


def _nullable_keys(df, keys=("state_code", "year", "month")):
    """Reference mode yields null keys; as DOUBLE they convert alike from both engines."""
    return df.select(*[F.col(c).cast("double").alias(c) if c in keys else F.col(c) for c in df.columns])


def _sql_nullable_keys(sql, keys=("state_code", "year", "month")):
    ks = ", ".join(f"CAST({k} AS DOUBLE) AS {k}" for k in keys)
    return f"SELECT * REPLACE ({ks}) FROM ({sql})"


def _grid_with_weather(spark, sf, mode):
    arms = ST.weather_naive_arms(spark, sf)
    arms = writers.stage(arms, "weather-arms") if mode == "reference" else arms
    return align.combine_long(X.grid(spark, sf), arms, ["state_code", "year", "month"],
                              "variable", "prediction", ST.WEATHER_ARM_COLUMNS, mode)


def _combine(spark, sf, mode):
    arms = ST.pollutant_naive_arms(spark, sf)
    arms = writers.stage(arms, "pollutant-arms") if mode == "reference" else arms
    return align.combine_long(X.grid(spark, sf), arms, ["state_code", "year", "month"],
                              "param", "prediction", ST.POLLUTANT_ARM_COLUMNS, mode)


@register("grid_with_weather", Q.with_ctes(*_WA) + Q.chain("grid", "warms", "variable", "prediction",
                                                             ST.WEATHER_ARM_COLUMNS, "merge"),
          "C3 (J2, P8, F3), merge mode: grid + four weather forecast arms, keys coalesced, gaps 0")
def q_grid_with_weather(spark, sf):
    return _grid_with_weather(spark, sf, "merge")


@register("grid_with_weather_reference", Q.with_ctes(*_WA) + _sql_nullable_keys(
    Q.chain("grid", "warms", "variable", "prediction", ST.WEATHER_ARM_COLUMNS, "reference")),
          "C3, reference mode (D1): grid keys only, unmatched arm rows keep null keys")
def q_grid_with_weather_reference(spark, sf):
    return _nullable_keys(_grid_with_weather(spark, sf, "reference"))


@register("combine_forecasts", Q.with_ctes(*_PA) + Q.chain("grid", "parms", "param", "prediction",
                                                             ST.POLLUTANT_ARM_COLUMNS, "merge"),
          "C5 (J3, P8), merge mode: grid + six pollutant forecast arms")
def q_combine_forecasts(spark, sf):
    return _combine(spark, sf, "merge")


@register("combine_forecasts_reference", Q.with_ctes(*_PA) + _sql_nullable_keys(
    Q.chain("grid", "parms", "param", "prediction", ST.POLLUTANT_ARM_COLUMNS, "reference")),
          "C5, reference mode (D1)")
def q_combine_forecasts_reference(spark, sf):
    return _nullable_keys(_combine(spark, sf, "reference"))


_AQI_COLS = ", ".join(
    [f"{S.forecast_column(p)}" for p in S.POLLUTANTS]
    + [f"{Q.sql_subindex(S.forecast_column(p), p)} AS {S.aqi_column(p)}" for p in S.POLLUTANTS])
_GLOBAL = "greatest(" + ", ".join(S.aqi_column(p) for p in S.POLLUTANTS) + ")"


@register("aqi_global", Q.with_ctes(*_PA) + f"""
SELECT *, {_GLOBAL} AS global_aqi FROM (
  SELECT state_code, year, month, {_AQI_COLS}
  FROM ({Q.chain("grid", "parms", "param", "prediction", ST.POLLUTANT_ARM_COLUMNS, "merge")}))""",
          "C6 (F4, F5, A6): six sub-indices of the combined forecasts and their maximum")
def q_aqi_global(spark, sf):
    return index.air_quality_index(_combine(spark, sf, "merge"))


@register("aqi_dominant", Q.with_ctes(*_PL) + f"""
SELECT state_code, year, month, aqi AS global_aqi, param AS dominant_param FROM (
  SELECT *, row_number() OVER (PARTITION BY state_code, year, month ORDER BY aqi DESC, param) AS rn
  FROM (SELECT param, state_code, year, month, {Q.sql_subindex_by_param("value", "param")} AS aqi
        FROM pollutant_long) WHERE aqi IS NOT NULL) WHERE rn = 1""",
          "A6 long form: per state-month the maximum sub-index and its pollutant (ties: smallest code)")
def q_aqi_dominant(spark, sf):
    return index.dominant_pollutant(ST.pollutant_long(spark, sf), ["state_code", "year", "month"])


# -- evaluation, history, recency, end to end ------------------------------------


TEST_YEAR = S.TRAIN_LAST_YEAR


def _sql_candidates(src: str, name_col: str) -> str:
    g = f"{name_col}, state_code"
    return f"""
ev_train AS (SELECT * FROM {src} WHERE year < {TEST_YEAR}),
ev_test AS (SELECT {g}, year, month, CAST(value AS DOUBLE) AS label FROM {src} WHERE year = {TEST_YEAR}),
ev_fit AS ({sql_trend("ev_train", [name_col, "state_code"])}),
ev_preds AS (
  SELECT t.{name_col}, t.state_code, t.year, t.month, {sql_trend_value(fit="f", grid="t")} AS prediction,
         'linear' AS model
  FROM ev_test t JOIN ev_fit f ON t.{name_col} = f.{name_col} AND t.state_code = f.state_code
  UNION ALL
  SELECT t.{name_col}, t.state_code, t.year, t.month, m.mean AS prediction, 'mean' AS model
  FROM ev_test t JOIN (SELECT {g}, avg(CAST(value AS DOUBLE)) AS mean FROM ev_train GROUP BY {g}) m
    ON t.{name_col} = m.{name_col} AND t.state_code = m.state_code
  UNION ALL
  SELECT {g}, year + 1 AS year, month, CAST(value AS DOUBLE) AS prediction, 'seasonal_naive' AS model
  FROM ev_train WHERE year = {TEST_YEAR - 1}
),
ev_scored AS (SELECT t.*, p.prediction, p.model FROM ev_test t JOIN ev_preds p USING ({g}, year, month)),
ev_mse AS (
  SELECT {g}, model, avg((prediction - label) * (prediction - label)) AS mse, count(*) AS n_test
  FROM ev_scored GROUP BY {g}, model
)"""


def _mse(spark, sf, long_df, name_col):
    long_df = writers.stage(long_df, f"{name_col}-monthly")
    scored = evaluate.candidate_predictions(long_df, [name_col], ["state_code"], TEST_YEAR)
    return evaluate.mse_by_model(scored, [name_col, "state_code"])


@register("holdout_mse", _WL.rstrip("\n") + "," + _sql_candidates("weather_long", "variable") + f"""
SELECT variable, state_code, model, {sql_round_sig("mse")} AS mse, n_test FROM ev_mse""",
          "M7, A5: train 1996-1999, score 2000; mse of linear / mean / seasonal-naive per (variable, state)")
def q_holdout_mse(spark, sf):
    m = _mse(spark, sf, ST.weather_long(spark, sf, last=TEST_YEAR), "variable")
    return m.withColumn("mse", round_sig("mse"))


@register("best_model", Q.with_ctes(*_PL).rstrip("\n") + "," + _sql_candidates("pollutant_long", "param") + f"""
SELECT param, state_code, model AS best_model, {sql_round_sig("mse")} AS best_mse FROM (
  SELECT *, row_number() OVER (PARTITION BY param, state_code ORDER BY mse, model) AS rn FROM ev_mse
) WHERE rn = 1""",
          "M6 / C9: the candidate with the smallest holdout mse per (param, state), ties by name")
def q_best_model(spark, sf):
    b = evaluate.best_model(_mse(spark, sf, ST.pollutant_long(spark, sf, last=TEST_YEAR), "param"), ["param", "state_code"])
    return b.withColumn("best_mse", round_sig("best_mse"))


_FE_SQL = Q.with_ctes(*_WF) + f"""
SELECT variable, month, state_code, observed, year_x, year_y,
       {sql_sig("predicted")} AS predicted, {sql_sig("predicted - observed")} AS diff
FROM (SELECT variable, month, state_code, {sql_exact_mean("arithmetic_mean")} AS observed,
             avg(CAST(year AS DOUBLE)) AS year_x
      FROM (SELECT *, {Q.ym()} FROM weather_daily) WHERE year = {S.GRID_YEAR}
      GROUP BY variable, month, state_code) o
JOIN (SELECT variable, state_code, month, year AS year_y, prediction AS predicted FROM weather_forecast) f
USING (variable, month, state_code)"""


@register("forecast_error", _FE_SQL,
          "C8 (A4, J4, F6): grid-year observations against the weather forecasts, joined without the year")
def q_forecast_error(spark, sf):
    wl = writers.stage(ST.weather_long(spark, sf, last=S.GRID_YEAR), "weather-monthly")
    out = evaluate.error_report(_observed(wl.where(F.col("year") == F.lit(S.GRID_YEAR))),
                                ST.weather_linear_forecast(spark, sf, wl=wl), ["state_code"], ["variable"])
    return sig(out, ["predicted", "diff"])


def _observed(wl: DataFrame) -> DataFrame:
    """Monthly series as observations; a month's mean of its daily readings is the mean that A4 takes."""
    return wl.select("variable", "month", "state_code", F.col("value").alias("observed"),
                     F.col("year").cast("double").alias("year_x"))


@register("forecast_error_by_year", Q.with_ctes(*_WF) + f"""
SELECT o.variable, o.month, o.state_code, o.value AS observed, CAST(o.year AS DOUBLE) AS year_x, f.year AS year_y,
       {sql_sig("f.prediction")} AS predicted, {sql_sig("f.prediction - o.value")} AS diff
FROM weather_long o JOIN weather_forecast f USING (variable, month, state_code, year)""",
          "C8 with the year matched (J4, D17): observations of every year against the forecasts of theirs")
def q_forecast_error_by_year(spark, sf):
    wl = writers.stage(ST.weather_long(spark, sf), "weather-monthly")
    out = evaluate.error_report(_observed(wl), ST.weather_linear_forecast(spark, sf, wl=wl), ["state_code"],
                                ["variable"], match_year=True)
    return sig(out, ["predicted", "diff"])


@register("history_and_forecast", Q.with_ctes(*_WF) + f"""
SELECT variable, state_code, year, month, value, 'history' AS kind FROM weather_long
UNION ALL
SELECT variable, state_code, year, month, {sql_sig("prediction")} AS value, 'forecast' AS kind FROM weather_forecast""",
          "C7 (U3): observed monthly series and forecasts in one table, union by name")
def q_history_and_forecast(spark, sf):
    wl = writers.stage(ST.weather_long(spark, sf), "weather-monthly")
    fc = sig(ST.weather_linear_forecast(spark, sf, wl=wl), ["prediction"]).withColumnRenamed("prediction", "value")
    return align.history_and_forecast(wl, fc)


RECENT_FROM = 1998


@register("recent_training",
          Q.with_ctes(Q.pollutant_daily(), Q.weather_daily(), Q.monthly_pollutant(), Q.monthly_weather(),
                      Q.monthly_features()) + f"""
SELECT param, state_code, year, month, {", ".join(S.MEASURES + _W)} FROM monthly_features
WHERE year >= {RECENT_FROM} AND year <= {S.TRAIN_LAST_YEAR}""",
          "P10: pollutant training rows restricted to recent years (year >= min_year)")
def q_recent_training(spark, sf):
    years = (RECENT_FROM, S.TRAIN_LAST_YEAR)
    f = monthly.monthly_features(X.pollutant_units(spark, sf, *years), X.weather_units(spark, sf, *years), STATE)
    return ST.in_training(f, RECENT_FROM)


def end_to_end(spark, sf, keys=STATE):
    """C1-C6 with least squares per region: monthly features -> weather forecasts -> grid with weather (C3) ->
    pollutant forecasts on the six features -> combined forecasts (C5) -> index (C6)."""
    k = [*keys, "year", "month"]
    m = ST.feature_forecasts(spark, sf, keys)
    comb = align.combine_long(m.grid.select(*k), m.pollutant_forecast, k, "param", "prediction", ST.POLLUTANT_ARM_COLUMNS)
    return m.grid.join(index.air_quality_index(comb), k)


_PRED = [S.forecast_column(p) for p in S.POLLUTANTS]


def _e2e_rounded(out: DataFrame) -> DataFrame:
    """Fitted values to 9 significant digits, indices to 6 places (as the SQL)."""
    return sig(rounded(out, cols=[c for c in out.columns if c not in _W + _PRED]), _W + _PRED)


def _index_select(keys=STATE) -> str:
    """The index of the trend forecasts with the weather forecasts (least squares by month and year)."""
    return _e2e_select(keys, Q.chain("grid", "weather_forecast", "variable", "prediction", ST.WEATHER_ARM_COLUMNS, "merge", (*keys, "year", "month")),
                       "pollutant_forecast")


def _e2e_select(keys=STATE, weather="SELECT * FROM grid_weather", forecasts="features_forecast") -> str:
    kc = (*keys, "year", "month")
    return f"""
SELECT * FROM (
  SELECT {", ".join(kc)}, {", ".join(f"{sql_sig(c)} AS {c}" for c in _W)},
         {", ".join(f"{sql_sig(S.forecast_column(p))} AS {S.forecast_column(p)}" for p in S.POLLUTANTS)},
         {", ".join(f"round({Q.sql_subindex(S.forecast_column(p), p)}, 6) AS {S.aqi_column(p)}"
                    for p in S.POLLUTANTS)},
         round(greatest({", ".join(Q.sql_subindex(S.forecast_column(p), p) for p in S.POLLUTANTS)}), 6)
           AS global_aqi
  FROM ({weather}) gw
  JOIN ({Q.chain("grid", forecasts, "param", "prediction", ST.POLLUTANT_ARM_COLUMNS, "merge", kc)}) pc
  USING ({", ".join(kc)}))"""


def _feature_ctes(keys=STATE) -> list[str]:
    return [Q.pollutant_daily(), Q.weather_daily(), Q.monthly_pollutant(keys), Q.monthly_weather(keys), Q.monthly_weather_long(keys),
            Q.monthly_features(keys), Q.grid(keys), *Q.feature_chain(keys)]


@register("end_to_end_linear", Q.with_ctes(*_feature_ctes()) + _e2e_select(),
          "C1-C6 end to end (M2, M5): features, least squares per region on all features, grid alignment, combination, index")
def q_end_to_end_linear(spark, sf):
    return _e2e_rounded(end_to_end(spark, sf))


def _forecast_features(spark, sf, keys=STATE, **model):
    m = ST.feature_forecasts(spark, sf, keys, **model)
    names = m.weather_forecast.withColumnRenamed("variable", "name").unionByName(m.pollutant_forecast.withColumnRenamed("param", "name"))
    return sig(names, ["prediction"])


def _sql_forecast_features(keys=STATE) -> str:
    k = ", ".join(keys)
    return Q.with_ctes(*_feature_ctes(keys)) + f"""
SELECT name, {k}, year, month, {sql_sig("prediction")} AS prediction FROM (
  SELECT variable AS name, {k}, year, month, prediction FROM wols_forecast
  UNION ALL SELECT param, {k}, year, month, prediction FROM features_forecast)"""


@register("forecast_features_linear", _sql_forecast_features(),
          "C2, C4 (M1, M2, M4, M5): one least-squares fit for every (variable, state) on month and year and every "
          "(param, state) on the six features")
def q_forecast_features_linear(spark, sf):
    return _forecast_features(spark, sf)


@register("forecast_tree_regions", Q.with_ctes(
    *_feature_ctes()[:7],
    *Q.tree("wtree", Q.in_training("weather_long"), "grid", ["variable", "state_code"], STATE, S.WEATHER_FEATURES, "value", 2),
    f"""
grid_weather AS ({Q.chain("grid", "wtree", "variable", "prediction", S.WEATHER_COLUMNS, "merge")})""",
    *Q.tree("ptree", Q.in_training("monthly_features"), "grid_weather", ["param", "state_code"], STATE, S.POLLUTANT_FEATURES, "max_value", 2)) + f"""
SELECT name, state_code, year, month, {sql_sig("prediction")} AS prediction FROM (
  SELECT variable AS name, state_code, year, month, prediction FROM wtree
  UNION ALL SELECT param, state_code, year, month, prediction FROM ptree)""",
          "M3, M4, M5: one regression tree of depth 2 for every (variable, state) and every (param, state), by value")
def q_forecast_tree_regions(spark, sf):
    return _forecast_features(spark, sf, trees=1, depth=2)


@register("forecast_gbt_regions", None,
          "M3, M4, M5 as in the source: 20 boosted trees of depth 5 for every (variable, state) and every (param, state)")
def q_forecast_gbt_regions(spark, sf):
    return _forecast_features(spark, sf, trees=20)


GBT_MSE_SHARE = 0.5

_REGION_LABELS = f"""
labels AS (
  SELECT variable AS name, state_code, value AS label FROM weather_long WHERE year <= {S.TRAIN_LAST_YEAR}
  UNION ALL SELECT param, state_code, max_value FROM monthly_features WHERE year <= {S.TRAIN_LAST_YEAR})"""


@register("gbt_regions_mse", Q.with_ctes(*_feature_ctes()[:7], _REGION_LABELS) + f"""
SELECT name, state_code, count(*) AS n_train, {sql_round_sig("var_pop(label)", 6)} AS mean_mse, true AS fine FROM labels GROUP BY name, state_code""",
          "M3-M6: the boosted trees of every region on their training rows: rows, mse of the mean predictor, and whether theirs "
          f"is at most {GBT_MSE_SHARE} of it, which no constant reaches")
def q_gbt_regions_mse(spark, sf):
    from ..operators import trees
    m = ST.feature_forecasts(spark, sf)
    fits = [trees.fit_and_forecast(t, t.limit(0), [n, *STATE], STATE, f, label, fitted=True).withColumnRenamed(n, "name")
            for t, n, f, label in ((m.weather, "variable", S.WEATHER_FEATURES, "value"), (m.features, "param", S.POLLUTANT_FEATURES, "max_value"))]
    error = F.col("prediction") - F.col("_label")
    out = fits[0].unionByName(fits[1]).groupBy("name", *STATE).agg(
        F.count("*").alias("n_train"), F.var_pop("_label").alias("mean_mse"), F.avg(error * error).alias("mse"))
    return out.select("name", *STATE, "n_train", round_sig("mean_mse", 6).alias("mean_mse"),
                      (F.col("mse") <= GBT_MSE_SHARE * F.col("mean_mse")).alias("fine"))


# -- model forms: rows-only checks ------------------------------------------------------

for _kind in ("gbt", "rf", "dt"):
    def _make(kind):
        def q(spark, sf):
            return ST.model_chain(spark, sf, STATE, kind)
        q.__name__ = f"q_forecast_{kind}_pooled"
        return q
    register(f"forecast_{_kind}_pooled", None,
             f"M1-M3 pooled {_kind}: one model per target over all states (state as a categorical "
             "feature), full chain to the index")(_make(_kind))


# -- sources, sinks and the streaming form ---------------------------------------------


_MP_SQL = Q.with_ctes(Q.pollutant_daily(), Q.monthly_pollutant()) + f"""
SELECT param, state_code, year, month, {", ".join(S.MEASURES)} FROM monthly_pollutant"""
_MF_SQL = Q.with_ctes(Q.pollutant_daily(), Q.weather_daily(), Q.monthly_pollutant(), Q.monthly_weather(),
                      Q.monthly_features()) + f"""
SELECT param, state_code, year, month, {", ".join(S.MEASURES + _W)} FROM monthly_features"""


@register("union_years", _MP_SQL,
          "U1, S1, S4: daily readings staged as param=/year= Parquet, read back as one multi-path "
          "read of every year, then monthly means")
def q_union_years(spark, sf):
    root = scratch_path(spark, "daily_pollutant")
    writers.stage_daily(X.pollutant_daily(spark, sf), root)
    return monthly.monthly_pollutant(readers.read_years(spark, root), STATE)


@register("csv_roundtrip", _MP_SQL,
          "S1, S6, K1: daily readings written as CSV with the raw header names, read back typed "
          "(try_cast, quarantine), monthly means")
def q_csv_roundtrip(spark, sf):
    root = scratch_path(spark, "daily_pollutant_csv")
    writers.stage_daily(X.pollutant_daily(spark, sf), root, fmt="csv", header_names=True)
    return monthly.monthly_pollutant(writers.none_lost(readers.read_daily_csv(spark, root, "pollutant")), STATE)


UPSERT_CUTOFF = "1999-06-15"


@register("upsert_monthly", _MF_SQL,
          "K3, K4: keyed upsert of monthly features; a stale snapshot (data up to mid-June 1999) "
          "is upserted with recomputed months from 1999 on, into a new version directory")
def q_upsert_monthly(spark, sf):
    cut_year = int(UPSERT_CUTOFF[:4])
    pdaily, wdaily = X.pollutant_units(spark, sf, last=cut_year), X.weather_units(spark, sf, last=cut_year)
    cut = F.col("date_local") < F.lit(UPSERT_CUTOFF).cast("date")
    stale = monthly.monthly_features(pdaily.where(cut), wdaily.where(cut), STATE)
    fresh = monthly.monthly_features(X.pollutant_units(spark, sf, cut_year), X.weather_units(spark, sf, cut_year), STATE)
    keys = ["param", "state_code", "year", "month"]
    root = scratch_path(spark, "monthly_features_table")
    schema = stale.schema
    for part in (stale, fresh):
        part = writers.stage(part.select(*schema.names), "upsert-rows")
        path = writers.upsert(spark, writers.none_lost(writers.coerce(part, schema, keys)), keys, root)
    return spark.read.parquet(path)


@register("upsert_partitions", _MF_SQL,
          "K3: the stale snapshot and the recomputed months in a manifest table partitioned by (param, year): the second write "
          "reads and writes the partitions from 1999 on only, and is published by an atomic pointer")
def q_upsert_partitions(spark, sf):
    cut_year = int(UPSERT_CUTOFF[:4])
    cut = F.col("date_local") < F.lit(UPSERT_CUTOFF).cast("date")
    stale = monthly.monthly_features(X.pollutant_units(spark, sf, last=cut_year).where(cut), X.weather_units(spark, sf, last=cut_year).where(cut), STATE)
    fresh = monthly.monthly_features(X.pollutant_units(spark, sf, cut_year), X.weather_units(spark, sf, cut_year), STATE)
    keys, root = ["param", "state_code", "year", "month"], scratch_path(spark, "features_manifest")
    for part in (stale, fresh):
        version = tables.upsert(spark, part, keys, ["param", "year"], root)
    return tables.read(spark, version, stale.schema)


@register("incremental_features", _MF_SQL,
          "S1, S2, U1: readings published as CSV, 1999 up to mid-June at first; ingested, 1999 republished in full, ingested again "
          "(only the republished files are read, their old sums subtracted), then C1 from the stored sums")
def q_incremental_features(spark, sf):
    cut = F.col("date_local") < F.lit(UPSERT_CUTOFF).cast("date")
    year = int(UPSERT_CUTOFF[:4])
    means = {}
    for kind, name, daily in (("pollutant", "param", X.pollutant_daily), ("weather", "variable", X.weather_daily)):
        source, state = scratch_path(spark, f"{kind}_published"), scratch_path(spark, f"{kind}_state")
        early = daily(spark, sf).where((F.year("date_local") != F.lit(year)) | cut)
        for rows in (early, daily(spark, sf, year, year)):
            writers.replace_days(rows, source, name)
            done = incremental.ingest(spark, source, state, kind, STATE)
            if done.quarantined:
                raise ValueError(f"{done.quarantined} rows in quarantine")
        means[kind] = incremental.monthly_means(spark, state, kind, STATE)
    return monthly.join_features(means["pollutant"], monthly.spread_weather(means["weather"], STATE), STATE)


@register("monthly_pollutant_stream", _MP_SQL,
          "C1's monthly means as a Structured Streaming aggregation over staged daily files "
          "(exact running sums, complete mode, epoch tables)")
def q_monthly_pollutant_stream(spark, sf):
    from ..streaming import monthly as SM
    root = scratch_path(spark, "daily_pollutant_stream_src")
    writers.stage_daily(X.pollutant_daily(spark, sf), root)
    out = scratch_path(spark, "monthly_pollutant_stream")
    SM.monthly_pollutant_stream(spark, root, out, scratch_path(spark, "stream_checkpoint"))
    return SM.latest_monthly(spark, out)


# -- county-level variants (state, county key over every state) ---------------------

_KC = (*COUNTY, "year", "month")
_WF_C = [Q.weather_daily(), Q.monthly_weather_long(COUNTY), Q.grid(COUNTY), Q.weather_train(keys=COUNTY),
         Q.weather_forecast(keys=COUNTY)]
_PL_C = [Q.pollutant_daily(), Q.monthly_pollutant(COUNTY), Q.pollutant_long(keys=COUNTY)]


@register("forecast_linear_weather_county", Q.with_ctes(*_WF_C) + f"""
SELECT variable, state_code, county_code, year, month, {sql_sig("prediction")} AS prediction FROM weather_forecast""",
          "C2 linear form per (variable, state, county)")
def q_forecast_linear_weather_county(spark, sf):
    return sig(ST.weather_linear_forecast(spark, sf, COUNTY), ["prediction"])


@register("forecast_linear_pollutant_county", Q.with_ctes(*_PL_C, Q.grid(COUNTY), Q.pollutant_forecast(keys=COUNTY))
          + f"""
SELECT param, state_code, county_code, year, month, {sql_sig("prediction")} AS prediction FROM pollutant_forecast""",
          "C4 linear form per (param, state, county)")
def q_forecast_linear_pollutant_county(spark, sf):
    return sig(ST.pollutant_linear_forecast(spark, sf, COUNTY), ["prediction"])


@register("combine_forecasts_county",
          Q.with_ctes(*_PL_C, Q.grid(COUNTY), Q.naive("pollutant_long", "param", "parms", COUNTY))
          + Q.chain("grid", "parms", "param", "prediction", ST.POLLUTANT_ARM_COLUMNS, "merge", _KC),
          "C5 county variant (merge mode)")
def q_combine_forecasts_county(spark, sf):
    arms = ST.pollutant_naive_arms(spark, sf, COUNTY)
    return align.combine_long(X.grid(spark, sf, COUNTY), arms, list(_KC), "param", "prediction",
                              ST.POLLUTANT_ARM_COLUMNS)


@register("forecast_features_linear_county", _sql_forecast_features(COUNTY),
          "C2, C4 (M2, M5) county variant: one fit for every (variable, county) and (param, county)")
def q_forecast_features_linear_county(spark, sf):
    return _forecast_features(spark, sf, COUNTY)


@register("end_to_end_linear_county", Q.with_ctes(*_feature_ctes(COUNTY)) + _e2e_select(COUNTY),
          "C1-C6 end to end at county level (least squares per county)")
def q_end_to_end_linear_county(spark, sf):
    return _e2e_rounded(end_to_end(spark, sf, COUNTY))



# -- latent reports: index forecast error, model comparison ---------------------------

@register("aqi_forecast_error", Q.with_ctes(*_WF, *_PL, Q.pollutant_forecast()).rstrip("\n") + f""",
e2e AS ({_index_select()}),
obs_day AS (
  SELECT state_code, date_local, max({Q.sql_subindex_by_param("CAST(max_value AS DOUBLE)", "param")}) AS aqi
  FROM pollutant_daily GROUP BY state_code, date_local),
obs AS (
  SELECT month, state_code, avg(aqi) AS observed, avg(CAST(year AS DOUBLE)) AS year_x
  FROM (SELECT *, {Q.ym()} FROM obs_day) WHERE year = {S.GRID_YEAR} GROUP BY month, state_code)
SELECT month, state_code, round(observed, 6) AS observed, year_x, year AS year_y,
       global_aqi AS predicted, round(global_aqi - observed, 6) AS diff
FROM obs JOIN e2e USING (month, state_code)""",
          "C8 for the index (latent): observed daily index per state (largest sub-index of the day), "
          "monthly means of the grid year against the forecast global index")
def q_aqi_forecast_error(spark, sf):
    # one scan: exact sums and the largest sub-index of each pollutant's day serve both sides
    d = aqi.subindex_long(X.pollutant_daily(spark, sf, last=S.GRID_YEAR).select(
        "param", "state_code", "date_local", "max_value"), "max_value")
    days = writers.stage(d.groupBy("param", "state_code", "date_local").agg(
        F.sum("max_value").alias("total"), F.count("max_value").alias("n"), F.max("aqi").alias("aqi")), "pollutant-days")
    pl = monthly.with_year_month(days).groupBy("param", "state_code", "year", "month").agg(
        (F.sum("total").cast("string").cast("double") / F.sum("n")).alias("value"))
    comb = align.combine_long(X.grid(spark, sf), ST.pollutant_linear_forecast(spark, sf, pl=pl),
                              ["state_code", "year", "month"], "param", "prediction", ST.POLLUTANT_ARM_COLUMNS)
    fc = rounded(index.air_quality_index(comb), cols=["global_aqi"])
    obs = days.where(F.year("date_local") == F.lit(S.GRID_YEAR)).groupBy("state_code", "date_local").agg(F.max("aqi").alias("aqi"))
    out = evaluate.forecast_error(obs, fc, ["state_code"], value_col="aqi", pred_col="global_aqi", exact=False)
    return rounded(out, cols=["observed", "diff"])


@register("compare_models", None,
          "C9 / M6 with the model candidates (linear with per-state intercepts, random forest, decision "
          "tree, GBT): pooled fits on all years before 2000, mse on 2000, winner per weather variable")
def q_compare_models(spark, sf):
    wl = writers.stage(ST.weather_long(spark, sf, last=TEST_YEAR), "weather-monthly")
    train, test = evaluate.holdout(wl, TEST_YEAR)
    return evaluate.compare_models(train, test, "variable", S.WEATHER_VARIABLES, ["state_code"],
                                   S.WEATHER_FEATURES)


CROSS_MODELS = {"mean": [], "calendar": list(S.WEATHER_FEATURES), "weather": list(S.POLLUTANT_FEATURES[2:]),
                "features": list(S.POLLUTANT_FEATURES)}


@register("compare_models_linear", Q.with_ctes(
    Q.pollutant_daily(), Q.weather_daily(), Q.monthly_pollutant(), Q.monthly_weather(), Q.monthly_features(),
    *Q.cross_fitted(Q.in_training("monthly_features"), ["param", "state_code"], CROSS_MODELS, "max_value")) + f"""
SELECT param, state_code, model, {sql_round_sig("mse")} AS mse, n_test,
       first(model) OVER (PARTITION BY param, state_code ORDER BY mse, model) AS best_model FROM cross_mse""",
          "C9 / M6, cross-fitted: five folds of every (param, state), every row scored by least squares on the other four; "
          "mse of the mean, month and year, the weather, and all six features, and the winner")
def q_compare_models_linear(spark, sf):
    from ..operators import ols
    f = monthly.monthly_features(X.pollutant_units(spark, sf, last=S.TRAIN_LAST_YEAR), X.weather_units(spark, sf, last=S.TRAIN_LAST_YEAR), STATE)
    f = writers.stage(f.select("param", "state_code", *S.POLLUTANT_FEATURES, "max_value"), "features")
    by = ["param", "state_code"]
    mse = writers.stage(ols.cross_fit(f, by, ["year", "month"], CROSS_MODELS, "max_value"), "cross-mse")
    best = evaluate.best_model(mse, by).drop("best_mse")
    return mse.join(best, by).withColumn("mse", round_sig("mse"))


_HOLDOUT = f"(SELECT * FROM {Q.in_training('weather_long')})"


@register("random_holdout_mse", Q.with_ctes(
    Q.weather_daily(), Q.monthly_weather_long(), Q.hash_ranked("ranked", _HOLDOUT, ["variable", "state_code"], ["year", "month"]), """
kept AS (SELECT * FROM ranked WHERE place >= floor(size * 20 / 100))""",
    Q.ols_sums("sums", "kept", ["variable", "state_code"], S.WEATHER_FEATURES, "value"),
    Q.ols_fit("fits", "sums", ["variable", "state_code"], 3, [0, 1])) + f"""
SELECT variable, state_code, {sql_round_sig("avg(e * e)")} AS mse, count(*) AS n_test, CAST(any_value(n) AS BIGINT) AS n_train FROM (
  SELECT variable, state_code, n, {Q.ols_value(S.WEATHER_FEATURES, "f", "r")} - r.value AS e
  FROM ranked r JOIN fits f USING (variable, state_code) JOIN (SELECT variable, state_code, n FROM sums) USING (variable, state_code)
  WHERE place < floor(size * 20 / 100))
GROUP BY variable, state_code""",
          "M7, A5: exact 80/20 split of every (variable, state) by the rank of a keyed hash, least squares on the 80, mse on the 20")
def q_random_holdout_mse(spark, sf):
    from ..operators import ols
    by = ["variable", "state_code"]
    wl = writers.stage(ST.weather_long(spark, sf, last=S.TRAIN_LAST_YEAR), "weather-monthly")
    train, test = ols.split_by_hash(wl, by, ["year", "month"])
    error = ols.fitted(F.col("fit"), S.WEATHER_FEATURES) - F.col("value")
    scored = test.join(ols.fit(train, by, S.WEATHER_FEATURES, "value"), by).select(*by, "n", (error * error).alias("square"))
    return scored.groupBy(*by).agg(round_sig(F.avg("square")).alias("mse"), F.count("*").alias("n_test"), F.first("n").alias("n_train"))


@register("staged_run",
          Q.with_ctes(Q.pollutant_daily(), Q.weather_daily(), Q.monthly_pollutant(), Q.monthly_weather(),
                      Q.monthly_features(), Q.pollutant_long(source="monthly_features"), Q.grid(),
                      Q.pollutant_forecast()) + f"""
SELECT state_code, year, month,
       {", ".join(f"{sql_sig(S.forecast_column(p))} AS {S.forecast_column(p)}" for p in S.POLLUTANTS)},
       {", ".join(f"round({Q.sql_subindex(S.forecast_column(p), p)}, 6) AS {S.aqi_column(p)}"
                  for p in S.POLLUTANTS)},
       round(greatest({", ".join(Q.sql_subindex(S.forecast_column(p), p) for p in S.POLLUTANTS)}), 6)
         AS global_aqi
FROM ({Q.chain("grid", "pollutant_forecast", "param", "prediction", ST.POLLUTANT_ARM_COLUMNS, "merge")})""",
          "Staged application (plans.runner): every stage published as a versioned table, later stages "
          "read the monthly tables back; result = the published index table")
def q_staged_run(spark, sf):
    from . import runner
    tables = runner.run(spark, sf, scratch_path(spark, "warehouse"))
    return _e2e_rounded(tables["air_quality_index"])


@register("error_report_csv", _FE_SQL,
          "K6, S7: the forecast-error report exported as CSV with a header and read back with its schema")
def q_error_report_csv(spark, sf):
    from pyspark.sql import types as T
    rep = q_forecast_error(spark, sf)
    path = writers.export_csv(rep, scratch_path(spark, "error_report"))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rep.schema.fields])
    return spark.read.schema(schema).option("header", True).csv(path)


@register("forecast_gbt_pooled_county", None,
          "M1-M3 pooled GBT at county level: (state, county) as the categorical key, full chain to the index")
def q_forecast_gbt_pooled_county(spark, sf):
    return ST.model_chain(spark, sf, COUNTY, "gbt")


# -- what SQL knows of the model forms -------------------------------------------------

_TRAINED = [Q.pollutant_daily(), Q.weather_daily(), Q.monthly_pollutant(), Q.monthly_weather(), Q.monthly_weather_long(),
            Q.monthly_features(), Q.grid(), f"""
labels AS (
  SELECT variable AS name, state_code, value AS label FROM weather_long WHERE year <= {S.TRAIN_LAST_YEAR}
  UNION ALL SELECT param, state_code, max_value FROM monthly_features WHERE year <= {S.TRAIN_LAST_YEAR}),
ranges AS (SELECT name, min(label) AS least_label, max(label) AS most_label FROM labels GROUP BY name)"""]


def _model_check(spark, sf, kind):
    m = ST.model_forecasts(spark, sf, STATE, kind)
    labels = m.weather.select(F.col("variable").alias("name"), F.col("value").alias("label")).unionByName(
        m.features.select(F.col("param").alias("name"), F.col("_label").alias("label")))
    ranges = labels.groupBy("name").agg(F.min("label").alias("least_label"), F.max("label").alias("most_label"))
    fc = m.weather_forecast.withColumnRenamed("variable", "name").unionByName(
        m.pollutant_forecast.withColumnRenamed("param", "name"))
    value = F.col("prediction")
    fine = value.isNotNull() & ~F.isnan(value)
    if kind != "gbt":  # means of training labels; boosted sums may leave their range
        fine = fine & value.between(F.col("least_label"), F.col("most_label"))
    return fc.join(ranges, "name").select("name", "state_code", "year", "month", "least_label", "most_label",
                                          F.coalesce(fine, F.lit(False)).alias("fine"))


for _kind in ("gbt", "rf", "dt"):
    def _make_check(kind):
        def q(spark, sf):
            return _model_check(spark, sf, kind)
        q.__name__ = f"q_model_check_{kind}"
        return q
    register(f"model_check_{_kind}", Q.with_ctes(*_TRAINED) + """
SELECT r.name, g.state_code, g.year, g.month, least_label, most_label, true AS fine
FROM grid g JOIN (SELECT DISTINCT name, state_code FROM labels) l USING (state_code) JOIN ranges r ON r.name = l.name""",
             f"M1-M5, U2, U4: {_kind} forecasts of every trained series and grid month, none missing"
             + ("" if _kind == "gbt" else ", all within the range of the training labels"))(_make_check(_kind))


@register("pollutant_features_linear", Q.with_ctes(*_TRAINED[:4], *_TRAINED[5:7]) + f"""
SELECT *, 12 AS n_forecast FROM (
  SELECT param, state_code, count(*) AS n_train, {sql_round_sig("avg(max_value)", 6)} AS mean_fit
  FROM monthly_features WHERE year <= {S.TRAIN_LAST_YEAR} GROUP BY param, state_code)
JOIN (
  SELECT param, {", ".join(f"{sql_round_sig(f'avg(max_value * {c})', 6)} AS fit_{c}" for c in S.POLLUTANT_FEATURES)}
  FROM monthly_features WHERE year <= {S.TRAIN_LAST_YEAR} GROUP BY param) USING (param)""",
          "C4 (M2, M5) with the six features, least squares with an intercept for each state: the normal equations "
          "(fitted values have the labels' mean in each state and their mean product with each feature), and the number "
          "of grid months forecast from the forecast weather (C3)")
def q_pollutant_features_linear(spark, sf):
    from ..operators import forecast
    m = ST.model_forecasts(spark, sf, STATE, "linear")
    fit = writers.stage(forecast.within_linear_forecast(m.features, m.features, "param", S.POLLUTANTS, STATE,
                                                        S.POLLUTANT_FEATURES, prepared=True), "fitted")
    states = fit.groupBy("param", "state_code").agg(F.count("*").alias("n_train"), round_sig(F.avg("prediction"), 6).alias("mean_fit"))
    rows = fit.join(m.features, ["param", "state_code", "year", "month"])
    products = rows.groupBy("param").agg(*[round_sig(F.avg(F.col("prediction") * F.col(c)), 6).alias(f"fit_{c}") for c in S.POLLUTANT_FEATURES])
    ahead = m.pollutant_forecast.groupBy("param", "state_code").agg(F.count("prediction").cast("int").alias("n_forecast"))
    return states.join(products, "param").join(ahead, ["param", "state_code"])


# -- options of single operators ---------------------------------------------------------

@register("features_from_csv", _MF_SQL,
          "C1 from CSV (S1, S2): pollutant and weather readings written as CSV with the raw headers, read back "
          "typed, averaged and joined")
def q_features_from_csv(spark, sf):
    roots = {"pollutant": scratch_path(spark, "pollutant_csv"), "weather": scratch_path(spark, "weather_csv")}
    writers.stage_daily(X.pollutant_daily(spark, sf), roots["pollutant"], fmt="csv", header_names=True)
    writers.stage_daily(X.weather_daily(spark, sf), roots["weather"], "variable", fmt="csv", header_names=True)
    read = {kind: writers.none_lost(readers.read_daily_csv(spark, root, kind)) for kind, root in roots.items()}
    return monthly.monthly_features(read["pollutant"], read["weather"], STATE)


@register("ingest_quarantine", Q.with_ctes(Q.pollutant_daily()) + """
SELECT CASE max_hour WHEN 5 THEN 'bad state code' WHEN 6 THEN 'bad date' WHEN 7 THEN 'bad max_value' ELSE 'good' END AS reason,
       param, count(*) AS n
FROM pollutant_daily GROUP BY ALL""",
          "S6, K4: readings written as CSV, one cell damaged in those of hours 5 to 7; rows read and rows quarantined, by reason")
def q_ingest_quarantine(spark, sf):
    inv = {v: k for k, v in S.DAILY_CSV_COLUMNS.items()}
    hour = F.col("max_hour")
    daily = X.pollutant_daily(spark, sf)
    text = daily.select("param", *[F.col(c).cast("string").alias(inv[c]) for c in daily.columns if c != "param"], hour.alias("h"))
    for h, c in ((5, "state_code"), (6, "date_local"), (7, "max_value")):
        text = text.withColumn(inv[c], F.when(F.col("h") == h, F.lit("n/a")).otherwise(F.col(inv[c])))
    path = writers.export_csv(text.drop("h"), scratch_path(spark, "damaged_csv"))
    good, bad = readers.read_daily_csv(spark, path, "pollutant")
    rows = good.select("param", F.lit("good").alias("reason")).unionByName(bad.select("param", "reason"))
    return rows.groupBy("reason", "param").agg(F.count("*").alias("n"))


@register("grid_from_csv", Q.with_ctes(Q.grid()) + """
SELECT state_code, month, year FROM grid""",
          "S3: the prediction grid written as CSV with its header and read back")
def q_grid_from_csv(spark, sf):
    return readers.read_grid_csv(spark, writers.export_csv(X.grid(spark, sf, STATE), scratch_path(spark, "grid_csv")))


ONE_STATE = 3


@register("monthly_features_one_state",
          Q.with_ctes(Q.pollutant_daily(), Q.weather_daily(), Q.monthly_pollutant(COUNTY),
                      Q.monthly_weather(COUNTY), Q.monthly_features(COUNTY)) + f"""
SELECT param, state_code, county_code, year, month, {", ".join(S.MEASURES + _W)} FROM monthly_features
WHERE state_code = {ONE_STATE}""",
          "P3: county features restricted to one state, as the county variant does")
def q_monthly_features_one_state(spark, sf):
    return monthly.monthly_features(X.pollutant_units(spark, sf), X.weather_units(spark, sf), COUNTY, state=ONE_STATE)


@register("forecast_linear_truncated", Q.with_ctes(
    Q.weather_daily(), Q.monthly_weather_long(), Q.grid(), Q.weather_train(truncate_label=True), Q.weather_forecast()) + f"""
SELECT variable, state_code, year, month, {sql_sig("prediction")} AS prediction FROM weather_forecast""",
          "F2 (D3): C2 with the label cut to a whole number, as the source does")
def q_forecast_linear_truncated(spark, sf):
    return sig(ST.weather_linear_forecast(spark, sf, truncate_label=True), ["prediction"])


@register("monthly_features_sorted", _MF_SQL + " ORDER BY param, state_code, year, month",
          "O1: monthly features in (param, state, year, month) order, sorted once at the sink")
def q_monthly_features_sorted(spark, sf):
    return monthly.sort_for_output(q_monthly_features_state(spark, sf))


@register("monthly_features_position", Q.with_ctes(Q.pollutant_daily(), Q.weather_daily(), Q.monthly_pollutant(), Q.monthly_weather(), Q.monthly_features()) + """
SELECT row_number() OVER (ORDER BY param, state_code, year, month) - 1 AS position, param, state_code, year, month, max_value
FROM monthly_features""",
          "O1 as a sink: files by key ranges, and every row's position read back from them")
def q_monthly_features_position(spark, sf):
    order = ["param", "state_code", "year", "month"]
    path = writers.write_sorted(q_monthly_features_state(spark, sf), scratch_path(spark, "features_sorted"), order)
    return readers.read_sorted(spark, path, order)[0].select("position", *order, "max_value")


@register("forecast_error_from_csv", _FE_SQL,
          "C8 from two CSV sides (S7): the grid year's daily observations and the forecasts written as files, read back and joined")
def q_forecast_error_from_csv(spark, sf):
    observed = writers.stage_daily(X.weather_daily(spark, sf, S.GRID_YEAR, S.GRID_YEAR), scratch_path(spark, "observed_csv"), "variable",
                                   fmt="csv", header_names=True)
    forecast = ST.weather_linear_forecast(spark, sf)
    path = writers.export_csv(forecast, scratch_path(spark, "forecast_csv"))
    daily = writers.none_lost(readers.read_daily_csv(spark, observed, "weather"))
    out = evaluate.forecast_error(daily, spark.read.schema(forecast.schema).option("header", True).csv(path), ["state_code"], ["variable"])
    return sig(out, ["predicted", "diff"])


REGION_BATCHES = 3


@register("batched_forecasts", Q.with_ctes(*_feature_ctes()) + f"""
SELECT param, state_code, year, month, {sql_sig("prediction")} AS prediction FROM features_forecast""",
          "K2, U4: forecasts written in batches of regions, each marked when finished; the run stops after the first batch, and a "
          "second one writes only what lacks")
def q_batched_forecasts(spark, sf):
    from ..operators import ols
    m = ST.feature_forecasts(spark, sf)
    by, root = ["param", *STATE], scratch_path(spark, "forecast_batches")

    def make(unit):
        mine = F.pmod(F.col("state_code"), F.lit(REGION_BATCHES)) == F.lit(int(unit.rpartition("-")[2]))
        return ols.forecast(ols.fit(m.features.where(mine), by, S.POLLUTANT_FEATURES, "max_value"), m.grid.where(mine), by, STATE, S.POLLUTANT_FEATURES)

    units = [f"regions-{i}" for i in range(REGION_BATCHES)]
    tables.write_units(spark, root, units[:1], make)
    tables.write_units(spark, root, units, make)
    return sig(tables.read_units(spark, root, m.pollutant_forecast.schema), ["prediction"])


_ODD_VALUE = "CASE max_hour WHEN 1 THEN -CAST(max_value AS DOUBLE) WHEN 2 THEN CAST('NaN' AS DOUBLE) WHEN 3 THEN NULL {bounds} ELSE CAST(max_value AS DOUBLE) END"


@register("aqi_odd_values", Q.with_ctes(Q.pollutant_daily(), """
odd AS (SELECT param, state_code, date_local, max_hour, """ + _ODD_VALUE.format(bounds=" ".join(
    f"WHEN {h} THEN CASE param " + " ".join(f"WHEN '{p}' THEN {pts.split()[at].split(':')[0]}e0" for p, pts in Q.INDEX_POINTS.items()) + " END"
    for h, at in ((4, 0), (5, 3), (6, -1)))) + """ AS value FROM pollutant_daily)""") + f"""
SELECT param, state_code, max_hour, CAST(date_local AS VARCHAR) AS date_local, {Q.sql_subindex_by_param("value", "param")} AS aqi FROM odd""",
          "F4 on negative values, NaN, null and the bounds themselves (first, fourth, last), by the hour of the reading")
def q_aqi_odd_values(spark, sf):
    bound = {h: F.create_map(*[x for p in S.POLLUTANTS for x in (F.lit(p), F.lit(float(S.CONCENTRATION_LEVELS[p][at])))])[F.col("param")]
             for h, at in ((4, 0), (5, 3), (6, -1))}
    hour, v = F.col("max_hour"), F.col("max_value").cast("double")
    value = F.when(hour == 1, -v).when(hour == 2, F.lit(float("nan"))).when(hour == 3, F.lit(None)) \
        .when(hour == 4, bound[4]).when(hour == 5, bound[5]).when(hour == 6, bound[6]).otherwise(v)
    d = X.pollutant_daily(spark, sf).select("param", "state_code", "max_hour", F.col("date_local").cast("string").alias("date_local"), value.alias("value"))
    return aqi.subindex_long(d, "value").drop("value")


@register("features_by_sql", Q.with_ctes(Q.pollutant_daily(), Q.weather_daily(), Q.monthly_pollutant(), Q.monthly_weather_long()) + """
SELECT p.param, p.state_code, p.year, p.month, p.max_value, w.value AS temperature
FROM monthly_pollutant p JOIN weather_long w USING (state_code, year, month) WHERE w.variable = 'TEMP'""",
          "P12: SQL text over the registered views")
def q_features_by_sql(spark, sf):
    from .views import register_views
    register_views(spark, sf)
    return spark.sql("""
        SELECT p.param, p.state_code, p.year, p.month, p.max_value, w.value AS temperature
        FROM pollutant_monthly p JOIN weather_monthly w USING (state_code, year, month) WHERE w.variable = 'TEMP'""")
