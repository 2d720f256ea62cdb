import datetime as dt
from decimal import Decimal

import pytest

from aerocast import schema as S
from aerocast.operators import evaluate


def test_best_model_ties_broken_by_name(spark):
    mse = spark.createDataFrame([("p", 1, "mean", 2.0), ("p", 1, "linear", 2.0), ("p", 1, "seasonal_naive", 5.0),
                                 ("q", 1, "mean", 1.0), ("q", 1, "linear", None)],
                                "param string, state_code int, model string, mse double")
    got = {r.param: (r.best_model, r.best_mse) for r in evaluate.best_model(mse, ["param", "state_code"]).collect()}
    assert got == {"p": ("linear", 2.0), "q": ("mean", 1.0)}


def test_mse_by_model(spark):
    scored = spark.createDataFrame([("a", "m", 1.0, 2.0), ("a", "m", 1.0, 4.0)], "g string, model string, label double, prediction double")
    r = evaluate.mse_by_model(scored, ["g"]).first()
    assert r.mse == pytest.approx(5.0) and r.n_test == 2


def test_forecast_error_ignores_year_unless_asked(spark):
    obs = spark.createDataFrame([("TEMP", 1, 10, dt.date(2016, 3, 1), Decimal("10")),
                                 ("TEMP", 1, 10, dt.date(2016, 3, 2), Decimal("20"))], S.WEATHER_DAILY)
    fc = spark.createDataFrame([("TEMP", 1, 2018, 3, 18.0)], "variable string, state_code int, year int, month int, prediction double")
    r = evaluate.forecast_error(obs, fc, ["state_code"], ["variable"]).first()
    assert (r.observed, r.year_x, r.year_y, r.predicted, r.diff) == (15.0, 2016.0, 2018, 18.0, 3.0)
    assert evaluate.forecast_error(obs, fc, ["state_code"], ["variable"], match_year=True).count() == 0


def test_holdout_and_random_split(spark):
    df = spark.createDataFrame([(y, float(y)) for y in range(1996, 2001)], "year int, value double")
    train, test = evaluate.holdout(df, 2000, 1997)
    assert sorted(r.year for r in train.collect()) == [1997, 1998, 1999]
    assert [r.year for r in test.collect()] == [2000]
    a, b = evaluate.random_holdout(df, 0.8, seed=1)
    assert a.count() + b.count() == 5
    a2, _ = evaluate.random_holdout(df, 0.8, seed=1)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, a2.collect()))
