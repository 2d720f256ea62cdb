import pytest

from aerocast.operators import linear, topk


def test_trend_recovers_line(spark):
    rows = [("a", 1, y, m, 3.0 + 0.5 * ((y - 1996) * 12 + m)) for y in (1996, 1997) for m in range(1, 13)]
    df = spark.createDataFrame(rows, "n string, state_code int, year int, month int, value double")
    fit = linear.trend_fit(df, ["n", "state_code"]).first()
    assert fit.slope == pytest.approx(0.5) and fit.intercept == pytest.approx(3.0) and fit.n_train == 24
    grid = spark.createDataFrame([(1, 2001, 3)], "state_code int, year int, month int")
    pred = linear.trend_predict(linear.trend_fit(df, ["n", "state_code"]), grid, ["state_code"]).first()
    assert pred.prediction == pytest.approx(3.0 + 0.5 * (5 * 12 + 3)) and pred.n == "a"


def test_ols2_recovers_plane_and_singular_is_null(spark):
    rows = [("a", 1, y, m, 10.0 + 2.0 * m - 3.0 * (y - 1996)) for y in (1996, 1997, 1998) for m in range(1, 13)]
    rows += [("b", 1, 1996, m, float(m)) for m in range(1, 13)]  # one year only: singular
    df = spark.createDataFrame(rows, "n string, state_code int, year int, month int, value double")
    fit = {r.n: r for r in linear.ols2_fit(df, ["n", "state_code"]).collect()}
    assert fit["a"].b1 == pytest.approx(2.0) and fit["a"].b2 == pytest.approx(-3.0)
    assert fit["b"].b1 is None and fit["b"].b2 is None
    grid = spark.createDataFrame([(1, 2001, 6)], "state_code int, year int, month int")
    preds = {r.n: r.prediction for r in
             linear.ols2_predict(linear.ols2_fit(df, ["n", "state_code"]), grid, ["state_code"]).collect()}
    assert preds["a"] == pytest.approx(10.0 + 12.0 - 15.0) and preds["b"] is None


def test_first_n_per_group_orders_by_year_then_month(spark):
    rows = [(k, y, m, 1.0) for k in (1, 2) for y in (2001, 2000, 2002) for m in (12, 1, 6)]
    df = spark.createDataFrame(rows, "state_code int, year int, month int, value double")
    got = topk.first_n_per_group(df, ["state_code"], ["year", "month"], 4)
    per_key = {}
    for r in got.collect():
        per_key.setdefault(r.state_code, []).append((r.year, r.month))
    for k, v in per_key.items():
        assert sorted(v) == [(2000, 1), (2000, 6), (2000, 12), (2001, 1)], k


def test_weather_training_truncates_label_toward_zero_when_asked(spark):
    from aerocast.plans import stages
    rows = [("TEMP", 1, 1996, 1, 3.9), ("TEMP", 1, 1996, 2, -3.9), ("TEMP", 1, 1995, 1, 7.0)]
    wl = spark.createDataFrame(rows, "variable string, state_code int, year int, month int, value double")
    got = sorted((r.month, r.value) for r in stages.weather_training(wl, truncate_label=True).collect())
    assert got == [(1, 3.0), (1, 7.0), (2, -3.0)]
    got = sorted((r.month, r.value) for r in stages.weather_training(wl).collect())
    assert got == [(1, 3.9), (1, 7.0), (2, -3.9)]
    got = sorted((r.month, r.value) for r in stages.weather_training(wl, months=2).collect())
    assert got == [(1, 3.9), (1, 7.0)]


def test_rows_of_the_first_year_change_the_slope(spark):
    from aerocast.operators import linear
    from aerocast.plans import stages
    rows = [(1, y, m, float(m + (50 if y == 1995 else 0))) for y in range(1995, 2001) for m in range(1, 13)]
    wl = spark.createDataFrame(rows, "state_code int, year int, month int, value double")
    every = linear.trend_fit(stages.in_training(wl), ["state_code"]).first()
    later = linear.trend_fit(stages.in_training(wl, first=1996), ["state_code"]).first()
    assert every.asDict() != later.asDict()


def test_variable_filter_restricts_rows_averaged(spark):
    import datetime as dt
    from decimal import Decimal
    from pyspark.sql import functions as F
    from aerocast import schema as S
    from aerocast.operators import monthly
    w = spark.createDataFrame([("TEMP", 1, 10, dt.date(2000, 1, 1), Decimal("10")),
                               ("TEMP", 1, 10, dt.date(2000, 1, 2), Decimal("30")),
                               ("WIND", 1, 10, dt.date(2000, 1, 2), Decimal("5"))], S.WEATHER_DAILY)
    all_rows = {r.variable: r.value for r in monthly.monthly_weather_long(w).collect()}
    assert all_rows == {"TEMP": 20.0, "WIND": 5.0}
    only = monthly.monthly_weather_long(w, variable_filter=F.col("arithmetic_mean") > 9)
    assert {r.variable: r.value for r in only.collect()} == {"TEMP": 20.0}
