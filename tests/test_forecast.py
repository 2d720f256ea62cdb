import pytest

from aerocast.operators import forecast


def _train(spark):
    rows = [(v, k, y, m, float(10 * k + m + (y - 1996)), ) for v in ("TEMP", "WIND") for k in (1, 2, 3)
            for y in range(1996, 2001) for m in range(1, 13)]
    return spark.createDataFrame(rows, "variable string, state_code int, year int, month int, value double")


def _grid(spark, keys=(1, 2, 3)):
    return spark.createDataFrame([(k, 2001, m) for k in keys for m in range(1, 13)],
                                 "state_code int, year int, month int")


@pytest.mark.parametrize("kind", ["rf", "dt"])
def test_pooled_tree_forecast_in_label_range_and_deterministic(spark, kind):
    tr = _train(spark)
    a = forecast.pooled_forecast(tr, _grid(spark), "variable", ["TEMP", "WIND"], ["state_code"],
                                 ["month", "year"], kind=kind)
    rows = a.collect()
    assert len(rows) == 2 * 36
    lo, hi = tr.agg({"value": "min"}).first()[0], tr.agg({"value": "max"}).first()[0]
    assert all(lo - 1e-9 <= r.prediction <= hi + 1e-9 for r in rows)
    b = forecast.pooled_forecast(tr, _grid(spark), "variable", ["TEMP", "WIND"], ["state_code"],
                                 ["month", "year"], kind=kind)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, b.collect()))


def test_untrained_pairs_get_no_forecast(spark):
    tr = _train(spark).where("state_code IN (1, 2) AND NOT (variable = 'WIND' AND state_code = 2)")
    out = forecast.pooled_forecast(tr, _grid(spark), "variable", ["TEMP", "WIND"], ["state_code"],
                                   ["month", "year"], kind="dt")
    keys = {(r.variable, r.state_code) for r in out.collect()}
    assert keys == {("TEMP", 1), ("TEMP", 2), ("WIND", 1)}


def test_more_keys_do_not_change_a_key_with_its_own_mean(spark):
    from pyspark.sql import functions as F
    tr = _train(spark).where("variable = 'TEMP'")
    many = tr.unionByName(tr.where("state_code = 1").select("variable", F.explode(F.sequence(F.lit(100), F.lit(160))).alias("state_code"),
                                                            "year", "month", F.lit(1e6).alias("value")))
    out = forecast.pooled_forecast(many, _grid(spark, (1,)), "variable", ["TEMP"], ["state_code"], ["month", "year"], kind="dt")
    assert all(0 < r.prediction < 100 for r in out.collect())



def test_name_without_training_rows_gets_no_forecast(spark):
    train = spark.createDataFrame([("a", 1, y, m, float(y + m)) for y in (1999, 2000) for m in range(1, 13)],
                                  "variable string, state_code int, year int, month int, value double")
    grid = spark.createDataFrame([(1, 2001, m) for m in range(1, 13)], "state_code int, year int, month int")
    for fit in (forecast.within_linear_forecast, forecast.pooled_forecast):
        out = fit(train, grid, "variable", ["a", "b"], ["state_code"], ["month", "year"])
        assert {r.variable for r in out.collect()} == {"a"} and out.count() == 12


def test_within_fit_equals_least_squares_with_an_intercept_for_each_key(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    rows = [("a", k, y, m, float(rng.normal())) for k in (1, 2, 3) for y in (1998, 1999, 2000) for m in range(1, 13)]
    train = spark.createDataFrame(rows, "variable string, state_code int, year int, month int, value double")
    grid = spark.createDataFrame([(k, 2001, m) for k in (1, 2, 3) for m in range(1, 13)], "state_code int, year int, month int")
    out = forecast.within_linear_forecast(train, grid, "variable", ["a"], ["state_code"], ["month", "year"])
    got = {(r.state_code, r.month): r.prediction for r in out.collect()}

    def design(k, y, m):
        return [k == 1, k == 2, k == 3, m, y - 2000]
    x = np.array([design(k, y, m) for _, k, y, m, _ in rows], dtype=float)
    b = np.linalg.lstsq(x, np.array([r[4] for r in rows]), rcond=None)[0]
    for (k, m), v in got.items():
        assert abs(v - np.dot(np.array(design(k, 2001, m), dtype=float), b)) < 1e-8
