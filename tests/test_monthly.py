import datetime as dt

import pytest
import random
from decimal import Decimal

from aerocast import schema as S
from aerocast.functions.stats import exact_mean, exact_sum, round_sig
from aerocast.operators import monthly
from pyspark.sql import functions as F


def _daily(spark, rows):
    rows = [(*r[:5], None if r[5] is None else Decimal(r[5]), *r[6:]) for r in rows]
    return spark.createDataFrame(rows, S.POLLUTANT_DAILY)


def _weather(spark, rows):
    return spark.createDataFrame(rows, S.WEATHER_DAILY)


def D(x):
    return Decimal(str(x))


def _p(param, st, day, v):
    return (param, st, st * 10, day, 1, 90, D(v), 3, D(v / 2))


def test_monthly_means_unweighted(spark):
    rows = [_p("42101", 1, dt.date(2000, 1, d), v) for d, v in [(1, 1.0), (2, 2.0), (3, 6.0)]]
    rows.append(_p("42101", 1, dt.date(2000, 2, 1), 10.0))
    out = {(r.month): r.max_value for r in monthly.monthly_pollutant(_daily(spark, rows)).collect()}
    assert out == {1: 3.0, 2: 10.0}


def test_month_without_all_weather_is_dropped(spark):
    p = _daily(spark, [_p("42101", 1, dt.date(2000, 1, 5), 1.0), _p("42101", 1, dt.date(2000, 2, 5), 1.0)])
    w_rows = [(v, 1, 10, dt.date(2000, 1, 3), D(5)) for v in S.WEATHER_VARIABLES]
    w_rows += [(v, 1, 10, dt.date(2000, 2, 3), D(5)) for v in S.WEATHER_VARIABLES[:3]]
    f = monthly.monthly_features(p, _weather(spark, w_rows))
    assert [(r.year, r.month) for r in f.collect()] == [(2000, 1)]
    r = f.first()
    assert (r.am_wind, r.am_temp, r.am_rh, r.am_press) == (5.0, 5.0, 5.0, 5.0)


def test_state_filter_and_county_key(spark):
    p = _daily(spark, [_p("42101", 6, dt.date(2000, 1, 5), 1.0), _p("42101", 7, dt.date(2000, 1, 5), 2.0)])
    w = _weather(spark, [(v, s, s * 10, dt.date(2000, 1, 3), D(5)) for v in S.WEATHER_VARIABLES for s in (6, 7)])
    f = monthly.monthly_features(p, w, keys=S.KEYS_COUNTY, state=6)
    assert [(r.state_code, r.county_code) for r in f.collect()] == [(6, 60)]


def test_input_order_does_not_change_result(spark):
    rng = random.Random(7)
    rows = [_p(rng.choice(S.POLLUTANTS), rng.randint(0, 4), dt.date(2000, rng.randint(1, 12), rng.randint(1, 28)),
               round(rng.uniform(0, 500), 4)) for _ in range(400)]
    a = monthly.monthly_pollutant(_daily(spark, rows).repartition(1))
    rng.shuffle(rows)
    b = monthly.monthly_pollutant(_daily(spark, rows).repartition(7))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))  # bit-identical


def test_exact_mean_and_double_mean_agree_closely(spark):
    df = spark.createDataFrame([(Decimal("0.1"),), (Decimal("0.2"),), (Decimal("0.4"),)], "x decimal(18,2)")
    e = df.agg(exact_mean("x").alias("m")).first().m
    a = df.agg(exact_mean("x", exact=False).alias("m")).first().m
    assert e == 0.7 / 3 and abs(e - a) < 1e-15


def test_round_sig(spark):
    df = spark.createDataFrame([(123456789.123,), (0.000123456789123,), (0.0,), (-98765.4321,)], "x double")
    got = [r.r for r in df.select(round_sig(F.col("x"), 4).alias("r")).collect()]
    assert got == pytest.approx([123500000.0, 0.0001235, 0.0, -98770.0], rel=1e-15)


def test_sums_of_units_are_exact(spark):
    rng = random.Random(11)
    values = [rng.randint(-2**60, 2**60) for _ in range(3000)] + [2**60, -2**60, 2**30, -2**30, -1, 0, 1, 2**30 - 1] * 20
    rows = [(i % 3, v if i % 7 else None) for i, v in enumerate(values)] + [(9, None)]
    df = spark.createDataFrame(rows, "k int, v long").repartition(7)
    got = {r.k: r for r in df.groupBy("k").agg(exact_sum(F.col("v")).alias("s"), exact_mean("v", scale=12).alias("m")).collect()}
    for k in range(3):
        own = [v for key, v in rows if key == k and v is not None]
        assert int(got[k].s) == sum(own) and got[k].m == float(Decimal(sum(own)) / 10**12) / len(own)
    assert got[9].s is None and got[9].m is None


def test_units_and_decimals_have_the_same_means(spark):
    from aerocast import fixtures as X
    sf, keys = "/root/testdata/sf0.001", S.KEYS_COUNTY
    for a, b in ((monthly.monthly_pollutant(X.pollutant_units(spark, sf), keys), monthly.monthly_pollutant(X.pollutant_daily(spark, sf), keys)),
                 (monthly.monthly_weather(X.weather_units(spark, sf), keys), monthly.monthly_weather(X.weather_daily(spark, sf), keys)),
                 (monthly.monthly_weather_long(X.weather_units(spark, sf)), monthly.monthly_weather_long(X.weather_daily(spark, sf)))):
        rows = sorted(map(tuple, a.collect()), key=repr)
        assert rows and rows == sorted(map(tuple, b.collect()), key=repr)
