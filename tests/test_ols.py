import numpy as np
import pytest
from aerocast.operators import ols
from pyspark.sql import functions as F

FEATURES = ["month", "year", "x1", "x2"]


def table(spark, seed=1, n=40, groups=3):
    r = np.random.RandomState(seed)
    rows = [(g, 1996 + i // 12, i % 12 + 1, float(r.standard_normal() * 1e4), float(r.rand()), float(r.standard_normal() * 10.0 ** g))
            for g in range(groups) for i in range(n)]
    return spark.createDataFrame(rows, "g int, year int, month int, x1 double, x2 double, y double")


def by_numpy(p, use):
    x = np.column_stack([np.ones(len(p)), *[p[c].to_numpy(float) for c in use]])
    return np.linalg.lstsq(x, p["y"].to_numpy(), rcond=None)[0]


def values(fit, p, use):
    return fit.level + sum(b * (p[c] - m) for b, m, c in zip(fit.slopes, fit.means, use))


def test_equal_to_numpy(spark):
    df = table(spark)
    p = df.toPandas()
    for r in ols.fit(df, ["g"], FEATURES, "y").collect():
        mine = p[p.g == r.g]
        beta = by_numpy(mine, FEATURES)
        assert r.n == 40 and np.allclose(r.fit.slopes, beta[1:], rtol=1e-5, atol=1e-9)
        assert np.allclose(values(r.fit, mine, FEATURES), beta[0] + sum(b * mine[c] for b, c in zip(beta[1:], FEATURES)), rtol=1e-5, atol=1e-6)


def test_rank_deficient_groups_have_a_fit(spark):
    rows = [(0, 2000, 3, 1.0, 2.0, 5.0)] + [(1, 2000, m, 2.0 * m, 1.0, 3.0 * m) for m in range(1, 9)] + [(2, 2000, 1, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g int, year int, month int, x1 double, x2 double, y double")
    got = {r.g: r for r in ols.fit(df, ["g"], FEATURES, "y").collect()}
    assert set(got) == {0, 1}
    assert list(got[0].fit.slopes) == [0.0] * 4 and got[0].fit.level == 5.0
    assert np.allclose(got[1].fit.slopes, [3, 0, 0, 0])  # x1 is twice the month, year and x2 are constant


def test_equations_do_not_depend_on_partitions_and_subtract_exactly(spark):
    df = table(spark, 2)
    a = ols.equations(df.repartition(7), ["g"], FEATURES, "y").orderBy("g").collect()
    assert a == ols.equations(df.coalesce(1), ["g"], FEATURES, "y").orderBy("g").collect()
    parts = ols.equations(df.withColumn("fold", F.col("month") % 4), ["g", "fold"], FEATURES, "y")
    left = ols.all_but(parts, ["g"], "fold", 5).where("fold = 1").drop("fold").orderBy("g").collect()
    direct = ols.equations(df.where("month % 4 != 1"), ["g"], FEATURES, "y").orderBy("g").collect()
    assert [tuple(r) for r in left] == [tuple(r) for r in direct]


def test_split_is_exact_and_keyed(spark):
    df = table(spark, 3, n=37)
    train, test = ols.split_by_hash(df, ["g"], ["year", "month"])
    again = ols.split_by_hash(df.repartition(7), ["g"], ["year", "month"])[1]
    key = ["g", "year", "month"]
    assert sorted(test.select(key).collect()) == sorted(again.select(key).collect())
    assert {r["count"] for r in test.groupBy("g").count().collect()} == {7} and train.count() == 3 * 30
    other = ols.split_by_hash(df, ["g"], ["year", "month"], seed=1)[1]
    assert sorted(test.select(key).collect()) != sorted(other.select(key).collect())


def test_cross_fit_equals_refitting_each_fold(spark):
    df = table(spark, 4, n=23)
    models = {"mean": [], "year": ["year"], "all": FEATURES}
    got = {(r.g, r.model): (r.mse, r.n_test) for r in ols.cross_fit(df, ["g"], ["year", "month"], models, "y").collect()}
    p = ols.hash_rank(df, ["g"], ["year", "month"]).toPandas()
    for (g, m), (mse, n) in got.items():
        mine, errors = p[p.g == g], []
        for k in range(5):
            train, test = mine[mine._rank % 5 != k], mine[mine._rank % 5 == k]
            beta = by_numpy(train, models[m])
            errors += list(beta[0] + sum(b * test[c] for b, c in zip(beta[1:], models[m])) - test["y"]) if models[m] else list(train["y"].mean() - test["y"])
        assert n == 23 and mse == pytest.approx(np.mean(np.square(errors)), rel=1e-4)
    assert len(got) == 9


def test_empty(spark):
    df = table(spark).where("g < 0")
    assert ols.fit(df, ["g"], FEATURES, "y").count() == 0
    assert ols.cross_fit(df, ["g"], ["year", "month"], {"mean": [], "all": FEATURES}, "y").count() == 0
    one = table(spark, n=1)
    assert ols.cross_fit(one, ["g"], ["year", "month"], {"mean": []}, "y").count() == 0
