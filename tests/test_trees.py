import numpy as np
import pytest
from aerocast.operators import trees
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F


def series(spark, groups=5, months=48, seed=1):
    r = np.random.RandomState(seed)
    rows = [(g, 1996 + i // 12, i % 12 + 1, float(r.randint(0, 9)), float(10.0 ** (g - 1) * (np.sin(i / 3) + 0.3 * r.rand())))
            for g in range(groups) for i in range(months)]
    return spark.createDataFrame(rows, "g int, year int, month int, x double, y double")


FEATURES = ["month", "year", "x"]


def by_ml(df, grid, model, features):
    assemble = VectorAssembler(inputCols=features, outputCol="features")
    return {(r.year, r.month): r.prediction for r in model.fit(assemble.transform(df)).transform(assemble.transform(grid)).collect()}


@pytest.mark.parametrize("kind,features", [("tree", FEATURES), ("boosted", FEATURES), ("boosted", ["x"])])
def test_equal_to_one_ml_model_a_group(spark, kind, features):
    """Training rows get the values of one ml model a group; so do new rows where no two features split a node alike
    (there the choice between equal gains is rounding noise in ml)."""
    boosted = kind == "boosted"
    df = series(spark) if len(features) > 1 else series(spark).withColumn("x", F.col("month") * 2 + 5.0 * ((F.col("year") - 1996) % 2))
    grid = spark.range(5).selectExpr("cast(id as int) g", "2000 year", "explode(sequence(1, 12)) month", "month * 2 + 0.25D x")
    got = trees.fit_and_forecast(df, grid, ["g"], ["g"], features, "y", trees=20 if boosted else 1, fitted=True).collect()
    model = GBTRegressor(labelCol="y") if boosted else DecisionTreeRegressor(labelCol="y")
    assert len(got) == 5 * (48 + 12)
    for g in range(0, 5, 4 if boosted else 1):
        own = df.where(F.col("g") == g).coalesce(1)
        both = own.select("year", "month", "x").unionByName(grid.where(F.col("g") == g).select("year", "month", "x"))
        want = by_ml(own, both, model, features)
        mine = {(r.year, r.month): r for r in got if r.g == g}
        assert mine.keys() == want.keys()
        for k, r in mine.items():
            if r._label is not None or len(features) == 1:
                assert r.prediction == pytest.approx(want[k], rel=2e-5, abs=1e-6)


def test_partitions_do_not_matter(spark):
    df = series(spark, 2, 60).withColumn("x", F.rand(3) * 100)
    df = spark.createDataFrame(df.collect(), df.schema)
    a = trees.fit_and_forecast(df.repartition(7), df, ["g"], ["g"], FEATURES, "y", trees=3, depth=3, bins=8).collect()
    b = trees.fit_and_forecast(df.coalesce(1), df, ["g"], ["g"], FEATURES, "y", trees=3, depth=3, bins=8).collect()
    assert sorted(a) == sorted(b)


def test_cut_points():
    assert trees.cut_points(np.array([3.0, 1.0, 2.0, 3.0])).tolist() == [1.5, 2.5]
    assert trees.cut_points(np.array([7.0, 7.0])).tolist() == [] == trees.cut_points(np.array([])).tolist()
    many = trees.cut_points(np.arange(100.0), 8)
    assert len(many) == 7 and np.diff(np.searchsorted(np.arange(100.0), many)).tolist() == [13, 12, 13, 12, 13, 12]


def test_large_values_stay_exact():
    x, y = np.arange(64.0)[:, None], np.where(np.arange(64) < 40, 5e9, -5e9)
    assert trees.predictions(x, y, 1, 1, 0.1, 32).tolist() == y.tolist()


def test_defined_results(spark):
    rows = [(0, 1999, 1, 1.0, 5.0), (1, 1999, 1, 1.0, 2.0), (1, 1999, 2, 1.0, 2.0), (2, 1999, 1, None, 1.0), (3, 1999, 1, 1.0, None)]
    df = spark.createDataFrame(rows, "g int, year int, month int, x double, y double")
    grid = df.select("g", "year", "month", F.lit(1.0).alias("x"))
    got = trees.fit_and_forecast(df, grid, ["g"], ["g"], FEATURES, "y", trees=2, depth=2)
    assert sorted((r.g, r.month, r.prediction) for r in got.collect()) == [(0, 1, 5.0), (1, 1, 2.0), (1, 2, 2.0)]
    assert trees.fit_and_forecast(df.where("g < 0"), grid, ["g"], ["g"], FEATURES, "y", trees=1).count() == 0
