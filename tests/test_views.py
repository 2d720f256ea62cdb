from aerocast.operators import align
from aerocast.plans import oracle as Q
from aerocast.plans import stages as ST
from aerocast.plans.views import register_views

from conftest import SF_CHECK

K = ["state_code", "year", "month"]


def test_sql_chain_over_views_equals_one_shuffle_combine(spark):
    register_views(spark, SF_CHECK)
    spark.sql("SELECT param, state_code, year + 1 AS year, month, max_value AS prediction "
              "FROM pollutant_monthly").createOrReplaceTempView("arms")
    for mode in ("merge", "reference"):
        sql = Q.chain("grid", "arms", "param", "prediction", ST.POLLUTANT_ARM_COLUMNS, mode)
        via_sql = spark.sql(sql)
        arms = spark.table("arms")
        via_df = align.combine_long(spark.table("grid"), arms, K, "param", "prediction",
                                    ST.POLLUTANT_ARM_COLUMNS, mode)
        cols = via_sql.columns
        assert sorted(map(tuple, via_sql.collect()), key=repr) == \
            sorted(map(tuple, via_df.select(cols).collect()), key=repr), mode


def test_views_are_queryable(spark):
    names = register_views(spark, SF_CHECK)
    for n in names:
        assert spark.sql(f"SELECT count(*) AS n FROM {n}").first().n > 0
