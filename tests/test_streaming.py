from aerocast import fixtures as X
from aerocast.operators import monthly
from aerocast.session import scratch_path
from aerocast.sources import writers
from aerocast.streaming import monthly as SM

from conftest import SF_SMALL


def test_stream_equals_batch(spark):
    daily = X.pollutant_daily(spark, SF_SMALL)
    root = scratch_path(spark, "t_stream_src")
    writers.stage_daily(daily, root)
    out = scratch_path(spark, "t_stream_out")
    SM.monthly_pollutant_stream(spark, root, out, scratch_path(spark, "t_stream_ckpt"))
    got = SM.latest_monthly(spark, out)
    want = monthly.monthly_pollutant(daily)
    cols = want.columns
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.collect()))


def test_stream_incremental_runs_and_late_data(spark):
    from pyspark.sql import functions as F
    daily = X.pollutant_daily(spark, SF_SMALL)
    early = daily.where((F.year("date_local") < 1999) & (F.dayofmonth("date_local") <= 15))
    late = daily.where((F.year("date_local") >= 1999) | (F.dayofmonth("date_local") > 15))
    root = scratch_path(spark, "t_stream_inc_src")
    out = scratch_path(spark, "t_stream_inc_out")
    ckpt = scratch_path(spark, "t_stream_inc_ckpt")
    writers.stage_daily(early, root)
    SM.monthly_pollutant_stream(spark, root, out, ckpt)
    first = SM.latest_monthly(spark, out)
    assert sorted(map(tuple, first.select(monthly.monthly_pollutant(early).columns).collect())) == \
        sorted(map(tuple, monthly.monthly_pollutant(early).collect()))
    # more files land (new years, and the second half of months already published)
    (late.withColumn("year", F.year("date_local")).write.mode("append")
     .partitionBy("param", "year").parquet(root))
    SM.monthly_pollutant_stream(spark, root, out, ckpt)
    got = SM.latest_monthly(spark, out)
    want = monthly.monthly_pollutant(daily)
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
