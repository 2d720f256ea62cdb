import datetime as dt

import pytest

from aerocast import schema as S
from aerocast.sources import readers, writers

HEADER = ("State Code,County Code,Date Local,Observation Count,Observation Percent,"
          "1st Max Value,1st Max Hour,Arithmetic Mean\n")


def _write(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(HEADER + "".join(lines))


def test_daily_csv_code_and_year_from_file_name_and_quarantine(spark, tmp_path):
    _write(tmp_path / "original" / "daily_42401_2013.csv", [
        "06,001,2013-01-02,24,100,3.5,7,1.25\n",
        "xx,001,2013-01-03,24,100,3.5,7,1.25\n",        # bad state code
        "06,001,2013-13-45,24,100,3.5,7,1.25\n",        # bad date
        "06,001,2014-01-01,24,100,3.5,7,1.25\n",        # outside the file's year
    ])
    _write(tmp_path / "original" / "daily_44201_2014.csv", ["04,013,2014-07-09,17,98.5,0.061,11,0.0442\n"])
    good, bad = readers.read_daily_csv(spark, [str(tmp_path / "original" / "daily_*.csv")])
    rows = sorted((r.param, r.state_code, r.date_local, float(r.max_value)) for r in good.collect())
    assert rows == [("42401", 6, dt.date(2013, 1, 2), 3.5), ("44201", 4, dt.date(2014, 7, 9), 0.061)]
    assert sorted(r.reason for r in bad.collect()) == ["bad date", "bad state code", "date outside file year"]


def test_staged_csv_roundtrip_is_exact(spark, tmp_path):
    from decimal import Decimal
    rows = [("42101", 1, 10, dt.date(1999, 5, d), 1, Decimal("95.000000"), Decimal("12.3456789012"),
             3, Decimal("11.728395110000")) for d in (1, 2)]
    daily = spark.createDataFrame(rows, S.POLLUTANT_DAILY)
    root = str(tmp_path / "staged")
    writers.stage_daily(daily, root, fmt="csv", header_names=True)
    good, bad = readers.read_daily_csv(spark, root)
    assert bad.count() == 0
    assert sorted(map(tuple, good.select(daily.columns).collect())) == sorted(map(tuple, daily.collect()))


def test_grid_csv_header_is_honoured(spark, tmp_path):
    p = tmp_path / "test.csv"
    p.write_text("state_code,month,year\n1,1,2018\n1,2,2018\n")
    g = readers.read_grid_csv(spark, str(p))
    assert [tuple(r) for r in g.collect()] == [(1, 1, 2018), (1, 2, 2018)]


def test_read_years_opens_only_listed_partitions(spark, tmp_path):
    from decimal import Decimal
    rows = [(p, 1, 10, dt.date(y, 1, 1), 1, Decimal("1"), Decimal("1"), 1, Decimal("1"))
            for p in ("42101", "44201") for y in (1998, 1999, 2000)]
    root = str(tmp_path / "parts")
    writers.stage_daily(spark.createDataFrame(rows, S.POLLUTANT_DAILY), root)
    got = readers.read_years(spark, root, [1999, 2000], params=["42101"])
    assert sorted((r.param, r.year) for r in got.collect()) == [("42101", 1999), ("42101", 2000)]


def test_coerce_quarantines_bad_values(spark):
    raw = spark.createDataFrame([("1", "2.5"), (None, "1.0"), ("3", "abc")], "k string, v string")
    schema = S.POLLUTANT_DAILY.__class__([S.POLLUTANT_DAILY["state_code"].__class__("k", S.T.IntegerType()),
                                          S.POLLUTANT_DAILY["state_code"].__class__("v", S.T.DoubleType())])
    good, bad = writers.coerce(raw, schema, ["k"])
    assert [tuple(r) for r in good.collect()] == [(1, 2.5)]
    assert sorted(r.reason for r in bad.collect()) == ["bad v", "null key k"]


def test_upsert_versions(spark, tmp_path):
    root = str(tmp_path / "table")
    v0 = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    assert writers.upsert(spark, v0, ["k"], root).endswith("/v0")
    v1 = spark.createDataFrame([(2, "new"), (3, "new")], "k int, v string")
    path = writers.upsert(spark, v1, ["k"], root)
    assert path.endswith("/v1") and writers.latest_version(spark, root) == 1
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "old"), (2, "new"), (3, "new")]
    assert spark.read.parquet(root + "/v0").count() == 2  # previous version intact


def test_export_csv_and_read_table(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0)], "a int, b double")
    writers.export_csv(df, str(tmp_path / "csv"), single_file=True)
    assert len(list((tmp_path / "csv").glob("part-*.csv"))) == 1
    writers.write_table(df, str(tmp_path / "pq"))
    assert readers.read_table(spark, str(tmp_path / "pq"), view="t_view").count() == 1
    assert spark.sql("SELECT count(*) AS n FROM t_view").first().n == 1


def test_weather_csv_variable_from_file_name(spark, tmp_path):
    from decimal import Decimal
    head = "State Code,County Code,Date Local,Arithmetic Mean\n"
    (tmp_path / "support").mkdir()
    (tmp_path / "support" / "daily_RH_DP_2014.csv").write_text(head + "06,037,2014-03-01,41.5\n")
    (tmp_path / "support" / "daily_TEMP_2014.csv").write_text(head + "06,037,2014-03-01,61.25\n06,037,x,1\n")
    good, bad = readers.read_daily_csv(spark, str(tmp_path / "support" / "*.csv"), kind="weather")
    rows = sorted((r.variable, r.state_code, r.county_code, r.arithmetic_mean) for r in good.collect())
    assert rows == [("RH_DP", 6, 37, Decimal("41.500000")), ("TEMP", 6, 37, Decimal("61.250000"))]
    assert [r.reason for r in bad.collect()] == ["bad date"]


def test_files_with_another_column_order_are_refused(spark, tmp_path):
    head = "State Code,County Code,Date Local,Observation Count,Observation Percent,1st Max Value,1st Max Hour,Arithmetic Mean"
    swapped = head.replace("State Code,County Code", "County Code,State Code")
    for name, h in (("daily_42401_1996.csv", head), ("daily_42401_1997.csv", swapped)):
        (tmp_path / name).write_text(f"{h}\n6,1,{name[12:16]}-01-02,24,100,1.5,3,1.25\n")
    good, _ = readers.read_daily_csv(spark, [str(tmp_path / "daily_42401_1996.csv"), str(tmp_path / "daily_42401_1997.csv")])
    with pytest.raises(Exception, match="(?i)header"):
        good.collect()


def test_measures_are_neither_cut_nor_lost(spark, tmp_path):
    head = "State Code,County Code,Date Local,Observation Count,Observation Percent,1st Max Value,1st Max Hour,Arithmetic Mean"
    rows = ["24,100,1.5,3,1.25", "24.5,100,1.5,3,1.25", "24,100,0.123456789012345,3,1.25", "24,100,1.5,3,abc", "24.0,100,1.5,,1.25"]
    (tmp_path / "daily_42401_1996.csv").write_text("\n".join([head, *[f"6,1,1996-01-02,{r}" for r in rows]]) + "\n")
    good, bad = readers.read_daily_csv(spark, str(tmp_path / "daily_42401_1996.csv"))
    assert good.count() == 2
    assert sorted(r.reason for r in bad.collect()) == ["bad arithmetic_mean", "bad max_value", "bad observation_count"]


def test_upsert_keeps_one_row_a_key(spark):
    from aerocast.session import scratch_path
    root = scratch_path(spark, "test_upsert")
    df = lambda rows: spark.createDataFrame(rows, "k int, t int, v string")
    writers.upsert(spark, df([(1, 1, "a"), (2, 1, "b")]), ["k"], root)
    path = writers.upsert(spark, df([(2, 5, "old"), (2, 9, "new"), (2, 9, "new"), (3, 1, "c")]), ["k"], root, latest_by=["t"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, 1, "a"), (2, 9, "new"), (3, 1, "c")]


def test_sorted_files_give_positions_and_quarantine_is_not_lost(spark, tmp_path):
    import pytest
    from pyspark.sql import functions as F
    df = spark.range(5000).select((F.hash("id") % 997).alias("a"), F.col("id").alias("b"))
    path = writers.write_sorted(df.repartition(5), str(tmp_path / "s"), ["a", "b"], files=4)
    rows, index = readers.read_sorted(spark, path, ["a", "b"])
    got = [(r.a, r.b) for r in sorted(rows.collect(), key=lambda r: r.position)]
    assert got == sorted((r.a, r.b) for r in df.collect()) and len(got) == 5000
    files = sorted(tuple(r) for r in index.select("first_position", "n_rows", "first_key", "last_key").collect())
    assert len(files) > 1 and all(x[0] + x[1] == y[0] and x[3] < y[2] for x, y in zip(files, files[1:]))
    none = spark.createDataFrame([], "reason string")
    assert writers.none_lost((df, none)) is df
    with pytest.raises(ValueError, match="bad date: 2"):
        writers.none_lost((df, spark.createDataFrame([("bad date",), ("bad date",)], "reason string")))
