import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_CHECK, SF_SMALL

TABLES = "region nation customer supplier part orders lineitem".split()
QUICK = ["monthly_pollutant", "monthly_weather_pivot", "monthly_features_county", "aqi_subindex",
         "first_60_months", "forecast_linear_weather", "combine_forecasts_reference", "aqi_dominant",
         "holdout_mse", "best_model", "forecast_error", "end_to_end_linear"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields] == ["param", "state_code", "year", "month", "max_value", "aqi"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def _cell(v):
    if v is None or v != v:
        return None
    return float(v) if isinstance(v, (int, float)) or hasattr(v, "dtype") else v


def _norm(pdf):
    pdf = pdf[sorted(pdf.columns)]
    return sorted((tuple(_cell(v) for v in row) for row in pdf.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", QUICK)
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_CHECK}/{t}.parquet')")
    got = E.queries()[name](spark, SF_CHECK).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _norm(got) == _norm(want)


def test_sf_small_runs(spark):
    assert E.queries()["end_to_end_linear"](spark, SF_SMALL).count() > 0
