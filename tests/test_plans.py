"""Guards on physical plans: the properties that matter at scale."""
import contextlib
import datetime as dt
import io
import re
from decimal import Decimal

import pandas as pd

from aerocast import fixtures as X
from aerocast import schema as S
from aerocast.operators import align, index, monthly
from aerocast.plans import stages as ST

from conftest import SF_CHECK, SF_SMALL


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def _shuffles(p):
    return len(re.findall(r"Exchange hashpartitioning|Exchange \(|ShuffleExchange", p))


def test_monthly_scan_is_pruned_and_filtered(spark):
    p = plan(monthly.monthly_pollutant(X.pollutant_daily(spark, SF_CHECK)))
    scan = [l for l in p.splitlines() if l.startswith("ReadSchema: struct<l_")][0]
    for unused in ("l_partkey", "l_tax", "l_orderkey"):
        assert unused not in scan
    assert "In(l_returnflag" in p and "In(l_linestatus" in p


def test_monthly_aggregation_is_partial_then_one_exchange(spark):
    df = monthly.monthly_pollutant(X.pollutant_daily(spark, SF_CHECK))
    p = plan(df, "simple")
    assert "partial_sum" in p
    assert p.count("Exchange hashpartitioning") == 1


def test_weather_pivot_is_one_aggregation(spark):
    p = plan(monthly.monthly_weather(X.weather_daily(spark, SF_CHECK)), "simple")
    assert p.count("Exchange hashpartitioning") == 1 and "pivotfirst" not in p.lower()


def test_merge_combine_is_one_shuffle(spark):
    g = X.grid(spark, SF_CHECK)
    arms = ST.pollutant_naive_arms(spark, SF_CHECK)
    out = align.combine_long(g, arms, ["state_code", "year", "month"], "param", "prediction",
                             ST.POLLUTANT_ARM_COLUMNS)
    p = plan(out, "simple")
    # monthly aggregate under the arms, distinct keys of the place dimension (grid), the combine
    assert p.count("Exchange hashpartitioning") == 3
    assert "SortMergeJoin" not in p and "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_dominant_pollutant_has_no_window(spark):
    long = ST.pollutant_long(spark, SF_CHECK)
    p = plan(index.dominant_pollutant(long, ["state_code", "year", "month"]), "simple")
    assert "Window" not in p and "min_by" in p


def test_no_cross_joins_anywhere(spark):
    import __spark_entry__ as E
    for name in ["prediction_grid", "end_to_end_linear", "combine_forecasts_reference", "forecast_error"]:
        p = plan(E.queries()[name](spark, SF_CHECK), "simple")
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_hot_key_holding_a_third_of_rows(spark):
    rows = []
    for i in range(3000):
        st = 0 if i % 3 == 0 else 1 + i % 50          # state 0 holds a third of all readings
        rows.append(("42101", st, st, dt.date(2000, 1 + i % 12, 1 + i % 28), 1, Decimal("90"),
                     Decimal(f"{(i % 997) / 7:.10f}"), 3, Decimal("1")))
    daily = spark.createDataFrame(rows, S.POLLUTANT_DAILY).repartition(16)
    got = monthly.monthly_pollutant(daily).toPandas().set_index(["state_code", "month"]).sort_index()
    pdf = pd.DataFrame(rows, columns=[f.name for f in S.POLLUTANT_DAILY.fields])
    pdf["month"] = [d.month for d in pdf.date_local]
    want = pdf.groupby(["state_code", "month"]).max_value.apply(lambda s: float(sum(s)) / len(s)).sort_index()
    assert (got.max_value - want).abs().max() < 1e-12


def test_long_subindex_needs_no_join_of_its_own(spark):
    import __spark_entry__ as E
    p = plan(E.queries()["aqi_subindex"](spark, SF_CHECK), "simple")
    assert p.count("BroadcastHashJoin") == 2  # supplier and nation
    assert "NestedLoop" not in p and "Exchange hashpartitioning" not in p


def test_weather_scan_has_pushed_priority_filter(spark):
    p = plan(monthly.monthly_weather(X.weather_daily(spark, SF_CHECK)))
    assert "In(o_orderpriority" in p
    scan = [l for l in p.splitlines() if l.startswith("ReadSchema: struct<o_")][0]
    assert "o_comment" not in scan and "o_orderstatus" not in scan


#: Two evaluations by their feature: the stale table, then the fresh months.
TWO_PASSES = {"upsert_monthly"}
#: The tables and plans of the decision-tree forms, with slower fits.
SAME_AS_DT = ("forecast_gbt", "forecast_rf", "model_check_gbt", "model_check_rf")


def test_each_fact_table_is_scanned_once(spark, monkeypatch):
    from aerocast.operators import forecast
    from aerocast.plans.queries import REGISTRY
    from aerocast.sources import writers
    plans = []

    def recorded(fn):
        def wrapper(df, *args):
            plans.append(plan(df, "simple"))
            return fn(df, *args)
        return wrapper

    monkeypatch.setattr(writers, "stage", recorded(writers.stage))
    monkeypatch.setattr(forecast, "stable", recorded(forecast.stable))
    many = {}
    for name, q in REGISTRY.items():
        if name in TWO_PASSES or name.startswith(SAME_AS_DT):
            continue
        plans.clear()
        plans.append(plan(q.run(spark, SF_SMALL), "simple"))
        scans = [line for p in plans for line in p.splitlines() if "FileScan parquet" in line]
        for col in ("l_shipdate", "o_orderdate"):
            if (n := sum(col in line for line in scans)) > 1:
                many[name, col] = n
    assert not many


def test_year_windows_reach_the_scan(spark, monkeypatch):
    import __spark_entry__ as E
    from aerocast.sources import writers
    staged, real = [], writers.stage
    monkeypatch.setattr(writers, "stage", lambda df, *args: (staged.append(plan(df)), real(df, *args))[1])  # what a query stores has scans too
    for name, bounds in {"recent_training": ("1998-01-01", "2001-01-01"), "forecast_linear_weather": ("2001-01-01",),
                         "forecast_linear_pollutant": ("2001-01-01",), "end_to_end_linear": ("2001-01-01",)}.items():
        staged.clear()
        p = "\n".join([plan(E.queries()[name](spark, SF_SMALL)), *staged])
        pushed = " ".join(line for line in p.splitlines() if line.startswith("PushedFilters") and "date" in line)
        assert all(b in pushed for b in bounds), (name, pushed)


def test_reference_chain_has_no_full_outer_join(spark):
    import __spark_entry__ as E
    for name in ("combine_forecasts_reference", "grid_with_weather_reference"):
        assert "FullOuter" not in plan(E.queries()[name](spark, SF_SMALL), "simple")


def test_monthly_means_keep_no_decimal_buffers(spark):
    p = plan(monthly.monthly_features(X.pollutant_units(spark, SF_CHECK), X.weather_units(spark, SF_CHECK)))
    partial = [line for line in p.splitlines() if line.startswith("Functions") and "partial_sum" in line]
    assert partial and not any("decimal" in line.lower() or "UnscaledValue" in line for line in partial)
