from aerocast.operators import align

K = ["state_code", "year", "month"]


def _grid(spark):
    return spark.createDataFrame([(1, 2001, 1), (1, 2001, 2)], "state_code int, year int, month int")


def _arm(spark, rows, col):
    return spark.createDataFrame(rows, f"state_code int, year int, month int, {col} double")


def test_merge_mode_coalesces_keys(spark):
    a = _arm(spark, [(1, 2001, 1, 10.0), (9, 2001, 1, 11.0)], "a")
    b = _arm(spark, [(9, 2001, 1, 20.0), (1, 2001, 2, 21.0)], "b")
    out = {(r.state_code, r.year, r.month): (r.a, r.b)
           for r in align.outer_chain(_grid(spark), {"a": a, "b": b}, K, "merge").collect()}
    assert out == {(1, 2001, 1): (10.0, 0.0), (1, 2001, 2): (0.0, 21.0), (9, 2001, 1): (11.0, 20.0)}


def test_reference_mode_keeps_unmatched_rows_apart_with_null_keys(spark):
    a = _arm(spark, [(1, 2001, 1, 10.0), (9, 2001, 1, 11.0)], "a")
    b = _arm(spark, [(9, 2001, 1, 20.0), (1, 2001, 2, 21.0)], "b")
    rows = align.outer_chain(_grid(spark), {"a": a, "b": b}, K, "reference").collect()
    assert len(rows) == 4  # 2 grid rows + one unmatched row per arm, never merged
    nulls = sorted((r.a, r.b) for r in rows if r.state_code is None)
    assert nulls == [(0.0, 20.0), (11.0, 0.0)]
    keyed = {(r.state_code, r.month): (r.a, r.b) for r in rows if r.state_code is not None}
    assert keyed == {(1, 1): (10.0, 0.0), (1, 2): (0.0, 21.0)}


def test_fill_none_leaves_gaps(spark):
    a = _arm(spark, [(1, 2001, 1, 10.0)], "a")
    out = {r.month: r.a for r in align.outer_chain(_grid(spark), {"a": a}, K, "merge", fill=None).collect()}
    assert out == {1: 10.0, 2: None}


def test_merge_mode_reduces_duplicate_arm_rows(spark):
    a = _arm(spark, [(1, 2001, 1, 10.0), (1, 2001, 1, 20.0)], "a")
    out = {r.month: r.a for r in align.outer_chain(_grid(spark), {"a": a}, K, "merge").collect()}
    assert out == {1: 15.0, 2: 0.0}


def test_row_count_property_reference_mode(spark):
    grid = spark.createDataFrame([(1, 2001, m) for m in range(1, 13)], "state_code int, year int, month int")
    arms = {f"c{i}": _arm(spark, [(1, 2001 + (m % (i + 2) == 0), m, float(m)) for m in range(1, 13)], f"c{i}")
            for i in range(3)}
    unmatched = sum(a.join(grid, K, "left_anti").count() for a in arms.values())
    out = align.outer_chain(grid, arms, K, "reference")
    assert out.count() == grid.count() + unmatched


def test_long_form_matches_dict_form(spark):
    long = spark.createDataFrame([("x", 1, 2001, 1, 1.0), ("y", 1, 2001, 2, 2.0), ("y", 7, 2001, 2, 3.0)],
                                 "n string, state_code int, year int, month int, v double")
    cols = {"x": "col_x", "y": "col_y"}
    for mode in ("merge", "reference"):
        got = sorted(map(tuple, align.combine_long(_grid(spark), long, K, "n", "v", cols, mode).collect()),
                     key=str)
        arms = {c: long.where(long.n == n).select(*K, long.v.alias(c)) for n, c in cols.items()}
        want = sorted(map(tuple, align.outer_chain(_grid(spark), arms, K, mode).collect()), key=str)
        assert got == want


def test_history_and_forecast_union_by_name(spark):
    h = spark.createDataFrame([(1, 2000, 1, 5.0)], "state_code int, year int, month int, value double")
    f = spark.createDataFrame([(7.0, 1, 2001, 1)], "value double, month int, year int, state_code int")
    rows = align.history_and_forecast(h, f).collect()
    assert {(r.year, r.month, r.value, r.kind) for r in rows} == {(2000, 1, 5.0, "history"), (2001, 1, 7.0, "forecast")}
