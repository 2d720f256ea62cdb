"""SQL text for the DuckDB oracle: common table expressions built from the
driver's tables, mirroring ``aerocast.fixtures`` and the operators.

Each builder returns ``name AS (...)`` fragments; ``with_ctes`` joins them.
"""

from __future__ import annotations

from .. import schema as S
from ..functions.stats import FIXED_STEPS, sql_fixed
from ..functions.stats import sql_exact_mean as mean


# Concentration and index level at the band ends of each pollutant, for the SQL
# side alone (the Spark side has its own table).
INDEX_POINTS = {
    "44201": "0:0 0.055:51 0.071:101 0.086:151 0.106:201 0.201:301",
    "42401": "0:0 36:51 76:101 186:151 305:201 605:301 805:401 1005:500",
    "42101": "0:0 4.5:51 9.5:101 12.5:151 15.5:201 30.5:301 40.5:401 50.5:500",
    "42602": "0:0 54:51 101:101 361:151 650:201 1250:301 1650:401 2050:500",
    "88101": "0:0 12.1:51 35.5:101 55.5:151 150.5:201 250.5:301 350.5:401 500.5:500",
    "88502": "0:0 12.1:51 35.5:101 55.5:151 150.5:201 250.5:301 350.5:401 500.5:500",
}


def sql_subindex(value: str, param: str) -> str:
    """The sub-index as SQL: one line per band, one less than the last level above, and the line through (0, 0) and
    (last concentration, 500) below zero."""
    v = f"CAST({value} AS DOUBLE)"
    pts = [tuple(f"{x}e0" for x in p.split(":")) for p in INDEX_POINTS[param].split()]
    line = [f"WHEN {v} < {g} THEN ({v} - {f}) * ({a} - {b}) / ({g} - {f}) + {b}" for (f, b), (g, a) in zip(pts, pts[1:])]
    top, level = pts[-1]
    return (f"(CASE WHEN {v} IS NULL OR isnan({v}) THEN CAST(NULL AS DOUBLE) WHEN {v} >= {top} THEN {level} - 1e0 "
            f"WHEN {v} < 0e0 THEN ({v} - {top}) * (0e0 - 500e0) / (0e0 - {top}) + 500e0 {' '.join(line)} END)")


def sql_subindex_by_param(value: str, param: str) -> str:
    return "(CASE " + " ".join(f"WHEN {param} = '{p}' THEN {sql_subindex(value, p)}" for p in INDEX_POINTS) + " END)"


def d(x: float) -> str:
    """A DOUBLE literal (scientific notation parses as DOUBLE, exactly)."""
    r = repr(float(x))
    return r if "e" in r else r + "e0"


def case(expr: str, mapping: dict, quote_values: bool = True) -> str:
    whens = " ".join(
        f"WHEN {expr} = '{k}' THEN " + (f"'{v}'" if quote_values else d(v)) for k, v in mapping.items())
    return f"(CASE {whens} END)"


def pollutant_daily() -> str:
    tops = {p: str(S.CONCENTRATION_LEVELS[p][-1]) for p in S.POLLUTANTS}
    top = "(CASE " + " ".join(f"WHEN param = '{p}' THEN CAST({v} AS DECIMAL(7,3))" for p, v in tops.items()) + " END)"
    t = {m: S.sql_type(S.MEASURE_TYPES[m]) for m in S.MEASURES}
    return f"""
pd_raw AS (
  SELECT {case("l.l_returnflag || l.l_linestatus", S.FLAG_TO_POLLUTANT)} AS param,
         n.n_regionkey AS state_code, n.n_nationkey AS county_code,
         CAST(l.l_shipdate AS DATE) AS date_local,
         l.l_quantity, CAST(l.l_extendedprice AS DECIMAL(9,2)) AS price,
         CAST(CAST(1 AS DECIMAL(3,2)) - CAST(l.l_discount AS DECIMAL(3,2)) AS DECIMAL(3,2)) AS keep,
         l.l_discount, l.l_linenumber
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
),
pd_mv AS (
  SELECT *, CAST(price * {top} * CAST(0.00001 AS DECIMAL(6,5)) AS {t["max_value"]}) AS max_value
  FROM pd_raw WHERE param IS NOT NULL
),
pollutant_daily AS (
  SELECT param, state_code, county_code, date_local,
         CAST(round(l_quantity) AS INTEGER) AS observation_count,
         100 - CAST(round(l_discount * 100.0e0) AS INTEGER) AS observation_percent,
         max_value,
         CAST(l_linenumber AS INTEGER) AS max_hour,
         CAST(max_value * keep AS {t["arithmetic_mean"]}) AS arithmetic_mean
  FROM pd_mv
)"""


def weather_daily() -> str:
    return f"""
weather_daily AS (
  SELECT * FROM (
    SELECT {case("o.o_orderpriority", S.PRIORITY_TO_VARIABLE)} AS variable,
           n.n_regionkey AS state_code, n.n_nationkey AS county_code,
           CAST(o.o_orderdate AS DATE) AS date_local,
           CAST(o.o_totalprice AS {S.sql_type(S.WEATHER_MEASURE_TYPE)}) AS arithmetic_mean
    FROM orders o
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
  ) WHERE variable IS NOT NULL
)"""


def ym(col: str = "date_local") -> str:
    return f"CAST(year({col}) AS INTEGER) AS year, CAST(month({col}) AS INTEGER) AS month"


def monthly_pollutant(keys=("state_code",), name="monthly_pollutant", source="pollutant_daily") -> str:
    k = ", ".join(keys)
    aggs = ", ".join(f"{mean(m)} AS {m}" for m in S.MEASURES)
    return f"""
{name} AS (
  SELECT param, {k}, year, month, {aggs}
  FROM (SELECT *, {ym()} FROM {source})
  GROUP BY param, {k}, year, month
)"""


def monthly_weather(keys=("state_code",), name="monthly_weather") -> str:
    k = ", ".join(keys)
    aggs = ", ".join(
        f"{mean(f'CASE WHEN variable = {chr(39)}{v}{chr(39)} THEN arithmetic_mean END')} AS {S.WEATHER_COLUMNS[v]}"
        for v in S.WEATHER_VARIABLES)
    return f"""
{name} AS (
  SELECT {k}, year, month, {aggs}
  FROM (SELECT *, {ym()} FROM weather_daily)
  GROUP BY {k}, year, month
)"""


def monthly_weather_long(keys=("state_code",), name="weather_long") -> str:
    k = ", ".join(keys)
    return f"""
{name} AS (
  SELECT variable, {k}, year, month, {mean("arithmetic_mean")} AS value
  FROM (SELECT *, {ym()} FROM weather_daily)
  GROUP BY variable, {k}, year, month
)"""


def monthly_features(keys=("state_code",), name="monthly_features",
                     pollutant="monthly_pollutant", weather="monthly_weather") -> str:
    k = ", ".join(f"p.{c}" for c in keys)
    on = " AND ".join(f"p.{c} = w.{c}" for c in (*keys, "year", "month"))
    wcols = ", ".join(f"w.{c}" for c in S.WEATHER_COLUMNS.values())
    notnull = " AND ".join(f"w.{c} IS NOT NULL" for c in S.WEATHER_COLUMNS.values())
    meas = ", ".join(f"p.{m}" for m in S.MEASURES)
    return f"""
{name} AS (
  SELECT p.param, {k}, p.year, p.month, {meas}, {wcols}
  FROM {pollutant} p JOIN {weather} w ON {on}
  WHERE {notnull}
)"""


def grid(keys=("state_code",), name="grid", year=S.GRID_YEAR) -> str:
    src = {"state_code": "n_regionkey AS state_code", "county_code": "n_nationkey AS county_code"}
    sel = ", ".join(src[k] for k in keys)
    return f"""
{name} AS (
  SELECT {", ".join(keys)}, CAST(month AS INTEGER) AS month, CAST({year} AS INTEGER) AS year
  FROM (SELECT {", ".join(keys)}, unnest(range(1, 13)) AS month FROM (SELECT DISTINCT {sel} FROM nation))
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",".join(c.strip("\n") for c in ctes) + "\n"


# -- stages (mirrors aerocast.plans.stages) -------------------------------------

STATE = ("state_code",)


def pollutant_long(name="pollutant_long", keys=STATE, source="monthly_pollutant") -> str:
    return f"""
{name} AS (SELECT param, {", ".join(keys)}, year, month, max_value AS value FROM {source})"""


def in_training(src: str) -> str:
    return f"(SELECT * FROM {src} WHERE year <= {S.TRAIN_LAST_YEAR})"


def weather_train(name="weather_train", truncate_label=False, keys=STATE, source="weather_long") -> str:
    v = "trunc(value) AS value" if truncate_label else "value"
    k = ", ".join(keys)
    return f"""
{name} AS (
  SELECT variable, {k}, year, month, {v} FROM {in_training(source)}
)"""


def _on(keys, a="g", b="f") -> str:
    return " AND ".join(f"{a}.{k} = {b}.{k}" for k in keys)


def weather_forecast(name="weather_forecast", keys=STATE, train="weather_train", grid_name="grid") -> str:
    from ..operators.linear import sql_ols2, sql_ols2_value
    gk = ", ".join(f"g.{k}" for k in keys)
    return f"""
wfit_{name} AS ({sql_ols2(train, ["variable", *keys])}),
{name} AS (
  SELECT f.variable, {gk}, g.year, g.month, {sql_ols2_value("f", "g")} AS prediction
  FROM {grid_name} g JOIN wfit_{name} f ON {_on(keys)}
)"""


def pollutant_forecast(name="pollutant_forecast", keys=STATE, source="pollutant_long", grid_name="grid") -> str:
    from ..operators.linear import sql_trend, sql_trend_value
    gk = ", ".join(f"g.{k}" for k in keys)
    return f"""
pfit_{name} AS ({sql_trend(in_training(source), ["param", *keys])}),
{name} AS (
  SELECT f.param, {gk}, g.year, g.month, {sql_trend_value(fit="f", grid="g")} AS prediction
  FROM {grid_name} g JOIN pfit_{name} f ON {_on(keys)}
)"""


def naive(src: str, name_col: str, name: str, keys=STATE) -> str:
    return f"""
{name} AS (SELECT {name_col}, {", ".join(keys)}, year + 1 AS year, month, CAST(value AS DOUBLE) AS prediction
           FROM {src})"""


def chain(grid_name: str, long_name: str, name_col: str, value_col: str, columns: dict,
          mode: str, keys=("state_code", "year", "month"), fill=0.0) -> str:
    """SQL of the grid's outer chain (both D1 modes) over a long table of arms."""
    arms, sel = [], []
    for i, (n, c) in enumerate(columns.items()):
        src = f"(SELECT {', '.join(keys)}, avg({value_col}) AS {c} FROM {long_name} WHERE {name_col} = '{n}' " \
              f"GROUP BY {', '.join(keys)})" if mode == "merge" else \
              f"(SELECT {', '.join(keys)}, {value_col} AS {c} FROM {long_name} WHERE {name_col} = '{n}')"
        arms.append((f"a{i}", src, c))
        sel.append(f"coalesce(a{i}.{c}, {d(fill)}) AS {c}" if fill is not None else f"a{i}.{c}")
    if mode == "merge":
        body = f"{grid_name} t" + "".join(f" FULL OUTER JOIN {src} {a} USING ({', '.join(keys)})"
                                         for a, src, _ in arms)
        keysel = ", ".join(keys)
    else:
        body = f"{grid_name} t" + "".join(
            f" FULL OUTER JOIN {src} {a} ON " + " AND ".join(f"t.{k} = {a}.{k}" for k in keys)
            for a, src, _ in arms)
        keysel = ", ".join(f"t.{k} AS {k}" for k in keys)
    return f"SELECT {keysel}, {', '.join(sel)} FROM {body}"


# -- least squares on any number of features: plain sums a group, elimination by a recursive query --------------

def ols_sums(name: str, source: str, groups, features, label: str) -> str:
    """``name``: per group the count, sums and products of features and label in fixed point."""
    g, z = ", ".join(groups), [*features, label]
    k = range(len(z))
    cols = ", ".join([f"CAST(sum(z{i}) AS HUGEINT) AS s{i}" for i in k]
                     + [f"CAST(sum(z{i} * z{j}) AS HUGEINT) AS p{i}_{j}" for i in k for j in k if i <= j])
    return f"""
{name} AS (
  SELECT {g}, CAST(count(*) AS HUGEINT) AS n, {cols}
  FROM (SELECT {g}, {", ".join(f"{sql_fixed(c)} AS z{i}" for i, c in enumerate(z))} FROM {source}
        WHERE {" AND ".join(f"{c} IS NOT NULL" for c in z)})
  GROUP BY {g}
)"""


def ols_fit(name: str, sums: str, groups, size: int, use) -> str:
    """``name``: groups, ``beta`` and ``mid`` (lists), ``level`` from the sums of ``size`` variables, the last one the label."""
    from ..operators.ols import RANK_TOL
    g, k, cols = ", ".join(groups), len(use), [*use, size - 1]

    def num(e: str) -> str:
        return f"CAST(CAST({e} AS VARCHAR) AS DOUBLE)"

    def cell(i: int, j: int) -> str:
        a, b = min(i, j), max(i, j)
        return num(f"n * p{a}_{b} - s{i} * s{j}")

    rows = "[" + ", ".join("[" + ", ".join(cell(i, j) for j in cols) + "]" for i in use) + "]"
    mids = ", ".join(f"{num(f's{i}')} / (CAST(n AS DOUBLE) * {float(FIXED_STEPS)!r})" for i in use)
    return f"""
{name}_step AS (
  SELECT {g}, 1 AS pos, {rows} AS m, [{", ".join(cell(i, i) for i in use)}] AS spread FROM {sums}
  UNION ALL
  SELECT {g}, pos + 1, list_transform(m, lambda line, i: CASE WHEN i = pos THEN own
    ELSE list_transform(line, lambda v, c: v - line[pos] * own[c]) END), spread
  FROM (SELECT *, CASE WHEN m[pos][pos] > {d(RANK_TOL)} * spread[pos] THEN list_transform(m[pos], lambda v: v / m[pos][pos])
          ELSE list_transform(m[pos], lambda v: 0.0e0) END AS own FROM {name}_step WHERE pos <= {k})
),
{name} AS (
  SELECT * EXCLUDE (m, pos), list_transform(m, lambda line: line[{k + 1}]) AS beta FROM
    (SELECT {g}, m, pos FROM {name}_step WHERE pos = {k + 1})
  JOIN (SELECT {g}, [{mids}] AS mid, {num(f"s{size - 1}")} / (CAST(n AS DOUBLE) * {float(FIXED_STEPS)!r}) AS level FROM {sums}) USING ({g})
)"""


def hash_ranked(name: str, source: str, groups, keys, seed: int = 42) -> str:
    """``name``: the rows of ``source`` with ``place`` (from 0) by the md5 of seed and key, and ``size``, within their group."""
    g = ", ".join(groups)
    text = " || '|' || ".join([f"'{seed}'", *[f"CAST({c} AS VARCHAR)" for c in [*groups, *keys]]])
    return f"""
{name} AS (SELECT *, row_number() OVER (PARTITION BY {g} ORDER BY md5({text}), {", ".join(keys)}) - 1 AS place,
  count(*) OVER (PARTITION BY {g}) AS size FROM {source})"""


def cross_fitted(source: str, groups, models: dict, label: str, folds: int = 5) -> list[str]:
    """``cross_mse``: groups, model, mse, n_test; each fold is fitted on the rows of the others, gathered anew."""
    g, every = ", ".join(groups), list(dict.fromkeys(c for f in models.values() for c in f))
    out = [hash_ranked("ranked", source, groups, ["year", "month"]), f"""
folded AS (SELECT *, place % {folds} AS fold FROM ranked),
others AS (SELECT r.* EXCLUDE (fold), f.fold FROM folded r JOIN (SELECT DISTINCT fold FROM folded) f ON r.fold <> f.fold)""",
           ols_sums("fold_sums", "others", [*groups, "fold"], every, label)]
    scored = []
    for m, features in models.items():
        if features:
            out.append(ols_fit(f"fit_{m}", "fold_sums", [*groups, "fold"], len(every) + 1, [every.index(c) for c in features]))
        else:
            n = len(every)
            out.append(f"""
fit_{m} AS (SELECT {g}, fold, CAST(CAST(s{n} AS VARCHAR) AS DOUBLE) / (CAST(n AS DOUBLE) * {float(FIXED_STEPS)!r}) AS level FROM fold_sums)""")
        scored.append(f"SELECT {g}, '{m}' AS model, {ols_value(features, 'f', 'r')} - r.{label} AS e "
                      f"FROM folded r JOIN fit_{m} f USING ({g}, fold)")
    return [*out, f"""
cross_mse AS (SELECT {g}, model, avg(e * e) AS mse, count(*) AS n_test FROM ({" UNION ALL ".join(scored)}) GROUP BY {g}, model)"""]


def ols_value(features, fit: str = "f", row: str = "g") -> str:
    return f"{fit}.level" + "".join(f" + {fit}.beta[{i + 1}] * (CAST({row}.{c} AS DOUBLE) - {fit}.mid[{i + 1}])" for i, c in enumerate(features))


def feature_chain(keys=STATE) -> list[str]:
    """Weather by (month, year), the grid with that weather, pollutants by all six features: one fit a group each."""
    gk, kc = ", ".join(f"g.{k}" for k in keys), [*keys, "year", "month"]
    wf, pf = list(S.WEATHER_FEATURES), list(S.POLLUTANT_FEATURES)
    return [ols_sums("wsum", in_training("weather_long"), ["variable", *keys], wf, "value"), ols_fit("wols", "wsum", ["variable", *keys], 3, [0, 1]), f"""
wols_forecast AS (
  SELECT f.variable, {gk}, g.year, g.month, {ols_value(wf)} AS prediction FROM grid g JOIN wols f ON {_on(keys)})""", f"""
grid_weather AS ({chain("grid", "wols_forecast", "variable", "prediction", S.WEATHER_COLUMNS, "merge", kc)})""",
            ols_sums("psum", in_training("monthly_features"), ["param", *keys], pf, "max_value"),
            ols_fit("pols", "psum", ["param", *keys], 7, range(6)), f"""
features_forecast AS (
  SELECT f.param, {gk}, g.year, g.month, {ols_value(pf)} AS prediction FROM grid_weather g JOIN pols f ON {_on(keys)})"""]


def tree(name: str, train: str, score: str, groups, keys, features, label: str, depth: int, bins: int = 32) -> list[str]:
    """``name``: one regression tree a group, every threshold tried on the rows of every node; ``prediction`` for the rows of ``score``."""
    g, kk, k = ", ".join(groups), ", ".join(keys), len(features)
    xs = "[" + ", ".join(f"CAST({c} AS DOUBLE)" for c in features) + "]"
    whole = " AND ".join(f"{c} IS NOT NULL" for c in [*features, label])
    out = [f"""
{name}_rows AS (SELECT {g}, year, month, {xs} AS xs, {sql_fixed(label)} AS r FROM {train} WHERE {whole}),
{name}_x AS (SELECT {g}, year, month, f, xs[f] AS x FROM (SELECT *, unnest(range(1, {k + 1})) AS f FROM {name}_rows)),
{name}_v AS (SELECT {g}, f, list_sort(list(DISTINCT x)) AS v FROM {name}_x GROUP BY {g}, f),
{name}_cut AS (
  SELECT {g}, f, c, (v[c * len(v) // least(len(v), {bins})] + v[c * len(v) // least(len(v), {bins}) + 1]) / 2 AS t
  FROM (SELECT *, unnest(range(1, least(len(v), {bins}))) AS c FROM {name}_v)),
{name}_n1 AS (SELECT {g}, year, month, r, xs, 1 AS node FROM {name}_rows),
{name}_s1 AS (SELECT {g}, year, month, {xs} AS xs, 1 AS node FROM {score} JOIN (SELECT DISTINCT {g} FROM {name}_rows) USING ({kk}))"""]
    for at in range(1, depth + 1):
        move = "CASE WHEN f IS NULL THEN node ELSE 2 * node + CAST(xs[f] > t AS INTEGER) END AS node"
        out.append(f"""
{name}_b{at} AS (
  SELECT {g}, node, f, t FROM (
    SELECT *, CAST(CAST(sl * (nt - nl) - (st - sl) * nl AS VARCHAR) AS DOUBLE) AS apart FROM (
      SELECT {g}, node, f, c, t, count(*) FILTER (xs[f] <= t) AS nl, count(*) AS nt,
        coalesce(sum(r) FILTER (xs[f] <= t), 0) AS sl, sum(r) AS st
      FROM {name}_n{at} JOIN {name}_cut USING ({g}) GROUP BY {g}, node, f, c, t)
    WHERE nl > 0 AND nl < nt)
  WHERE apart <> 0 QUALIFY row_number() OVER (PARTITION BY {g}, node
    ORDER BY apart * apart / (CAST(nl AS DOUBLE) * CAST(nt - nl AS DOUBLE) * CAST(nt AS DOUBLE)) DESC, f, c) = 1),
{name}_n{at + 1} AS (SELECT {g}, year, month, r, xs, {move} FROM {name}_n{at} LEFT JOIN {name}_b{at} USING ({g}, node)),
{name}_s{at + 1} AS (SELECT {g}, year, month, xs, {move} FROM {name}_s{at} LEFT JOIN {name}_b{at} USING ({g}, node))""")
    return [*out, f"""
{name} AS (
  SELECT {g}, year, month, value AS prediction FROM {name}_s{depth + 1} JOIN (
    SELECT {g}, node, CAST(CAST(sum(r) AS VARCHAR) AS DOUBLE) / (count(*) * {float(FIXED_STEPS)!r}) AS value
    FROM {name}_n{depth + 1} GROUP BY {g}, node) USING ({g}, node))"""]
