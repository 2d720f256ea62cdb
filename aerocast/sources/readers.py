"""Sources (S1-S7).

* Daily pollutant / weather CSV files (S1, S2, S6, S7): one multi-path read for
  every (code, year) file -- never a per-year loop of reads and unions -- with
  the raw header names mapped to typed columns. Code and year come from the
  data, from Hive-style partition directories (``param=44201/year=2013``), or
  from the reference's file names ``daily_<code>_<year>.csv`` through
  ``_metadata.file_path``. Text is parsed with ``try_cast``/``try_to_date``
  (ANSI stays on everywhere else), and rows whose keys do not parse go to a
  quarantine frame instead of failing the job (D7, D9).
* Prediction grid CSV (S3), with its header always honoured (D5).
* Stage tables (S4, S5): Parquet directories, optionally registered as views.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S

_FILE_CODE = r"daily_([A-Za-z0-9_]+?)_(\d{4})\.csv"


def _num(raw: str, t: T.DataType) -> Column:
    if isinstance(t, T.IntegralType):  # "24" and "24.0" both read as 24
        number = F.expr(f"try_cast(try_cast(`{raw}` AS DECIMAL(38,6)) AS {t.simpleString()})")
        return F.when(_plain(raw, t), F.expr(f"try_cast(`{raw}` AS {t.simpleString()})")).otherwise(number)
    return F.expr(f"try_cast(`{raw}` AS {t.simpleString()})")


def _plain(raw: str, t: T.DataType) -> Column:
    """Whether the text is a number that the type surely holds exactly: few digits, no exponent, no white space."""
    digits, places = (9, 0) if isinstance(t, T.IntegralType) else (t.precision - t.scale, t.scale)
    return F.col(f"`{raw}`").rlike(rf"^[+-]?[0-9]{{1,{digits}}}" + (rf"(\.[0-9]{{1,{places}}})?" if places else "") + r"\z")


def _code_from_path(df: DataFrame, col: str) -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), _FILE_CODE, 1 if col == "code" else 2)


def read_daily_csv(spark: SparkSession, paths, kind: str = "pollutant", code: str | None = None,
                   key_columns=("State Code", "County Code"), base_path: str | None = None,
                   with_file: bool = False) -> tuple[DataFrame, DataFrame]:
    """Read raw daily CSV files into the typed daily schema.

    ``base_path``: the root of the partition folders when ``paths`` are single files below it; ``with_file`` adds each row's ``file``.

    ``kind`` is ``pollutant`` (column ``param``) or ``weather`` (``variable``).
    Returns ``(good, quarantine)``; quarantine rows keep the raw text and a
    ``reason``.
    """
    return parted(read_daily_rows(spark, paths, kind, code, key_columns, base_path, with_file), kind)


def parted(rows: DataFrame, kind: str = "pollutant") -> tuple[DataFrame, DataFrame]:
    """``(good, quarantine)`` of what ``read_daily_rows`` read."""
    good = rows.where(F.col("_reason").isNull()).drop(*[c for c in rows.columns if c.startswith("_")])
    bad = rows.where(F.col("_reason").isNotNull()).select(
        "param" if kind == "pollutant" else "variable", F.col("_raw_state").alias("raw_state_code"), F.col("_raw_date").alias("raw_date"),
        F.col("_reason").alias("reason"))
    return good, bad


def read_daily_rows(spark: SparkSession, paths, kind: str = "pollutant", code: str | None = None,
                    key_columns=("State Code", "County Code"), base_path: str | None = None, with_file: bool = False) -> DataFrame:
    """All rows of raw daily CSV files, good or not (``read_daily_csv``), with ``_reason``: null, or why the row goes to quarantine."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    at = {} if base_path is None else {"basePath": base_path}
    raw = (spark.read.options(**at).option("header", True).option("inferSchema", False)
           .option("mode", "PERMISSIVE").csv(paths))
    # the first file's header is the schema, and a file with other columns or another order is refused
    raw = (spark.read.options(**at).schema(raw.schema).option("header", True).option("enforceSchema", False)
           .option("mode", "PERMISSIVE").csv(paths))
    name_col = "param" if kind == "pollutant" else "variable"
    if code is not None:
        name = F.lit(code)
    elif name_col in raw.columns:
        name = F.col(name_col).cast("string")
    else:
        name = F.nullif(_code_from_path(raw, "code"), F.lit(""))
    if "year" in raw.columns:
        file_year = F.col("year").cast("int")
    else:
        file_year = F.nullif(_code_from_path(raw, "year"), F.lit("")).try_cast("int")
    measures = S.MEASURES if kind == "pollutant" else ["arithmetic_mean"]
    types = S.MEASURE_TYPES if kind == "pollutant" else {"arithmetic_mean": S.WEATHER_MEASURE_TYPE}
    inv = {v: k for k, v in S.DAILY_CSV_COLUMNS.items()}
    state_raw, county_raw = key_columns
    typed = raw.select(
        name.alias(name_col),
        _num(state_raw, T.IntegerType()).alias("state_code"),
        (_num(county_raw, T.IntegerType()) if county_raw in raw.columns else F.lit(None).cast("int"))
        .alias("county_code"),
        F.expr(f"try_to_date(`{inv['date_local']}`, 'yyyy-MM-dd')").alias("date_local"),
        *[_num(inv[m], types[m]).alias(m) for m in measures],
        file_year.alias("_file_year"), *([F.col("_metadata.file_path").alias("file")] if with_file else []),
        F.col(f"`{state_raw}`").alias("_raw_state"), F.col(f"`{inv['date_local']}`").alias("_raw_date"),
        *[F.col(f"`{inv[m]}`").alias(f"_raw_{m}") for m in measures])
    reason = (F.when(F.col(name_col).isNull(), F.lit("no code"))
              .when(F.col("state_code").isNull(), F.lit("bad state code"))
              .when(F.col("date_local").isNull(), F.lit("bad date"))
              .when(F.col("_file_year").isNotNull() & (F.year("date_local") != F.col("_file_year")),
                    F.lit("date outside file year")))
    for m in measures:  # a value that does not parse, or does not fit its type exactly, is not cut or lost
        text = F.nullif(F.trim(F.col(f"_raw_{m}")), F.lit(""))
        wide = text.try_cast("decimal(38,18)")
        reason = reason.when(text.isNotNull() & ~_plain(f"_raw_{m}", types[m]) & (F.col(m).isNull() | (wide != F.col(m))), F.lit(f"bad {m}"))
    return typed.withColumn("_reason", reason)


def read_grid_csv(spark: SparkSession, path: str, keys=S.KEYS_STATE) -> DataFrame:
    """S3: the prediction grid (keys, month, year) with its header honoured."""
    schema = T.StructType([*[T.StructField(k, T.IntegerType()) for k in keys],
                           T.StructField("month", T.IntegerType()), T.StructField("year", T.IntegerType())])
    return spark.read.schema(schema).option("header", True).csv(path)


def read_table(spark: SparkSession, path: str, view: str | None = None) -> DataFrame:
    """A stage table (Parquet directory, possibly partitioned), optionally as a view."""
    df = spark.read.parquet(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def read_sorted(spark: SparkSession, path: str, order) -> tuple[DataFrame, DataFrame]:
    """(rows with ``position``, index) of what ``writers.write_sorted`` wrote.

    The index has one row a file: least and greatest key, rows, and the position of its first row. Files whose ranges
    overlap, or whose rows are out of order, give positions that contradict the keys.
    """
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    key = F.struct(*order)
    files = rows.groupBy("_file").agg(F.min(key).alias("first_key"), F.max(key).alias("last_key"), F.count("*").alias("n_rows"))
    before = Window.orderBy("first_key").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    index = files.withColumn("first_position", F.coalesce(F.sum("n_rows").over(before), F.lit(0)))
    out = rows.join(index.select("_file", "first_position"), "_file").withColumn("position", F.col("first_position") + F.col("_row"))
    return out.drop("_file", "_row", "first_position"), index


def read_years(spark: SparkSession, root: str, years=None, params=None) -> DataFrame:
    """U1 as one read of a ``param=/year=`` partitioned Parquet table.

    Filters on the partition columns: only the directories of ``years`` and ``params`` (default: all) are opened.
    """
    df = spark.read.schema(S.staged_daily_schema()).parquet(root)
    for col, wanted in (("year", years and [int(y) for y in years]), ("param", params)):
        if wanted is not None:
            df = df.where(F.col(col).isin(list(wanted)))
    return df
