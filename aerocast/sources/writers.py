"""Sinks (K1-K6).

* ``write_table``: Parquet, optionally partitioned (``param``/``year``); the
  re-aim of the per-pollutant CSV folders, batch folders (K2) and keyed-store
  tables (K3). No ``coalesce(1)``: every task writes its own file.
* ``export_csv``: CSV with header for people and spreadsheets (K1, K6); only
  this export may ask for a single file.
* ``coerce``: cast a frame to a target schema (K4); rows whose key or measure
  would not convert go to a quarantine frame instead of failing the write.
* ``upsert``: keyed upsert, ``existing ⟕anti new ∪ new``, written to a new
  version directory (the store's primary-key overwrite, made atomic by
  publishing a new version rather than rewriting files in place).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..session import scratch_path


def write_table(df: DataFrame, path: str, partition_by=None, mode: str = "overwrite") -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a fresh path of the shared folder and read back: several uses, one evaluation."""
    path = scratch_path(df.sparkSession, f"stage-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def export_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> str:
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).option("sep", ",").csv(path)
    return path


def stage_daily(daily: DataFrame, root: str, name_col: str = "param", fmt: str = "parquet",
                header_names: bool = False) -> str:
    """Write daily readings partitioned by (code, year): scans of a year range
    or of one pollutant then open only those directories."""
    df = daily.withColumn("year", F.year("date_local"))
    if header_names:
        inv = {v: k for k, v in S.DAILY_CSV_COLUMNS.items()}
        df = df.select(*[F.col(c).alias(inv.get(c, c)) for c in df.columns])
    # one directory's rows meet in few tasks; AQE splits the large ones
    w = df.hint("rebalance", name_col, "year").write.mode("overwrite").partitionBy(name_col, "year")
    if fmt == "csv":
        w.option("header", True).csv(root)
    else:
        w.parquet(root)
    return root


def write_sorted(df: DataFrame, path: str, order, files: int | None = None) -> str:
    """O1 as a sink: files by ranges of ``order``, each sorted, so that their positions make one order.

    ``files``: how many at most; by default as many as the shuffle has parts, small ones joined.
    """
    df.repartitionByRange(*([] if files is None else [files]), *order).sortWithinPartitions(*order).write.mode("errorifexists").parquet(path)
    return path


def replace_days(daily: DataFrame, root: str, name_col: str = "param") -> str:
    """Republish daily readings as raw CSV: the ``name_col=/year=`` folders they fall in are replaced, all others stay."""
    df = daily.withColumn("year", F.year("date_local"))
    inv = {v: k for k, v in S.DAILY_CSV_COLUMNS.items()}
    df = df.select(*[F.col(c).alias(inv.get(c, c)) for c in df.columns]).hint("rebalance", name_col, "year")
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(name_col, "year").option("header", True).csv(root)
    return root


def none_lost(good_and_bad: tuple[DataFrame, DataFrame]) -> DataFrame:
    """The good rows, after counting the quarantined ones (one pass over the source): any of them ends the job by name."""
    good, bad = good_and_bad
    reasons = [f"{r['reason']}: {r['count']}" for r in bad.groupBy("reason").count().collect()]
    if reasons:
        raise ValueError(f"rows in quarantine: {', '.join(sorted(reasons))}")
    return good


def coerce(df: DataFrame, schema: T.StructType, keys) -> tuple[DataFrame, DataFrame]:
    """K4: ``(good, quarantine)``. A value that is present but does not convert,
    or a missing key, sends the row to quarantine with a reason."""
    casts = {f.name: F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})") for f in schema.fields}
    typed = df.select(*[casts[f.name].alias(f.name) for f in schema.fields],
                      *[F.col(f.name).alias(f"_raw_{f.name}") for f in schema.fields])
    checks = [F.when(F.col(k).isNull(), F.lit(f"null key {k}")) for k in keys]
    checks += [F.when(F.col(f"_raw_{f.name}").isNotNull() & F.col(f.name).isNull(), F.lit(f"bad {f.name}"))
               for f in schema.fields]
    reason = F.coalesce(*checks)
    typed = typed.withColumn("_reason", reason)
    good = typed.where(F.col("_reason").isNull()).select(*[f.name for f in schema.fields])
    bad = typed.where(F.col("_reason").isNotNull()).select(
        *[F.col(f"_raw_{f.name}").cast("string").alias(f.name) for f in schema.fields],
        F.col("_reason").alias("reason"))
    return good, bad


def upsert(spark: SparkSession, new: DataFrame, keys, table_root: str, existing: DataFrame | None = None,
           latest_by=()) -> str:
    """K3: keyed upsert into ``table_root/v<N>``; returns the new version's path.

    ``existing`` defaults to the latest version under ``table_root``. The new
    version is fully written before it becomes the latest, so a failed job
    leaves the previous version intact. Of several new rows with one key the greatest by
    ``latest_by``, then by the other columns, is kept. ``new`` is evaluated once.
    """
    staged = scratch_path(spark, "upsert")
    new.write.parquet(staged)
    new = spark.read.parquet(staged)
    order = [F.col(c).desc_nulls_last() for c in [*latest_by, *[c for c in new.columns if c not in (*keys, *latest_by)]]]
    if order:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        new = new.withColumn("_place", place).where("_place = 1").drop("_place")
    else:
        new = new.dropDuplicates(list(keys))
    version = latest_version(spark, table_root)
    if existing is None and version is not None:
        existing = spark.read.parquet(f"{table_root}/v{version}")
    merged = new if existing is None else (
        existing.join(new.select(*keys), list(keys), "left_anti").unionByName(new.select(*existing.columns)))
    nxt = 0 if version is None else version + 1
    path = f"{table_root}/v{nxt}"
    merged.write.mode("errorifexists").parquet(path)
    return path


def latest_version(spark: SparkSession, table_root: str) -> int | None:
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(table_root)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(hpath)]
    versions = [int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit()
                and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{table_root}/{n}/_SUCCESS"))]
    return max(versions) if versions else None

