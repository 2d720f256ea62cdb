"""Incremental ingest of republished daily files.

Every file's contribution to the monthly means is kept as exact sums and counts, with the file's path, length and time. A new run lists the
files, reads those that are new or changed, and subtracts what changed or removed files had contributed; all others are not opened. Sums are
exact decimals, so the result is that of reading everything anew.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators.monthly import with_year_month
from . import readers, tables


@dataclass(frozen=True)
class Run:
    """What one run did: files read, files whose contribution was taken out, rows that went to quarantine."""

    read: list[str]
    removed: list[str]
    quarantined: int


def _measures(kind: str) -> list[str]:
    return S.MEASURES if kind == "pollutant" else ["arithmetic_mean"]


def _name(kind: str) -> str:
    return "param" if kind == "pollutant" else "variable"


def _sums(daily: DataFrame, kind: str, keys, by=()) -> DataFrame:
    m = _measures(kind)
    return with_year_month(daily).groupBy(*by, _name(kind), *keys, "year", "month").agg(
        *[F.sum(c).cast("decimal(38,12)").alias(f"sum_{c}") for c in m], *[F.count(c).alias(f"n_{c}") for c in m])


def _read_once(rows: DataFrame, kind: str, keys, path: str) -> DataFrame:
    """Sums of the good rows by file (``good``), and a row for each file with rows that go to quarantine (not ``good``), stored in ``path``.

    One pass over the files finds both.
    """
    good = F.col("_reason").isNull()
    columns = [_name(kind), *keys, "date_local", *_measures(kind)]
    own = rows.select("file", good.alias("good"), *[F.when(good, F.col(c)).alias(c) for c in columns])
    out = _sums(own, kind, keys, ["file", "good"])
    out.write.parquet(path)
    return rows.sparkSession.read.schema(out.schema).parquet(path)


def _added(df: DataFrame, kind: str, keys) -> DataFrame:
    m = _measures(kind)
    cols = [f"sum_{c}" for c in m] + [f"n_{c}" for c in m]
    out = df.groupBy(_name(kind), *keys, "year", "month").agg(*[F.sum(c).cast(df.schema[c].dataType).alias(c) for c in cols])
    return out.where(" OR ".join(f"n_{c} <> 0" for c in m))


def ingest(spark: SparkSession, source: str, root: str, kind: str = "pollutant", keys=S.KEYS_COUNTY) -> Run:
    """Brings the state under ``root`` up to the CSV files under ``source`` (in ``<name>=/year=`` folders).

    The state is one small table a run: totals, and each file's contribution. It is published like a table version.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(source)
    here = {r.path: f"{r.length} {r.modificationTime}" for r in files.select("path", "length", "modificationTime").collect()}
    base = tables.current(spark, root)
    state = json.loads(base.partitions["state"]) if base.partitions else {"files": {}, "totals": None}
    before = state["files"]
    changed = sorted(p for p in here if p not in before or before[p]["stamp"] != here[p])
    removed = sorted(p for p in before if here.get(p) != before[p]["stamp"])
    if not changed and not removed:
        return Run([], [], 0)
    parts, bad_rows, path = [], 0, None
    if changed:
        path = f"{root}/files-{uuid.uuid4().hex}"
        rows = readers.read_daily_rows(spark, changed, kind, base_path=source, with_file=True)
        summed = _read_once(rows, kind, keys, f"{root}/read-{uuid.uuid4().hex}")
        summed.where("good").drop("good").write.parquet(path)
        bad = readers.parted(rows, kind)[1]
        quarantine = f"{root}/quarantine-{uuid.uuid4().hex}"
        # the files are read again only where some row of theirs goes to quarantine
        (spark.createDataFrame([], bad.schema) if summed.where("NOT good").isEmpty() else bad).write.parquet(quarantine)
        bad_rows = spark.read.schema(bad.schema).parquet(quarantine).count()
        parts.append(spark.read.parquet(path).drop("file"))
    if state["totals"]:
        parts.append(spark.read.parquet(state["totals"]))
    m = _measures(kind)
    gone: dict[str, list[str]] = {}
    for p in removed:
        gone.setdefault(before[p]["rows"], []).append(p)
    for rows, paths in gone.items():
        old = spark.read.parquet(rows).where(F.col("file").isin(paths)).drop("file")
        parts.append(old.select(*[(-F.col(c)).cast(old.schema[c].dataType).alias(c) if c in {f"sum_{x}" for x in m} | {f"n_{x}" for x in m}
                                  else F.col(c) for c in old.columns]))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    totals = f"{root}/totals-{uuid.uuid4().hex}"
    _added(every, kind, keys).write.parquet(totals)
    kept = {p: f for p, f in before.items() if p not in removed} | {p: {"stamp": here[p], "rows": path} for p in changed}
    tables.publish(spark, f"{root}/_manifest/{base.number + 1:012d}.json", json.dumps({"state": json.dumps({"files": kept, "totals": totals})}))
    return Run(changed, removed, bad_rows)


def monthly_means(spark: SparkSession, root: str, kind: str = "pollutant", keys=S.KEYS_COUNTY) -> DataFrame:
    """A1, A2: monthly means of everything ingested: pollutant measures by (param, ``keys``), or weather as ``value`` by (variable, ``keys``).

    ``keys`` are those of the state or some of them: its sums add up.
    """
    totals = spark.read.parquet(json.loads(tables.current(spark, root).partitions["state"])["totals"])
    sums = _added(totals, kind, keys)
    out = {c: (F.col(f"sum_{c}").cast("string").cast("double") / F.col(f"n_{c}")) for c in _measures(kind)}
    names = [c if kind == "pollutant" else "value" for c in out]
    return sums.select(_name(kind), *keys, "year", "month", *[v.alias(n) for v, n in zip(out.values(), names, strict=True)])
