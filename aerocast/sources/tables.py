"""Partitioned tables with a manifest (K3, K2): writes touch only their partitions, and are seen as a whole or not at all.

A table is a folder of data folders, one for each write, and of numbered manifests. A manifest names, for every partition
(``param=44201/year=1999``), the data folder that holds its current rows; the one with the highest number is the table. A commit
publishes the next number by a rename that fails if the number is taken, so of two writers that started from the
same version one loses, with nothing of its rows in the table. That is atomic where the store's rename is.

Manifests and partitions are listed through Spark's readers; only publishing and existence tests go to the file system.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


class StaleVersion(RuntimeError):
    """Another writer has published since this one read the table."""


@dataclass(frozen=True)
class Version:
    number: int = -1
    partitions: dict[str, str] = field(default_factory=dict)  # partition -> data folder


def _hadoop(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    _, p, fs = _hadoop(spark, path)
    return fs.exists(p)


def publish(spark: SparkSession, path: str, text: str) -> None:
    """``text`` as the file ``path``, whole or not at all; ``StaleVersion`` if there is one already."""
    jvm, target, fs = _hadoop(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(f"{path.rpartition('/')[0]}/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(context.makeQualified(draft), context.makeQualified(target),
                       spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Exception as e:
        fs.delete(draft, False)
        if fs.exists(target):
            raise StaleVersion(f"{path} was published by another writer") from e
        raise


def current(spark: SparkSession, root: str) -> Version:
    """The latest version; an empty one for a table that is not there."""
    if not exists(spark, f"{root}/_manifest"):
        return Version()
    files = [r.path for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(f"{root}/_manifest").select("path").collect()]
    if not files:
        return Version()
    last = max(files)
    held = json.loads("\n".join(r.value for r in spark.read.option("wholetext", True).text(last).collect()))
    return Version(int(last.rpartition("/")[2].removesuffix(".json")), held)


def _folders(df: DataFrame, base: str) -> list[str]:
    """The partition folders below ``base`` that hold files of ``df``."""
    mark = base.rstrip("/").rpartition("/")[2]
    return sorted({unquote(f).partition(f"/{mark}/")[2].rpartition("/")[0] for f in df.inputFiles()})  # listed as URIs


def read(spark: SparkSession, version: Version, schema: T.StructType, only: Iterable[str] | None = None) -> DataFrame:
    """The rows of a version, or of its partitions ``only``: no other folder is opened."""
    wanted = version.partitions if only is None else {p: version.partitions[p] for p in only if p in version.partitions}
    by_base: dict[str, list[str]] = {}
    for part, base in wanted.items():
        by_base.setdefault(base, []).append(f"{base}/{part}")
    out = None
    for base, paths in sorted(by_base.items()):
        df = spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)
        out = df if out is None else out.unionByName(df)
    return spark.createDataFrame([], schema) if out is None else out


def _one_a_key(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    rest = [*latest_by, *[c for c in df.columns if c not in (*keys, *latest_by)]]
    if not rest:
        return df.dropDuplicates(list(keys))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in rest]))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def upsert(spark: SparkSession, new: DataFrame, keys: Sequence[str], partition_by: Sequence[str], root: str,
           base: Version | None = None, latest_by: Sequence[str] = ()) -> Version:
    """Rows of ``new`` replace those with their keys; only the partitions that hold one are read and written.

    ``keys`` include ``partition_by``, so that a row never changes partitions. Of several new rows with one key the greatest by ``latest_by``,
    then by the other columns, stays. ``base`` is the version that the writer read (default: the current one); if it is no longer the current
    one at the end, ``StaleVersion`` is raised and the table is as the other writer left it.
    """
    if not set(partition_by) <= set(keys):
        raise ValueError(f"keys {list(keys)} lack a partition column of {list(partition_by)}")
    base = current(spark, root) if base is None else base
    schema = new.schema
    staged = f"{root}/staged-{uuid.uuid4().hex}"
    _one_a_key(new, keys, latest_by).write.partitionBy(*partition_by).parquet(staged)
    fresh = spark.read.schema(schema).parquet(staged).select(*schema.names)
    touched = _folders(fresh, staged)
    old = read(spark, base, schema, touched)
    merged = old.join(fresh.select(*keys), list(keys), "left_anti").unionByName(fresh)
    data = f"{root}/data-{uuid.uuid4().hex}"
    merged.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(data)
    found = {**base.partitions, **dict.fromkeys(touched, data)}
    if current(spark, root).number != base.number:
        raise StaleVersion(f"{root} is no longer at version {base.number}")
    publish(spark, f"{root}/_manifest/{base.number + 1:012d}.json", json.dumps(found, sort_keys=True))
    return Version(base.number + 1, found)


def write_units(spark: SparkSession, root: str, units: Sequence[str], make: Callable[[str], DataFrame]) -> list[str]:
    """K2, resumable: writes ``make(unit)`` to ``root/unit=<unit>`` for each unit that no earlier run has finished; returns those written.

    A unit is finished when its mark is published, after its rows are. Rows of a run that died half-way are in a folder
    that no mark names.
    """
    written = []
    for unit in units:
        mark = f"{root}/_done/{unit}.json"
        if exists(spark, mark):
            continue
        path = f"{root}/{unit}-{uuid.uuid4().hex}"
        make(unit).write.parquet(path)
        publish(spark, mark, json.dumps({"unit": unit, "path": path}))
        written.append(unit)
    return written


def read_units(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The rows of all finished units."""
    marks = spark.read.schema("unit string, path string").json(f"{root}/_done").collect() if exists(spark, f"{root}/_done") else []
    if not marks:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[r.path for r in marks])
