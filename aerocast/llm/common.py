"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: White space of the word definition: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage with files that every executor can read, so a lost
    executor costs the tasks it ran and nothing upstream.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(df: DataFrame) -> Column:
    """All input columns in one struct, so that no name of theirs can clash."""
    return F.struct(*[df[f"`{c.replace('`', '``')}`"].alias(c) for c in df.columns])


def unpack(df: DataFrame, schema, packed_as: str = "row") -> DataFrame:
    return df.select(*[F.col(packed_as).getField(f.name).alias(f.name) for f in schema.fields])


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


#: Rows of texts that Spark hands to a Python worker at once.
BATCH_ROWS = 1024
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def text_batches(df: DataFrame) -> DataFrame:
    """``df``, with its session set to hand texts over in small batches, so that buffers stay small on both sides."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_BATCH_CONF, "10000")) <= BATCH_ROWS:
        conf.set(_BATCH_CONF, str(BATCH_ROWS))
    return df


def chunked(batches: Iterator[pa.RecordBatch], text_index: int, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that the texts of one hold about ``max_bytes`` at most (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        if batch.column(text_index).nbytes <= max_bytes:
            yield batch
            continue
        lengths = pc.binary_length(batch.column(text_index)).fill_null(0).to_numpy(zero_copy_only=False)
        start = used = 0
        for i in range(n):
            if used and used + int(lengths[i]) > max_bytes:
                yield batch.slice(start, i - start)
                start, used = i, 0
            used += int(lengths[i])
        yield batch.slice(start)


class BoundedCache(dict):
    """Values made on first use, ``most`` of them at a time.

    Two generations of half that size: a full one becomes the old one, from which what is
    used again comes back, so frequent keys stay and rare ones go.
    """

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.half, self.old = make, most // 2, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value
