"""Comparing the rows of index buckets in bounded units.

A bucket is cut into blocks of about ``block`` rows by a hash; each block on its own
and each pair of blocks is a unit. Units of a large bucket go to many tasks, and
none holds more than two blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage_table


def pair_units(keyed: DataFrame, spread: str, block: int, name: str) -> DataFrame:
    """Rows of ``keyed`` (a stored table with a ``key`` column) whose key occurs twice or more, once per unit.

    Adds ``mine`` (the row's block), ``low`` and ``high`` (the unit's blocks); sorted by unit within
    partitions, key columns first.
    """
    shared = stage_table(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), f"{name}-buckets")
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    rest = [c for c in keyed.columns if c != "key"]
    return (keyed.join(shared, "key")
            .select("key", blocks.alias("blocks"), F.pmod(F.xxhash64(spread, F.lit("block")), blocks).cast("int").alias("mine"), *rest)
            .select("key", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"), *rest)
            .select("key", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "mine", *rest)
            .repartition("key", "low", "high").sortWithinPartitions("key", "low", "high"))


def whole_units(batches: Iterator[pa.RecordBatch], rows: int = 20_000) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Tables of complete units, with each unit's first row and size; the first three columns name a unit."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < rows:
            continue
        t = pa.Table.from_batches(held)
        cols = [t.column(i).to_numpy() for i in range(3)]
        same = np.logical_and.reduce([c == c[-1] for c in cols])
        cut = int(np.argmax(same))  # the last unit may go on in the next batch
        if cut:
            yield _bounded(t.slice(0, cut))
            held = t.slice(cut).combine_chunks().to_batches()
    if held:
        yield _bounded(pa.Table.from_batches(held))


def _bounded(t: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    cols = [t.column(i).to_numpy() for i in range(3)]
    new = np.ones(t.num_rows, dtype=bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
    first = np.flatnonzero(new)
    return t, first, np.diff(np.append(first, t.num_rows))


def near_rows(first: np.ndarray, size: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows inside units of at most ``most`` rows, by their distance, vectorised over units."""
    keep = (size > 1) & (size <= most)
    ends = np.repeat((first + size)[keep], size[keep])
    at = np.concatenate([np.arange(f, f + s) for f, s in zip(first[keep], size[keep], strict=True)]) if keep.any() else np.empty(0, int)
    for d in range(1, most):
        ok = at + d < ends
        at, ends = at[ok], ends[ok]
        if not len(at):
            return
        yield at, at + d
