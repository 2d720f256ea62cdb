"""Embedding near-duplicates with a pivot-permutation index.

Every vector is described by the ordered list of its nearest reference points
(pivots). Inverted lists are kept per pair of pivots (per triple where the caller asks for them): a list brings
together the vectors that hold all of them among their nearest ``prefix`` pivots. Within a list, pairs that
share at least ``shared`` of their nearest ``depth`` pivots are candidates; the cosine in double precision
decides. Pivots are seeded random directions, so nothing is fitted and the index is
the same on every run; every vector is indexed.

Lists hold descriptions only. A vector is fetched for the units of comparison in which it has a candidate.
Equal vectors are one node with a count. A pair is counted in exactly one list (the one
of its smallest shared pivots), so links are summed without ever being gathered, and a
unit of comparison emits counts and a spanning forest instead of its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import combinations, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage_table
from .components import components
from .pairs import near_rows, whole_units

MIN_COSINE = 0.9
#: Distinct vectors of a list that are compared as one unit.
BLOCK = 1024
SMALL = 16
SEED = 20_011
_CHUNK = 50_000
_PIVOTS: dict[tuple[int, int], np.ndarray] = {}


@dataclass(frozen=True)
class Setting:
    """Pivots in all, those whose combinations name lists, those of a combination, those compared, those that candidates share."""

    pivots: int
    prefix: int
    key: int
    depth: int
    shared: int


#: Smallest number of dimensions -> setting. Narrow spaces take fewer pivots: with many, the nearest ones of two vectors
#: at cosine 0.9 no longer meet. Recall of random pairs at cosine 0.9 exactly is 0.94 or more for each (README).
SETTINGS = {24: Setting(1024, 7, 2, 20, 7), 12: Setting(512, 7, 2, 20, 5), 6: Setting(128, 6, 2, 16, 4), 4: Setting(32, 6, 2, 12, 2),
            3: Setting(16, 5, 2, 8, 2), 2: Setting(8, 4, 2, 6, 2), 1: Setting(2, 2, 2, 2, 2)}
#: Whether wide vectors take lists of triples, which are shorter and five times as many. Never told from the table: one
#: pair of vectors is found or not whatever else the table holds.
LARGE = False
LARGE_WIDE = Setting(1024, 10, 3, 24, 8)
_PIVOT_BITS, _KEY_BITS = 10, 40


def setting(dim: int, large: bool = False) -> Setting:
    return LARGE_WIDE if large and dim >= 24 else next(s for least, s in SETTINGS.items() if dim >= least)


def pivots(dim: int, count: int) -> np.ndarray:
    """``count`` unit vectors of ``dim`` components, the same on every worker."""
    if (dim, count) not in _PIVOTS:
        p = np.random.RandomState(SEED + dim).standard_normal((count, dim))
        _PIVOTS[dim, count] = p / np.linalg.norm(p, axis=1, keepdims=True)
    return _PIVOTS[dim, count]


def permutation(x: np.ndarray, s: Setting) -> np.ndarray:
    """Indices of the nearest pivots of each row of ``x``, nearest first, ties by index."""
    return np.argsort(-(x @ pivots(x.shape[1], s.pivots).T), axis=1, kind="stable")[:, :s.depth].astype(np.uint16)


def _code(few: np.ndarray) -> np.ndarray:
    """Rows of ascending pivots as one number each."""
    out = np.zeros(len(few), np.int64)
    for c in few.T:
        out = out << _PIVOT_BITS | c
    return out


def _unit_length(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _vectors(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(dimensions, end, all components) of a list column's rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    dims = column.value_lengths().to_numpy()
    return dims, np.cumsum(dims, dtype=np.int64), column.flatten().to_numpy()


def _describe(batches: Iterator[pa.RecordBatch], large: bool) -> Iterator[pa.RecordBatch]:
    """Rows (node, vector) -> (node, keys of its lists, permutation)."""
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            b = batch.slice(at, 4096)
            dims, ends, flat = _vectors(b.column(1))
            for dim in np.unique(dims).tolist():
                s, rows = setting(dim, large), np.flatnonzero(dims == dim)
                x = flat[(ends[rows] - dim)[:, None] + np.arange(dim)]
                perm = permutation(_unit_length(x.astype(np.float64)), s)
                head = np.sort(perm[:, :s.prefix], axis=1).astype(np.int64)
                keys = np.stack([dim << _KEY_BITS | _code(head[:, c]) for c in combinations(range(s.prefix), s.key)], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(rows)),
                     pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32)), pa.array(keys.ravel())),
                     pa.array([p.tobytes() for p in perm], pa.binary())], ["node", "keys", "perm"])


def _comparisons(lists: DataFrame, block: int) -> DataFrame:
    """Rows (key, node, perm) with ``low``, ``high`` and ``mine``: once per unit, sorted by unit within partitions.

    A list of at most ``block`` rows is one unit. A longer one is cut into blocks by a hash; each block and each pair of
    blocks is a unit, so that a hot list goes to many tasks. Only the few long lists are joined.
    """
    long_ones = stage_table(lists.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block)
                            .select("key", F.ceil(F.col("n") / F.lit(block)).cast("int").alias("blocks")), "vector-long-lists")
    blocks = F.coalesce("blocks", F.lit(1))
    return (lists.join(long_ones, "key", "left")
            .select("key", blocks.alias("blocks"), F.pmod(F.xxhash64("node", F.lit("block")), blocks).cast("int").alias("mine"), "node", "perm")
            .select("key", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"), "node", "perm")
            .select("key", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "mine", "node", "perm")
            .repartition("key", "low", "high").sortWithinPartitions("key", "low", "high"))


def _near(i, j, key, cross, mine, perm, s: Setting):
    """Those pairs (i, j) that this list counts: enough shared pivots, the list their own."""
    for at in range(0, len(i), _CHUNK):
        a, b = i[at:at + _CHUNK], j[at:at + _CHUNK]
        ok = ~cross[a] | (mine[a] != mine[b])
        a, b = a[ok], b[ok]
        head_a, head_b = perm[a][:, :s.prefix], perm[b][:, :s.prefix]
        both = np.sort(np.where((head_a[:, :, None] == head_b[:, None, :]).any(axis=2), head_a, s.pivots), axis=1)
        ok = _code(both[:, :s.key].astype(np.int64)) == key[a] & (1 << _KEY_BITS) - 1
        a, b = a[ok], b[ok]
        ok = (perm[a][:, :, None] == perm[b][:, None, :]).sum(axis=(1, 2)) >= s.shared
        if ok.any():
            yield a[ok], b[ok]


def _candidates(t: pa.Table, first: np.ndarray, size: np.ndarray, large: bool):
    """(dimensions, first row, last row, candidate pairs among them) for the units of a table (key, low, high, mine, node, perm, ...)."""
    key, low, high, mine = (t.column(c).to_numpy() for c in range(4))
    cross, dims = low != high, key >> _KEY_BITS  # rows are sorted by key, so those of one width are neighbours
    for dim in np.unique(dims).tolist():
        lo, hi = np.searchsorted(dims, [dim, dim + 1]).tolist()
        s, here = setting(dim, large), (first >= lo) & (first < hi)
        perm = np.frombuffer(b"".join(t.column(5).slice(lo, hi - lo).to_pylist()), dtype=np.uint16).reshape(hi - lo, -1)
        start, n = first[here] - lo, size[here]
        found, args = [], (key[lo:hi], cross[lo:hi], mine[lo:hi], perm, s)
        for i, j in near_rows(start, n, SMALL):
            found += _near(i, j, *args)
        for f, m in zip(start[n > SMALL].tolist(), n[n > SMALL].tolist(), strict=True):
            names, where = np.unique(perm[f:f + m], return_inverse=True)
            held = np.zeros((m, len(names)), dtype=np.float32)
            held[np.arange(m)[:, None], where.reshape(m, -1)] = 1
            i, j = np.nonzero(np.triu(held @ held.T >= s.shared, 1))
            found += _near(i + f, j + f, *args)
        if found:
            yield dim, lo, hi, found


def _promising(batches: Iterator[pa.RecordBatch], large: bool) -> Iterator[pa.RecordBatch]:
    """The rows (key, low, high, mine, node, perm) with a candidate in their unit."""
    for t, first, size in whole_units(batches):
        hit = np.zeros(t.num_rows, bool)
        for _, lo, _, found in _candidates(t, first, size, large):
            for a, b in found:
                hit[a + lo] = hit[b + lo] = True
        if hit.any():
            yield from t.filter(pa.array(hit)).combine_chunks().to_batches()


def _forest(n: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of ``n`` rows the smallest row its links reach."""
    root = np.arange(n)
    a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return root


def _links(batches: Iterator[pa.RecordBatch], large: bool) -> Iterator[pa.RecordBatch]:
    """Rows (key, low, high, mine, node, perm, copies, vector) sorted by unit -> counts (a, null, n) and links (a, b, null)."""
    for t, first, size in whole_units(batches, 4096):
        node, copies = t.column(4).to_numpy(), t.column(6).to_numpy()
        _, ends, flat = _vectors(t.column(7))
        for dim, lo, hi, found in _candidates(t, first, size, large):
            x = _unit_length(flat[ends[lo] - dim:ends[hi - 1]].reshape(hi - lo, dim).astype(np.float64))
            own, many = node[lo:hi], copies[lo:hi]
            pairs = []
            for a, b in found:
                for at in range(0, len(a), _CHUNK):
                    i, j = a[at:at + _CHUNK], b[at:at + _CHUNK]
                    ok = np.einsum("ij,ij->i", x[i], x[j]) >= MIN_COSINE
                    pairs.append((i[ok], j[ok]))
            a, b = (np.concatenate(p) for p in zip(*pairs, strict=True))
            if not len(a):
                continue
            n = np.bincount(a, many[b], hi - lo) + np.bincount(b, many[a], hi - lo)
            hit = np.flatnonzero(n)
            root = _forest(hi - lo, pairs)
            tied = np.flatnonzero(root != np.arange(hi - lo))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([own[hit], own[tied]])),
                 pa.array([None] * len(hit) + own[root[tied]].tolist(), pa.int64()),
                 pa.array(n[hit].astype(np.int64).tolist() + [None] * len(tied), pa.int64())], ["a", "b", "n"])


def _name(vector: Column) -> Column:
    return F.xxhash64(vector)


def _nodes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows (id, node, vector), distinct vectors (node, vector, copies)); different vectors have different nodes.

    Nodes are hashes. Where vectors that differ share one, theirs are hashed again with the next seed until none do.
    """
    rows = rows.withColumn("node", F.when(F.col("vector").isNotNull(), _name(F.col("vector"))))
    for seed in count(1):
        nodes = stage_table(rows.where("node IS NOT NULL").groupBy("node", "vector").agg(F.count("*").alias("copies")), "vector-nodes")
        clash = stage_table(nodes.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").select("node", F.lit(True).alias("clash")), "vector-clashes")
        if clash.isEmpty():
            return rows, nodes
        rows = rows.join(clash, "node", "left").select(
            "id", F.when(F.col("clash"), F.xxhash64("node", "vector", F.lit(seed))).otherwise(F.col("node")).alias("node"), "vector")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", large: bool | None = None) -> DataFrame:
    """``id_col, n_links, component_id, kept`` for every row.

    ``n_links`` counts the other rows linked directly, equal vectors included; ``component_id``
    is the smallest id reachable. Ties (ids of equal vectors, pivots at one distance) go to the smaller one. A vector that is null, empty or zero or holds a null or
    non-finite component links with nothing and is kept; so does one with other dimensions than the rest.
    Repeated rows count as vectors of their own; other columns are ignored. An empty table gives an empty result.
    ``large`` (by default ``LARGE``) takes lists of triples for wide vectors.
    """
    large = bool(LARGE if large is None else large)
    v = F.col("vector")
    fine = (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))) \
        & F.exists(v, lambda c: c != 0)
    # vectors travel in their own width and are compared in double precision
    kind = "float" if vectors.schema[vector_col].dataType.elementType.simpleString() == "float" else "double"
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")).select(
        "id", F.when(fine, F.transform(v, lambda c: (c + F.lit(0.0)).cast(kind))).alias("vector"))  # one zero
    rows, nodes = _nodes(rows)
    flat = stage_table(rows.select("id", "node"), "vector-ids")
    described = stage_table(nodes.select("node", "vector").mapInArrow(
        partial(_describe, large=large), "node long, keys array<long>, perm binary"), "vector-permutations")
    units = _comparisons(described.select(F.explode("keys").alias("key"), "node", "perm"), BLOCK)
    promising = stage_table(units.mapInArrow(partial(_promising, large=large), units.schema), "vector-candidates")
    found = stage_table(promising.join(nodes, "node")
                        .select("key", "low", "high", "mine", "node", "perm", "copies", "vector")
                        .repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
                        .mapInArrow(partial(_links, large=large), "a long, b long, n long"), "vector-links")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    joined = components(found.where("b IS NOT NULL"))
    size = flat.where("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("copies"), F.min("id").alias("least"))
    of = stage_table(size.join(counts, "node", "left").join(joined, "node", "left").select(
        "node", "least", F.coalesce("component", "node").alias("component"),
        (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")), "vector-degrees")
    least = stage_table(of.groupBy("component").agg(F.min("least").alias("component_id")), "vector-least")
    classes = stage_table(of.join(least, "component").select("node", "n_links", "component_id"), "vector-classes")
    out = flat.join(classes, "node", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
