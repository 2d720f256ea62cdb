"""Embedding whitening by incremental eigendecomposition.

Entries become integers ``x = floor(SCALE c) + OFFSET``, so counts, sums and deviations are exact. The spectrum of the
scatter matrix is built without ever forming it: a task starts with the first vector of its partition and adds each further one as a
centred rank-one update, whose eigenvalues are the roots of a secular equation. Entries of the update that are negligible, and
equal eigenvalues, are deflated first; eigenvectors come from the recomputed update vector (Gu and Eisenstat), so they stay
orthogonal. The spectra of partitions are combined, ``FAN_IN`` to a task, by successive rank-one updates: one
for each eigenpair of the other spectrum, one for the difference of the means. At last one distributed Rayleigh-Ritz pass
projects the centred rows on the whole basis, sums the small matrix, and rotates the basis to its eigenvectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage_table

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Spectra that one task combines.
FAN_IN = 8
#: Part of the whole variance below which a component has no variance that could be scaled to one.
RANK_TOL = 1e-12
#: An entry of a vector is too large from here on, as its x would not fit a long.
TOO_LARGE = 2.0 ** 56
_EPS = float(np.finfo(float).eps)
_SPECTRUM = "n long, mean array<double>, values array<double>, vectors binary"


def secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum_i z2_i / (d_i - t) = 0`` for ascending distinct ``d`` and positive ``z2``.

    Returns (index of the pole that a root is measured from, distance from it), root j between d_j and d_j+1. All
    roots are found at once: rational interpolation through the two neighbouring poles, bisection where that leaves the bracket.
    """
    k, total = len(d), z2.sum()
    upper = np.append(d[1:], d[-1] + total)
    gap = upper - d
    middle = 1.0 + (z2 / (d - (d + gap / 2)[:, None])).sum(axis=1)
    origin = np.arange(k)
    right = (middle < 0) & (origin < k - 1)  # the root lies nearer to the pole on its right
    origin[right] += 1
    delta = d - d[origin][:, None]
    low, high = np.where(right, -gap / 2, 0.0), np.where(right, 0.0, np.where(middle < 0, gap, gap / 2))
    low[-1], high[-1] = (gap[-1] / 2, gap[-1]) if middle[-1] < 0 else (0.0, gap[-1] / 2)
    left = np.arange(k) <= np.arange(k)[:, None]  # the poles up to j
    row = np.arange(k)
    a, b = delta[row, row], np.append(delta[row[:-1], row[1:]], np.inf)
    t = (low + high) / 2
    for _ in range(80):
        gaps = delta - t[:, None]
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            terms = z2 / gaps
            f = 1.0 + terms.sum(axis=1)
            slopes = terms / gaps
            psi, phi = np.where(left, slopes, 0).sum(axis=1), np.where(left, 0, slopes).sum(axis=1)
            low, high = np.where(f <= 0, t, low), np.where(f >= 0, t, high)
            done = (np.abs(f) <= 4 * _EPS * k * (1.0 + np.abs(terms).sum(axis=1))) | (high - low <= 2 * _EPS * np.abs(t))
            if done.all():
                break
            da, db = a - t, b - t
            c = f - da * psi - db * phi
            p, q = (da + db) * f - da * db * (psi + phi), da * db * f
            root = np.sqrt(np.maximum(p * p - 4 * q * c, 0))
            step = np.where(p <= 0, (p - root) / (2 * c), 2 * q / (p + root))
            last = da * da * psi / (f - da * psi)  # the last root has one pole: f = c + s / (a - t)
            step[-1] = da[-1] + last[-1] if np.isfinite(last[-1]) else np.nan
            new = t + step
        bad = ~np.isfinite(new) | (new <= low) | (new >= high)
        t = np.where(done, t, np.where(bad, (low + high) / 2, new))
    return origin, t


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors (columns) of ``vectors diag(values) vectors' + v v'``."""
    z = vectors.T @ v
    size = z @ z
    scale = max(values[-1], size)
    if scale == 0 or not np.isfinite(scale):
        return values, vectors
    tol = 8 * _EPS * scale
    values, z, vectors = values.copy(), z.copy(), vectors.copy()
    # equal eigenvalues: a reflection of their vectors leaves one of them to be updated
    for group in np.split(np.arange(len(values)), np.flatnonzero(np.diff(values) > tol) + 1):
        if len(group) > 1:
            part = z[group]
            norm = np.linalg.norm(part)
            if norm:
                h = part.copy()
                h[-1] += np.copysign(norm, part[-1])
                vectors[:, group] -= np.outer(vectors[:, group] @ h, h) * (2 / (h @ h))
                z[group] = 0.0
                z[group[-1]] = -np.copysign(norm, part[-1])
    live = np.flatnonzero(np.abs(z) * np.sqrt(size) > tol)
    if not len(live):
        return values, vectors
    d, zl = values[live], z[live]
    origin, t = secular_roots(d, zl * zl)
    # gaps[i, j] = d_i - root_j, exact to the last digits as roots are kept as distances from a pole
    gaps = (d[:, None] - d[origin]) - t
    with np.errstate(divide="ignore", invalid="ignore"):
        apart = d[:, None] - d
        np.fill_diagonal(apart, 1.0)
        ratio = -gaps / -apart.T  # (root_j - d_i) / (d_j - d_i)
        k = np.arange(len(live))
        ratio[k, k] = -gaps[k, k]
        z_new = np.copysign(np.sqrt(np.abs(np.prod(ratio, axis=1))), zl)
        q = z_new[:, None] / gaps
    fine = np.isfinite(q).all(axis=0)
    q[:, ~fine] = np.where(np.arange(len(live))[:, None] == origin[~fine], 1.0, 0.0)
    q /= np.linalg.norm(q, axis=0)
    values[live] = d[origin] + t
    vectors[:, live] = vectors[:, live] @ q
    order = np.argsort(values, kind="stable")
    return np.maximum(values[order], 0.0), vectors[:, order]


class Spectrum:
    """Count, mean and eigendecomposition of the scatter of the vectors added so far."""

    def __init__(self, n: int, mean: np.ndarray, values: np.ndarray, vectors: np.ndarray):
        self.n, self.mean, self.values, self.vectors = n, mean, values, vectors

    @classmethod
    def of(cls, x: np.ndarray) -> Spectrum:
        return cls(1, x.astype(float), np.zeros(len(x)), np.eye(len(x)))

    def add(self, x: np.ndarray, n: int = 1) -> None:
        """``n`` copies of one vector: the mean moves, the scatter gets a centred rank-one update."""
        apart = x - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, apart * np.sqrt(self.n * n / (self.n + n)))
        self.n += n
        self.mean = self.mean + apart * (n / self.n)

    def merge(self, other: Spectrum) -> None:
        for value, vector in zip(other.values.tolist(), other.vectors.T, strict=True):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector * np.sqrt(value))
        self.add(other.mean, other.n)

    def row(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([self.n]), pa.array([self.mean.tolist()]), pa.array([self.values.tolist()]),
             pa.array([np.ascontiguousarray(self.vectors).tobytes()], pa.binary())], ["n", "mean", "values", "vectors"])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[Spectrum]:
    """Spectra of rows (n, mean, values, vectors)."""
    for b in batches:
        for n, mean, values, vectors in zip(*(b.column(c).to_pylist() for c in ("n", "mean", "values", "vectors")), strict=True):
            yield Spectrum(n, np.array(mean), np.array(values), np.frombuffer(vectors).reshape(len(mean), -1).copy())


def spectrum(rows: DataFrame, dim: int) -> Spectrum:
    """The spectrum of all vectors ``x`` of ``rows``, one small row from each task combined level by level."""
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = None
        for b in batches:
            x, copies = np.unique(_matrix(b.column(0), dim), axis=0, return_counts=True)
            for v, n in zip((x - OFFSET).astype(float), copies.tolist(), strict=True):
                if got is None:
                    got = Spectrum.of(v)
                    got.n = n
                else:
                    got.add(v, n)
        if got is not None:
            yield got.row()

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = None
        for s in _read(batches):
            if got is None:
                got = s
            else:
                got.merge(s)
        if got is not None:
            yield got.row()

    parts = stage_table(rows.select("x").mapInArrow(first, _SPECTRUM), "whitening-spectra")
    while (left := parts.count()) > FAN_IN:
        parts = stage_table(parts.repartition(-(-left // FAN_IN)).mapInArrow(combined, _SPECTRUM), "whitening-spectra")
    got = None
    for s in _read(parts.toArrow().to_batches()):  # FAN_IN rows of dim * dim numbers at most
        if got is None:
            got = s
        else:
            got.merge(s)
    return got


def _summed(rows: DataFrame, project, size: int) -> np.ndarray:
    """Sum over all rows of ``y y'`` for ``y = project(x)``: one matrix of size * size from each task, added in Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for b in batches:
            y = project(b)
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * size)), pa.array(total.ravel())], ["cell", "value"])

    out = np.zeros(size * size)
    got = rows.select("x").mapInArrow(run, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    if got.num_rows:
        out[got.column("cell").to_numpy()] = got.column("value").to_numpy()
    return out.reshape(size, size)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``id_col, component, n, deviation, whitened, explained, identity_error``: one row per vector and component.

    A vector that is null or empty, or holds a null, non-finite or too large (``TOO_LARGE``) entry is left out, as
    are those of another length than the most frequent one (the shortest of several). Components are ordered by falling eigenvalue; the
    entry of a component that is largest in size is positive. A component whose variance is under ``RANK_TOL`` of the whole has no
    unit scale and is left out, so vectors that are all equal, or a single one, give no rows. ``deviation`` is null where
    it does not fit a long. Repeated rows count each; other columns are ignored; an empty table gives an empty result.
    """
    v = F.col("vector")
    fine = (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(TOO_LARGE)))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector")).where(fine)
    rows = stage_table(rows.select("id", F.transform(v, lambda c: F.floor(c * SCALE).cast("long") + F.lit(OFFSET)).alias("x")), "whitening-rows")
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    nothing = vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    usual = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    if not usual:
        return nothing
    dim, n = int(usual[0][0]), int(usual[0][1])
    rows = rows.where(F.size("x") == dim)
    # exact sums per dimension: dim rows
    sums = rows.select(F.posexplode("x").alias("at", "x")).groupBy("at").agg(F.sum(F.col("x").cast("decimal(19,0)")).alias("s")).collect()
    total = [int(r.s) for r in sorted(sums)]
    mean = np.array([(s - n * OFFSET) / n for s in total])  # of x - OFFSET: an integer difference, one rounding

    basis = spectrum(rows, dim).vectors

    def projected(b: pa.RecordBatch) -> np.ndarray:
        return (_matrix(b.column(0), dim) - OFFSET - mean) @ basis

    small = _summed(rows, projected, dim) / n
    values, turn = np.linalg.eigh((small + small.T) / 2)  # dim * dim numbers
    values, axes = values[::-1], (basis @ turn)[:, ::-1]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(dim)])
    trace = values.sum()
    use = int((values[:components] > RANK_TOL * trace).sum()) if trace > 0 else 0
    if not use:
        return nothing
    axes, values = axes[:, :use], values[:use]
    scaled = axes / np.sqrt(values)

    def white(b: pa.RecordBatch) -> np.ndarray:
        return (_matrix(b.column(b.schema.get_field_index("x")), dim) - OFFSET - mean) @ scaled

    error = float(np.abs(_summed(rows, white, use) / n - np.eye(use)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                b = batch.slice(at, 2048)
                w, m = white(b), b.num_rows
                apart = _deviations(_matrix(b.column(1), dim), n, total)
                each = np.repeat(np.arange(m), use)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, use + 1, dtype=np.int32), m)), pa.array(np.full(m * use, n)),
                     pa.array([apart[i] for i in each.tolist()], pa.int64()), pa.array(w.ravel()), pa.array(np.tile(values / trace, m)),
                     pa.array(np.full(m * use, error))],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _deviations(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; null where it passes a long."""
    rough = ((n * x.astype(float) - np.array(total, dtype=float)) ** 2).sum(axis=1)
    if max(n * float(np.abs(x).max()), max(map(abs, total)), float(rough.max())) < 2 ** 62:
        return ((n * x - np.array(total)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * int(c) - s) ** 2 for c, s in zip(row, total, strict=True)) for row in x.tolist()]
    return [e if e < 2 ** 63 else None for e in exact]
