import numpy as np
import pytest
from aerocast.llm import whitening as W
from pyspark.sql import functions as F


def table(spark, x, kind="float"):
    return spark.createDataFrame([(i, v, 1) for i, v in enumerate(x)], f"vec_id long, embedding array<{kind}>, label int")


def plain(x):
    """(x - mean, eigenvalues, eigenvectors) by numpy, in integers as far as they go."""
    x = np.floor(np.array(x, dtype=float) * 64).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    apart = (x - 1_000_000) - (s - n * 1_000_000) / n
    values, vectors = np.linalg.eigh(apart.T @ apart / n)
    return x, n, s, apart, values[::-1], vectors[:, ::-1]


def check(spark, rows, ids, components=32):
    got = W.whiten(table(spark, rows), components=components).collect()
    x, n, s, apart, values, vectors = plain([rows[i] for i in ids])
    use = min(components, int((values > 1e-12 * values.sum()).sum()))
    assert sorted((r.vec_id, r.component) for r in got) == [(i, c + 1) for i in ids for c in range(use)]
    w = np.zeros((n, use))
    for r in got:
        i = ids.index(r.vec_id)
        w[i, r.component - 1] = r.whitened
        assert r.n == n and r.deviation == ((n * x[i] - s) ** 2).sum() and r.identity_error < 1e-9
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
    want = apart @ vectors[:, :use] / np.sqrt(values[:use])
    want *= np.sign((want * w).sum(axis=0))
    assert np.abs(w - want).max() < 1e-6
    assert np.abs(w.T @ w / n - np.eye(use)).max() < 1e-9


def vectors(seed, n, dim):
    r = np.random.RandomState(seed)
    return (r.standard_normal((n, dim)) * np.linspace(0.3, 3, dim) @ r.standard_normal((dim, dim))).astype(np.float32).tolist()


@pytest.mark.parametrize("dim,n", [(1, 5), (3, 40), (40, 300)])
def test_equal_to_numpy(spark, dim, n):
    x = vectors(dim, n, dim)
    check(spark, x, list(range(n)))


def test_copies_and_more_parts_than_fan_in(spark, monkeypatch):
    monkeypatch.setattr(W, "FAN_IN", 2)
    x = vectors(5, 60, 6)
    x[10:40] = [x[9]] * 30
    check(spark, x, list(range(60)), components=4)


def test_rank_one_updates_of_hard_spectra():
    r = np.random.RandomState(1)
    for case in range(60):
        dim = 2 + case % 9
        q, _ = np.linalg.qr(r.standard_normal((dim, dim)))
        values = np.sort(r.choice([0.0, 1.0, 1.0 + 1e-15, 1.0 + 1e-9, 2.0, 1e6, 1e-9], dim))
        v = q @ (r.standard_normal(dim) * 10.0 ** r.randint(-12, 4, dim) * r.randint(0, 2, dim))
        new, vec = W.rank_one(values, q, v)
        whole = q @ np.diag(values) @ q.T + np.outer(v, v)
        size = max(np.abs(whole).max(), 1e-300)
        assert np.abs(vec @ np.diag(new) @ vec.T - whole).max() < 1e-13 * size * dim
        assert np.abs(vec.T @ vec - np.eye(dim)).max() < 1e-13 * dim and (np.diff(new) >= 0).all()


def test_partition_spectra_merge_to_the_whole():
    x = np.floor(np.array(vectors(3, 90, 7)) * 64)
    parts = []
    for some in (x[:1], x[1:30], x[30:]):
        s = W.Spectrum.of(some[0])
        for v in some[1:]:
            s.add(v)
        parts.append(s)
    parts[0].merge(parts[1])
    parts[0].merge(parts[2])
    want = np.linalg.eigvalsh(np.cov(x.T, bias=True) * 90)
    assert parts[0].n == 90 and np.allclose(parts[0].mean, x.mean(axis=0)) and np.abs(parts[0].values - want).max() < 1e-11 * want.max()


def test_defined_results(spark):
    nan, inf = float("nan"), float("inf")
    good = vectors(8, 12, 2)
    rows = [None, [], [1.0, None], [nan, 1.0], [inf, 1.0], [1e30, 1.0], [1.0, 2.0, 3.0], *good, good[0], good[0]]
    check(spark, rows, list(range(7, len(rows))))
    clash = table(spark, rows).withColumn("x", F.lit("x")).withColumn("a.b", F.lit(1)).withColumn("n", F.lit(0)).withColumn("component", F.lit(0))
    assert W.whiten(clash).count() == 2 * (len(rows) - 7)
    for few in ([], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 5):
        got = W.whiten(table(spark, few))
        assert got.count() == 0 and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert [r.component for r in W.whiten(table(spark, [[1.0, 2.0], [2.0, 4.0], [4.0, 8.0]])).collect()] == [1, 1, 1]


def test_deviations_beyond_a_long():
    x = np.array([[2 ** 40, 0], [5, 1]])
    got = W._deviations(x, 10 ** 6, [0, 10 ** 6])
    assert got == [None, (5 * 10 ** 6) ** 2]
