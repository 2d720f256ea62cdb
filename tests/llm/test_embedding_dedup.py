import numpy as np
import pytest
from aerocast.llm import embed_dedup as D
from pyspark.sql import functions as F


def brute(ids, x):
    ok = np.array([v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for v in x])
    near = np.zeros((len(x), len(x)), bool)
    for i in np.flatnonzero(ok):
        for j in np.flatnonzero(ok):
            if i != j and len(x[i]) == len(x[j]):
                a, b = np.array(x[i], float), np.array(x[j], float)
                near[i, j] = a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.9
    low = np.array(ids)
    while True:
        new = np.array([min([low[i], *low[near[i]]]) for i in range(len(ids))])
        if (new == low).all():
            return near.sum(1), low
        low = new


def table(spark, x, kind="double"):
    return spark.createDataFrame([(i, v, 1) for i, v in enumerate(x)], f"vec_id long, embedding array<{kind}>, label int")


def clusters(seed, n, dim, noise):
    r = np.random.RandomState(seed)
    centre = r.standard_normal((n, dim))
    return [(centre[i % n] + noise * r.standard_normal(dim)).tolist() for i in range(6 * n)]


def check(spark, x, kind="double", recall=0.98):
    got = sorted(D.near_duplicates(table(spark, x, kind)).collect())
    links, low = brute(range(len(x)), [None if v is None else [None if c is None else float(np.float32(c)) if kind == "float" else c for c in v] for v in x])
    mine = np.array([r.n_links for r in got])
    assert (mine <= links).all() and mine.sum() >= recall * links.sum() and links.sum() > 0
    assert np.mean([r.component_id == c for r, c in zip(got, low)]) >= recall
    assert all(r.kept == (r.component_id == r.vec_id) for r in got)


def test_recall(spark):
    check(spark, clusters(1, 60, 64, 0.2))
    check(spark, clusters(2, 40, 32, 0.22), "float")


def test_large_lists_are_cut_into_units(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK", 20)
    check(spark, clusters(3, 2, 64, 0.15) * 1 + clusters(4, 30, 64, 0.15), recall=0.95)


def pairs_at(dim, n, cosine, seed=9):
    """``n`` pairs of random directions at ``cosine`` exactly, a pair in neighbouring rows."""
    r = np.random.RandomState(seed)
    a, b = r.standard_normal((2, n, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (b * a).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    return np.stack([a, cosine * a + np.sqrt(1 - cosine * cosine) * b], axis=1).reshape(2 * n, dim)


@pytest.mark.parametrize("dim", [2, 3, 4, 5, 6, 8, 11, 12, 16, 23, 24, 32, 64, 768])
@pytest.mark.parametrize("large", [False, True])
def test_settings_reach_recall(dim, large):
    s = D.setting(dim, large)
    perm = D.permutation(pairs_at(dim, 2000, 0.9), s)

    def met(k):
        return (perm[::2, :k, None] == perm[1::2, None, :k]).sum((1, 2))

    assert ((met(s.prefix) >= s.key) & (met(s.depth) >= s.shared)).mean() >= 0.93


@pytest.mark.parametrize("dim", [1, 2, 4, 8, 16])
def test_narrow_vectors(spark, dim):
    r = np.random.RandomState(dim)
    check(spark, r.standard_normal((100, dim)).round(3).tolist() + clusters(8, 10, dim, 0.15), recall=0.95)


def test_lists_of_triples(spark, monkeypatch):
    monkeypatch.setattr(D, "LARGE", 1)
    check(spark, clusters(6, 40, 64, 0.2))


def test_hashes_that_clash(spark, monkeypatch):
    monkeypatch.setattr(D, "_name", lambda v: F.pmod(F.xxhash64(v), F.lit(5)))
    x = clusters(7, 20, 24, 0.1)
    check(spark, x + x[:7])


def test_vectors_stay_out_of_the_lists(spark):
    x = table(spark, pairs_at(64, 50, 0.0).tolist()).select("vec_id", "embedding")
    units = D._comparisons(x.select(F.explode(F.array(F.lit(1), F.lit(2))).alias("key"), F.col("vec_id").alias("node"), F.lit(b"").alias("perm")), 40)
    assert units.columns == ["key", "low", "high", "mine", "node", "perm"]
    assert units.groupBy("key", "low", "high").count().agg(F.max("count")).first()[0] < 100  # a list of 100 rows is cut
    assert units.where("low = high").groupBy("key").count().collect()[0]["count"] == 100


def test_dense_group(spark):
    r = np.random.RandomState(5)
    c = r.standard_normal(64)
    check(spark, [(c + 0.1 * r.standard_normal(64)).tolist() for _ in range(150)], recall=0.99)


def test_defined_results(spark):
    nan, inf = float("nan"), float("inf")
    x = [None, [], [0.0, -0.0], [1.0, None], [nan, 1.0], [inf, 1.0], [1.0, 2.0], [1.0, 2.0], [2.0, 4.0], [1.0, 2.0, 3.0], [1e200, 2e200], [-1.0, -2.0]]
    got = sorted(D.near_duplicates(table(spark, x).withColumn("node", F.lit(1)).withColumn("copies", F.lit(2))).collect())
    assert [(r.n_links, r.component_id, r.kept) for r in got] == [
        *[(0, i, True) for i in range(6)], (3, 6, True), (3, 6, False), (3, 6, False), (0, 9, True), (3, 6, False), (0, 11, True)]
    assert D.near_duplicates(table(spark, [])).count() == 0


def test_results_do_not_depend_on_the_size_of_the_table(spark, monkeypatch):
    t = table(spark, pairs_at(64, 600, 0.9 + 1e-9).tolist())
    small, triples = sorted(D.near_duplicates(t).collect()), sorted(D.near_duplicates(t, large=True).collect())
    assert small != triples  # the pairs of each setting differ at the edge
    monkeypatch.setattr(type(t), "count", lambda self: 1 << 40)
    assert sorted(D.near_duplicates(t).collect()) == small
