import pytest
from aerocast.llm import mixing
from helpers import ODD, documents, with_clashes, words


def fill(sizes):
    """Targets by resharing the excess round after round."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    left, open_ = float(sum(sizes.values())), set(order)
    while open_ and left > 1e-9:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        left = 0.0
        for s in list(open_):
            target[s] += share[s]
            if target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                open_.discard(s)
    return target


def test_targets_and_cut(spark):
    rows, n = [], 0
    for source, docs in (("b", 40), ("a", 10), ("é", 120), (None, 30), ("Z", 60)):
        for i in range(docs):
            rows.append((n, words(3 + 7 * i % 23), "en", source))
            n += 1
    out = mixing.mix(documents(spark, rows)).collect()
    sizes = {}
    for _, text, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(text.split())
    target = fill(sizes)
    assert len(out) == n
    for s in sizes:
        mine = [r for r in out if r.source == s]
        assert {r.source_size for r in mine} == {sizes[s]}
        assert mine[0].target == pytest.approx(target[s], rel=1e-12)
        assert sum(r.taken for r in mine) == int(target[s] + 0.5)
        assert all(0 <= r.taken <= 3 * r.size for r in mine)
        whole = [r for r in mine if r.taken not in (r.epochs * r.size, (r.epochs + 1) * r.size)]
        assert len(whole) <= 1
    again = mixing.mix(documents(spark, rows).repartition(7)).collect()
    assert sorted((r.id, r.taken) for r in again) == sorted((r.id, r.taken) for r in out)


def test_whole_documents(spark):
    rows = [(i, words(1 + i % 9), "en", "ab"[i % 4 == 0]) for i in range(200)]
    docs = with_clashes(documents(spark, rows))
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    placed = {r.id: r for r in mixing.mix(docs).collect()}
    for s in "ab":
        got = sum(len(r.text.split()) for r in out.where(f"source = '{s}'").collect())
        target = next(r.target for r in placed.values() if r.source == s)
        assert abs(got - target) <= 5


def test_edge_cases(spark):
    out = mixing.mix(with_clashes(documents(spark, ODD))).collect()
    assert len(out) == len(ODD) and sum(r.taken for r in out) > 0
    assert {r.size for r in out if r.id in (1, 2, 3)} == {0}
    only = mixing.mix(documents(spark, [(1, None), (2, "")])).collect()
    assert [(r.target, r.taken) for r in only] == [(0.0, 0), (0.0, 0)]
    assert mixing.mix(documents(spark, [])).count() == 0 and mixing.mix_documents(documents(spark, [])).count() == 0


def test_texts_are_counted_once(spark):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        mixing.mix(documents(spark, [(i, words(i), "en", "ab"[i % 2]) for i in range(20)])).explain("formatted")
    assert "regexp_count" not in buf.getvalue().lower() and "mix-rows" in buf.getvalue()
