import random
import re

import pytest
from aerocast.llm import quality as Q
from aerocast.llm import sql
from helpers import ODD, documents, with_clashes, words


def counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    covered = {j for i, t in enumerate(tri) if tri.count(t) > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(covered)


def test_counts(spark):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(["a ", "b ", "c\n", "#", "é", "\x0b", "\x1c", "\n", "🙂 ", "a b c "]) for _ in range(rnd.randint(0, 60))) for _ in range(300)]
    docs = documents(spark, [*enumerate(texts), (900, None)])
    got = {r.doc_id: tuple(r[c] for c in Q.COUNTS) for r in Q.with_counts(docs.select("doc_id", "text"), "text").collect()}
    for i, t in [*enumerate(texts), (900, None)]:
        assert got[i] == counts(t), repr(t)


def test_verdicts(spark):
    clean = [(i, words(80, i * 100), "en", "a") for i in range(100)]
    symbols = [(200, " ".join(f"w{i}##" for i in range(80)), "en", "a"), (201, " ".join(f"w{i}|" for i in range(80)), "fr", "rare")]
    bad = [(300, words(49)), (301, "x y z " * 30), (302, None), (303, "")]
    out = {r.row.doc_id: r for r in Q.judge(with_clashes(documents(spark, [*clean, *symbols, *bad]))).collect()}
    assert all(out[r[0]].kept for r in clean)
    assert not any(out[r[0]].kept or out[r[0]].base_failed for r in symbols)
    assert all(out[r[0]].base_failed and not out[r[0]].kept for r in bad)


def test_sketches_merge(spark):
    rows = [(i, words(60 + i % 30, i) + " #" * (i % 4), "en", "ab"[i % 2]) for i in range(120)]
    parts = [Q.sketches(Q.with_counts(documents(spark, p).select("doc_id", "lang", "source", "text"), "text")) for p in (rows, rows[:50], rows[50:])]
    merged = parts[1].union(parts[2]).groupBy("lang", "source", "name", "bucket").sum("n")
    assert sorted(map(str, (tuple(r) for r in merged.collect()))) == sorted(map(str, (tuple(r) for r in parts[0].collect())))


def test_keep_good(spark):
    docs = with_clashes(documents(spark, [*ODD, *[(10 + i, words(60, i), "en", None) for i in range(5)]]))
    out = Q.keep_good(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [5, 10, 11, 12, 13, 14]
    assert Q.keep_good(documents(spark, [])).count() == 0


def by_sql(docs, path):
    """doc_id -> kept, by the query's SQL."""
    duckdb = pytest.importorskip("duckdb")
    docs.write.parquet(str(path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    return dict(con.execute(f"SELECT doc_id, kept FROM ({sql.QUALITY})").fetchall())


def test_thresholds_follow_the_data(spark, tmp_path):
    """Mean word lengths of 5 to 6 but for one group of 9 to 10: what is far out is so within its group, below any old floor too."""
    def text(i, long):
        return " ".join(f"{'x' * (long + (i + j) % 2)}{j:04d}"[-long - (i + j) % 2:] for j in range(100))
    rows = [(i, text(i, 5), "en", "a") for i in range(60)] + [(100 + i, text(i, 9), "de", "b") for i in range(60)]
    far = [(200, text(0, 9), "en", "a"), (201, text(0, 20), "de", "b")]
    docs = documents(spark, rows + far)
    out = {r.row.doc_id: r.kept for r in Q.judge(docs).collect()}
    assert all(out[r[0]] for r in rows)
    assert not out[200] and not out[201]
    assert by_sql(docs, tmp_path / "d") == out


def test_sql_states_the_same_rule(spark, tmp_path):
    """Groups of all sizes, with and without spread: every branch of the thresholds, the long tails and the counting errors."""
    rnd = random.Random(9)

    def text(i):
        long = rnd.choice([0] * 30 + [30])
        lines = [" ".join(rnd.choice("abcdefgh") * (long + rnd.randint(1, 9)) + str(rnd.randint(0, 400)) for _ in range(rnd.randint(3, 12))) for _ in range(rnd.randint(12, 30))]
        lines += rnd.choices(lines, k=rnd.choice([0] * 30 + [1, 4, 14])) + ["#" * rnd.choice([0] * 20 + [3, 40])]
        return "\n".join(lines) + " big red dog" * rnd.choice([0] * 20 + [3, 25])
    sizes = {("en", "a"): 150, ("en", "b"): 20, ("de", "a"): 70, ("fr", "c"): 30, (None, "a"): 10, ("fr", None): 10}
    rows = [(1000 * g + i, text(i), *key) for g, (key, n) in enumerate(sizes.items()) for i in range(n)]
    docs = documents(spark, rows)
    out = {r.row.doc_id: (r.kept, r.base_failed) for r in Q.judge(docs).collect()}
    assert by_sql(docs, tmp_path / "d") == {i: kept for i, (kept, _) in out.items()}
    adaptive = sum(not kept and not failed for kept, failed in out.values())
    assert 5 < adaptive < len(rows) / 2
    few = documents(spark, rows[:40])
    assert by_sql(few, tmp_path / "e") == {r.row.doc_id: r.kept for r in Q.judge(few).collect()}


def test_few_repeats_are_no_evidence_and_many_are(spark):
    """In groups without repeated lines, one of five is kept, 40 of 100 (below the old floor) are not."""
    def text(i, lines, twice):
        one = [" ".join(f"v{i}q{n}q{j}" for j in range(20)) for n in range(lines - twice)]
        return "\n".join(one + [f"again{i} and again"] * twice if twice < 3 else one + ["same"] * (twice + 1))
    rows = [(i, text(i, 5, 0), "en", "a") for i in range(300)]
    out = {r.row.doc_id: (r.kept, r.base_failed) for r in Q.judge(documents(spark, [*rows, (500, text(500, 5, 2)), (501, text(501, 100, 40))])).collect()}
    assert all(out[r[0]] == (True, False) for r in rows)
    assert out[500] == (True, False) and out[501] == (False, False)
