import random
import re

import pytest
from aerocast.llm import license_scan as L
from aerocast.llm import sql as Q
from aerocast.llm.license_texts import PHRASES, TEXTS

from helpers import ODD, documents, with_clashes

MIT = next(text for label, text in TEXTS if label == "mit" and len(text) > 200)
BSD = next(text for label, text in TEXTS if label == "bsd")


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w]


def plain(text, templates=TEXTS, phrases=PHRASES):
    """Spans by direct counting of equal grams on diagonals."""
    w, out = words(text), []
    for t, (label, body) in enumerate([*phrases, *templates]):
        tw = words(body)
        k, n = min(3, len(tw)), len(tw)
        places = {}
        for i in range(n - k + 1 if n else 0):
            places.setdefault(tuple(tw[i:i + k]), []).append(i)
        votes = {}
        for i in range(len(w) - k + 1):
            for p in places.get(tuple(w[i:i + k]), []):
                votes.setdefault(i - p, []).append((p, i))
        strong = sorted((d, v) for d, v in votes.items() if len(v) >= max(1, (n - k + 1) // 32))
        groups = []
        for d, v in strong:
            if groups and d - groups[-1][-1][0] <= n // 8:
                groups[-1].append((d, v))
            else:
                groups.append([(d, v)])

        def judged(vs):
            covered = {p + j for v in vs for p, _ in v for j in range(k)}
            lo, hi = min(i for v in vs for _, i in v), max(i for v in vs for _, i in v) + k
            fine = len(covered) >= 0.8 * n and len(covered) >= 0.5 * (hi - lo)
            return [(lo, hi, t, label, t < len(phrases), len(covered) / n)] if fine else []

        for g in groups:
            out += judged([v for _, v in g]) or [s for _, v in g for s in judged([v])]
    return len(w), sorted(out)


def scan(spark, rows, **kw):
    got = L.scan_documents(documents(spark, rows), **kw).collect()
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, [tuple(s) for s in r.spans]) for r in got)


def edited(r, text):
    w = text.split()
    for _ in range(r.randrange(8)):
        i = r.randrange(len(w) + 1)
        w[i:i + r.randrange(3)] = r.choice([[], ["new"], ["two", "words"], ["the", "software"]])
    return " ".join(w)


def corpus(seed, n=60):
    r = random.Random(seed)
    filler = ["the", "software", "of", "mit", "license", "MIT License.", "general public", "apache", "kİnd", "K", "é", *[f"w{i}" for i in range(30)]]

    def fill():
        return " ".join(r.choice(filler) for _ in range(r.randrange(60)))
    return [(i, "\n".join([fill(), *[edited(r, r.choice([*TEXTS, *PHRASES])[1]) + " " + fill() for _ in range(r.randrange(4))]])) for i in range(n)]


def test_equal_to_plain_voting(spark):
    rows = corpus(1)
    want = sorted((i, *plain(t)) for i, t in rows)
    assert scan(spark, rows) == want
    assert sum(len(x[2]) for x in want) > 40


def test_a_cut_and_edited_copy_is_one_span(spark):
    w = MIT.split()
    text = "Intro words here. " + " ".join(w[:40] + ["an", "added", "remark"] + w[40:70] + w[74:]) + " and so on"
    [(_, _, spans)] = scan(spark, [(1, text)])
    [mit] = [s for s in spans if s[3] == "mit"]
    assert mit[0] == 3 and mit[1] >= len(w) and 0.9 < mit[5] < 1
    half = " ".join(w[:len(w) // 2])
    assert scan(spark, [(1, half)])[0][2] == []


def test_copies_one_after_the_other_and_noise(spark):
    rows = [(1, f"{BSD} {BSD}"), (2, " ".join(["the above copyright notice"] * 500 + [BSD]))]
    got = scan(spark, rows)
    assert [len([s for s in x[2] if s[3] == "bsd"]) for x in got] == [2, 1] and got == [(i, *plain(t)) for i, t in rows]


def test_defined_results(spark):
    rows = [*ODD, (7, "MIT License"), (7, "MIT License"), (8, "mit\x00license, MIT\nLICENSE Mit license2"), (9, "mIt-license " * 20_000)]
    docs = with_clashes(documents(spark, rows)).withColumnRenamed("spans", "template")
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, [tuple(s) for s in r.spans]) for r in L.scan_documents(docs).collect())
    assert got == sorted((-1 if r[0] is None else r[0], *plain(r[1])) for r in rows)
    assert L.scan_documents(docs.limit(0)).count() == 0
    assert scan(spark, rows[:3], templates=[], phrases=[("x", "--")]) == [(i, 0, []) for i in (1, 2, 3)]
    assert scan(spark, [(1, "Foo bar foo")], templates=[("f", "foo")], phrases=[])[0][2] == [(0, 1, 0, "f", False, 1.0), (2, 3, 0, "f", False, 1.0)]


def test_equal_to_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    rows = [*corpus(7), *ODD]
    documents(spark, rows).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    got = con.execute(f"SELECT coalesce(doc_id, -1), n_words, n_base, first_word, last_word, base_labels, labels, score FROM ({Q.LICENSES})").fetchall()

    def digest(n, spans):
        base = [s for s in spans if s[4]]
        return (n, len(base), min((s[0] for s in base), default=None), max((s[0] for s in base), default=None),
                ",".join(sorted({s[3] for s in base})), ",".join(sorted({s[3] for s in spans})), max((s[5] for s in spans), default=0.0))
    assert sorted(map(repr, got)) == sorted(repr((-1 if r[0] is None else r[0], *digest(*plain(r[1])))) for r in rows)
