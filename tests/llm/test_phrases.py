import random
import re
from collections import Counter

import pytest
from aerocast.llm import phrases as P
from aerocast.llm import sql as Q
from pyspark.sql import functions as F

from helpers import ODD, documents, with_clashes

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, top=2000):
    f, total = [Counter() for _ in range(4)], Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lower):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            total[lang] += len(w)
            for k in (1, 2, 3):
                f[k].update((lang, *w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for k in (2, 3):
        for (lang, *w), a in f[k].items():
            if a < 10 or k == 2 and any(f[3][g] >= 10 and 2 * f[3][g] >= a for g in f[3] if g[0] == lang and w in ([*g[1:3]], [*g[2:4]])):
                continue
            cuts = [(10 ** 6 * a * a // (f[c][lang, *w[:c]] * f[k - c][lang, *w[c:]]), c) for c in range(1, k)]
            score, c = min(cuts)
            out.append((lang, " ".join(w), a, f[c][lang, *w[:c]], f[k - c][lang, *w[c:]], total[lang], score))
    ranked = []
    for lang in {x[0] for x in out}:
        mine = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        ranked += [(lang, i + 1, *x[1:]) for i, x in enumerate(mine[:top])]
    return sorted(ranked)


def corpus(seed, n=90, words=4):
    r = random.Random(seed)
    vocabulary = ["the", "The", "of", "é", "漢字", "x-y", "it's", "a b", "Q" * 80, "q" * 80 + "z", *[f"w{i}" for i in range(words)]]

    def text():
        return "".join(r.choice(vocabulary) + r.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "!?"]) for _ in range(r.randrange(120)))
    return [(text() + r.choice(["", "big red dog ", "big red dog big red cat"]) * 3, r.choice(["en", "de", None])) for _ in range(n)]


def found(spark, rows, **kw):
    docs = documents(spark, [(i, t, x) for i, (t, x) in enumerate(rows)])
    return sorted(tuple(r) for r in P.collocations(docs, **kw).select(COLUMNS).collect())


def test_equal_to_plain_counting(spark):
    rows = corpus(1)
    assert found(spark, rows) == plain(rows) and len(plain(rows)) > 30


def test_bursts_spills_slices_and_a_full_bitmap(spark, monkeypatch):
    rows = corpus(2)
    for name, value in (("BURST", 8), ("MOST_ENTRIES", 60), ("SLICE", 37), ("FILTER_BITS", 8), ("RANK_PARTS", 3)):
        monkeypatch.setattr(P, name, value)
    assert found(spark, rows, top=25) == plain(rows, 25)


def test_trie_counts_and_spills_whole_subtrees():
    r = random.Random(3)
    trie, want, out = P.Trie(3, burst=5), Counter(), Counter()
    for _ in range(300):
        grams = [b"".join((r.randrange(9) << 56 | r.randrange(9)).to_bytes(8, "big") for _ in range(3)) for _ in range(10)]
        trie.add(grams, [2] * 10)
        for g in grams:
            want[g] += 2
        if trie.size > 300:
            run, n = trie.spill(150)
            left = {g[0] for part in trie._parts(trie.root) for g in part.counts}
            assert run == sorted(run) and trie.size <= 150 and {g[0] for g in run}.isdisjoint(left)
            out.update(dict(zip(run, n)))
    out.update(dict(zip(*trie.spill())))
    assert out == want and trie.size == 0


def test_clashing_ids_take_the_next_seed(spark, monkeypatch):
    rows = [("big red dog. " * 12, "en")]
    seeds, real = [], P.count_words

    def count_words(docs, seed):
        seeds.append(seed)
        out = real(docs, seed)
        return out if seed else out.withColumn("w1", F.lit(7).cast("long"))
    monkeypatch.setattr(P, "count_words", count_words)
    assert found(spark, rows) == plain(rows) and seeds == [0, 1]


def test_defined_results(spark):
    rows = [(r[1], r[2] if len(r) > 2 else "en") for r in ODD] + [("same pair here. " * 6, "en")] * 2
    docs = with_clashes(documents(spark, [(1, t, x) for t, x in rows])).withColumn("a.b", F.lit(1)).withColumn("w1", F.lit("x"))
    got = sorted(tuple(r) for r in P.collocations(docs).select(COLUMNS).collect())
    assert got == plain(rows) and ("same pair here" in [x[2] for x in got])
    assert P.collocations(docs.limit(0)).count() == 0
    assert found(spark, [("one two", "en")]) == []


def test_equal_to_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    rows = corpus(5, 120)
    documents(spark, [(i, t, x) for i, (t, x) in enumerate(rows)]).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    got = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({Q.PHRASES})").fetchall()
    assert sorted(got) == found(spark, rows)
