import random

import numpy as np
import xxhash
from aerocast.llm import simhash as S
from helpers import LONG, ODD, documents, with_clashes, words


def plain(text):
    w = "".join(c.lower() if c.isascii() else c for c in text or "")
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", w) if x]
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fp):
    """Components by comparing all pairs."""
    root = list(range(len(fp)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for i in range(len(fp)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 3:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fp))]


def test_fingerprints(spark):
    texts = [None, "", " \n", "One", "one TWO", "ÀB c d", "a b c", "a b c d a b c d", "x\x1cy z", words(500), LONG]
    got = S.fingerprints(documents(spark, [*enumerate(texts)])).collect()
    assert [r.fingerprint % 2**64 for r in got] == [plain(t) for t in texts]
    spark_hash = spark.sql("select xxhash64('a b c') h").first().h % 2**64
    assert spark_hash == xxhash.xxh64_intdigest(b"a b c", seed=42)


def clouds(seed, centres, around, far=3):
    rnd, out = random.Random(seed), set()
    for _ in range(centres):
        c = rnd.getrandbits(64)
        for _ in range(around):
            x = c
            for b in rnd.sample(range(64), rnd.randint(0, far)):
                x ^= 1 << b
            out.add(x)
    return sorted(out)


def check(spark, fp):
    nodes = spark.createDataFrame([(i, int(np.uint64(x).view(np.int64))) for i, x in enumerate(fp)], "doc_id long, fingerprint long")
    got = {int(np.int64(r.fingerprint).view(np.uint64)): r.component_id for r in S.classes(nodes).collect()}
    assert [got[x] for x in fp] == groups(fp)


def test_links_as_by_all_pairs(spark):
    check(spark, clouds(1, 60, 6, far=5))


def test_large_buckets_are_cut_into_units(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 40)
    check(spark, clouds(2, 2, 250))


def test_chain_of_links(spark):
    x = [0]
    for i in range(20):
        x.append(x[-1] ^ (0b111 << 3 * i))
    check(spark, x)


def test_rows(spark):
    docs = with_clashes(documents(spark, ODD))
    out = S.near_duplicates(docs).collect()
    assert len(out) == len(ODD)
    assert {r.component_id for r in out if r.doc_id in (1, 2, 3)} == {1}
    assert S.near_duplicates(documents(spark, [])).count() == 0


def test_keep_one(spark):
    base = words(400).split()
    near = " ".join([*base[:-1], "other"])
    rows = [(5, " ".join(base)), (4, near), (9, words(300, 5000)), (9, words(300, 5000)), (9, words(200, 9000)), (None, "no id"), (1, None), (2, "")]
    assert (S.fingerprint(rows[0][1]) ^ S.fingerprint(near)).bit_count() <= 3
    docs = with_clashes(documents(spark, rows))
    out = S.keep_one(docs)
    assert out.columns == docs.columns
    got = sorted((r.doc_id or -1, r.text or "") for r in out.collect())
    assert got == sorted([(4, near), (9, words(300, 5000)), (9, words(200, 9000)), (-1, "no id"), (1, "")])
    assert S.keep_one(documents(spark, [])).count() == 0
