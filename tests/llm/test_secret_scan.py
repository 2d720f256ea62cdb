import re
from math import log2

from aerocast.llm import secret_scan as S
from helpers import ODD, documents, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st

HEX40 = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
RANDOM = "qT7vLx2ZpR9sWk4YbN8mHc5J"


def brute(text):
    """The base spans straight from their definition."""
    found = []
    for kind, pattern, group, least in (
            (0, r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
            (1, r"AKIA[A-Z0-9]+", 0, 20), (2, r"[0-9a-f]+", 0, 24)):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m.group(group)) >= least]
    return [(S.KINDS[k], a, b) for a, k, b in sorted(found)]


piece = st.sampled_from(["token", "Secret", "api_key", "APIKEY", "passwd", "=", ":", " ", "\n", "'", '"', "AKIA", "ABCDEFGHIJKLMNOP12", HEX40[:23],
                         HEX40, "é", "ſecret", "toKen", "abc", "-/+", RANDOM, "🙂"])


@settings(max_examples=400, deadline=None)
@given(st.lists(piece, max_size=12).map("".join))
def test_base_spans(text):
    assert [s for s in S.scan(text) if s[0] != "entropy"] == brute(text)


def test_entropy_is_that_of_each_window():
    run = RANDOM + "aaaaaaaaaaaaaaaaaaaa" + HEX40
    limit, good = S.THRESHOLDS[S.char_class(run)], set()
    for i in range(len(run) - S.WINDOW + 1):
        w = run[i:i + S.WINDOW]
        if -sum(w.count(c) / S.WINDOW * log2(w.count(c) / S.WINDOW) for c in set(w)) >= limit:
            good |= set(range(i, i + S.WINDOW))
    assert {x for a, b in S.entropy_spans(run) for x in range(a, b)} == good and good


def test_allow_list():
    for clean in ("internationalization-of-everything", "123e4567-e89b-12d3-a456-426614174000", "https://example.org/aB3xY7/news/2024",
                  "1234567890.1234567890.123", "www.example.com/some/long/path/to/a/page", "=" * 40):
        assert S.scan(clean) == [], clean
    assert [k for k, _, _ in S.scan(f"x {RANDOM} y")] == ["entropy"]
    assert {k for k, _, _ in S.scan(f'token = "{HEX40}"')} == {"assign", "hex", "entropy"}


def test_redact():
    text = f'é a token = "{HEX40}" b AKIA{"A1" * 10} c'
    assert S.redact(text, S.scan(text)) == 'é a [SECRET]" b [SECRET] c'
    assert S.redact(None, []) is None and S.redact("x", []) == "x"


def test_rows(spark):
    docs = with_clashes(documents(spark, [*ODD, (8, f"token={HEX40}")]))
    out = S.scan_documents(docs).collect()
    assert len(out) == len(ODD) + 1 and sum(bool(r["spans"]) for r in out) == 1
    kept = S.redact_documents(docs)
    assert kept.columns == docs.columns and kept.count() == len(ODD) + 1
    assert kept.where("doc_id = 8").first().text == "[SECRET]" and kept.where("doc_id = 1").first().text is None
    assert S.scan_documents(documents(spark, [])).count() == 0 and S.redact_documents(documents(spark, [])).count() == 0


def test_segments_of_paths_are_judged_alone():
    text = f"see hooks.example.com/services/T0/{RANDOM} or x"
    assert [(k, text[a:b]) for k, a, b in S.scan(text)] == [("entropy", RANDOM)]
    assert S.redact(text, S.scan(text)) == "see hooks.example.com/services/T0/[SECRET] or x"
    letters = "qTbvLxZpRdsWkaYbNmHcJgUw"
    assert [k for k, _, _ in S.scan(f"x {letters} y")] == ["entropy"]
    assert [k for k, _, _ in S.scan(f"x path/to/{letters} y")] == ["entropy"]
    for clean in ("www.example.com/blog/the-10-best-things-to-do-in-paris-2024", "docs.example.com/api/parseHTTPResponseHeaderFields", "InternationalizationOfEverything",
                  "files.example.com/123e4567-e89b-12d3-a456-426614174000/x", "THEQUICKBROWNFOXJUMPSOVER", "a-very-long-subdomain-name.example.com/x"):
        assert S.scan(clean) == [], clean


def test_keys_in_paths_of_urls_are_found_and_ordinary_urls_are_not():
    import random
    r, n = random.Random(4), 400
    mixed = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(r.choice(mixed) for _ in range(24)) for _ in range(n)]
    for before in ("https://hooks.example.com/services/T0/", "hooks.example.com/services/T0/", "https://example.com/a?key=", ""):
        at = len(before) + 5
        hit = sum(any(kind == "entropy" and a <= at + 2 and b >= at + 22 for kind, a, b in S.scan(f"see: {before}{k} x")) for k in keys)
        assert hit >= 0.95 * n, before
    words = ["news", "about", "Contact", "best-things-to-do-in-paris", "2024", "index.html", "user_profile", "category", "long-article-title-here-and-more", "p", "v1.2.3"]
    clean = [f"https://www.example.{r.choice(['com', 'org'])}/{'/'.join(r.choice(words) for _ in range(r.randrange(6)))}" for _ in range(n)]
    assert not any(S.scan(f"at {u} today") for u in clean)
    text = f"git+ssh://user.example.com/{RANDOM}/x"
    assert [text[a:b] for _, a, b in S.scan(text)] == [RANDOM]


def test_columns_with_any_name(spark):
    from pyspark.sql import functions as F
    docs = documents(spark, [(1, f"token={HEX40}")]).withColumn("a.b", F.lit(1)).withColumn("x`y", F.lit(2)).withColumn("c0", F.lit(3))
    out = S.redact_documents(docs)
    assert out.columns == docs.columns and tuple(out.first())[1] == "[SECRET]" and tuple(out.first())[-3:] == (1, 2, 3)
