import random
import re

from aerocast.llm import url_filter as U
from aerocast.llm.queries import URL_RULES

URLS = ["http://A.Example.COM/de/1?x#y", "https://example.com/de", "x://net", "x://net/", "x://a.net/en/", "http://example.net/en/1", "http://xexample.net/en/1",
        "http://É.org/fr/", "http://org/fr/a?b", "http://b.org/fr", "no scheme", None, "", "a://b://c/d", "http://h?q://x/y", "http://example.net:80/en/", "http://h#f"]


def plain(url):
    if not url or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in URL_RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best and best[2]


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")


def test_rules(spark):
    got = {r.page_id: r for r in U.judge(pages(spark, URLS), URL_RULES).collect()}
    for i, u in enumerate(URLS):
        host, path, rule, verdict = plain(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        assert got[i].verdict == (verdict or "allow")


def test_forms_and_variable_segments(spark):
    urls = [f"http://h.x/user/{chr(97 + i % 26)}{chr(97 + i // 26)}q/post/{i}.html" for i in range(200)] + ["http://h.x/about"] * 50
    got = U.judge(pages(spark, urls), []).select("template").distinct().collect()
    assert len(got) <= 3 and any("*" in r.template and "<n>.html" in r.template for r in got)


def test_templates_by_labelled_purity(spark):
    urls = [f"http://h.x/casino/{i}" for i in range(60)] + [f"http://h.x/news/{i}" for i in range(300)] + [f"http://k.x/a/{i}" for i in range(9)]
    labels = spark.createDataFrame([(i, True) for i in range(40)], "page_id long, bad boolean")
    got = {r.page_id: r.verdict for r in U.judge(pages(spark, urls), [], labels=labels).collect()}
    assert all(got[i] == "block" for i in range(60))  # the twenty without a label too
    assert all(got[i] == "allow" for i in range(60, len(urls)))


def test_similar_branches_merge(spark):
    urls = [f"http://h.x/{s}/{i}" for s in ("a", "b", "c") for i in range(40)]
    got = {r.template for r in U.judge(pages(spark, urls), []).collect()}
    assert got == {"/*/<n>"}


def test_empty_and_repeated(spark):
    assert U.judge(pages(spark, []), URL_RULES).count() == 0
    one = pages(spark, ["http://a.net/"]).union(pages(spark, ["http://a.net/"]))
    assert [r.verdict for r in U.judge(one, URL_RULES).collect()] == ["block"] * 2


def test_pages_without_a_label_do_not_dilute(spark):
    urls = [f"http://h.x/casino/{i}" for i in range(1000)] + [f"http://k.x/mixed/{i}" for i in range(100)] + [f"http://h.x/news/{i}" for i in range(200)]
    marks = [(i, True) for i in range(300)] + [(1000 + i, i < 10) for i in range(70)]
    got = {r.page_id: r.verdict for r in U.judge(pages(spark, urls), [], labels=spark.createDataFrame(marks, "page_id long, bad boolean")).collect()}
    assert all(got[i] == "block" for i in range(1000))  # 300 of 300 labelled pages are bad
    assert all(got[i] == "allow" for i in range(1000, 1300))  # 10 of 70, and no label at all


def test_deep_paths_share_templates(spark):
    urls = [f"http://h.x/a/b/c/d/e/f/g/{chr(97 + i % 26)}{chr(97 + i // 26)}q" for i in range(60)] + ["http://k.x/" + "z/" * 40, "http://k.x/y"]
    labels = spark.createDataFrame([(i, True) for i in range(30)], "page_id long, bad boolean")
    got = {r.page_id: r for r in U.judge(pages(spark, urls), [], labels=labels).collect()}
    assert len(got) == 62 and {got[i].template for i in range(60)} == {"/a/b/c/d/e/f/g/*"}
    assert all(got[i].verdict == "block" for i in range(60))  # the thirty without a label too
    assert got[60].verdict == got[61].verdict == "allow"


def marked(spark, urls, marks):
    """(url, label or None) -> template and verdict of each page."""
    labels = spark.createDataFrame([(i, m) for i, m in enumerate(marks) if m is not None], "page_id long, bad boolean")
    return {r.page_id: r for r in U.judge(pages(spark, urls), [], labels=labels).collect()}


def test_a_branch_is_compared_with_its_siblings(spark):
    urls = ["http://a.x/spam/x"] * 300 + ["http://a.x/good/x"] * 300 + ["http://b.x/bad/p"] * 30 + ["http://b.x/news/p"] * 3 \
        + ["http://c.x/one/p"] * 4 + ["http://c.x/two/p"] * 4 + [f"http://d.x/{s}/p" for s in ("k", "l", "m") for _ in range(20)] + ["http://e.x/n/p"] * 20 + ["http://e.x/o/p"] * 20
    marks = [True] * 300 + [None] * 300 + [True] * 30 + [False] * 3 + [True] * 4 + [False] * 4 + [i % 20 < 10 for i in range(60)] + [True] * 20 + [False] * 20
    got = {(r.host, r.template, r.verdict) for r in marked(spark, urls, marks).values()}
    assert got == {("a.x", "/spam/x", "block"), ("a.x", "/good/x", "allow"), ("b.x", "/bad/p", "block"), ("b.x", "/news/p", "allow"),
                   ("c.x", "/one/p", "allow"), ("c.x", "/two/p", "allow"), ("d.x", "/*/p", "block"), ("e.x", "/n/p", "block"), ("e.x", "/o/p", "allow")}


def plain_tree(urls, marks):
    """page -> (template, blocked), by a plain walk down each depth."""
    rows = {}
    for i, u in enumerate(urls):
        host, path = plain(u)[:2]
        rows[i] = [host, tuple("<n>" if s.isdigit() else s for s in path.split("/") if s)]
    for d in range(max(len(t) for _, t in rows.values())):
        nodes = {}
        for i, (host, t) in rows.items():
            if len(t) > d:
                c = nodes.setdefault((host, t[:d]), {}).setdefault(t[d], [0, 0, 0, []])
                c[0] += 1
                c[1] += marks[i] is not None
                c[2] += marks[i] is True
                c[3].append(i)
        for children in nodes.values():
            n, known, bad = (sum(c[j] for c in children.values()) for j in range(3))
            variable, merge = len(children) >= U.MANY and n < U.RARE * len(children), []
            for c in children.values():
                differs, enough = False, c[1] >= U.EVIDENCE and known - c[1] >= U.EVIDENCE
                if enough:
                    p = bad / known
                    differs = abs(c[2] / c[1] - (bad - c[2]) / (known - c[1])) > U.APART * (p * (1 - p) * (1 / c[1] + 1 / (known - c[1]))) ** 0.5
                if (variable or enough or bad == 0) and not differs:
                    merge.append(c)
            if len(merge) > 1:
                for c in merge:
                    for i in c[3]:
                        rows[i][1] = (*rows[i][1][:d], "*", *rows[i][1][d + 1:])
    known = [i for i in rows if marks[i] is not None]

    def count(of):
        mine = [i for i in known if of(rows[i])]
        return len(mine), sum(marks[i] for i in mine)
    every = count(lambda r: True)
    prior, out, memo = every[1] / every[0] if every[0] else 0.0, {}, {}
    for i, (host, t) in rows.items():
        if (host, t) not in memo:
            h, own = count(lambda r: r[0] == host), count(lambda r: r == [host, t])
            of_host = (h[1] + U.PRIOR * prior) / (h[0] + U.PRIOR)
            memo[host, t] = own[1] >= U.MIN_BAD and (own[1] + U.PRIOR * of_host) / (own[0] + U.PRIOR) >= U.REJECT
        out[i] = ("/" + "/".join(t), memo[host, t])
    return out


def test_equal_to_a_plain_tree(spark):
    for seed in (1, 2):
        r = random.Random(seed)
        urls, marks = [], []
        for _ in range(1500):
            host, depth = r.choice(["a.x", "b.x", "c.x"]), r.randrange(5)
            segments = [r.choice(["p", "q", "r", str(r.randrange(9)), r.choice("abcdefghijklmnopqrstuvwxyz") + "z"]) for _ in range(depth)]
            urls.append(f"http://{host}/{'/'.join(segments)}")
            odds = 0.9 if "p" in segments[:2] and host != "c.x" else 0.1
            marks.append(r.random() < odds if r.random() < 0.4 else None)
        got = {i: (x.template, x.verdict == "block") for i, x in marked(spark, urls, marks).items()}
        want = plain_tree(urls, marks)
        assert got == want and len({t for t, _ in want.values()}) > 20 and any("*" in t for t, _ in want.values()) and any(b for _, b in want.values())


def test_very_long_urls_and_paths(spark):
    urls = ["http://h.x/" + "a" * 200_000, "http://h.x/" + "s/" * 1000, "http://h.x/" + "/" * 50_000]
    assert len(marked(spark, urls, [None, None, True])) == 3
