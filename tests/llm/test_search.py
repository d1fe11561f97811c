from __future__ import annotations

import math
import random

import numpy as np

from branchyard.llm import maxscore, url_rules
from tests.llm.helpers import frame

VECTORS = "vec_id long, embedding array<float>"


def brute(rows, wanted, k):
    ok = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in ok} & wanted):
        vector = min(v for i, v in ok if i == q)
        scores = sorted((-sum(a * b for a, b in zip(vector, v)), i) for i, v in ok if i != q)
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:k])]
    return out


def test_top_k_is_that_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(maxscore, "SHARD_ROWS", 100)
    monkeypatch.setattr(maxscore, "QUERY_ROWS", 7)
    drawn = random.Random(4)
    rows = [(k, [drawn.gauss(0, 0.2) for _ in range(12)]) for k in range(400)]
    rows += [(1000 + k, rows[k % 5][1]) for k in range(40)]  # ties
    rows += [(2000, None), (2001, [float("nan")] * 12), (2002, [None] * 12), (2003, [float("inf")] * 12), (None, [0.1] * 12), (2010, [0.0] * 12), (2020, [0.5]), (2030, []), (10, rows[10][1])]
    table = frame(spark, rows, VECTORS)
    wanted = {k for k, _ in rows if k is not None and k % 10 == 0}
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in maxscore.top_k(table, table.where("vec_id % 10 = 0")).collect())
    assert got == brute(rows, wanted, 10)


def test_slices_pass_over_rows_that_cannot_compete(monkeypatch):
    drawn = np.random.default_rng(2)
    rows = drawn.integers(-50, 50, (2000, 8))
    part, query = maxscore.Slice(np.arange(2000), rows), rows[7]
    scores = rows @ query
    least = int(np.sort(scores)[-20])
    ids, found = part.search(-1, query, least)
    assert set(np.flatnonzero(scores >= least)) <= set(ids) and len(ids) < 200
    assert (scores[ids] == found).all()


def test_few_and_no_vectors(spark):
    two = frame(spark, [(0, [1.0, 2.0]), (1, [3.0, -1.0])], VECTORS)
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in maxscore.top_k(two, two.where("vec_id = 0")).collect()] == [(0, 1, 1, 1024 * 1024)]
    assert maxscore.top_k(two.limit(0), two.limit(0)).collect() == []


# ---- URLs

URLS = [
    "http://a.example.net/en/x", "http://example.net/en/", "https://b.net", "https://b.net?x=/", "http://b.net/", "http://notexample.net/en/1", "http://EXAMPLE.com/de/1#x",
    "http://x.example.com/en/1", "http://a.org/fr/1", "http://org/fr/", "http://a.org/frx", "ftp://b.net/y://z.org/fr/", "no scheme", "", None, "http:///en/", "http://b.net:80/", "http://a..net/", "http://net./", "http://net/",
]


def judge(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, rest = rest[:cut], rest[cut:]
        path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


def test_urls_are_judged_like_rule_by_rule(spark):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("a.example.net", "", "block"), ("net", "/", "allow")]
    drawn = random.Random(5)
    urls = URLS + [f"http://{'.'.join(drawn.choices(['a', 'b', 'example', 'net', 'com', 'org'], k=drawn.randint(1, 4)))}/{drawn.choice(['en', 'de', 'fr', ''])}/{drawn.randint(0, 9)}" for _ in range(500)]
    urls += ["http://hot.net/same"] * 300
    pages = frame(spark, [*enumerate(urls), (None, URLS[0]), (1, URLS[0])], "page_id long, url string")
    got = sorted(((r.id, r.host, r.path, r.rule, r.verdict) for r in url_rules.judged_urls(pages, frame(spark, rules, "host string, path string, verdict string")).collect()), key=repr)
    want = [(r[0], *judge(r[1], [x for x in rules if x != ("net", "/", "allow")])) for r in [*enumerate(urls), (None, URLS[0]), (1, URLS[0])]]
    assert got == sorted(want, key=repr)


def test_no_rules_and_no_pages(spark):
    pages, rules = frame(spark, [(1, URLS[0])], "page_id long, url string"), frame(spark, [], "host string, path string, verdict string")
    assert [(r.rule, r.verdict) for r in url_rules.judged_urls(pages, rules, default="block").collect()] == [(None, "block")]
    assert url_rules.judged_urls(pages.limit(0), rules).collect() == []
