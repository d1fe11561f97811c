"""Operators over whole tables: whitening, Merkle manifests, repeated passages, each against a plain version."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from branchyard.llm import merkle, repeated_spans, whitening
from tests.llm.helpers import ODD, clashing, frame

NULLS_FIRST = lambda row: tuple((v is not None, v if v is not None else 0) for v in row)

# ---- whitening

VECTORS = "vec_id long, embedding array<float>"


def covariance(rows):
    """Ids, whole numbers padded to the widest, and eigenvalues and eigenvectors of their covariance."""
    fit = [(i, [float(np.float32(x)) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(len(v) for _, v in fit)
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v + [0.0] * (width - len(v))] for _, v in fit])
    away = x - x.sum(0) / len(x)
    _, singular, axes = np.linalg.svd(away, full_matrices=False)  # more exact than from the covariance
    return [i for i, _ in fit], x, away, singular**2 / len(x), axes.T


def check_whitening(spark, rows, expected, near=1e-9, **options):
    ids, x, away, values, axes = covariance(rows)
    got = whitening.whiten(frame(spark, rows, VECTORS), **options).collect()
    assert len(got) == len(ids) * expected
    n, sums = len(x), x.sum(0)
    exact = {(i, sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums))) for i, row in zip(ids, x)}
    assert {(r.vec_id, int(r.deviation)) for r in got} == exact
    assert {r.n for r in got} == {n} and {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9
    for k in range(expected):
        plain = away @ axes[:, k] / math.sqrt(values[k])
        own = sorted((i, v) for i, v in zip([repr(i) for i in ids], plain))
        mine = sorted((repr(r.vec_id), r.whitened) for r in got if r.component == k + 1)
        a, b = np.array([v for _, v in own]), np.array([v for _, v in mine])
        assert [i for i, _ in own] == [i for i, _ in mine]
        assert min(np.abs(np.sort(a) - np.sort(b)).max(), np.abs(np.sort(a) - np.sort(-b)).max()) < near
        shares = {r.explained for r in got if r.component == k + 1}
        assert len(shares) == 1 and abs(shares.pop() / (values[k] / values.sum()) - 1) < 1e-9


def test_whitening_is_that_of_the_covariance(spark):
    drawn = random.Random(11)
    rows = [(k, [drawn.gauss(0, 0.1 + 0.05 * d) for d in range(12)]) for k in range(300)]
    rows += [(1000, rows[3][1])] * 100  # one vector is a quarter of all
    rows += [(None, [0.5] * 12), (2000, None), (2001, [None] * 12), (2002, [float("nan")] * 12), (2003, [float("inf")] * 12), (2004, [0.25] * 3), (2005, [])]
    check_whitening(spark, rows, 8)
    check_whitening(spark, rows, 3, components=3)


def test_ill_conditioned_and_dependent_dimensions(spark):
    drawn = random.Random(12)
    large = [[drawn.gauss(0, 4000.0) for _ in range(3)] for _ in range(200)]
    steep = [(k, [*v, v[0] + drawn.randint(0, 1) / 1024, drawn.gauss(0, 0.01)]) for k, v in enumerate(large)]
    check_whitening(spark, steep, 5, near=1e-7)  # the condition number is about 1e7
    flat = [(k, [*v, v[0], 7.0, v[1] - v[2]]) for k, v in enumerate([[float(round(x)) for x in v] for v in large])]
    check_whitening(spark, flat, 3)  # a copy, a constant and a difference add no component
    check_whitening(spark, flat[:3], 2)  # three rows span two directions


@pytest.mark.parametrize("rows", [[], [(1, [0.5, 0.25])], [(1, [0.5]), (2, [0.5])], [(1, None)], [(1, []), (2, [])]])
def test_nothing_to_whiten(spark, rows):
    assert whitening.whiten(frame(spark, rows, VECTORS)).collect() == []


def test_whitening_with_other_columns(spark):
    rows = [(k, [float(k % 3), float(k % 5)]) for k in range(30)]
    table = frame(spark, rows, VECTORS).withColumns({c: F.lit("x") for c in ("n", "whitened", "vector", "component", "row", "i")})
    assert len(whitening.whiten(table).collect()) == 60


def test_components_too_large(spark):
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(frame(spark, [(1, [1e30]), (2, [0.0])], VECTORS)).collect()


def test_exact_sums_beyond_64_bits():
    x = np.array([[2**50, 3], [5, -(2**50)]])
    sums = [2**61 + 1, -(2**60)]
    n = 2**12
    assert whitening.squared_distances(x, n, sums) == [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
    assert np.allclose(whitening.centred(x, n, sums), [[(n * int(a) - s) / n for a, s in zip(row, sums)] for row in x], rtol=1e-15)


# ---- Merkle manifest

LEAF = ("doc_id", "lang", "text")
TABLE = "doc_id long, lang string, text string"


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[1], text)))


def tree_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def sides(levels, i):
    for level in levels[:-1]:
        run = level[i // 8 * 8 :][:8]
        yield "".join(run[: i % 8]), "".join(run[i % 8 + 1 :])
        i //= 8


def manifest(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append(row)
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    for lang in order:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[2])))
    built = {lang: tree_of([leaf(r, r[2]) for r in trees[lang]]) for lang in order}
    top = tree_of([built[lang][-1][0] for lang in order])
    for k, lang in enumerate(order):
        for i, row in enumerate(trees[lang]):
            path = [*sides(built[lang], i), *sides(top, k)]
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[2] is not None
            folded = leaf(row, "".join(c.lower() if "A" <= c <= "Z" else c for c in row[2]) if tampered else row[2])
            for left, right in path:
                folded = H(left + folded + right)
            yield row[0], leaf(row, row[2]), built[lang][-1][0], top[-1][0], H("".join(a + b for a, b in path)), folded, folded == top[-1][0]


def proved(table):
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    small = {"text": F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")}
    rows = merkle.merkle_proofs(table, LEAF, small, where=third)
    return sorted((tuple(r) for r in rows.select("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=NULLS_FIRST)


def test_manifest_and_proofs(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_LEAVES", 20)  # not a whole number of runs
    rows = [(k, "en", f"Text {k % 7} É") for k in range(150)]
    rows += [(k, lang, "A b") for k, lang in enumerate(["de", None, "", "aé", "z", "é", "fr", "it", "\U0001f600", "￿"] + ["es"] * 9 + ["pt"] * 8)]
    rows += [(i, "odd", t) for i, t in ODD] + [(5, None, None), (None, None, None)] + [(77, "en", "twice")] * 40
    table = frame(spark, rows, TABLE)
    assert proved(clashing(table).withColumns({c: F.lit("x") for c in ("tree", "size", "place", "digest", "level", "_part", "_tie")})) == sorted(manifest(rows), key=NULLS_FIRST)


@pytest.mark.parametrize("rows", [[(1, "en", "X")], [(1, None, None)], [(1, "en", "X"), (2, "de", "X")], [(k, "en", "x") for k in range(8)], [(k, "en", "x") for k in range(9)]])
def test_small_trees(spark, rows):
    assert proved(frame(spark, rows, TABLE)) == sorted(manifest(rows), key=NULLS_FIRST)


def test_no_leaves(spark):
    assert proved(frame(spark, [], TABLE)) == []


def test_shared_nodes_are_fetched_once():
    size = 1000
    for places in ([0], [0, 7], [3, 500, 999], list(range(64, 128)), [998, 999]):
        wanted = merkle.missing_nodes(places, size)
        assert len(set(wanted)) == len(wanted)
        needed, known = set(), {(0, p) for p in places}
        for place in places:
            n, level = size, 0
            while n > 1:
                needed |= {(level, at) for at in merkle.run_of(place, n)}
                place, n, level = place // 8, -(-n // 8), level + 1
                known.add((level, place))
        assert set(wanted) == needed - known


# ---- repeated passages


def plain_repeats(rows, window):
    first, docs = {}, [(i, (t or "").encode().split()) for i, t in rows]
    for i, words in docs:
        for p in range(len(words) - window + 1 if i is not None else 0):
            key = tuple(words[p : p + window])
            first[key] = min(i, first.get(key, i))
    for i, words in docs:
        gone = [False] * len(words)
        for p in range(len(words) - window + 1 if i is not None else 0):
            if first[tuple(words[p : p + window])] < i:
                gone[p : p + window] = [True] * window
        yield i, len(words), sum(gone), hashlib.sha256(b" ".join(w for w, g in zip(words, gone) if not g)).hexdigest()


def check_repeats(spark, rows, window=50):
    got = repeated_spans.without_repeats(clashing(frame(spark, rows)).withColumns({c: F.lit("x") for c in ("anchor", "context", "marks", "text_key", "at", "a", "b")}), window=window)
    want = sorted(plain_repeats(rows, window), key=NULLS_FIRST)
    assert sorted((tuple(r) for r in got.collect()), key=NULLS_FIRST) == want
    return sum(row[2] for row in want)


def test_repeats_of_pieces_put_together(spark):
    """Passages cut anywhere, joined, and changed in places: factors end within windows."""
    drawn = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    base = [drawn.choices(words, k=drawn.randint(60, 400)) for _ in range(10)]
    rows = []
    for i in range(150):
        text = []
        for _ in range(drawn.randint(0, 4)):
            source = drawn.choice(base)
            start = drawn.randrange(len(source))
            text += source[start : drawn.randint(start, len(source))] + drawn.choices(words, k=drawn.choice([0, 0, 5, 30]))
        for _ in range(drawn.choice([0, 0, 3]) if text else 0):
            text[drawn.randrange(len(text))] = drawn.choice(words)
        rows.append((drawn.choice([i, i, i // 3, -i]), drawn.choice([" ", "\n", "  \t"]).join(text)))
    assert check_repeats(spark, rows) > 3000
    assert check_repeats(spark, rows[:60], window=12) > 3000


def test_repeats_of_odd_texts(spark):
    rows = ODD + [(100, "a " * 3000), (101, "a " * 2000 + "b " * 60), (102, "b " * 70), (103, "x y z " * 100), (104, "y z x " * 100), (None, "a " * 100), (105, " a " * 60), (106, " a " * 60)]
    rows += [(200 + k, " ".join(f"{w}" for w in range(80))) for k in range(50)]  # one passage in many documents
    assert check_repeats(spark, rows) > 3000
    assert check_repeats(spark, []) == 0
    with pytest.raises(ValueError, match="at least"):
        repeated_spans.without_repeats(frame(spark, []), window=5)


def test_factors_are_maximal_and_cover_what_they_hold():
    starts = np.array([3, 4, 5, 9, 20, 21])
    first, last = repeated_spans.factors(starts)
    assert list(zip(first, last)) == [(3, 5), (9, 9), (20, 21)]
    assert list(np.flatnonzero(repeated_spans.covered(starts, 30, 4))) == [*range(3, 13), *range(20, 25)]
    assert not len(repeated_spans.factors(np.zeros(0, np.int64))[0])
