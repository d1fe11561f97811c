from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from branchyard.llm import common, decontamination, near_duplicates
from tests.llm.helpers import ODD, clashing, frame


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))) if words else frozenset()


def components(rows, width, percent):
    """All pairs, compared one by one."""
    sets = {doc: shingles(text, width) for doc, text in rows}
    parent = {doc: doc for doc in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {doc: (len(sets[doc]), root(doc), root(doc) == doc) for doc in ids}


def copies(seed, n):
    """Texts of groups of copies with more and more changed words, and short texts."""
    drawn = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(n // 10):
        base = drawn.choices(vocabulary, k=drawn.choice([3, 6, 12, 40, 150, 400]))
        for _ in range(10):
            words = list(base)
            for _ in range(drawn.randint(0, max(1, len(words) // 25))):
                words[drawn.randrange(len(words))] = drawn.choice(vocabulary)
            rows.append(" ".join(words))
    return list(enumerate(rows))


@pytest.mark.parametrize("width", [4, 5])
def test_components_are_those_of_all_pairs(spark, width):
    rows = copies(width, 300)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates.near_duplicates(frame(spark, rows), width=width).collect()}
    assert got == components(rows, width, 80)


def test_odd_rows(spark):
    got = sorted((r.doc_id is None, r.doc_id, r.n_shingles > 0, r.component_id, r.kept) for r in near_duplicates.near_duplicates(clashing(frame(spark, ODD))).collect())
    assert [(d, c, k) for _, d, _, c, k in got] == [
        (1, 1, True), (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 5, True), (6, 6, True), (7, 7, True), (8, 8, True), (9, 1, False), (None, None, True),
    ]
    assert near_duplicates.near_duplicates(frame(spark, [])).collect() == []


def test_long_lists_are_compared_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK", 3)
    rows = copies(9, 100)
    got = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(frame(spark, rows), width=4).collect()}
    assert got == {doc: c for doc, (_, c, _) in components(rows, 4, 80).items()}


def test_sizes_rule_out_only_pairs_that_cannot_be_similar(spark):
    base = [f"u{k}" for k in range(103)]  # 100 shingles of four words
    rows = [(k, " ".join(base[:n])) for k, n in enumerate([103, 83, 82, 68, 67, 103])]
    run = near_duplicates.NearDuplicates(frame(spark, rows), "doc_id", "text", 4, 80)
    pairs = {(r.a, r.b) for r in run.pivot_pairs(run.lists()).collect()}
    sizes = {doc: len(shingles(text, 4)) for doc, text in rows}
    assert pairs and all(a < b and 100 * min(sizes[a], sizes[b]) >= 80 * max(sizes[a], sizes[b]) for a, b in pairs)
    got = {r.doc_id: r.component_id for r in run.components().collect()}
    assert got == {doc: c for doc, (_, c, _) in components(rows, 4, 80).items()}


def test_sketches_hold_the_smallest_values_of_each_class():
    values = np.unique(near_duplicates.shingles(" ".join(map(str, range(900))).encode(), 4))
    made = near_duplicates.sketch(values)
    for band in range(near_duplicates.BANDS):
        want = [int(v) >> 32 for v in values if int(v) % near_duplicates.BANDS == band][: near_duplicates.PER_BAND]
        assert [int(v) for v in made[band]] == want + [int(near_duplicates.EMPTY)] * (near_duplicates.PER_BAND - len(want))


def test_the_estimate_keeps_similar_sets():
    drawn = np.random.default_rng(1)
    for n in (5, 60, 500, 5000):
        values = drawn.integers(0, 2**63, n + n // 4 + 1).astype(np.uint64)
        both = values[: n - n // 9]
        a, b = np.unique(values[:n]), np.unique(np.concatenate([both, values[n : n + n // 9]]))
        similar = 100 * len(both) >= 80 * (len(a) + len(b) - len(both))
        args = near_duplicates.sketch(a)[None], near_duplicates.sketch(b)[None], np.array([len(a)]), np.array([len(b)])
        assert similar and near_duplicates.likely(*args, 0.8)[0]
        assert near_duplicates.likely(args[0], near_duplicates.sketch(np.unique(values[n:]))[None], np.array([n]), np.array([n // 4 + 1]), 0.8)[0] == (n == 0)


def test_connected_finds_long_chains(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (103, 102), (102, 100)], "a long, b long")
    got = {r.node: r.label for r in common.connected(edges).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100, 103: 100}


def test_group_minimum(spark):
    rows = spark.createDataFrame([("a", 3), ("a", 1), ("a", 2), ("b", 9), (None, 4), ("a", 1)], "k string, v long")
    got = sorted(((r.k, r.v, r.m) for r in common.with_group_min(rows, "k", "v", "m").collect()), key=repr)
    assert got == sorted([("a", 3, 1), ("a", 1, 1), ("a", 2, 1), ("b", 9, 9), (None, 4, None), ("a", 1, 1)], key=repr)


# ---- decontamination


def overlaps(docs, items, min_words=13, percent=80):
    """(doc, item) pairs by trying every alignment and every stretch."""
    split = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower())
    out = set()
    for doc, text in docs:
        for item, passage in items:
            d, i = split(text), split(passage)
            least = min(min_words, len(i))
            for shift in range(-len(i) + 1, len(d)) if i else ():
                same = [0 <= k + shift < len(d) and d[k + shift] == i[k] for k in range(len(i))]
                for first in range(len(i)):
                    for last in range(first + least, len(i) + 1):
                        if same[first] and same[last - 1] and 100 * sum(same[first:last]) >= percent * (last - first):
                            out.add((doc, item))
    return out


def test_planted_passages_are_found(spark):
    drawn = random.Random(3)
    words = [f"v{k}" for k in range(300)]
    items = [(k, " ".join(drawn.choices(words, k=n))) for k, n in enumerate([20, 30, 14, 8, 3, 40])] + [(6, None), (7, "")]
    docs = []
    for k in range(30):
        text = drawn.choices(words, k=40)
        if k % 3 == 0:
            item = items[(k // 3) % 6][1].split()
            if k % 2 and len(item) > 13:  # every seventh word is another one
                item = ["other" if n % 7 == 5 else w for n, w in enumerate(item)]
            text[10:10] = item
        docs.append((k, ", ".join(text).upper()))
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminations(clashing(frame(spark, docs)), frame(spark, items, "item_id long, text string")).collect()}
    assert got == overlaps(docs, items)
    assert {d for d, _ in got} >= {k for k in range(0, 30, 3)}


def accepted(n):
    """Runs of n words as bits, with the replaced ones 0, that begin and end with agreeing words and agree in 80 %."""
    for replaced in range(n // 5 + 1):
        for gaps in itertools.combinations(range(1, n - 1), replaced):
            yield sum(1 << k for k in range(n) if k not in gaps)


def seeded(run, n, masks):
    bits = [(int(mask[::-1], 2), len(mask)) for mask in masks]
    return any(run >> place & mask == mask for mask, span in bits for place in range(n - span + 1))


def test_every_accepted_run_meets_a_mask():
    for n in range(1, 13):  # whole items of few words
        masks = decontamination.short_masks(n)
        assert all(len(mask) == n for mask in masks) and all(seeded(run, n, masks) for run in accepted(n))
    for n in range(13, 23):
        lost = sum(not seeded(run, n, decontamination.MASKS) for run in accepted(n))
        assert lost == 0, (n, lost)


def test_long_runs_without_a_mask_agree_in_too_few_words():
    """The most agreeing words that a run of each length can have without meeting a mask, by its last 12 words."""
    masks = [int(mask, 2) for mask in decontamination.MASKS]
    last = np.arange(1 << 12)
    free = np.ones(1 << 12, bool)
    for mask in masks:
        free &= ((last << 1 | 1) & mask) != mask
    most = np.full(1 << 12, -(10**6))
    most[1] = 1
    for n in range(2, 400):
        longer = np.full(1 << 12, -(10**6))
        np.maximum.at(longer, last << 1 & 0xFFF, most)
        np.maximum.at(longer, ((last << 1 | 1) & 0xFFF)[free], most[free] + 1)
        most = longer
        assert n < 13 or 100 * most[1::2].max() < 80 * n, n


def test_replaced_words_at_any_place_are_found(spark):
    drawn = random.Random(11)
    words = [f"u{k}" for k in range(5000)]
    sizes = [5, 7, 9, 10, 11, 12, 13, 14, 15, 16, 18, 20, 34]
    items = [(k, " ".join(drawn.sample(words, n))) for k, n in enumerate(sizes)]
    docs = []
    for item, text in items:
        n = sizes[item]
        gaps = [drawn.sample(range(1, n - 1), n // 5) for _ in range(40)] + [drawn.sample(range(1, n - 1), n // 5 + 1) for _ in range(4)]
        gaps += list(itertools.combinations(range(1, n - 1), n // 5)) if n <= 14 else []
        for gap in gaps:
            passage = ["other" if k in gap else w for k, w in enumerate(text.split())]
            docs.append((len(docs), item, " ".join(["left", "side", *passage, "right", "side"])))
    # each document against the item that it was made from; the others share no word with it but by chance
    want = {pair for doc, item, text in docs for pair in overlaps([(doc, text)], [items[item]])}
    found = decontamination.contaminations(frame(spark, [(doc, text) for doc, _, text in docs]), frame(spark, items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == want
    assert len(want) > 13 * 40


def test_the_longest_good_stretch():
    drawn = np.random.default_rng(3)
    for n in [*range(1, 40), 200]:
        for share in (0.3, 0.7, 0.9):
            same = drawn.random(n) < share
            good = [
                (i, j - i) for i in range(n) for j in range(i + 1, n + 1)
                if same[i] and same[j - 1] and 100 * same[i:j].sum() >= 80 * (j - i) and j - i >= 5
            ]
            want = max(good, key=lambda run: (run[1], -run[0]), default=None)
            assert decontamination.best_run(same, 5, 80) == want, (same, want)


def test_looser_rules_than_the_masks_hold_are_an_error(spark):
    docs, items = frame(spark, ODD), frame(spark, [(1, "x")], "item_id long, text string")
    for options in ({"min_words": 12}, {"percent": 79}):
        with pytest.raises(ValueError):
            decontamination.contaminations(docs, items, **options)


def test_odd_documents_and_empty_tables(spark):
    docs, items = frame(spark, ODD), frame(spark, [(1, "some plain text with words"), (2, None), (None, "x"), (1, "some plain text with words")], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.doc_word, r.n_words, r.n_equal) for r in decontamination.contaminations(docs, items).collect())
    assert got == [(1, 1, 0, 5, 5), (9, 1, 0, 5, 5)]
    left = decontamination.without_contaminated(clashing(docs), items)
    assert left.columns == clashing(docs).columns and sorted(r.doc_id or 0 for r in left.collect()) == [0, 2, 3, 4, 5, 6, 7, 8]
    assert decontamination.contaminations(docs, items.limit(0)).collect() == []
    assert decontamination.contaminations(docs.limit(0), items).collect() == []


def test_the_filter_passes_its_own_keys(spark):
    keys = spark.range(1000).select(F.xxhash64("id").alias("h"))
    bits = common.bit_filter(keys, "h")
    assert common.passes(bits, np.array([r.h for r in keys.collect()])).all()
    assert common.passes(bits, np.arange(10**6) * 7919).mean() < 0.001
