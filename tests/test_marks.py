"""Deleted rows by their places: no row is shuffled to find them, and rows that two versions share cancel out unread."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from branchyard import BranchStore
from branchyard.operators.audit import row_diff
from branchyard.plans.queries import QUERIES

SCHEMA = "k bigint, a string, `x.y` double"


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = BranchStore.start(spark, str(tmp_path_factory.mktemp("marks")))
    store.create_namespace("s")
    rng = random.Random(7)
    rows = [(n % 90_000, rng.choice(["x", "y", None]), rng.choice([0.5, float("nan"), None])) for n in range(100_000)]
    tables = store.at("main")
    tables.create_table("s.t", SCHEMA)
    tables.append("s.t", spark.createDataFrame(rows, SCHEMA).coalesce(1))
    tables.append("s.t", spark.createDataFrame(rows[:50], SCHEMA))
    store.create_ref("less")
    store.at("less").delete("s.t", "a = 'x' AND k % 3 = 0")
    store.at("less").delete_keys("s.t", spark.createDataFrame([(5,), (40_000,), (89_999,)], "k bigint"))
    return store


def plain(rows):
    return Counter(str(tuple(r)) for r in rows)


def plan(spark, df) -> str:
    """The plan where nothing is small enough to be broadcast but by a hint."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_marked_rows_are_those_of_the_conditions(store, spark):
    rows = store.table("s.t").collect()
    left = [r for r in rows if not (r.a == "x" and r.k % 3 == 0) and r.k not in (5, 40_000, 89_999)]
    assert plain(store.table("s.t@less").collect()) == plain(left)
    for options in ({"marks_limit": 0}, {"path_limit": 0}):
        assert plain(BranchStore(spark, store.root, **options).table("s.t@less").collect()) == plain(left)


def test_scan_shuffles_no_row_for_deletes(store, spark):
    text = plan(spark, store.table("s.t@less"))
    assert "SortMergeJoin" not in text and "ShuffledHashJoin" not in text and "BroadcastHashJoin" in text


def test_row_diff_nets_only_rows_that_came_or_went(store, spark):
    """Both versions hold both batches; the new one shows no row that the old one does not."""
    gone = plain(store.table("s.t").collect())
    gone.subtract(plain(store.table("s.t@less").collect()))
    for old, new, change in (("main", "less", "removed"), ("less", "main", "added")):
        diff = row_diff(store, "s.t", old, new)
        got = Counter()
        for r in diff.collect():
            assert r["change"] == change
            got[str(tuple(r)[1:-1])] += r["n_rows"]
        assert got == +gone
    text = plan(spark, row_diff(store, "s.t", "main", "less"))
    assert "SortMergeJoin" not in text


def test_many_deletes_are_read_in_few_passes(store, spark):
    store.create_ref("many")
    tables = store.at("many")
    tables.create_table("s.m", SCHEMA)
    for n in range(6):
        tables.append("s.m", spark.createDataFrame([(k, "x", float(n)) for k in range(20)], SCHEMA))
        tables.delete("s.m", f"k = {n}")
    want = plain((k, "x", float(n)) for n in range(6) for k in range(20) if not n <= k < 6)
    rows = tables.table("s.m")
    assert plain(rows.collect()) == want
    assert plan(spark, rows).partition("Initial Plan")[0].count("BroadcastHashJoin") == 1


def test_a_column_cannot_be_named_as_the_place(store):
    with pytest.raises(ValueError, match="place"):
        store.at("main").create_table("s.odd", "`_batch~place` int")


def test_profile_by_ref_counts_columns_apart(spark, sf_dir):
    text = QUERIES["profile_by_ref"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in text and "LeftAnti" not in text
