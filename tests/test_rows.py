"""Row diff, merge by key and gate rules against brute force in plain Python."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from branchyard import AuditFailed, BranchStore, MergeConflict
from branchyard.operators import audit, merge
from branchyard.operators.merge import conflicting_rows, resolved_rows, three_way_rows

SCHEMA = "k bigint, `a.b` string, x double"


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = BranchStore.start(spark, str(tmp_path_factory.mktemp("rows")))
    store.create_namespace("s")
    store.at("main").create_table("s.t", SCHEMA)
    return store


def some_rows(rng, n):
    """Rows with copies, NULLs, NaN and signed zeros; one row makes up a third."""
    hot = (1, "hot", 0.5)
    out = []
    for _ in range(n):
        if rng.random() < 1 / 3:
            out.append(hot)
        else:
            out.append((
                rng.choice([None, *range(6)]), rng.choice([None, "", "p", "q"]),
                rng.choice([None, 0.0, 1.5, float("nan")]),
            ))
    return out


def plain(row):
    return tuple("nan" if isinstance(v, float) and v != v else v for v in row)


@pytest.mark.parametrize("seed", range(3))
def test_row_diff_is_a_difference_of_multisets(store, spark, seed):
    rng = random.Random(seed)
    first, old, new = some_rows(rng, 60), some_rows(rng, 60), some_rows(rng, 60)
    a, b = f"diff-a{seed}", f"diff-b{seed}"
    store.create_ref(a)
    store.at(a).append("s.t", spark.createDataFrame(first, SCHEMA))
    store.create_ref(b, a)
    store.at(a).append("s.t", spark.createDataFrame(old, SCHEMA))
    store.at(b).append("s.t", spark.createDataFrame(new, SCHEMA))
    expected = Counter(map(plain, new))
    expected.subtract(Counter(map(plain, old)))
    got = {}
    for row in audit.row_diff(store, "s.t", a, b).collect():
        sign = 1 if row["change"] == "added" else -1
        got[plain((row["k"], row["a.b"], row["x"]))] = sign * row["n_rows"]
    assert got == {row: n for row, n in expected.items() if n}
    assert audit.row_diff(store, "s.t", a, a).count() == 0


def test_row_diff_after_a_column_drop_compares_the_common_columns(store, spark):
    store.create_ref("narrow")
    store.at("narrow").append("s.t", spark.createDataFrame([(1, "p", 1.0), (1, "p", 2.0)], SCHEMA))
    store.create_ref("narrower", "narrow")
    store.at("narrower").drop_column("s.t", "x")
    assert audit.row_diff(store, "s.t", "narrow", "narrower").count() == 0
    store.at("narrower").append_values("s.t", [(2, "q")])
    assert [tuple(r) for r in audit.row_diff(store, "s.t", "narrow", "narrower").collect()] == [("added", 2, "q", 1)]


def merged_by_hand(base, ours, theirs):
    rows, conflicts = {}, {}
    for key in {*base, *ours, *theirs}:
        b, o, t = base.get(key), ours.get(key), theirs.get(key)
        if o == t or t == b:
            rows[key] = o
        elif o == b:
            rows[key] = t
        else:
            conflicts[key] = (b, o, t)
    return {k: v for k, v in rows.items() if v is not None}, conflicts


@pytest.mark.parametrize("seed", range(4))
def test_three_way_rows(spark, seed):
    rng = random.Random(seed)

    def side():
        return {
            (i, rng.choice("mn")): (rng.choice([None, "p", "q"]), rng.choice([None, 1]))
            for i in [None, *range(25)] if rng.random() < 0.8
        }

    sides = [side() for _ in range(3)]
    schema = "i int, j string, v string, w int"
    frames = [spark.createDataFrame([(*k, *v) for k, v in s.items()], schema) for s in sides]
    rows, conflicts = merged_by_hand(*sides)
    compared = three_way_rows(*frames, ["i", "j"])
    got = {(r["i"], r["j"]): (r["v"], r["w"]) for r in resolved_rows(compared, ["i", "j", "v", "w"], ["i", "j"]).collect()}
    assert got == rows
    listed = {}
    for r in conflicting_rows(compared, ["i", "j"]).collect():
        listed[(r["i"], r["j"])] = tuple(None if r[s] is None else tuple(r[s]) for s in ("base", "ours", "theirs"))
    assert listed == conflicts


def test_a_table_of_keys_only_can_be_merged(spark):
    def keys(*values):
        return spark.createDataFrame([(v,) for v in values], "k int")

    compared = three_way_rows(keys(1, 2, 3), keys(1, 2, 4), keys(2, 3, 5), ["k"])
    assert sorted(r["k"] for r in resolved_rows(compared, ["k"], ["k"]).collect()) == [2, 4, 5]


def test_keyed_merge_through_refs_keeps_shared_batches(store, spark):
    store.create_ref("km")
    store.at("km").append("s.t", spark.createDataFrame([(i, "base", 0.0) for i in range(20)], SCHEMA))
    store.create_ref("km2", "km")
    shared = store.content_at(store.state("km"), "s.t").batches
    store.at("km").append_values("s.t", [(100, "ours", 1.0), (101, "both", 1.0)])
    store.at("km2").append_values("s.t", [(200, "theirs", 2.0), (101, "both", 1.0)])
    head = store.merge_ref("km2", "km", by_key={"s.t": ["k"]}).first()["hash"]
    rows = {r["k"]: r["a.b"] for r in store.table("s.t@km").collect()}
    assert rows == {**{i: "base" for i in range(20)}, 100: "ours", 101: "both", 200: "theirs"}
    batches = store.content_at(store.state("km"), "s.t").batches
    assert batches[:-1] == shared
    assert store.state(head)["parent2"] == store.head("km2")
    # the other way round nothing is left to merge
    store.merge_ref("km", "km2")
    assert store.head("km") == store.head("km2")


def test_row_conflicts_publish_nothing_and_duplicate_keys_stop(store, spark):
    store.create_ref("rc")
    store.at("rc").overwrite("s.t", spark.createDataFrame([(1, "base", 0.0), (2, "base", 0.0)], SCHEMA))
    store.create_ref("rc2", "rc")
    store.at("rc").overwrite("s.t", spark.createDataFrame([(1, "ours", 0.0), (2, "base", 0.0)], SCHEMA))
    store.at("rc2").overwrite("s.t", spark.createDataFrame([(1, "theirs", 0.0)], SCHEMA))
    head = store.head("rc")
    with pytest.raises(MergeConflict):
        store.merge_ref("rc2", "rc", by_key={"s.t": ["k"]})
    with pytest.raises(MergeConflict):
        store.merge_ref("rc2", "rc")
    assert store.head("rc") == head
    compared = merge.compare_by_key(store, "s.t", ["k"], "rc2", "rc")
    listed = conflicting_rows(compared, ["k"]).collect()
    assert [(r["k"], r["base"]["a.b"], r["ours"]["a.b"], r["theirs"]["a.b"]) for r in listed] == [
        (1, "base", "ours", "theirs")
    ]
    store.at("rc2").append_values("s.t", [(1, "again", 0.0)])
    with pytest.raises(ValueError, match="not unique"):
        store.merge_ref("rc2", "rc", by_key={"s.t": ["k"]})
    with pytest.raises(ValueError):
        store.merge_ref("rc2", "rc", by_key={"s.t": ["no such column"]})


@pytest.mark.parametrize("limit", [0, 1, 2, 1000])
def test_a_keyed_merge_does_not_depend_on_the_limit(store, spark, limit):
    some = BranchStore(spark, store.root, path_limit=limit)
    ours, theirs, twice = (f"{name}{limit}" for name in ("lm", "lt", "ld"))
    store.create_ref(ours)
    for first in (0, 5, 10):
        store.at(ours).append("s.t", spark.createDataFrame([(i, "base", 0.0) for i in range(first, first + 5)], SCHEMA))
    store.create_ref(theirs, ours)
    store.create_ref(twice, ours)
    store.at(ours).append_values("s.t", [(100, "ours", 1.0)])
    store.at(theirs).append_values("s.t", [(200, "theirs", 2.0)])
    store.at(twice).append_values("s.t", [(5, "again", 2.0)])
    before = set(store.content_at(store.ref_state(ours), "s.t").batches[:3])
    with pytest.raises(ValueError, match="not unique"):
        some.merge_ref(twice, ours, by_key={"s.t": ["k"]})
    some.merge_ref(theirs, ours, by_key={"s.t": ["k"]})
    assert sorted(r["k"] for r in some.table(f"s.t@{ours}").collect()) == [*range(15), 100, 200]
    after = store.content_at(store.ref_state(ours), "s.t")
    assert after.n_batches == 4 and before <= set(after.batches)


def test_a_row_diff_takes_any_column_name(store, spark):
    store.create_ref("rd")
    store.at("rd").create_table("s.named", "_net int, net int, _0 string")
    store.create_ref("rd2", "rd")
    store.at("rd2").append_values("s.named", [(1, 2, "x"), (1, 2, "x")])
    from branchyard.operators import audit

    diff = audit.row_diff(store, "s.named", "rd", "rd2")
    assert diff.columns == ["change", "_net", "net", "_0", "n_rows"]
    assert [tuple(r) for r in diff.collect()] == [("added", 1, 2, "x", 2)]
    store.at("rd").create_table("s.taken", "change int")
    with pytest.raises(ValueError, match="change"):
        audit.row_diff(store, "s.taken", "rd", "rd")


NESTED = (
    "id int, amount decimal(20,4), day date, at timestamp, tags array<string>, place struct<x:double,`y z`:int>,"
    " props map<string,int>, raw binary, flag boolean, present int, n float"
)


def test_all_column_types_survive(store, spark):
    rows = spark.sql(
        "SELECT CAST(id AS int), CAST(id / 3 AS decimal(20,4)), DATE'2024-02-29', TIMESTAMP'2024-01-01 00:00:00.123456',"
        " array('a', NULL), named_struct('x', double(2.5), 'y z', 3), map('k', 1), X'00FF', true, 7, float(0.1)"
        " FROM range(4)"
    )
    store.create_ref("types")
    store.at("types").create_table("s.nested", NESTED)
    store.at("types").append("s.nested", rows)
    table = store.table("s.nested@types")
    assert table.schema == spark.createDataFrame([], NESTED).schema
    wanted = {r["id"]: r.asDict(True) for r in rows.toDF(*table.columns).to(table.schema).collect()}
    assert {r["id"]: r.asDict(True) for r in table.collect()} == wanted
    store.create_ref("types2", "types")
    store.at("types2").overwrite("s.nested", table.filter("id <> 2"))
    diff = audit.row_diff(store, "s.nested", "types", "types2").collect()
    assert [(r["change"], r["id"], r["n_rows"]) for r in diff] == [("removed", 2, 1)]
    # maps have no equality, so a merge by key needs a table without one
    for ref in ("types", "types2"):
        store.at(ref).drop_column("s.nested", "props")
    sides = [store.table(f"s.nested@{ref}") for ref in ("types", "types", "types2")]
    merged = resolved_rows(three_way_rows(*sides, ["id"]), sides[0].columns, ["id"])
    assert sorted(r["id"] for r in merged.collect()) == [0, 1, 3]


SEASONS = [("2015-16", "a"), ("2016-17", "b"), ("2017-28", "c"), ("2018-19", "a"), (None, "a"), ("Season", "Player")]


def test_gate_rules_find_known_defects(spark):
    rows = spark.createDataFrame(SEASONS, "Season string, Player string")
    rules = [
        audit.not_null("Season"),
        audit.matches("Season", r"[0-9]{4}-[0-9]{2}"),
        audit.in_set("Player", ["a", "b", "c"]),
        audit.unique("Player"),
        audit.same_count_as(rows.filter("Season <> 'Season'")),
    ]
    results = {r["rule"]: (r["n_failed"], r["passed"]) for r in audit.check(rows, rules).collect()}
    assert results == {
        "Season not null": (1, False),
        "Season matches": (2, False),
        "Player in set": (1, False),
        "Player unique": (2, False),
        "same count as source": (2, False),
    }
    # the wrong season has the right form; its years do not follow each other
    start, end = F.substring("Season", 1, 4).try_cast("int"), F.substring("Season", 6, 2).try_cast("int")
    follows = audit.Rule("years follow", holds=(start + 1) % 100 == end)
    failed = audit.check(rows.filter("Season like '2%'"), [follows]).first()
    assert (failed["n_failed"], failed["passed"]) == (1, False)
    assert audit.check(rows, []).count() == 0
    empty = audit.check(rows.limit(0), [audit.not_null("Season"), audit.unique("Player")]).collect()
    assert [(r["n_failed"], r["passed"]) for r in empty] == [(0, True), (0, True)]


def test_publish_stops_or_merges(store, spark):
    store.create_ref("gate-to")
    store.create_ref("gate", "gate-to")
    store.at("gate").append_values("s.t", [(1, "x", 0.0), (1, "y", 0.0)])
    with pytest.raises(AuditFailed, match="k unique"):
        audit.publish(store, "gate", {"s.t": [audit.unique("k")]}, "gate-to")
    assert store.table("s.t@gate-to").count() == 0
    audit.publish(store, "gate", {"s.t": [audit.unique("k", "a.b"), audit.not_null("x")]}, "gate-to")
    assert store.table("s.t@gate-to").count() == 2
    with pytest.raises(AuditFailed):
        audit.require_reconciled(store.table("s.t@gate"), spark.range(3))
