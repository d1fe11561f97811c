"""Properties of refs, commits and merges of whole tables."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

from branchyard import AlreadyExists, BranchStore, MergeConflict, StaleHead, UnknownRef, UnknownTable
from branchyard.operators import audit, cleanup, merge


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = BranchStore.start(spark, str(tmp_path_factory.mktemp("refs")))
    store.create_namespace("a")
    for name in ("t", "u"):
        store.at("main").create_table(f"a.{name}", "k bigint, v string")
        store.at("main").append(f"a.{name}", spark.range(10).selectExpr("id", "CAST(id AS string)"))
    return store


def rows(store, name):
    return sorted((r["k"], r["v"]) for r in store.table(name).collect())


def data_files(store):
    return sorted(str(p) for p in Path(store.root, "data").rglob("*.parquet"))


def test_a_new_ref_adds_no_data(store):
    files = data_files(store)
    store.create_ref("copy")
    assert data_files(store) == files
    assert rows(store, "a.t@copy") == rows(store, "a.t")
    assert store.head("copy") == store.head("main")


def test_a_write_changes_no_other_ref(store):
    store.create_ref("w1")
    before = {r["name"]: r["hash"] for r in store.list_refs().collect()}
    main = rows(store, "a.t")
    store.at("w1").append_values("a.t", [(100, "x"), (101, None)])
    after = {r["name"]: r["hash"] for r in store.list_refs().collect()}
    assert rows(store, "a.t") == main
    assert (101, None) in store.table("a.t@w1").collect()
    assert {name for name in after if after[name] != before[name]} == {"w1"}


def test_merge_into_an_unmoved_target_makes_heads_equal_and_repeats_change_nothing(store):
    store.create_ref("m1")
    store.create_ref("m2", "m1")
    store.at("m2").append_values("a.u", [(7, "seven")])
    first = store.merge_ref("m2", "m1").first()["hash"]
    assert first == store.head("m1") == store.head("m2")
    assert store.merge_ref("m2", "m1").first()["hash"] == first
    assert store.moves("m1").count() == 2


def test_diverged_merge_takes_each_table_from_its_side(store):
    store.create_ref("d1")
    store.create_ref("d2")
    store.at("d1").append_values("a.t", [(50, "d1")])
    store.at("d2").append_values("a.u", [(60, "d2")])
    store.at("d2").create_table("a.extra", "x int")
    head = store.merge_ref("d2", "d1").first()["hash"]
    assert (50, "d1") in rows(store, "a.t@d1") and (60, "d2") in rows(store, "a.u@d1")
    assert "a.extra" in store.at("d1").table_keys()
    commit = store.state(head)
    assert commit["parent2"] == store.head("d2")
    # the next merge starts from here: only what changed since counts
    store.at("d2").append_values("a.u", [(61, "d2")])
    store.merge_ref("d2", "d1")
    assert {(60, "d2"), (61, "d2")} <= set(rows(store, "a.u@d1"))
    store.merge_ref("d1", "d2")
    assert store.head("d1") == store.head("d2")


def test_conflicts_publish_nothing(store):
    store.create_ref("c1")
    store.create_ref("c2")
    store.at("c1").append_values("a.t", [(1, "c1")])
    store.at("c2").append_values("a.t", [(2, "c2")])
    store.at("c2").append_values("a.u", [(3, "c2")])
    heads = store.head("c1"), store.head("c2")
    with pytest.raises(MergeConflict) as stopped:
        store.merge_ref("c2", "c1")
    assert stopped.value.keys == ["a.t"]
    assert heads == (store.head("c1"), store.head("c2"))
    assert (3, "c2") not in rows(store, "a.u@c1")
    listed = merge.conflicting_tables(store, "c2", "c1").collect()
    assert [tuple(r) for r in listed] == [("a.t", 10, 11, 11)]


def test_dropped_against_changed_is_a_conflict_and_dropped_twice_is_not(store):
    store.create_ref("x1")
    store.create_ref("x2")
    store.at("x1").drop_table("a.t")
    store.at("x2").rename_table("a.t", "a.s")
    store.merge_ref("x2", "x1")
    assert store.at("x1").table_keys() == ["a.s", "a.u"]
    store.create_ref("x3")
    store.create_ref("x4")
    store.at("x3").append_values("a.u", [(9, "more")])
    store.at("x4").drop_table("a.u")
    with pytest.raises(MergeConflict):
        store.merge_ref("x4", "x3")
    listed = merge.conflicting_tables(store, "x4", "x3").collect()
    assert [tuple(r) for r in listed] == [("a.u", 10, None, 11)]


def test_the_same_schema_change_on_both_sides_is_no_conflict(store):
    store.create_ref("s1")
    store.create_ref("s2")
    for ref in ("s1", "s2"):
        store.at(ref).drop_column("a.t", "v")
    store.merge_ref("s2", "s1")
    assert store.table("a.t@s1").columns == ["k"]


def test_ref_at_an_older_commit(store):
    store.create_ref("o1")
    older = store.head("o1")
    store.at("o1").append_values("a.t", [(1000, "new")])
    store.create_ref("o2", "o1", at=older)
    assert rows(store, "a.t@o2") == rows(store, "a.t@main")
    assert rows(store, f"a.t@{older}") == rows(store, "a.t@main")
    with pytest.raises(UnknownRef):
        store.create_ref("o3", "main", at=store.head("o1"))


def test_dropped_and_remade_refs(store):
    store.create_ref("r1")
    store.at("r1").append_values("a.t", [(5, "first life")])
    lost = store.head("r1")
    store.drop_ref("r1")
    with pytest.raises(UnknownRef):
        store.table("a.t@r1")
    store.create_ref("r1")
    assert rows(store, "a.t@r1") == rows(store, "a.t")
    store.at("r1").append_values("a.t", [(6, "second life")])
    assert merge.merge_base(store, store.state(lost), store.state("r1"))["hash"] == store.head("main")
    with pytest.raises(AlreadyExists):
        store.create_ref("r1")
    with pytest.raises(ValueError):
        store.drop_ref("main")
    with pytest.raises(ValueError):
        store.create_ref("no/slash")


def test_stale_commits_are_rejected(store, spark):
    store.create_ref("z1")
    seen = store.state("z1")
    store.at("z1").append_values("a.t", [(8, "other writer")])
    with pytest.raises(StaleHead):
        store.commit("z1", "late", {"a.t": seen["tables"]["a.t"]}, base=seen)
    with pytest.raises(StaleHead):
        store.commit("z1", "late", {}, expected_hash=seen["hash"])
    # another table did not move, so the work on it still stands
    store.commit("z1", "drop", {"a.u": None}, base=seen)
    assert store.at("z1").table_keys() == ["a.t"]


def test_tables_are_defined_once_and_need_their_namespace(store, spark):
    store.create_ref("n1")
    tables = store.at("n1")
    with pytest.raises(UnknownTable):
        tables.create_table("b.t", "x int")
    store.create_namespace("b", "n1")
    store.create_namespace("b", "n1")
    with pytest.raises(AlreadyExists):
        store.create_namespace("b", "n1", if_not_exists=False)
    tables.create_table("b.t", "x int")
    tables.create_table("b.t", "y string, z string")
    assert tables.table("b.t").columns == ["x"]
    with pytest.raises(AlreadyExists):
        tables.create_table("b.t", "x int", if_not_exists=False)
    spaces = {(r["ref"], r["namespace"]) for r in store.list_namespaces().collect()}
    assert ("n1", "b") in spaces and ("main", "b") not in spaces and ("main", "a") in spaces


def test_inserts_go_by_position_and_are_checked(store, spark):
    store.create_ref("p1")
    tables = store.at("p1")
    tables.overwrite("a.t", spark.sql("SELECT 1 AS anything, 'x' AS at_all"))
    assert rows(store, "a.t@p1") == [(1, "x")]
    with pytest.raises(AnalysisException):
        tables.append("a.t", spark.sql("SELECT 1 AS k"))
    with pytest.raises(AnalysisException):
        tables.append("a.t", spark.sql("SELECT 'text' AS k, 'x' AS v"))
    tables.drop_column("a.t", "K")
    with pytest.raises(AnalysisException):
        tables.append("a.t", spark.sql("SELECT 1 AS k, 'x' AS v"))
    tables.append("a.t", spark.sql("SELECT 'y'"))
    assert sorted(r["v"] for r in tables.table("a.t").collect()) == ["x", "y"]
    with pytest.raises(ValueError):
        tables.drop_column("a.t", "v")


def test_a_table_can_be_overwritten_from_itself(store):
    store.create_ref("q1")
    tables = store.at("q1")
    tables.overwrite("a.t", tables.table("a.t").filter("k < 3"))
    assert [k for k, _ in rows(store, "a.t@q1")] == [0, 1, 2]
    assert len(rows(store, "a.t")) == 10


def test_long_batch_lists_stay_in_spark(spark, store):
    store.create_ref("l1")
    few = BranchStore(spark, store.root, path_limit=1)
    for i in range(3):
        few.at("l1").append_values("a.t", [(i, "more")])
    assert few.content_of(few.state("l1")["tables"]["a.t"]).batches is None
    few.at("l1").drop_column("a.t", "v")
    few.at("l1").append("a.t", spark.sql("SELECT CAST(77 AS bigint)"))
    expected = sorted([*range(10), 0, 1, 2, 77])
    for reader in (few, store, BranchStore(spark, store.root, path_limit=1, broadcast_limit=0)):
        assert sorted(r["k"] for r in reader.table("a.t@l1").collect()) == expected
        counts = {r["table"]: r["n_rows"] for r in audit.count_rows(reader, ["l1", "main"]).filter("ref = 'l1'").collect()}
        assert counts == {"a.t": 14, "a.u": 10}
        states = [{**reader.state(r), "name": r} for r in ("l1", "main")]
        some = audit.count_tables(reader, states, ["name"], keys=["a.u"]).collect()
        assert sorted(tuple(r) for r in some) == [("l1", "a.u", 10), ("main", "a.u", 10)]
        diff = audit.row_diff(reader, "a.t", "main", "l1").collect()
        assert sorted((r["change"], r["k"], r["n_rows"]) for r in diff) == [
            ("added", 0, 1), ("added", 1, 1), ("added", 2, 1), ("added", 77, 1),
        ]


def test_commit_log_and_orphans(spark, tmp_path):
    store = BranchStore.start(spark, str(tmp_path))
    store.create_namespace("a")
    assert cleanup.orphan_batches(store).count() == 0
    main = store.at("main")
    main.create_table("a.t", "k bigint")
    assert [r["rows_added"] for r in audit.commit_log(store, "main").collect()] == [0, 0, 0]
    main.append("a.t", spark.range(5))
    main.overwrite("a.t", main.table("a.t").filter("k > 2"))
    store.create_ref("gone")
    store.at("gone").append("a.t", spark.range(7))
    log = audit.commit_log(store, "gone").orderBy("depth").collect()
    assert [(r["message"], r["rows_added"]) for r in log] == [
        ("start", 0), ("create namespace a", 0), ("create table a.t", 0),
        ("append to a.t", 5), ("overwrite a.t", 2), ("append to a.t", 7),
    ]
    # a write that was never published
    content = store.content_of(store.state("main")["tables"]["a.t"])
    store.write_batch(content, spark.range(3), "bleft")
    assert {r["_batch"]: r["n_rows"] for r in cleanup.orphan_batches(store).collect()} == {"bleft": 3}
    store.drop_ref("gone")
    for reader in (store, BranchStore(spark, store.root, path_limit=0)):
        orphans = cleanup.orphan_batches(reader).collect()
        # the overwritten batch is still in the history of main
        assert sorted(r["n_rows"] for r in orphans) == [3, 7]
        assert all(r["n_bytes"] > 0 for r in orphans)
