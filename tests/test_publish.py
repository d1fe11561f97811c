"""Writers that meet, names that pin a ref, views, and the gate."""

from __future__ import annotations

import threading

import pytest
from pyspark.errors import AnalysisException

from branchyard import AuditFailed, BranchStore, StaleHead
from branchyard.operators import audit
from branchyard.operators import merge as mg
from branchyard.session import names_in, work_folder

SCHEMA = "id int, name string"


@pytest.fixture
def store(spark):
    made = BranchStore.start(spark, work_folder(spark, "publish"))
    for space in ("x", "y"):
        made.create_namespace(space)
    made.at("main").create_table("x.t", SCHEMA)
    return made


def test_of_writers_that_meet_none_is_lost(store, spark):
    failed = []

    def write(n):
        try:
            BranchStore(spark, store.root).at("main").append("x.t", spark.range(10).selectExpr("CAST(id AS int)", f"'w{n}'"))
        except Exception as error:  # noqa: BLE001
            failed.append(error)

    threads = [threading.Thread(target=write, args=(n,)) for n in range(3)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert all(isinstance(error, StaleHead) for error in failed)
    assert store.table("x.t").count() == 30 - 10 * len(failed)


def test_two_commits_on_one_head_are_not_both_published(store):
    now = store.ref_state("main")
    store.commit("main", "first", {"z": "namespace"}, now=now)
    with pytest.raises(StaleHead):
        store.commit("main", "second", {"w": "namespace"}, now=now)
    store.create_ref("side")
    store.create_namespace("more", "side")
    plan = mg.planned_merge(store, "side", "main", None, {})
    store.at("main").append_values("x.t", [(1, "a")])
    with pytest.raises(StaleHead):
        mg.publish_merge(store, plan)


def test_a_head_is_found_by_one_file(store, spark, monkeypatch):
    opened = []
    real = BranchStore.move
    monkeypatch.setattr(BranchStore, "move", lambda self, ref, seq: opened.append(seq) or real(self, ref, seq))
    for n in range(5):
        store.create_namespace(f"n{n}")
    assert len(names_in(spark, f"{store.root}/ledger/ref=main")) == 9
    opened.clear()
    store.head("main")
    assert opened == [8]


def test_names_pin_a_ref_in_writes(store):
    store.create_ref("b")
    main = store.at("main")
    main.append_values("x.t@b", [(1, "a")])
    main.create_table("x.u@b", SCHEMA)
    main.rename_table("x.u@b", "x.v")
    main.overwrite("x.v@b", store.table("x.t@b"))
    main.drop_column("x.v@b", "name")
    assert store.at("b").table_keys() == ["x.t", "x.v"] and main.table_keys() == ["x.t"]
    assert [tuple(r) for r in main.table("x.v@b").collect()] == [(1,)]
    main.drop_table("x.v@b")
    assert store.at("b").table_keys() == ["x.t"] and main.table("x.t").count() == 0
    with pytest.raises(ValueError):
        main.rename_table("x.t@b", "x.z@main")


def test_views_show_the_current_ref_and_the_right_namespace(store, spark):
    main = store.at("main")
    main.create_table("y.t", SCHEMA)
    main.append_values("x.t", [(1, "a")] * 3)
    main.append_values("y.t", [(1, "a")] * 5)
    main.create_table("x.gone", SCHEMA)
    store.create_ref("e")
    store.at("e").drop_table("x.gone")
    main.create_views()
    count = lambda name: spark.sql(f"SELECT count(*) FROM `{name}`").first()[0]
    assert (count("x.t"), count("y.t"), count("x.t@main"), count("y.t@main"), count("gone")) == (3, 5, 3, 5, 0)
    for name in ("t", "t@main"):
        with pytest.raises(AnalysisException):
            count(name)
    store.at("e").create_views()
    for name in ("gone", "x.gone", "gone@e"):
        with pytest.raises(AnalysisException):
            count(name)
    assert count("x.gone@main") == 0
    store.at("main").create_views(current=False)


def test_the_gate_checks_what_it_publishes(store):
    main = store.at("main")
    main.create_table("x.other", SCHEMA)
    store.create_ref("dev")
    main.append_values("x.t", [(1, None)])
    store.at("dev").append_values("x.other", [(1, "a")])
    with pytest.raises(AuditFailed, match="not null"):
        audit.publish(store, "dev", {"x.t": [audit.not_null("name")]})
    assert main.table("x.other").count() == 0
    store.at("dev").append_values("x.t", [(2, "b")])
    audit.publish(store, "dev", {"x.t": [audit.unique("id")]}, by_key={"x.t": ["id"]})
    assert sorted(r.id for r in main.table("x.t").collect()) == [1, 2] and main.table("x.other").count() == 1


def test_a_stream_belongs_to_the_table(store, spark):
    from branchyard.streaming import stream_files

    folder = work_folder(spark, "in")
    stream = lambda key: stream_files(store, "main", key, folder, "s", header=True)
    spark.range(10).selectExpr("CAST(id AS int)", "'a' AS name").write.option("header", True).csv(folder)
    stream("x.t")
    store.create_ref("keep")
    store.at("main").rename_table("x.t", "x.u")
    spark.range(5).selectExpr("CAST(id AS int)", "'b' AS name").write.mode("append").option("header", True).csv(folder)
    stream("x.u")
    assert (store.table("x.u").count(), store.table("x.t@keep").count()) == (15, 10)
    store.at("main").drop_table("x.u")
    store.at("main").create_table("x.u", SCHEMA)
    stream("x.u")
    assert store.table("x.u").count() == 15
