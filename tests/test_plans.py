"""What the plans must and must not contain."""

from __future__ import annotations

import contextlib
import io
from pathlib import Path

import pytest

from branchyard import BranchStore
from branchyard.operators import audit, merge
from branchyard.plans.queries import QUERIES
from branchyard.plans.workflow import given
from branchyard.session import work_folder


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def store(spark, sf_dir, tmp_path_factory):
    store = BranchStore.start(spark, str(tmp_path_factory.mktemp("plans")))
    orders = given(spark, sf_dir, "orders")
    store.create_namespace("s")
    store.at("main").create_table("s.orders", orders.schema)
    store.at("main").append("s.orders", orders)
    store.create_ref("more")
    store.at("more").append("s.orders", orders.limit(10))
    return store


def test_scan_prunes_columns_and_pushes_filters(store):
    text = plan(store.table("s.orders").filter("o_orderstatus = 'F'").select("o_custkey"))
    assert "EqualTo(o_orderstatus,F)" in text
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string>" in text


def test_scan_reads_only_the_batches_of_its_ref(store):
    assert len(store.table("s.orders").inputFiles()) == 1
    assert len(store.table("s.orders@more").inputFiles()) == 2


def test_a_long_list_prunes_by_the_broadcast_and_needs_none_beyond_its_bound(spark, store):
    few = BranchStore(spark, store.root, path_limit=0)
    text = plan(few.table("s.orders"))
    assert "dynamicpruning" in text and "BroadcastHashJoin" in text
    hints = BranchStore(spark, store.root, path_limit=0, broadcast_limit=0).table("s.orders")
    assert "broadcast" not in hints._jdf.queryExecution().logical().toString().lower()


def test_row_diff_reads_only_batches_that_differ(store):
    diff = audit.row_diff(store, "s.orders", "main", "more")
    assert len(diff.inputFiles()) == 1
    assert plan(diff).count("Exchange (") <= 1 + plan(diff).count("AdaptiveSparkPlan (")


def test_counts_read_no_column(store):
    text = plan(audit.reconcile(store.table("s.orders"), store.table("s.orders@more")))
    assert text.count("ReadSchema: struct<>") == 2


def test_merge_by_key_shuffles_each_row_once(spark, store):
    store.create_ref("k1")
    store.create_ref("k2")
    for ref in ("k1", "k2"):
        store.at(ref).overwrite("s.orders", store.table("s.orders"))
    text = plan(merge.compare_by_key(store, "s.orders", ["o_orderkey"], "k2", "k1"))
    assert "Join" not in text
    assert text.count("REPARTITION_BY_COL") == 1 and "ENSURE_REQUIREMENTS" not in text


def test_a_branch_writes_no_data(store):
    data = Path(store.root, "data")
    files = sorted(data.rglob("*"))
    store.create_ref("flat")
    assert sorted(data.rglob("*")) == files


@pytest.mark.parametrize("name", ["row_diff", "keyed_merge_conflicts", "publish_gate", "commit_log", "list_refs", "asof_events", "row_history", "windowed_stream", "session_stream", "explain_difference", "delete_rows", "profile_by_ref"])
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_work_folder_is_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    folder = work_folder(spark, "x")
    assert folder != work_folder(spark, "x")
    if shared:
        assert folder.startswith(shared)


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, name, default=None):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "spark://somewhere"})

    with pytest.raises(RuntimeError):
        work_folder(Session(), "x")
