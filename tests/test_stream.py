"""Streams into a ref: restarts, replays, failures."""

from __future__ import annotations

import pytest

from branchyard import BranchStore
from branchyard.operators import cleanup
from branchyard.streaming import stream_files

SCHEMA = "k bigint, v string"


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = BranchStore.start(spark, str(tmp_path_factory.mktemp("stream")))
    store.create_namespace("s")
    store.at("main").create_table("s.t", SCHEMA)
    return store


def put_file(folder, name, keys):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("k,v\n" + "".join(f"{k},v{k}\n" for k in keys))


def keys(store, name):
    return sorted(r["k"] for r in store.table(name).collect())


def test_a_restart_takes_only_new_files(store, tmp_path):
    store.create_ref("r")
    folder = tmp_path / "in"
    put_file(folder, "1.csv", range(3))
    put_file(folder, "2.csv", range(3, 5))
    assert stream_files(store, "r", "s.t", str(folder), "feed", files_per_batch=1, header=True) == 2
    assert keys(store, "s.t@r") == [0, 1, 2, 3, 4]
    assert stream_files(store, "r", "s.t", str(folder), "feed", header=True) == 0
    put_file(folder, "3.csv", [9])
    assert stream_files(store, "r", "s.t", str(folder), "feed", header=True) == 1
    assert keys(store, "s.t@r") == [0, 1, 2, 3, 4, 9]
    assert keys(store, "s.t") == []
    # the same name on another ref is a stream of its own
    store.create_ref("r2")
    assert stream_files(store, "r2", "s.t", str(folder), "feed", header=True) == 1
    assert keys(store, "s.t@r2") == [0, 1, 2, 3, 4, 9]


def test_a_header_comes_in_as_a_row_if_not_skipped(store, spark, tmp_path):
    store.create_ref("raw")
    store.at("raw").create_table("s.raw", "k string, v string")
    put_file(tmp_path / "in", "1.csv", range(3))
    stream_files(store, "raw", "s.raw", str(tmp_path / "in"), "feed")
    assert store.table("s.raw@raw").count() == 4


def test_a_replayed_batch_adds_nothing(store, spark):
    store.create_ref("p")
    rows = spark.sql("SELECT CAST(1 AS bigint), 'x'")
    assert store.at("p").append_stream_batch("s.t", rows, "feed", 0)
    head = store.head("p")
    assert not store.at("p").append_stream_batch("s.t", rows, "feed", 0)
    assert store.head("p") == head
    assert store.at("p").append_stream_batch("s.t", rows, "feed", 1)
    assert keys(store, "s.t@p") == [1, 1]
    # also after the table was replaced
    store.at("p").overwrite("s.t", rows)
    assert not store.at("p").append_stream_batch("s.t", rows, "feed", 1)
    assert keys(store, "s.t@p") == [1]


def test_a_batch_that_failed_before_publishing_is_written_again(store, spark, monkeypatch):
    store.create_ref("f")
    rows = spark.sql("SELECT CAST(5 AS bigint), 'x'")

    def lost(*args, **kwargs):
        raise RuntimeError("lost before the publishing step")

    with monkeypatch.context() as patch:
        patch.setattr(store, "commit", lost)
        with pytest.raises(RuntimeError):
            store.at("f").append_stream_batch("s.t", rows, "feed", 0)
    assert keys(store, "s.t@f") == []
    assert cleanup.orphan_batches(store).filter("n_rows = 1").count() >= 1
    assert store.at("f").append_stream_batch("s.t", rows, "feed", 0)
    assert keys(store, "s.t@f") == [5]


def test_stream_names_are_plain(store, tmp_path):
    with pytest.raises(ValueError):
        stream_files(store, "main", "s.t", str(tmp_path), "a/b")
