"""Totals kept up to date, and windows over streams, against plain recounts."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from branchyard import BranchStore
from branchyard.operators.totals import refresh_totals
from branchyard.streaming.windows import stream_windows, with_closed

SCHEMA = "g string, k bigint, x bigint"


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = BranchStore.start(spark, str(tmp_path_factory.mktemp("totals")))
    store.create_namespace("s")
    return store


def test_totals_follow_every_change(store, spark):
    rng = random.Random(9)
    store.create_ref("totals")
    tables = store.at("totals")
    tables.create_table("s.t", SCHEMA)
    measures = {"sum_x": ("sum", "x"), "least": ("min", "x"), "most": ("max", "x + k")}

    def check():
        refresh_totals(tables, "s.t", "s.sums", ["g"], measures)
        whole = tables.table("s.t").groupBy("g").agg(
            F.count("*").alias("n_rows"), F.coalesce(F.sum("x"), F.lit(0)).alias("sum_x"), F.min("x").alias("least"), F.max(F.expr("x + k")).alias("most")
        )
        assert Counter(map(tuple, tables.table("s.sums").select("g", "n_rows", "sum_x", "least", "most").collect())) == Counter(map(tuple, whole.collect()))

    def rows(n):
        return spark.createDataFrame([(rng.choice(["a", "b", "c", None]), rng.randrange(50), rng.choice([None, *range(-5, 6)])) for _ in range(n)], SCHEMA)

    check()  # no rows, no groups
    tables.append("s.t", rows(40))
    check()
    head = store.head("totals")
    check()
    assert store.head("totals") == head  # nothing changed, nothing written
    tables.append("s.t", spark.createDataFrame([("d", 1, 100), ("d", 2, None)], SCHEMA))
    tables.delete("s.t", "x = 5 OR x = -5")
    check()
    tables.delete("s.t", "g = 'd' AND x IS NOT NULL")
    check()  # the largest left, NULL stays
    tables.update("s.t", "g IS NULL", {"x": "x - 3", "g": "'b'"})
    tables.delete("s.t", "g = 'd'")
    check()  # groups went
    tables.overwrite("s.t", tables.table("s.t").union(rows(5)))
    check()
    store.create_ref("totals2", "totals")
    store.at("totals2").append("s.t", rows(10))
    store.merge_ref("totals2", "totals")
    check()
    with pytest.raises(ValueError, match="not exact"):
        refresh_totals(tables, "s.t", "s.other", ["g"], {"y": ("sum", "CAST(x AS double)")})
    with pytest.raises(ValueError, match="not measures"):
        refresh_totals(tables, "s.t", "s.other", ["g"], {"y": ("avg", "x")})


@pytest.mark.parametrize("seed", range(2))
def test_windows_and_late_rows(store, spark, tmp_path, seed):
    """Micro-batches drawn at random, one file each, against a walk through them."""
    rng = random.Random(seed)
    start, ref = datetime(2024, 1, 1), f"windows{seed}"
    store.create_ref(ref)
    schema = spark.createDataFrame([], "ts timestamp_ntz, g string, x int").schema
    windows, late, newest = {}, Counter(), None

    def take(name="w"):
        return stream_windows(store, ref, "s.windows", "s.late", str(tmp_path / "in"), name, schema, time="ts", width="2 hours", delay="3 HOURS", group_by=["g"], sums={"total": "x"}, files_per_batch=1)

    for number in range(4):
        rows = [
            (start + timedelta(minutes=rng.randrange(number * 180, number * 180 + 600) - rng.choice([0, 0, 600])) if rng.random() < 0.95 else None, rng.choice(["a", None]), rng.choice([1, 2, None]))
            for _ in range(30)
        ]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        closed = None if newest is None else newest - timedelta(hours=3)
        for ts, g, x in rows:
            begin = ts and ts.replace(minute=0) - timedelta(hours=ts.hour % 2)
            if ts is None or closed is not None and begin + timedelta(hours=2) <= closed:
                late[ts, g, x] += 1
            else:
                n, total, last = windows.get((begin, g), (0, 0, ts))
                windows[begin, g] = (n + 1, total + (x or 0), max(last, ts))
        newest = max([last for _, _, last in windows.values()])
        assert take() == 1 and take() == 0
    shown = with_closed(store.table(f"s.windows@{ref}"), "3 HOURS").collect()
    assert {(r.window_start, r.g): (r.n_rows, r.total, r.last_time) for r in shown} == windows
    assert all(r.closed == (r.window_end <= newest - timedelta(hours=3)) for r in shown)
    assert Counter(map(tuple, store.table(f"s.late@{ref}").collect())) == late and late


def test_an_append_between_two_micro_batches_loses_nothing(store, spark, monkeypatch):
    store.create_ref("between")
    tables = store.at("between")
    tables.create_table("s.t", SCHEMA)
    write = store.write_batch

    def late(*args, **more):
        monkeypatch.setattr(store, "write_batch", write)
        store.at("between").append("s.t", spark.createDataFrame([("own", 1, 1)], SCHEMA))
        return write(*args, **more)

    monkeypatch.setattr(store, "write_batch", late)
    assert tables.append_stream_batch("s.t", spark.createDataFrame([("stream", 1, 1)], SCHEMA), "s", 0)
    assert not tables.append_stream_batch("s.t", spark.createDataFrame([("stream", 1, 1)], SCHEMA), "s", 0)
    assert Counter(r.g for r in tables.table("s.t").collect()) == Counter(["own", "stream"])
