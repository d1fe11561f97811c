"""Where refs differ, against all groups; sessions of a stream, against a walk through its micro-batches."""

from __future__ import annotations

import itertools
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from branchyard import BranchStore
from branchyard.operators.explain import explain_difference
from branchyard.streaming.sessions import closed_sessions, stream_sessions

SCHEMA = "id long, a string, b int, `c.d` boolean"


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = BranchStore.start(spark, str(tmp_path_factory.mktemp("explain")))
    store.create_namespace("s")
    return store


def smallest(changes: Counter, share: float) -> dict:
    """All heavy groups of signed rows that hold no smaller heavy one."""
    total = sum(map(abs, changes.values()))
    groups: dict = {}
    for (_, *values), n in changes.items():
        for fixed in itertools.product((False, True), repeat=3):
            added, removed = groups.get((fixed, group := tuple(v if f else None for v, f in zip(values, fixed))), (0, 0))
            groups[fixed, group] = (added + max(n, 0), removed + max(-n, 0))
    heavy = {g: n for g, n in groups.items() if sum(n) >= share * total}
    up = {
        (tuple(f and k != i for k, f in enumerate(fixed)), tuple(None if k == i else v for k, v in enumerate(values)))
        for fixed, values in heavy
        for i in range(3)
        if fixed[i]
    }
    names = ("a", "b", "t")
    return {(", ".join(n for n, f in zip(names, fixed) if f), *values): (*n, total) for (fixed, values), n in heavy.items() if (fixed, values) not in up}


@pytest.mark.parametrize("seed", range(3))
def test_smallest_groups_are_those_of_all_groups(store, spark, seed):
    rng = random.Random(seed)
    row = lambda: (rng.randrange(5), rng.choice("xyz") if rng.random() < 0.8 else None, rng.choice([1, 2, 3, None]), rng.choice([True, False, None]))
    rows = [row() for _ in range(80)]
    later = [r for r in rows if not (r[1] == "x" and rng.random() < 0.8)] + [row() for _ in range(15)] + rows[:3]
    first, second = f"one{seed}", f"two{seed}"
    store.create_ref(first)
    tables = store.at(first)
    tables.create_table("s.t", spark.createDataFrame([], SCHEMA).schema)
    tables.append("s.t", spark.createDataFrame(rows, SCHEMA))
    store.create_ref(second, source=first)
    store.at(second).overwrite("s.t", spark.createDataFrame(later, SCHEMA))
    changes = Counter(later)
    changes.subtract(rows)
    by = {"a": "a", "b": "b", "t": "`c.d`"}
    for share in (0.05, 0.3, 1.0):
        got = explain_difference(store, "s.t", first, second, by, share).collect()
        assert {tuple(r)[:4]: tuple(r)[4:] for r in got} == smallest(changes, share) and len({tuple(r)[:4] for r in got}) == len(got)
    assert explain_difference(store, "s.t", first, first, by).collect() == []


def test_names_and_shares_that_cannot_be(store):
    for by, share in (({}, 0.1), ({"n_added": "1"}, 0.1), ({"a": "a", "A": "b"}, 0.1), ({"a": "a"}, 0), ({"a": "a"}, 1.5)):
        with pytest.raises(ValueError):
            explain_difference(store, "s.t", "main", "main", by, share)


@pytest.mark.parametrize("seed", range(2))
def test_sessions_and_late_rows(store, spark, tmp_path, seed):
    """Micro-batches drawn at random, one file each, against a walk through them."""
    rng = random.Random(seed)
    start, ref, gap, delay = datetime(2024, 1, 1), f"sessions{seed}", timedelta(minutes=30), timedelta(hours=2)
    store.create_ref(ref)
    schema = spark.createDataFrame([], "ts timestamp_ntz, g string, x int").schema
    kept, late, newest = [], Counter(), None

    def take():
        return stream_sessions(store, ref, "s.sessions", "s.late", str(tmp_path / "in"), "u", schema, time="ts", gap="30 MINUTES", delay="2 HOURS", group_by=["g"], sums={"total": "x"}, files_per_batch=1)

    for number in range(4):
        rows = [
            (start + timedelta(minutes=rng.randrange(number * 180, number * 180 + 400) // 10 * 10 - rng.choice([0, 0, 300])) if rng.random() < 0.95 else None, rng.choice(["a", "b", None]), rng.choice([1, 2, None]))
            for _ in range(30)
        ]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        for r in rows:
            if r[0] is None or newest is not None and r[0] < newest - delay:
                late[r] += 1
            else:
                kept.append(r)
        newest = max(r[0] for r in kept)
        assert take() == 1 and take() == 0
    want = {}
    for g in ("a", "b", None):
        runs = []
        for ts, x in sorted(((ts, x or 0) for ts, k, x in kept if k == g)):
            if not runs or ts >= runs[-1][-1][0] + gap:
                runs.append([])
            runs[-1].append((ts, x))
        want |= {(run[0][0], run[-1][0] + gap, g): (len(run), sum(x for _, x in run), run[-1][0], run[-1][0] + gap <= newest - delay) for run in runs}
    shown = closed_sessions(store.table(f"s.sessions@{ref}"), "2 HOURS").collect()
    assert {(r.session_start, r.session_end, r.g): (r.n_rows, r.total, r.last_time, r.closed) for r in shown} == want and len(shown) == len(want)
    assert Counter(map(tuple, store.table(f"s.late@{ref}").collect())) == late and late
    with pytest.raises(ValueError):
        stream_sessions(store, ref, "s.sessions", "s.late", str(tmp_path / "in"), "v", schema, time="ts", gap="30 MINUTES", delay="2 HOURS", group_by=[])
