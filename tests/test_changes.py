"""Rows deleted, changed, undone and followed through commits; columns that evolve; partitions; as-of joins."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from branchyard import BranchStore, MergeConflict, StaleHead
from branchyard.operators import audit
from branchyard.operators.asof import asof_join
from branchyard.operators.changes import change_conflicts, pick_rows, revert_rows, row_history

SCHEMA = "k bigint, `a.b` string, x double"
NAN = float("nan")


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = BranchStore.start(spark, str(tmp_path_factory.mktemp("changes")))
    store.create_namespace("s")
    return store


def plain(rows):
    return Counter(tuple("nan" if isinstance(v, float) and v != v else v for v in row) for row in rows)


def content(store, ref, key="s.t"):
    return store.content_at(store.ref_state(ref), key)


ROWS = [(k % 7 if k % 11 else None, ["p", None, "q"][k % 3], [0.5, NAN, None, -1.0][k % 4]) for k in range(60)]


def filled(store, spark, ref, n=3):
    """A table of n batches at a new ref."""
    store.create_ref(ref)
    tables = store.at(ref)
    tables.create_table("s.t", SCHEMA)
    for part in range(n):
        tables.append("s.t", spark.createDataFrame(ROWS[part::n], SCHEMA))
    return tables


@pytest.mark.parametrize("limit", [1000, 0])
def test_deletes_and_updates_rewrite_no_batch(store, spark, limit):
    few = BranchStore(spark, store.root, path_limit=limit)
    ref = f"del-{limit}"
    tables = filled(store, spark, ref)
    store.create_ref(f"{ref}-kept", ref)
    tables, before = few.at(ref), content(few, ref)
    tables.delete("s.t", "k = 3 OR `a.b` IS NULL")
    want = [r for r in ROWS if not (r[0] == 3 or r[1] is None)]
    assert plain(tables.table("s.t").collect()) == plain(want)
    assert content(few, ref).digest == before.digest and content(few, ref).n_batches == 3
    tables.append("s.t", spark.createDataFrame([(3, None, 9.0)], SCHEMA))  # comes after the delete
    tables.update("s.t", F.col("k") == 2, {"X": "x * 2"})
    want = [(r[0], r[1], r[2] * 2 if r[0] == 2 and r[2] is not None else r[2]) for r in want] + [(3, None, 9.0)]
    assert plain(tables.table("s.t").collect()) == plain(want)
    tables.delete_keys("s.t", spark.createDataFrame([(None, NAN), (5, 0.5)], "k bigint, x double"))
    want = [r for r in want if not (r[0] is None and r[2] is not None and r[2] != r[2] or r[0] == 5 and r[2] == 0.5)]
    assert plain(tables.table("s.t").collect()) == plain(want)
    assert {r["n_rows"] for r in audit.count_rows(few, [ref]).collect()} == {len(want)}
    assert plain(store.table(f"s.t@{ref}-kept").collect()) == plain(ROWS)
    gone = {(r["change"], r["n_rows"]) for r in audit.row_diff(few, "s.t", f"{ref}-kept", ref).groupBy("change").agg(F.sum("n_rows").alias("n_rows")).collect()}
    old, new = plain(ROWS), plain(want)
    assert gone == {("removed", sum((old - new).values())), ("added", sum((new - old).values()))}
    head = few.head(ref)
    tables.delete("s.t", "k = 12345")  # no row, no commit
    assert few.head(ref) == head
    tables.overwrite("s.t", tables.table("s.t").where("k = 1"))
    assert plain(tables.table("s.t").collect()) == plain(r for r in want if r[0] == 1) and (content(few, ref).deletes == ())


def test_only_touched_batches_are_joined(store, spark):
    tables = filled(store, spark, "plan")
    tables.append("s.t", spark.createDataFrame([(100, "own", 1.0)], SCHEMA))
    tables.delete("s.t", "k = 100")
    version = content(store, "plan")
    assert [len(d.batches) for d in version.deletes] == [1]
    assert sum(bool(version.deletes_of(b)) for b in version.batches) == 1
    assert tables.table("s.t").where("k = 100").count() == 0 and tables.table("s.t").count() == 60


def test_keys_have_to_tell_rows_apart(store, spark):
    tables = filled(store, spark, "apart")
    with pytest.raises(ValueError, match="do not tell"):
        tables.delete("s.t", "x = 0.5", by=["k"])
    with pytest.raises(ValueError, match="no columns"):
        tables.delete("s.t", "x = 0.5", by=["nope"])
    with pytest.raises(ValueError, match="no columns"):
        tables.update("s.t", "x = 0.5", {"nope": "1"})
    tables.delete("s.t", "k = 1", by=["k"])
    assert content(store, "apart").deletes[0].keys[0][0] == "k" and len(content(store, "apart").deletes[0].keys) == 1
    assert plain(tables.table("s.t").collect()) == plain(r for r in ROWS if r[0] != 1)


def test_upsert_and_merge_of_deletes(store, spark):
    store.create_ref("up")
    up = store.at("up")
    up.create_table("s.t", SCHEMA)
    up.append("s.t", spark.createDataFrame([(k, "a", float(k)) for k in range(10)], SCHEMA))
    up.append("s.t", spark.createDataFrame([(k, "b", float(k)) for k in range(10, 20)], SCHEMA))
    store.create_ref("up2", "up")
    up.upsert("s.t", spark.createDataFrame([(3, "new", 0.0), (77, "new", 0.0)], SCHEMA), by=["k"])
    store.at("up2").delete("s.t", "k IN (4, 15)")
    store.merge_ref("up2", "up", by_key={"s.t": ["k"]})
    want = [(k, "a" if k < 10 else "b", float(k)) for k in range(20) if k not in (3, 4, 15)] + [(3, "new", 0.0), (77, "new", 0.0)]
    assert plain(up.table("s.t").collect()) == plain(want)


def test_two_changes_from_one_head_do_not_both_win(store, spark, monkeypatch):
    tables = filled(store, spark, "race")
    write = store.write_batch

    def late(*args, **more):
        monkeypatch.setattr(store, "write_batch", write)
        store.at("race").append("s.t", spark.createDataFrame([(50, "z", 0.0)], SCHEMA))
        return write(*args, **more)

    monkeypatch.setattr(store, "write_batch", late)
    with pytest.raises(StaleHead):
        tables.update("s.t", "k = 1", {"x": "0D"})
    assert plain(tables.table("s.t").collect()) == plain([*ROWS, (50, "z", 0.0)])


# ---- partitions


def test_partitions_are_replaced_and_pruned(store, spark):
    store.create_ref("part")
    tables = store.at("part")
    tables.create_table("s.p", "k bigint, name string", partitioned_by="name")
    values = ["a", None, "", "n", "v n", "50%", "x/y=z~1", "é*+", "A"]
    rows = [(k, values[k % len(values)]) for k in range(90)]
    tables.append("s.p", spark.createDataFrame(rows, "k bigint, name string"))
    assert plain(tables.table("s.p").collect()) == plain(rows)
    assert {r["partition"]: r["n_batches"] for r in tables.partitions("s.p").collect()} == {v: 1 for v in values}
    for value in values:
        read = tables.table("s.p", partitions=[value])
        assert plain(read.collect()) == plain(r for r in rows if r[1] == value)
        assert len(read.inputFiles()) < len(tables.table("s.p").inputFiles())
    before = set(content(store, "part", "s.p").batches)
    new = [(1000, None), (1001, "x/y=z~1"), (1002, "fresh")]
    tables.overwrite_partitions("s.p", spark.createDataFrame(new, "k bigint, name string"))
    want = [r for r in rows if r[1] not in (None, "x/y=z~1")] + new
    assert plain(tables.table("s.p").collect()) == plain(want)
    assert len(before & set(content(store, "part", "s.p").batches)) == len(values) - 2
    few = BranchStore(spark, store.root, path_limit=0)
    few.at("part").overwrite_partitions("s.p", spark.createDataFrame([(7, "a")], "k bigint, name string"))
    want = [r for r in want if r[1] != "a"] + [(7, "a")]
    assert plain(few.table("s.p@part").collect()) == plain(want)
    assert plain(few.at("part").table("s.p", partitions=["a", "A"]).collect()) == plain(r for r in want if r[1] in ("a", "A"))
    tables.overwrite_partitions("s.p", spark.createDataFrame([], "k bigint, name string"))
    assert plain(tables.table("s.p").collect()) == plain(want)
    with pytest.raises(ValueError, match="partitioned by"):
        tables.drop_column("s.p", "name")
    tables.create_table("s.whole", "k bigint")
    with pytest.raises(ValueError, match="not partitioned"):
        tables.table("s.whole", partitions=[1])


# ---- columns


def test_columns_keep_their_values_whatever_they_are_called(store, spark):
    store.create_ref("cols")
    tables = store.at("cols")
    tables.create_table("s.c", "k int, v float, d decimal(5,2), day date")
    tables.append("s.c", spark.sql("SELECT 1, CAST(1.5 AS float), CAST(2.25 AS decimal(5,2)), DATE'2020-01-02'"))
    tables.rename_column("s.c", "v", "w")
    tables.add_column("s.c", "v", "string")
    for column, kind in (("k", "bigint"), ("w", "double"), ("d", "decimal(12,4)"), ("day", "timestamp_ntz")):
        tables.widen_column("s.c", column, kind)
    tables.append("s.c", spark.sql("SELECT 5000000000, 2.5D, CAST(3.1234 AS decimal(12,4)), TIMESTAMP_NTZ'2021-01-01 10:00:00', 'text'"))
    tables.drop_column("s.c", "v")
    tables.add_column("s.c", "V", "int")
    rows = tables.table("s.c")
    assert [(f.name, f.dataType.simpleString()) for f in rows.schema.fields] == [("k", "bigint"), ("w", "double"), ("d", "decimal(12,4)"), ("day", "timestamp_ntz"), ("V", "int")]
    got = {(r.k, r.w, float(r.d), r.day, r.V) for r in rows.collect()}
    assert got == {(1, 1.5, 2.25, datetime(2020, 1, 2), None), (5000000000, 2.5, 3.1234, datetime(2021, 1, 1, 10), None)}
    assert rows.where("k = 1").count() == 1 and rows.where("d > 3").count() == 1
    with pytest.raises(ValueError, match="does not widen"):
        tables.widen_column("s.c", "k", "int")
    with pytest.raises(ValueError, match="distinct"):
        tables.add_column("s.c", "K", "int")
    tables.delete("s.c", "k = 1", by=["day"])
    tables.drop_column("s.c", "day")  # the delete still knows it
    assert [r.k for r in tables.table("s.c").collect()] == [5000000000]


def test_changes_of_columns_merge(store, spark):
    store.create_ref("m1")
    ours = store.at("m1")
    ours.create_table("s.m", "k bigint, a int, b string, c string")
    ours.append("s.m", spark.sql("SELECT id, CAST(id AS int), 'b', 'c' FROM range(6)"))
    store.create_ref("m2", "m1")
    theirs = store.at("m2")
    ours.add_column("s.m", "more", "string")
    ours.update("s.m", "k < 2", {"more": "'new'"})
    theirs.drop_column("s.m", "b")
    theirs.rename_column("s.m", "c", "named")
    theirs.widen_column("s.m", "a", "bigint")
    store.create_ref("m3", "m1")
    store.merge_ref("m2", "m3")  # rows changed on one side only: no key is needed
    assert store.table("s.m@m3").columns == ["k", "a", "named", "more"]
    theirs.update("s.m", "k = 5", {"a": "a + 5000000000"})
    with pytest.raises(MergeConflict):
        store.merge_ref("m2", "m1")
    store.merge_ref("m2", "m1", by_key={"s.m": ["k"]})
    got = ours.table("s.m")
    assert got.columns == ["k", "a", "named", "more"]
    assert plain(got.collect()) == plain((k, k + (5000000000 if k == 5 else 0), "c", "new" if k < 2 else None) for k in range(6))


@pytest.mark.parametrize("name,mine,other", [
    ("renamed twice", ("rename_column", "a", "x"), ("rename_column", "a", "y")), ("dropped, renamed", ("drop_column", "a"), ("rename_column", "a", "y")),
    ("same name", ("add_column", "x", "int"), ("add_column", "X", "string")),
])
def test_columns_in_conflict(store, name, mine, other):
    ref = name.replace(" ", "-").replace(",", "")
    store.create_ref(ref)
    store.at(ref).create_table("s.q", "k bigint, a int")
    store.create_ref(f"{ref}-2", ref)
    for tables, (verb, *args) in ((store.at(ref), mine), (store.at(f"{ref}-2"), other)):
        getattr(tables, verb)("s.q", *args)
    head = store.head(ref)
    with pytest.raises(MergeConflict):
        store.merge_ref(f"{ref}-2", ref, by_key={"s.q": ["k"]})
    assert store.head(ref) == head


# ---- undoing, picking, history


@pytest.mark.parametrize("seed", range(2))
def test_revert_and_pick_are_arithmetic_on_bags(store, spark, seed):
    rng = random.Random(seed)
    draw = lambda n: [rng.choice(ROWS[:12]) for _ in range(n)]
    ref = f"undo{seed}"
    store.create_ref(ref)
    tables = store.at(ref)
    tables.create_table("s.t", SCHEMA)
    first, second = draw(30), draw(20)
    tables.append("s.t", spark.createDataFrame(first, SCHEMA))
    tables.append("s.t", spark.createDataFrame(second, SCHEMA))
    added = store.head(ref)
    tables.delete("s.t", "k = 1")
    deleted, gone = store.head(ref), plain(r for r in first + second if r[0] == 1)
    store.create_ref(f"{ref}-other", ref)
    revert_rows(tables, "s.t", deleted)
    assert plain(tables.table("s.t").collect()) == plain(first + second)
    revert_rows(tables, "s.t", added)
    assert plain(tables.table("s.t").collect()) == plain(first)
    pick_rows(tables, "s.t", added)
    pick_rows(tables, "s.t", added)
    assert plain(tables.table("s.t").collect()) == plain(first + second + second)
    other = store.at(f"{ref}-other")
    missing = {tuple(r)[:-1]: r["n_missing"] for r in change_conflicts(other, "s.t", added, undo=True).collect()}
    want = plain(second) - (plain(first + second) - gone)
    assert plain(missing) == Counter(dict.fromkeys(want, 1)) and sum(missing.values()) == sum(want.values())
    if want:
        with pytest.raises(MergeConflict):
            revert_rows(other, "s.t", added)
    assert plain(other.table("s.t").collect()) == plain(first + second) - gone


def test_history_of_keys(store, spark):
    store.create_ref("hist")
    tables = store.at("hist")
    states = []

    def note():
        states.append((store.state("hist")["depth"], {tuple(r) for r in tables.table("s.h").collect()}))

    rows = [(k, f"v{k % 3}") for k in range(12)]
    tables.create_table("s.h", "k bigint, v string")
    tables.append("s.h", spark.createDataFrame(rows[:8], "k bigint, v string"))
    note()
    tables.append("s.h", spark.createDataFrame(rows[8:], "k bigint, v string"))
    note()
    tables.update("s.h", "k % 4 = 1", {"v": "concat(v, '!')"})
    note()
    tables.delete("s.h", "k IN (2, 5)", by=["k"])
    note()
    store.create_ref("hist2", "hist")
    tables = store.at("hist2")
    tables.overwrite("s.h", tables.table("s.h").where("k <> 7"))  # a rewrite ends only row 7
    states.append((store.state("hist2")["depth"], {tuple(r) for r in tables.table("s.h").collect()}))
    tables.append("s.h", spark.createDataFrame([(2, "v2"), (7, "back")], "k bigint, v string"))
    states.append((store.state("hist2")["depth"], {tuple(r) for r in tables.table("s.h").collect()}))
    got = [tuple(r) for r in row_history(store, "s.h", "hist2", ["k"]).collect()]
    want, open_rows = [], {}
    for depth, state in states:
        for row in set(open_rows) - state:
            want.append((*row, open_rows.pop(row), depth))
        for row in state - set(open_rows):
            open_rows[row] = depth
    want += [(*row, since, None) for row, since in open_rows.items()]
    assert Counter(got) == Counter(want)
    few = BranchStore(spark, store.root, path_limit=0)
    assert Counter(tuple(r) for r in row_history(few, "s.h", "hist2", ["k"]).collect()) == Counter(want)
    tables.append("s.h", spark.createDataFrame([(7, "twice")], "k bigint, v string"))
    with pytest.raises(Exception, match="not unique"):
        row_history(store, "s.h", "hist2", ["k"]).collect()


# ---- as-of join


def test_asof_join_is_a_search_by_time(spark):
    rng, start = random.Random(5), datetime(2024, 1, 1)
    at = lambda hours: start + timedelta(hours=hours)
    right = [(rng.choice(["hot", "hot", "b", None]), at(rng.randrange(200)) if rng.random() < 0.95 else None, n) for n in range(120)]
    left = [(n, rng.choice(["hot", "hot", "b", "c", None]), at(rng.randrange(-20, 220)) if rng.random() < 0.95 else None) for n in range(300)]
    left += left[:5]
    rows = spark.createDataFrame(left, "n bigint, key string, ts timestamp_ntz")
    values = spark.createDataFrame(right, "key string, day timestamp_ntz, version bigint")
    want = []
    for n, key, ts in left:
        fits = [(day, version) for k, day, version in right if key is not None and k == key and day is not None and ts is not None and day <= ts]
        want.append((n, key, ts, *(max(fits)[::-1] if fits else (None, None))))
    for seconds in (3600, 86_400, 10**9):
        got = asof_join(rows, values, {"key": "key"}, "ts", "day", {"version": "version", "since": "day"}, seconds, ties=["version"])
        assert Counter(map(tuple, got.collect())) == Counter(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    with pytest.raises(ValueError, match="itself"):
        asof_join(rows, values, {"key": "key"}, "ts", "day", {"n": "version"})
    assert asof_join(rows.limit(0), values, {"key": "key"}, "ts", "day", {"version": "version"}).collect() == []
