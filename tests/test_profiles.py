"""Column profiles from sketches of batches against plain counts, and what the gate makes of drift."""

from __future__ import annotations

import math
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from branchyard import BranchStore
from branchyard.errors import AuditFailed
from branchyard.operators import audit
from branchyard.operators.profiles import ACCURACY, DriftLimits, bucket_of, drift, profile, sketch_batches, value_of

SCHEMA = "k bigint, x double, `c.d` string, t timestamp_ntz, u timestamp, d date, b boolean, m map<string,int>, bin binary, p decimal(12,2)"


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = BranchStore.start(spark, str(tmp_path_factory.mktemp("profiles")))
    store.create_namespace("s")
    return store


def drawn(rng, n):
    number = lambda: rng.choice([None, 0.0, -0.0, math.inf, -math.inf, math.nan, 1e-300, -1e300, *[rng.gauss(0, 100) for _ in range(20)]])
    moment = datetime(2024, 1, 1)
    return [
        (
            rng.choice([None, *range(-50, 50)]), number(), rng.choice([None, "", "a", "é"]), moment.replace(day=rng.randrange(1, 29)),
            moment.replace(hour=rng.randrange(24)), date(2024, rng.randrange(1, 13), 1), rng.random() < 0.5, {"a": 1}, b"x", None,
        )
        for _ in range(n)
    ]


def order(value):
    return (1, 0) if isinstance(value, float) and math.isnan(value) else (0, value)


def near(got, exact):
    if math.isnan(exact) or math.isinf(exact) or exact == 0:
        return got == exact or math.isnan(got) and math.isnan(exact)
    return abs(got - exact) <= (ACCURACY + 1e-9) * abs(exact)


def held_against(store, ref, quantiles=(0.0, 0.1, 0.5, 0.9, 1.0)):
    got = {r["column"]: r for r in profile(store, "s.t", [ref], quantiles).collect()}
    rows = [r.asDict() for r in store.at(ref).table("s.t").collect()]
    assert set(got) == set(store.at(ref).table("s.t").columns)
    for column, row in got.items():
        values = sorted((r[column] for r in rows if r[column] is not None), key=order) if column not in ("m", "bin") else [r[column] for r in rows]
        assert (row["n_rows"], row["n_values"]) == (len(rows), len(values)), column
        if column != "m":
            distinct = len({"nan" if v != v else v for v in map(lambda v: bytes(v) if column == "bin" else v, values)})
            assert row["n_distinct"] == distinct, column  # so few that the sketch counts them one by one
        assert (row["quantiles"] is None) == (column not in ("k", "x", "p") or not values)
        if row["quantiles"]:
            for q, value in zip(quantiles, row["quantiles"]):
                assert near(value, values[max(1, math.ceil(q * len(values))) - 1]), (column, q)
        if column == "k" and values:
            assert (int(row["smallest"]), int(row["largest"])) == (values[0], values[-1])
        if column == "c.d" and values:
            assert (row["smallest"], row["largest"]) == (values[0], values[-1])
    return got


def test_profiles_follow_appends_deletes_and_columns(store, spark):
    rng = random.Random(4)
    tables = store.at("main")
    tables.create_table("s.t", SCHEMA)
    empty = held_against(store, "main")
    assert {(r["n_rows"], r["n_distinct"]) for c, r in empty.items() if c != "m"} == {(0, 0)} and empty["m"]["n_distinct"] is None
    for _ in range(2):
        tables.append("s.t", spark.createDataFrame(drawn(rng, 60), SCHEMA))
    held_against(store, "main")
    assert sketch_batches(store, store.content_at(store.state("main"), "s.t")) == 0
    store.create_ref("other")
    other = store.at("other")
    other.append("s.t", spark.createDataFrame(drawn(rng, 30), SCHEMA))
    assert sketch_batches(store, store.content_at(store.state("other"), "s.t")) == 1  # the shared ones are there
    held_against(store, "other")
    other.delete("s.t", "k > 20", by=["k"])
    held_against(store, "other")
    held_against(store, "main")
    other.delete("s.t", "k IS NULL OR k <= 20", by=["k"])
    held_against(store, "other")  # batches without a row left
    tables.add_column("s.t", "more", "int")
    tables.rename_column("s.t", "k", "key")
    got = {r["column"]: r for r in profile(store, "s.t", ["main"]).collect()}
    assert got["more"]["n_values"] == 0 and got["key"]["n_rows"] == 120


def test_long_batch_lists_give_the_same(store, spark):
    few = BranchStore(spark, store.root, path_limit=0)
    store.create_ref("long", "main")
    store.at("long").append("s.t", store.at("long").table("s.t"))
    store.at("long").delete("s.t", "key = 7", by=["key"])
    a = sorted(map(str, profile(few, "s.t", ["long"]).collect()))
    assert a == sorted(map(str, profile(store, "s.t", ["long"]).collect()))
    assert profile(few, "s.t", ["long"]).where("column = 'key'").first()["n_rows"] == store.at("long").table("s.t").count()


def test_buckets_hold_their_values(spark):
    rng = random.Random(2)
    values = [rng.choice([1, -1]) * 10 ** rng.uniform(-300, 300) for _ in range(2000)] + [5e-324, -1.7976931348623157e308, 0.0]
    rows = spark.createDataFrame([(v,) for v in values], "x double").withColumn("b", bucket_of(F.col("x"))).withColumn("v", value_of(F.col("b")))
    rows = sorted(rows.collect())
    assert [r["b"] for r in rows] == sorted(r["b"] for r in rows)
    assert all(near(r["v"], r["x"]) for r in rows if abs(r["x"]) > 1e-305)


def test_drift(store, spark):
    one = [(k, float(k % 100 + 1)) for k in range(1000)]
    store.create_ref("old")
    store.at("old").create_table("s.n", "k bigint, x double")
    assert [(r["column"], r["distance"], r["old_nulls"]) for r in drift(store, "s.n", "old", "old").sort("column").collect()] == [("k", None, None), ("x", None, None)]
    store.at("old").append("s.n", spark.createDataFrame(one, "k bigint, x double"))
    store.create_ref("new", "old")
    store.at("new").append("s.n", spark.createDataFrame([(k, None if k % 2 else 1000.0) for k in range(1000)], "k bigint, x double"))
    assert {tuple(r) for r in drift(store, "s.n", "old", "old").collect()} == {("k", 0.0, 0.0, 0.0), ("x", 0.0, 0.0, 0.0)}
    rows = {r["column"]: r for r in drift(store, "s.n", "old", "new").collect()}
    assert rows["k"]["distance"] == pytest.approx(0) and rows["x"]["distance"] == pytest.approx(1 / 3)
    assert (rows["x"]["old_nulls"], rows["x"]["new_nulls"]) == (0, 0.25)
    with pytest.raises(AuditFailed, match="x drifted$"):
        audit.publish(store, "new", {}, "old", drift={"s.n": DriftLimits()})
    audit.publish(store, "new", {}, "old", drift={"s.n": DriftLimits(distance=0.5, nulls=0.3), "s.absent": DriftLimits()})
    assert store.head("old") == store.head("new")


def test_quantiles_are_shares(store):
    with pytest.raises(ValueError):
        profile(store, "s.t", ["main"], [1.5])
