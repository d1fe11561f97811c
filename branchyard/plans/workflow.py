"""The workflow that the queries look at, run once per session and input folder.

    dev          creates and loads `orders` (the history) and `customer`; merged
    etl          appends the newer `orders`, drops a column of `customer`,
                 creates and loads `supplier`; merged
    experiment   drops `customer`, appends a reversed copy of all `orders`;
                 never merged

After `etl` the default ref holds every row of the three tables.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchyard.operators.store import BranchStore
from branchyard.operators.tables import RefTables
from branchyard.session import work_folder

#: orders before this day are the history, the others arrive later
CUTOFF = "2000-01-01"


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def history(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp_ntz"))


def newer(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("o_orderdate") >= F.lit(CUTOFF).cast("timestamp_ntz"))


def reversed_orders(orders: DataFrame) -> DataFrame:
    """Every order booked back: a key of its own and the negative price."""
    return orders.withColumns(
        {"o_orderkey": -1 - F.col("o_orderkey"), "o_totalprice": -F.col("o_totalprice")}
    )


@dataclass
class Workflow:
    store: BranchStore
    #: where every ref of the workflow pointed after each stage
    stages: dict[str, list[dict]] = field(default_factory=dict)

    def stage(self, name: str, *refs: str) -> None:
        self.stages[name] = [self.store.ref_state(ref) for ref in refs]


def run_workflow(spark: SparkSession, sf_dir: str) -> Workflow:
    orders, customer, supplier = (given(spark, sf_dir, t) for t in ("orders", "customer", "supplier"))
    store = BranchStore.start(spark, work_folder(spark, "workflow"))
    work = Workflow(store)
    store.create_namespace("shop")
    store.create_ref("dev")
    work.stage("1 branched", "main", "dev")

    dev = store.at("dev")
    dev.create_table("shop.orders", orders.schema)
    dev.append("shop.orders", history(orders))
    dev.create_table("shop.customer", customer.schema)
    dev.append("shop.customer", customer)
    work.stage("2 dev loaded", "main", "dev")
    store.merge_ref("dev")
    work.stage("3 dev merged", "main", "dev")

    store.create_ref("etl")
    etl = store.at("etl")
    etl.append("shop.orders", newer(orders))
    etl.drop_column("shop.customer", "c_mktsegment")
    etl.create_table("shop.supplier", supplier.schema)
    etl.append("shop.supplier", supplier)
    work.stage("4 etl loaded", "main", "dev", "etl")
    store.merge_ref("etl")
    work.stage("5 etl merged", "main", "dev", "etl")

    store.create_ref("experiment")
    experiment = store.at("experiment")
    experiment.drop_table("shop.customer")
    experiment.append("shop.orders", reversed_orders(orders))
    work.stage("6 experiment loaded", "main", "dev", "etl", "experiment")
    return work


class Sandbox:
    """A store whose default ref holds whole given tables, loaded when first asked for.

    Queries that write do so on refs of their own: branching copies no rows.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.store = BranchStore.start(spark, work_folder(spark, "sandbox"))
        self.store.create_namespace("shop")
        self._numbers = itertools.count(1)
        self._loaded: set[str] = set()

    def load(self, *names: str) -> None:
        main = self.store.at(self.store.default)
        for name in names:
            if name not in self._loaded:
                rows = given(self.spark, self.sf_dir, name)
                main.create_table(f"shop.{name}", rows.schema)
                main.append(f"shop.{name}", rows)
                self._loaded.add(name)

    def branch(self, name: str, source: str | None = None) -> RefTables:
        """Tables of a new ref whose name no other query uses."""
        ref = f"{name}-{next(self._numbers)}"
        self.store.create_ref(ref, source)
        return self.store.at(ref)


def drop_refs(spark: SparkSession, sf_dir: str) -> BranchStore:
    """A store after cleaning up: `dev` was merged, `experiment` was not."""
    store = BranchStore.start(spark, work_folder(spark, "dropped"))
    store.create_namespace("shop")
    for ref, name in (("dev", "customer"), ("experiment", "orders")):
        rows = given(spark, sf_dir, name)
        store.create_ref(ref)
        store.at(ref).create_table(f"shop.{name}", rows.schema)
        store.at(ref).append(f"shop.{name}", rows)
        if ref == "dev":
            store.merge_ref(ref)
    store.drop_ref("dev")
    store.drop_ref("experiment")
    return store


_kept: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, make):
    """One run per Spark application, as its refs are the data of many queries."""
    key = (spark.sparkContext.applicationId, sf_dir, make)
    if key not in _kept:
        _kept[key] = make(spark, sf_dir)
    return _kept[key]


def workflow(spark: SparkSession, sf_dir: str) -> Workflow:
    return _once(spark, sf_dir, run_workflow)


def sandbox(spark: SparkSession, sf_dir: str) -> Sandbox:
    return _once(spark, sf_dir, Sandbox)


def dropped_refs(spark: SparkSession, sf_dir: str) -> BranchStore:
    return _once(spark, sf_dir, drop_refs)
