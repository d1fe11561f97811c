"""One query per operator. Each reads whole given tables, directly or through a store."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from branchyard.errors import AuditFailed, MergeConflict, StaleHead
from branchyard.functions.expressions import counted_once, header_line
from branchyard.operators import audit, changes, cleanup, merge
from branchyard.operators.asof import asof_join
from branchyard.operators.explain import explain_difference as explained
from branchyard.operators.profiles import ACCURACY, DriftLimits, profile
from branchyard.operators.store import BranchStore
from branchyard.operators.totals import refresh_totals
from branchyard.plans.workflow import (
    dropped_refs,
    given,
    history,
    newer,
    reversed_orders,
    sandbox,
    workflow,
)
from branchyard.session import rows_frame, work_folder
from branchyard.sources.files import (
    csv_with_header,
    csv_without_header,
    parquet_files,
    temp_view,
    write_csv,
)
from branchyard.streaming.ingest import stream_files
from branchyard.streaming.sessions import closed_sessions, stream_sessions
from branchyard.streaming.windows import stream_windows, with_closed

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def cents(column: str):
    """An exact sum of prices, whatever the order of the rows."""
    return F.sum(F.round(F.col(column) * 100).cast("bigint"))


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def totals(orders: DataFrame, ref: str) -> DataFrame:
    sums = orders.agg(F.count("*").alias("n_rows"), cents("o_totalprice").alias("cents"))
    return sums.select(F.lit(ref).alias("ref"), "n_rows", "cents")


# ---- sources -------------------------------------------------------------------


@query
def csv_header_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = given(spark, sf_dir, "customer")
    path = write_csv(rows, work_folder(spark, "customer-csv"))
    return csv_with_header(spark, path, rows.schema)


@query
def csv_headerless_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file's header line comes out as a data row; nothing else changes."""
    rows = given(spark, sf_dir, "orders")
    path = write_csv(rows, work_folder(spark, "orders-csv"))
    text = StructType([StructField(name, StringType()) for name in rows.columns])
    lines = csv_without_header(spark, path, text)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), header_line(rows.columns).alias("header"))
    files = lines.groupBy("file").agg(
        counted_once(~F.col("header")).alias("data_rows"), counted_once(F.col("header")).alias("header_rows")
    )
    return files.agg(
        F.sum("data_rows").alias("n_data_rows"),
        F.min("header_rows").alias("fewest_headers_per_file"),
        F.max("header_rows").alias("most_headers_per_file"),
    )


@query
def stage_load_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load text files into staging twice, then replace a versioned table with it."""
    rows = given(spark, sf_dir, "part")
    box = sandbox(spark, sf_dir)
    path = write_csv(rows, work_folder(spark, "part-csv"), header=False)
    for _ in range(2):
        staged = box.store.load_staging("part", csv_without_header(spark, path, rows.schema))
    branch = box.branch("staged")
    branch.create_table("shop.staged_part", rows.schema)
    branch.overwrite("shop.staged_part", staged)
    branch.overwrite("shop.staged_part", box.store.staging("part"))
    return branch.table("shop.staged_part")


@query
def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    region, nation, customer = (
        parquet_files(spark, f"{sf_dir}/{name}.parquet") for name in ("region", "nation", "customer")
    )
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    joined = joined.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy("r_name").agg(F.count("*").alias("n_customers"))


@query
def temp_view_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over a session view of a CSV file, every column as text."""
    rows = given(spark, sf_dir, "supplier")
    path = write_csv(rows, work_folder(spark, "supplier-csv"))
    temp_view(csv_with_header(spark, path), "supplier_file")
    return spark.sql("SELECT s_nationkey, count(*) AS n FROM supplier_file GROUP BY s_nationkey")


@query
def scan_current_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = workflow(spark, sf_dir).store.table("shop.orders")
    return orders.groupBy("o_orderstatus").agg(
        F.count("*").alias("n_rows"), cents("o_totalprice").alias("cents")
    )


@query
def scan_at_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pinned name overrides the ref of the handle."""
    main = workflow(spark, sf_dir).store.at("main")
    return union([
        main.table(f"shop.orders@{ref}")
        .groupBy(F.lit(ref).alias("ref"), "o_orderstatus")
        .agg(F.count("*").alias("n_rows"))
        for ref in ("dev", "etl", "experiment", "main")
    ])


@query
def sql_pinned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = workflow(spark, sf_dir).store
    for ref in ("experiment", "main"):
        store.at(ref).create_views(current=False)
    return spark.sql(
        "SELECT 'experiment' AS ref, count(*) AS n_rows FROM `orders@experiment`"
        " UNION ALL SELECT 'main', count(*) FROM `orders@main`"
    )


@query
def append_at_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables are created, renamed and written at a ref that their names pin."""
    orders = given(spark, sf_dir, "orders")
    box = sandbox(spark, sf_dir)
    ref = box.branch("pinned").ref
    main = box.store.at(box.store.default)
    main.create_table(f"shop.arrived@{ref}", orders.schema)
    main.append(f"shop.arrived@{ref}", history(orders))
    main.rename_table(f"shop.arrived@{ref}", "shop.kept")
    main.append(f"shop.kept@{ref}", newer(orders))
    return main.table(f"shop.kept@{ref}")


@query
def use_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same SQL shows another state after another ref was made current."""
    store = workflow(spark, sf_dir).store
    results = []
    for ref in ("experiment", "main"):
        store.at(ref).create_views(current=True)
        rows = spark.sql("SELECT o_orderpriority, count(*) AS n_rows FROM orders GROUP BY o_orderpriority")
        results.append(rows.withColumn("ref", F.lit(ref)))
    return union(results)


# ---- table definition ------------------------------------------------------------


@query
def create_namespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A namespace made twice is there once, and only on its ref."""
    box = sandbox(spark, sf_dir)
    box.load("customer")
    branch = box.branch("namespaced")
    for _ in range(2):
        box.store.create_namespace("archive", branch.ref)
    customer = box.store.table("shop.customer")
    branch.create_table("archive.customer", customer.schema)
    branch.append("archive.customer", customer)
    spaces = box.store.list_namespaces().filter(F.col("ref").isin(branch.ref, "main"))
    spaces = spaces.groupBy("namespace").agg(
        counted_once(F.col("ref") == branch.ref).alias("on_branch"),
        counted_once(F.col("ref") == "main").alias("on_main"),
    )
    counts = audit.count_rows(box.store, [branch.ref]).filter(F.col("table").endswith(".customer"))
    counts = counts.select(F.split_part("table", F.lit("."), F.lit(1)).alias("namespace"), "n_rows")
    return spaces.join(counts, "namespace").select("namespace", "on_branch", "on_main", "n_rows")


@query
def create_table_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second create leaves the rows; a new table is empty."""
    box = sandbox(spark, sf_dir)
    box.load("supplier")
    branch = box.branch("created")
    branch.create_table("shop.supplier", "other string")
    branch.create_table("shop.nothing_yet", branch.table("shop.supplier").schema)
    counts = audit.count_rows(box.store, [branch.ref])
    return counts.filter(F.col("table").isin("shop.supplier", "shop.nothing_yet")).select("table", "n_rows")


@query
def drop_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workflow(spark, sf_dir).store.table("shop.customer")


@query
def rename_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = sandbox(spark, sf_dir)
    box.load("supplier")
    branch = box.branch("renamed")
    branch.rename_table("shop.supplier", "shop.vendor")
    assert "shop.supplier" not in branch.table_keys()
    return branch.table("shop.vendor")


@query
def drop_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dropped on one ref, still there on the other."""
    return audit.count_rows(workflow(spark, sf_dir).store, ["experiment", "main"])


@query
def list_tables_at_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = workflow(spark, sf_dir).store
    listed = union([store.at(ref).list_tables() for ref in ("dev", "etl", "experiment", "main")])
    return listed.join(audit.count_rows(store), ["ref", "table"], "left")


# ---- writes ----------------------------------------------------------------------


@query
def append_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given(spark, sf_dir, "orders")
    branch = sandbox(spark, sf_dir).branch("appended")
    branch.create_table("shop.all_orders", orders.schema)
    branch.append("shop.all_orders", history(orders))
    branch.append("shop.all_orders", newer(orders))
    return branch.table("shop.all_orders")


@query
def append_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = sandbox(spark, sf_dir)
    box.load("orders")
    branch = box.branch("values")
    branch.append_values("shop.orders", [
        (-1, 7, "O", 1.25, datetime(2002, 1, 1), "1-URGENT"),
        (-2, 7, "O", 2.25, datetime(2002, 1, 2), "2-HIGH"),
        (-3, 7, "O", 3.25, datetime(2002, 1, 3), None),
        (-4, 7, "O", 4.25, datetime(2002, 1, 4), "5-LOW"),
    ])
    return branch.table("shop.orders")


@query
def overwrite_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by a query over itself; the ref it came from keeps its rows."""
    box = sandbox(spark, sf_dir)
    box.load("orders")
    branch = box.branch("overwritten")
    branch.overwrite("shop.orders", branch.table("shop.orders").filter("o_orderstatus <> 'F'"))
    return totals(branch.table("shop.orders"), "branch").union(totals(box.store.table("shop.orders"), "main"))


@query
def project_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workflow(spark, sf_dir).store.table("shop.supplier@etl").select("*")


@query
def count_rows_by_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pass for all refs: a batch that they share is counted once."""
    counts = audit.count_rows(workflow(spark, sf_dir).store)
    return counts.filter(F.col("table") == "shop.orders").select("ref", "n_rows")


@query
def count_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = given(spark, sf_dir, "customer")
    branch = sandbox(spark, sf_dir).branch("counted")
    branch.create_table("shop.segments", customer.schema)
    branch.append("shop.segments", customer.withColumn("c_mktsegment", F.expr("nullif(c_mktsegment, 'BUILDING')")))
    segments = branch.table("shop.segments")
    return segments.select(F.count("c_mktsegment").alias("n_values"), F.count("*").alias("n_rows"))


@query
def count_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = sandbox(spark, sf_dir)
    box.load("lineitem")
    return box.store.table("shop.lineitem").select(F.count(F.lit(1)).alias("n"))


# ---- refs ------------------------------------------------------------------------


@query
def create_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new ref shows its source's tables and adds no file."""
    box = sandbox(spark, sf_dir)
    box.load("orders", "customer", "lineitem")
    before = cleanup.stored_batches(box.store).count()
    branch = box.branch("new")
    new_batches = cleanup.stored_batches(box.store).count() - before
    counts = audit.count_rows(box.store, [branch.ref])
    counts = counts.filter(F.col("table").isin("shop.orders", "shop.customer", "shop.lineitem"))
    return counts.select("table", "n_rows", F.lit(new_batches).cast("bigint").alias("new_batches"))


@query
def create_ref_at_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ref from an older commit of its source shows the older rows."""
    box = sandbox(spark, sf_dir)
    box.load("orders")
    moved = box.branch("moved")
    older = box.store.head(moved.ref)
    moved.append("shop.orders", reversed_orders(moved.table("shop.orders")))
    name = f"{moved.ref}-before"
    box.store.create_ref(name, source=moved.ref, at=older)
    return totals(box.store.at(name).table("shop.orders"), "older").union(
        totals(moved.table("shop.orders"), "moved")
    )


@query
def list_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = workflow(spark, sf_dir).store
    counts = audit.count_rows(store).groupBy("ref").agg(F.sum("n_rows").alias("n_rows"))
    return store.list_refs().select("ref_type", F.col("name").alias("ref")).join(counts, "ref", "left")


@query
def drop_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = dropped_refs(spark, sf_dir)
    refs = store.list_refs().select("ref_type", F.col("name").alias("ref"))
    return refs.join(audit.count_rows(store), "ref", "left")


@query
def orphan_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the dropped refs leave behind: only the rows that were not merged."""
    orphans = cleanup.orphan_batches(dropped_refs(spark, sf_dir))
    return orphans.agg(F.count("*").alias("n_orphan_batches"), F.sum("n_rows").alias("n_rows"))


@query
def ref_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After each stage: does the ref point where the default ref does, and its rows."""
    work = workflow(spark, sf_dir)
    states, heads = [], []
    for stage, refs in work.stages.items():
        main = next(state["hash"] for state in refs if state["ref"] == "main")
        states += [{**state, "stage": stage} for state in refs]
        heads += [{"stage": stage, "ref": s["ref"], "same_as_main": s["hash"] == main} for s in refs]
    counts = audit.count_tables(work.store, states, ["stage", "ref"])
    counts = counts.groupBy("stage", "ref").agg(F.sum("n_rows").alias("n_rows"))
    heads = rows_frame(spark, heads, "stage string, ref string, same_as_main boolean")
    rows = heads.join(counts, ["stage", "ref"], "left")
    return rows.withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))


@query
def commit_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several puts and removes in one commit with a message, on top of a known head."""
    box = sandbox(spark, sf_dir)
    box.load("orders", "customer")
    branch = box.branch("committed")
    state = box.store.state(branch.ref)
    changes = {"shop.archive": state["tables"]["shop.orders"], "shop.customer": None}
    box.store.commit(branch.ref, "archive the orders", changes, expected_hash=state["hash"])
    try:
        box.store.commit(branch.ref, "late", changes, expected_hash=state["hash"])
        raise AssertionError("the commit should have been rejected")
    except StaleHead:
        pass
    counts = audit.count_rows(box.store, [branch.ref])
    kept = counts.filter(F.col("table").isin("shop.archive", "shop.orders", "shop.customer"))
    message = box.store.state(branch.ref)["message"]
    return kept.select(F.lit(message).alias("message"), "table", "n_rows")


@query
def commit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.commit_log(workflow(spark, sf_dir).store, "experiment").drop("hash")


# ---- merges ----------------------------------------------------------------------


@query
def merge_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables on `main` before and after each of the two merges."""
    work = workflow(spark, sf_dir)
    states = [
        {**state, "stage": stage}
        for stage, refs in work.stages.items()
        for state in refs
        if state["ref"] == "main"
    ]
    return audit.count_tables(work.store, states, ["stage"])


@query
def merge_diverged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both refs moved, on different tables: the merge has the work of both, and a repeat adds nothing."""
    box = sandbox(spark, sf_dir)
    box.load("orders", "customer", "supplier")
    target = box.branch("target")
    source = box.branch("source", target.ref)
    target.append("shop.orders", reversed_orders(target.table("shop.orders")))
    source.drop_column("shop.customer", "c_mktsegment")
    source.append("shop.supplier", source.table("shop.supplier"))
    for _ in range(2):
        box.store.merge_ref(source.ref, target.ref)
    counts = audit.count_rows(box.store, [target.ref])
    counts = counts.filter(F.col("table").isin("shop.orders", "shop.customer", "shop.supplier"))
    columns = len(target.table("shop.customer").columns)
    return counts.select("table", "n_rows", F.lit(columns).alias("n_customer_columns"))


@query
def merge_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table changed on both sides stops the merge; the target stays as it was."""
    box = sandbox(spark, sf_dir)
    box.load("orders", "supplier")
    target = box.branch("target")
    source = box.branch("source", target.ref)
    target.overwrite("shop.orders", target.table("shop.orders").filter("o_orderstatus <> 'F'"))
    source.append("shop.orders", reversed_orders(source.table("shop.orders")))
    source.append("shop.supplier", source.table("shop.supplier"))
    before = box.store.head(target.ref)
    try:
        box.store.merge_ref(source.ref, target.ref)
        raise AssertionError("the merge should have stopped")
    except MergeConflict:
        assert box.store.head(target.ref) == before
    return merge.conflicting_tables(box.store, source.ref, target.ref)


def changed_customers(rows: DataFrame, side: str) -> DataFrame:
    """Changes that do not meet: different segments, or the same change on both sides."""
    same = F.when(F.col("c_mktsegment") == "FURNITURE", F.lit(0.0)).otherwise(F.col("c_acctbal"))
    rows = rows.withColumn("c_acctbal", same)
    if side == "ours":
        more = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 1)
        return rows.withColumn("c_acctbal", more.otherwise(F.col("c_acctbal")))
    name = F.when(F.col("c_mktsegment") == "MACHINERY", "INDUSTRY")
    rows = rows.filter("NOT (c_mktsegment = 'HOUSEHOLD' AND c_acctbal < 0)")
    return rows.withColumn("c_mktsegment", name.otherwise(F.col("c_mktsegment")))


@query
def keyed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both refs rewrote and extended `customer`; the merge by key publishes all changes."""
    box = sandbox(spark, sf_dir)
    box.load("customer")
    target = box.branch("target")
    source = box.branch("source", target.ref)
    customer = box.store.table("shop.customer")
    target.overwrite("shop.customer", changed_customers(customer, "ours"))
    source.overwrite("shop.customer", changed_customers(customer, "theirs"))
    source.append("shop.customer", customer.withColumn("c_custkey", -1 - F.col("c_custkey")))
    box.store.merge_ref(source.ref, target.ref, by_key={"shop.customer": ["c_custkey"]})
    return target.table("shop.customer")


@query
def keyed_merge_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that both refs changed in different ways, with the three sides."""
    box = sandbox(spark, sf_dir)
    box.load("customer")
    target = box.branch("target")
    source = box.branch("source", target.ref)
    customer = box.store.table("shop.customer")
    more = F.when(F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE"), F.col("c_acctbal") + 1)
    target.overwrite("shop.customer", customer.withColumn("c_acctbal", more.otherwise(F.col("c_acctbal"))))
    name = F.when(F.col("c_acctbal") < 0, "DEBTOR").otherwise(F.col("c_mktsegment"))
    gone = customer.filter("NOT (c_acctbal > 9000 AND c_mktsegment = 'BUILDING')")
    source.overwrite("shop.customer", gone.withColumn("c_mktsegment", name))
    compared = merge.compare_by_key(box.store, "shop.customer", ["c_custkey"], source.ref, target.ref)
    rows = merge.conflicting_rows(compared, ["c_custkey"])
    return rows.select(
        "c_custkey",
        F.col("base.c_acctbal").alias("old_acctbal"),
        F.col("ours.c_acctbal").alias("our_acctbal"),
        F.col("theirs.c_mktsegment").alias("their_mktsegment"),
    )


@query
def keyed_merge_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A branch repeats keys of rows that it shares with the target: the merge is refused, whatever the limit."""
    box = sandbox(spark, sf_dir)
    box.load("customer")
    customer = box.store.table("shop.customer")
    results = []
    for limit in (0, 1, 1000):
        store = BranchStore(spark, box.store.root, path_limit=limit)
        target = box.branch("target")
        source = box.branch("source", target.ref)
        source.append("shop.customer", customer.where("c_acctbal < 0").withColumn("c_acctbal", F.lit(0.0)))
        target.append("shop.customer", customer.withColumn("c_custkey", -F.col("c_custkey")))
        try:
            store.merge_ref(source.ref, target.ref, by_key={"shop.customer": ["c_custkey"]})
            outcome = "merged"
        except ValueError:
            outcome = "refused"
        counts = target.table("shop.customer").agg(F.count("*").alias("n_rows"), F.sum("c_custkey").alias("sum_keys"))
        results.append(counts.select(F.lit(limit).alias("path_limit"), F.lit(outcome).alias("outcome"), "n_rows", "sum_keys"))
    return union(results)


# ---- rows and columns that change ------------------------------------------------


def yearly(orders: DataFrame) -> DataFrame:
    sums = orders.groupBy(F.year("o_orderdate").alias("year"))
    return sums.agg(F.count("*").alias("n_rows"), cents("o_totalprice").alias("cents"))


@query
def delete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows deleted by a condition and by keys: all batches stay, and another ref still has the rows."""
    lines = given(spark, sf_dir, "lineitem")
    box = sandbox(spark, sf_dir)
    branch = box.branch("deleted")
    branch.create_table("shop.lines", lines.schema)
    for flag in ("A", "N", "R"):
        branch.append("shop.lines", lines.where(F.col("l_returnflag") == flag))
    kept = box.branch("kept", branch.ref)
    branch.delete("shop.lines", "l_returnflag = 'R' AND l_quantity < 10")
    cancelled = given(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    branch.delete_keys("shop.lines", cancelled)
    before, after = (box.store.content_at(box.store.state(t.ref), "shop.lines") for t in (kept, branch))
    shared = len(set(before.batches).intersection(after.batches))
    return union([
        t.table("shop.lines").groupBy(F.lit(name).alias("ref"), "l_returnflag").agg(
            F.count("*").alias("n_rows"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"), F.lit(shared).cast("bigint").alias("shared_batches")
        )
        for name, t in (("deleted", branch), ("kept", kept))
    ])


@query
def update_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns set in some rows; the others are read from where they were."""
    box = sandbox(spark, sf_dir)
    box.load("lineitem")
    branch = box.branch("updated")
    branch.update("shop.lineitem", "l_shipdate < TIMESTAMP_NTZ'1995-01-01'", {"l_discount": "l_tax", "l_tax": "l_discount", "l_returnflag": "'Z'"})
    return branch.table("shop.lineitem")


@query
def upsert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows put in the place of those with their keys, and new ones added."""
    box = sandbox(spark, sf_dir)
    box.load("supplier")
    branch = box.branch("upserted")
    supplier = given(spark, sf_dir, "supplier")
    some = supplier.where("s_acctbal < 0").withColumns({"s_acctbal": F.lit(0.0), "s_name": F.lower("s_name")})
    branch.upsert("shop.supplier", some.union(some.withColumn("s_suppkey", -F.col("s_suppkey"))), by=["s_suppkey"])
    return branch.table("shop.supplier")


@query
def overwrite_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two years replaced in a table partitioned by year; only the wanted years are read."""
    orders = given(spark, sf_dir, "orders")
    branch = sandbox(spark, sf_dir).branch("partitioned")
    branch.create_table("shop.yearly", orders.schema, partitioned_by="year(o_orderdate)")
    branch.append("shop.yearly", orders)
    new = orders.where("year(o_orderdate) IN (1995, 1996) AND o_orderstatus = 'F'")
    branch.overwrite_partitions("shop.yearly", new.withColumn("o_totalprice", -F.col("o_totalprice")))
    wanted = branch.table("shop.yearly", partitions=[1995, 1996, 1997])
    assert len(wanted.inputFiles()) < len(branch.table("shop.yearly").inputFiles())
    return yearly(wanted)


@query
def evolve_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ref adds a column and fills it, the other drops, renames and widens some; the merge has it all."""
    box = sandbox(spark, sf_dir)
    box.load("customer")
    target = box.branch("target")
    source = box.branch("source", target.ref)
    target.add_column("shop.customer", "c_grade", "string")
    target.update("shop.customer", "c_acctbal < 0", {"c_grade": "'debtor'"}, by=["c_custkey"])
    source.drop_column("shop.customer", "c_mktsegment")
    source.rename_column("shop.customer", "c_name", "c_label")
    source.widen_column("shop.customer", "c_nationkey", "bigint")
    source.update("shop.customer", "c_acctbal >= 0 AND c_nationkey = 3", {"c_nationkey": "c_nationkey + 5000000000"}, by=["c_custkey"])
    box.store.merge_ref(source.ref, target.ref, by_key={"shop.customer": ["c_custkey"]})
    return target.table("shop.customer")


def _booked(spark: SparkSession, sf_dir: str) -> tuple:
    """A branch where some orders were booked back, two copies of each, and then others changed; the first commit."""
    box = sandbox(spark, sf_dir)
    box.load("orders")
    branch = box.branch("booked")
    back = reversed_orders(given(spark, sf_dir, "orders").where("o_orderstatus = 'F'"))
    branch.append("shop.orders", back.union(back))
    commit = box.store.head(branch.ref)
    branch.update("shop.orders", "o_orderstatus = 'O'", {"o_orderpriority": "'9-NONE'"}, by=["o_orderkey"])
    return box, branch, commit


@query
def revert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a commit added goes again; what came later stays."""
    _, branch, commit = _booked(spark, sf_dir)
    changes.revert_rows(branch, "shop.orders", commit)
    return branch.table("shop.orders")


@query
def revert_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a revert would take away and that are gone: nothing is published."""
    box, branch, commit = _booked(spark, sf_dir)
    branch.delete("shop.orders", "o_orderkey < 0 AND o_orderpriority = '1-URGENT'")
    before = box.store.head(branch.ref)
    try:
        changes.revert_rows(branch, "shop.orders", commit)
        raise AssertionError("the revert should have stopped")
    except MergeConflict:
        assert box.store.head(branch.ref) == before
    return changes.change_conflicts(branch, "shop.orders", commit, undo=True)


@query
def pick_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One commit of a branch done again on another, without the commits around it."""
    box, branch, commit = _booked(spark, sf_dir)
    other = box.branch("other")
    other.delete("shop.orders", "o_orderstatus = 'P'")
    changes.pick_rows(other, "shop.orders", commit)
    return other.table("shop.orders")


@query
def row_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From which to which of five commits each row of a key held."""
    box = sandbox(spark, sf_dir)
    customer = given(spark, sf_dir, "customer")
    branch = box.branch("followed")
    branch.create_table("shop.followed", customer.schema)
    first = box.store.state(branch.ref)["depth"]
    branch.append("shop.followed", customer.where("c_nationkey < 15"))
    branch.append("shop.followed", customer.where("c_nationkey >= 15"))
    branch.update("shop.followed", "c_acctbal < 0", {"c_mktsegment": "'DEBTOR'"}, by=["c_custkey"])
    branch.delete("shop.followed", "c_acctbal > 9000", by=["c_custkey"])
    branch.overwrite("shop.followed", branch.table("shop.followed").where("c_nationkey <> 3"))
    spans = changes.row_history(box.store, "shop.followed", branch.ref, ["c_custkey"])
    number = [(F.col(name) - first).alias(name) for name in ("valid_from", "valid_to")]
    return spans.select("c_custkey", "c_mktsegment", *number)


@query
def asof_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last order of a customer at the time of each event, with the month of events stretched over the orders' years."""
    seconds = "80 * timestampdiff(SECOND, TIMESTAMP_NTZ'2024-01-01', ts)"
    events = given(spark, sf_dir, "events")
    events = events.select("event_id", "user_id", F.expr(f"timestampadd(SECOND, CAST({seconds} AS INT), TIMESTAMP_NTZ'1995-01-01')").alias("moment"))
    columns = {"o_orderkey": "o_orderkey", "since": "o_orderdate"}
    orders = given(spark, sf_dir, "orders")
    return asof_join(events, orders, {"user_id": "o_custkey"}, "moment", "o_orderdate", columns, piece_seconds=30 * 86_400, ties=["o_orderkey"])


# ---- audit -----------------------------------------------------------------------


@query
def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = workflow(spark, sf_dir).store
    return union([
        audit.reconcile(store.table(f"shop.{name}"), given(spark, sf_dir, name)).withColumn("table", F.lit(name))
        for name in ("orders", "customer", "supplier")
    ])


@query
def isolation_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.isolation(workflow(spark, sf_dir).store, "experiment", "main")


@query
def row_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only appended batches differ, so only they are read."""
    return audit.row_diff(workflow(spark, sf_dir).store, "shop.orders", "main", "experiment")


@query
def row_diff_rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch differs; copies of rows are kept as a number."""
    box = sandbox(spark, sf_dir)
    box.load("lineitem")
    branch = box.branch("rewritten")
    lines = branch.table("shop.lineitem")
    flag = F.when(F.col("l_returnflag") == "R", "X").otherwise(F.col("l_returnflag"))
    changed = lines.withColumn("l_returnflag", flag)
    branch.overwrite("shop.lineitem", changed.union(changed.filter("l_returnflag = 'X'")))
    return audit.row_diff(box.store, "shop.lineitem", "main", branch.ref)


@query
def explain_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows of `lineitem` an update, a delete and an append changed, told by what the rows have in common."""
    box = sandbox(spark, sf_dir)
    box.load("lineitem")
    branch = box.branch("changed")
    lines = branch.table("shop.lineitem")
    branch.append("shop.lineitem", lines.where("l_orderkey % 25 = 0").withColumn("l_orderkey", F.expr("-1 - l_orderkey")))
    branch.update("shop.lineitem", "l_returnflag = 'R' AND l_linestatus = 'F' AND year(l_shipdate) = 1994 AND l_orderkey > 0", {"l_tax": "l_tax + 1"})
    branch.delete("shop.lineitem", "l_linenumber = 3 AND l_quantity > 25")
    by = {"l_returnflag": "l_returnflag", "l_linestatus": "l_linestatus", "ship_year": "year(l_shipdate)", "l_linenumber": "l_linenumber", "copied": "l_orderkey < 0"}
    return explained(box.store, "shop.lineitem", "main", branch.ref, by, share=0.04)


def rank_holds(column: str, value: float, q: float):
    """Whether a row of rank ceil(q * n) differs from the value by at most the stated share."""
    low, high = sorted((value / (1 + ACCURACY), value / (1 - ACCURACY)))
    rank = F.greatest(F.lit(1), F.ceil(F.lit(q) * F.count(column)))
    x, slack = F.col(column), 1e-9 * abs(value)
    return (counted_once(x < low - slack) < rank) & (counted_once(x <= high + slack) >= rank)


@query
def profile_by_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of `lineitem` on two refs that share a batch, from sketches, and whether these keep to their error.

    The other ref has a batch without discounts and lost rows of both. Distinct counts are held against exact ones
    (five standard errors), quantiles against the ranks of their values.
    """
    box = sandbox(spark, sf_dir)
    box.load("lineitem")
    branch = box.branch("profiled")
    lines = branch.table("shop.lineitem")
    more = lines.where("l_orderkey % 25 = 0").withColumns({"l_orderkey": F.expr("-1 - l_orderkey"), "l_discount": F.lit(None).cast("double")})
    branch.append("shop.lineitem", more)
    branch.delete("shop.lineitem", "l_linenumber = 3 AND l_quantity > 25")
    quantiles, results = (0.01, 0.25, 0.5, 0.75, 0.99), []
    folder = work_folder(spark, "profiled")
    profile(box.store, "shop.lineitem", ["main", branch.ref], quantiles).coalesce(1).write.parquet(folder)
    profiled = spark.read.parquet(folder)
    for row_ref, ref in (("main", "main"), ("changed", branch.ref)):
        columns = profiled.where(F.col("ref") == ref).collect()  # one row per column
        rows = box.store.at(ref).table("shop.lineitem")
        near = {
            r["column"]: [rank_holds(r["column"], v, q) for v, q in zip(r["quantiles"], quantiles)] if r["quantiles"] else [F.lit(None).cast("boolean")]
            for r in columns
        }
        held = rows.agg(*[reduce(lambda a, b: a & b, checks).alias(c) for c, checks in near.items()])
        # a column at a time, as counting all at once shuffles each row once for each of them, as wide as all of them
        exact = union([rows.agg(F.count_distinct(c).alias("n_exact")).select(F.lit(c).alias("column"), "n_exact") for c in near])
        held = held.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("quantiles_hold")) for c in near])))
        least, most = (F.expr(f"try_cast({c} AS DOUBLE)").alias(a) for c, a in (("smallest", "least"), ("largest", "most")))
        distinct = (F.abs(F.col("n_distinct") - F.col("n_exact")) <= 0.04 * F.col("n_exact")).alias("distinct_holds")
        mine = profiled.where(F.col("ref") == ref).join(exact, "column").join(held, "column")
        results.append(mine.select(F.lit(row_ref).alias("ref"), "column", "n_rows", "n_values", least, most, distinct, "quantiles_hold"))
    return union(results)


@query
def gated_publish_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A branch whose prices are tenfold is refused by the profile of `orders`; one with a tenth of the rows anew is merged."""
    box = sandbox(spark, sf_dir)
    box.load("orders")
    target = box.branch("steady")
    orders = given(spark, sf_dir, "orders")
    limits, outcomes = {"shop.orders": DriftLimits(distance=0.2, columns=("o_totalprice", "o_custkey"))}, []
    for factor, part in ((10, orders), (1, orders.where("o_orderkey % 10 = 0"))):
        source = box.branch("source", target.ref)
        changed = part.withColumns({"o_orderkey": F.expr("-1 - o_orderkey"), "o_totalprice": F.col("o_totalprice") * factor})
        source.append("shop.orders", changed)
        try:
            audit.publish(box.store, source.ref, {}, target.ref, drift=limits)
            outcomes.append("merged")
        except AuditFailed as failed:
            outcomes.append(str(failed))
    return totals(target.table("shop.orders"), "; then ".join(outcomes)).withColumnRenamed("ref", "outcome")


@query
def schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.schema_diff(workflow(spark, sf_dir).store, "shop.customer", "main", "dev", with_values=True)


def lineitem_rules(source: DataFrame) -> list[audit.Rule]:
    return [
        audit.not_null("l_shipdate"),
        audit.matches("l_linestatus", "[FO]"),
        audit.in_set("l_returnflag", ["A", "N"]),
        audit.unique("l_orderkey", "l_linenumber"),
        audit.same_count_as(source),
    ]


@query
def publish_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules over `lineitem`, which breaks two of them: the merge does not happen."""
    box = sandbox(spark, sf_dir)
    box.load("lineitem")
    target = box.branch("target")
    source = box.branch("source", target.ref)
    lines = given(spark, sf_dir, "lineitem")
    source.overwrite("shop.lineitem", lines)
    rules = lineitem_rules(lines)
    before = box.store.head(target.ref)
    try:
        audit.publish(box.store, source.ref, {"shop.lineitem": rules}, target.ref)
        raise AssertionError("the gate should have stopped the merge")
    except AuditFailed:
        assert box.store.head(target.ref) == before
    return audit.check(source.table("shop.lineitem"), rules)


@query
def gated_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule holds, so the branch is merged."""
    box = sandbox(spark, sf_dir)
    box.load("customer")
    target = box.branch("target")
    source = box.branch("source", target.ref)
    customer = given(spark, sf_dir, "customer")
    source.overwrite("shop.customer", customer.withColumn("c_mktsegment", F.lower("c_mktsegment")))
    rules = [
        audit.not_null("c_name"),
        audit.matches("c_mktsegment", "[a-z]+"),
        audit.unique("c_custkey"),
        audit.same_count_as(customer),
    ]
    audit.publish(box.store, source.ref, {"shop.customer": rules}, target.ref)
    return target.table("shop.customer")


@query
def gated_publish_moved_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target moved and breaks a rule that the source keeps: the merge's own result is checked, and refused."""
    box = sandbox(spark, sf_dir)
    box.load("customer", "supplier")
    target = box.branch("target")
    source = box.branch("source", target.ref)
    supplier = given(spark, sf_dir, "supplier")
    source.append("shop.customer", given(spark, sf_dir, "customer"))
    target.append("shop.supplier", supplier.withColumn("s_name", F.lit(None).cast("string")))
    try:
        audit.publish(box.store, source.ref, {"shop.supplier": [audit.not_null("s_name")]}, target.ref)
        outcome = "merged"
    except AuditFailed as failed:
        outcome = "refused" if "not null" in str(failed) else "failed"
    customers = target.table("shop.customer").agg(F.count("*").alias("customers"))
    suppliers = target.table("shop.supplier").agg(F.count("*").alias("suppliers"), F.count("s_name").alias("named"))
    return customers.withColumn("outcome", F.lit(outcome)).join(suppliers.withColumn("outcome", F.lit(outcome)), "outcome")


# ---- streams ---------------------------------------------------------------------


@query
def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files taken in by a stream; a restart takes only those that came since."""
    orders = given(spark, sf_dir, "orders")
    box = sandbox(spark, sf_dir)
    branch = box.branch("streamed")
    branch.create_table("shop.streamed", orders.schema)
    folder = work_folder(spark, "arriving")
    for part in (history(orders), newer(orders)):
        part.write.mode("append").option("header", True).csv(folder)
        stream_files(box.store, branch.ref, "shop.streamed", folder, "orders", header=True)
    return branch.table("shop.streamed").groupBy("o_orderpriority").agg(
        F.count("*").alias("n_rows"), cents("o_totalprice").alias("cents")
    )


@query
def stream_after_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream goes on after its table was renamed, starts anew with a new table, and leaves other refs alone."""
    orders = given(spark, sf_dir, "orders")
    box = sandbox(spark, sf_dir)
    branch = box.branch("renamed")
    branch.create_table("shop.before", orders.schema)
    folder = work_folder(spark, "arriving")
    results = []

    def arrive(part: DataFrame | None, key: str) -> None:
        if part is not None:
            part.write.mode("append").option("header", True).csv(folder)
        stream_files(box.store, branch.ref, key, folder, "orders", header=True)

    arrive(history(orders), "shop.before")
    kept = box.branch("kept", branch.ref)
    branch.rename_table("shop.before", "shop.after")
    arrive(newer(orders), "shop.after")
    results = [totals(branch.table("shop.after"), "renamed"), totals(kept.table("shop.before"), "kept")]
    branch.create_table("shop.before", orders.schema)
    arrive(None, "shop.before")
    return union([*results, totals(branch.table("shop.before"), "anew")])


@query
def windowed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of events by type from three arrivals, the last with rows of days that are closed; and what came too late."""
    events = given(spark, sf_dir, "events")
    branch = (box := sandbox(spark, sf_dir)).branch("windows")
    folder, delay = work_folder(spark, "arriving"), "1 DAY"
    held = (F.col("ts") < F.expr("TIMESTAMP_NTZ'2024-01-06'")) & (F.col("event_id") % 10 == 0)
    day = F.dayofmonth("ts")
    for part in (events.where(~held & (day <= 10)), events.where((day > 10) & (day <= 20)), events.where(held | (day > 20))):
        part.write.mode("append").parquet(folder)
        for _ in range(2):  # a restart finds nothing new
            stream_windows(
                box.store, branch.ref, "shop.days", "shop.late", folder, "days", events.schema, time="ts", width="1 day", delay=delay,
                group_by=["event_type"], sums={"cents": "CAST(round(value * 100) AS BIGINT)"},
            )
    days = with_closed(branch.table("shop.days"), delay).select("window_start", "event_type", "n_rows", "cents", "closed")
    late = branch.table("shop.late").groupBy(F.window("ts", "1 day")["start"].alias("window_start"), "event_type")
    late = late.agg(F.count("*").alias("n_rows"), cents("value").alias("cents"), F.lit(None).cast("boolean").alias("closed"))
    return days.union(late)


@query
def session_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of users from three arrivals: the last has rows that join sessions, and rows that come too late."""
    events = given(spark, sf_dir, "events")
    branch = (box := sandbox(spark, sf_dir)).branch("sessions")
    folder, delay = work_folder(spark, "arriving"), "5 DAYS"
    day = F.dayofmonth("ts")
    held = (F.col("event_id") % 10 == 0) & ((day < 6) | day.between(18, 20))
    for part in (events.where(~held & (day <= 10)), events.where(~held & day.between(11, 20)), events.where(held | (day > 20))):
        part.write.mode("append").parquet(folder)
        for _ in range(2):  # a restart finds nothing new
            stream_sessions(
                box.store, branch.ref, "shop.sessions", "shop.late", folder, "users", events.schema, time="ts", gap="6 HOURS", delay=delay,
                group_by=["user_id"], sums={"cents": "CAST(round(value * 100) AS BIGINT)"},
            )
    sessions = closed_sessions(branch.table("shop.sessions"), delay).select("user_id", "session_start", "session_end", "n_rows", "cents", "closed")
    late = branch.table("shop.late").groupBy("user_id").agg(F.min("ts").alias("session_start"), F.count("*").alias("n_rows"), cents("value").alias("cents"))
    return sessions.unionByName(late, allowMissingColumns=True)


@query
def maintained_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by customer folded from the changes of an append, an update, a delete and a merge."""
    orders = given(spark, sf_dir, "orders")
    box = sandbox(spark, sf_dir)
    branch = box.branch("totals")
    branch.create_table("shop.counted", orders.schema)

    def refresh() -> None:
        measures = {
            "cents": ("sum", "CAST(round(o_totalprice * 100) AS BIGINT)"), "first_day": ("min", "o_orderdate"), "last_day": ("max", "o_orderdate"),
        }
        refresh_totals(branch, "shop.counted", "shop.customer_totals", ["o_custkey"], measures)

    for part in (history(orders), newer(orders)):
        branch.append("shop.counted", part)
        refresh()
    other = box.branch("other", branch.ref)
    branch.update("shop.counted", "o_orderstatus = 'P'", {"o_totalprice": "0D"}, by=["o_orderkey"])
    other.delete("shop.counted", "o_orderstatus <> 'P' AND (o_orderpriority = '1-URGENT' OR o_custkey % 7 = 0)", by=["o_orderkey"])
    refresh()
    box.store.merge_ref(other.ref, branch.ref, by_key={"shop.counted": ["o_orderkey"]})
    refresh()
    return branch.table("shop.customer_totals")
