"""Time the registered queries and plain Spark on the same rows; print one JSON line.

BENCH_SF_DIR: folder of the given tables. BENCH_CPUS: local cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchyard.operators import audit
from branchyard.plans.queries import QUERIES
from branchyard.plans.workflow import given, sandbox, workflow

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(make) -> float:
    """Seconds to make a frame and to compute all its rows."""
    started = time.perf_counter()
    made = make()
    if isinstance(made, DataFrame):
        made.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def best(make, times: int = 3) -> float:
    return min(run(make) for _ in range(times))


def against_plain_spark(spark: SparkSession) -> dict[str, float]:
    """The same work on the store and on the given files, warm, best of three."""
    box = sandbox(spark, SF_DIR)
    box.load("lineitem", "orders", "customer")
    store = box.store
    lines = given(spark, SF_DIR, "lineitem")

    def report(rows: DataFrame) -> DataFrame:
        return rows.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity"), F.count("*"))

    times = {
        "scan_store": best(lambda: store.table("shop.lineitem")),
        "scan_plain": best(lambda: given(spark, SF_DIR, "lineitem")),
        "group_store": best(lambda: report(store.table("shop.lineitem"))),
        "group_plain": best(lambda: report(given(spark, SF_DIR, "lineitem"))),
    }
    seven = [f"l_linenumber = {i}" for i in range(1, 8)]
    names = iter(f"bench-{i}" for i in range(1000))

    def branch() -> str:
        name = next(names)
        store.create_ref(name)
        return name

    times["create_ref_beside_lineitem"] = best(branch)

    # versions of a table in seven batches: one batch rewritten, or all of them
    ref = branch()
    tables = store.at(ref)
    tables.create_table("shop.parts", lines.schema)
    for part in seven:
        tables.append("shop.parts", lines.filter(part))
    state = store.ref_state(ref)
    content = store.content_at(state, "shop.parts")
    for label, n_new in (("one_of_seven", 1), ("all", 7)):
        fresh = []
        for part in seven[:n_new]:
            batch = f"bench{label}{len(fresh)}"
            store.write_batch(content, lines.filter(part).withColumn("l_tax", F.col("l_tax") + 1), batch)
            fresh.append(batch)
        changed = content.holding(*content.batches[n_new:], *fresh)
        store.create_ref(f"bench-{label}", ref)
        store.commit(f"bench-{label}", "rewrite", {"shop.parts": store.save_content(changed)})
        times[f"row_diff_{label}"] = best(lambda: audit.row_diff(store, "shop.parts", ref, f"bench-{label}"))

    refs = [f"bench-{label}" for label in ("one_of_seven", "all")] + [ref, "main"]
    times["count_four_refs_once"] = best(lambda: audit.count_rows(store, refs))
    times["count_four_refs_apart"] = best(
        lambda: [store.at(r).table(key).count() for r in refs for key in store.at(r).table_keys()]
    )
    return times


def main() -> None:
    spark = session()
    run(lambda: given(spark, SF_DIR, "region"))
    seconds = {"workflow": run(lambda: workflow(spark, SF_DIR))}
    for name, query in QUERIES.items():
        seconds[name] = run(lambda: query(spark, SF_DIR))
        print(f"{name:26s} {seconds[name]:7.2f}", file=sys.stderr, flush=True)
    compared = against_plain_spark(spark)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({
        "metric": "total time of all registered queries, each run once, with the workflow they look at",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "against_plain_spark": {name: round(value, 3) for name, value in compared.items()},
        "sf": float(scale.group(1)) if scale else None,
        "cpus": int(CPUS),
    }))


if __name__ == "__main__":
    main()
