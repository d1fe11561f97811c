"""What no live ref needs any more."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchyard.operators.audit import batch_counts

if TYPE_CHECKING:
    from branchyard.operators.store import BranchStore


def reachable_batches(store: BranchStore) -> DataFrame:
    """table_id, _batch of every commit in the history of a live ref."""
    reach: dict[str, dict] = {}
    for state in store.live_states():
        for lane, last in state["seen"].items():
            reach[lane] = max(last, reach.get(lane, last), key=lambda entry: entry["pos"])
    commits = store.history(reach)
    ids = commits.select(F.explode(F.map_values("tables")).alias("content_id")).distinct()
    contents = store.all_contents().join(ids, "content_id", "left_semi")
    return contents.select("table_id", F.explode("batches").alias("_batch")).distinct()


def stored_batches(store: BranchStore) -> DataFrame:
    """table_id, _batch, n_bytes of every batch folder, from the file listing alone."""
    sizes = store.stored_files().groupBy(F.col("table").alias("table_id"), "_batch")
    return sizes.agg(F.sum("length").alias("n_bytes"))


def orphan_batches(store: BranchStore) -> DataFrame:
    """table_id, _batch, n_bytes, n_rows of batches that no live ref's history holds.

    These include leftovers of writes that were never published. They are what a
    cleanup may delete while no write runs; nothing is deleted here.
    """
    orphans = stored_batches(store).join(reachable_batches(store), ["table_id", "_batch"], "left_anti")
    counts = batch_counts(store, orphans.select("table_id", "_batch"))
    rows = orphans.join(counts, ["table_id", "_batch"], "left")
    return rows.withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
