"""Append files to a table at a ref through Structured Streaming."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StructType

from branchyard.operators.store import BranchStore


def stream_files(
    store: BranchStore,
    ref: str,
    key: str,
    path: str,
    name: str,
    file_format: str = "csv",
    files_per_batch: int | None = None,
    **options,
) -> int:
    """Take in all files that are new below ``path``, then stop; the number of batches added.

    The files are read under the table's own columns. Each micro-batch is one
    commit. The checkpoint belongs to the name, the table and the life of the ref, so a
    restart goes on where it stopped, also after a rename of the table, and a replayed
    micro-batch adds nothing.
    """
    tables = store.at(ref)
    schema = store.content_at(store.ref_state(ref), key).schema

    def add(batch: DataFrame, number: int) -> bool:
        return tables.append_stream_batch(key, batch, name, number)

    return run_stream(store, ref, key, path, name, schema, add, file_format, files_per_batch, **options)


def run_stream(
    store: BranchStore,
    ref: str,
    key: str,
    path: str,
    name: str,
    schema: StructType,
    add: Callable[[DataFrame, int], bool],
    file_format: str = "csv",
    files_per_batch: int | None = None,
    **options,
) -> int:
    """Give each micro-batch of the files that are new below ``path`` to ``add``, which says whether it added it.

    The checkpoint belongs to the name, the table and the life of the ref.
    """
    if not re.fullmatch(r"[A-Za-z0-9_]+", name):
        raise ValueError(f"not a stream name: {name!r}")
    state = store.ref_state(ref)
    table = store.content_at(state, key)
    reader: DataStreamReader = store.spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.options(**options).format(file_format).load(path)
    added = []
    writer = rows.writeStream.foreachBatch(lambda batch, number: added.append(add(batch, number))).trigger(availableNow=True)
    checkpoint = f"{store.root}/streams/{state['ref_lane']}/{table.table_id}/{name}"
    writer.option("checkpointLocation", checkpoint).start().awaitTermination()
    return sum(added)
