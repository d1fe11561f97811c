"""Windows of event time over a stream of files, kept as tables at a ref.

The state of the stream is the table of windows itself: it has a row for each window and group, so it is
branched, read and merged like any table, and nothing is lost with a checkpoint's state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from branchyard.functions.expressions import quoted
from branchyard.operators.content import new_batch_id
from branchyard.operators.store import BranchStore
from branchyard.operators.tables import RefTables, _with_keys
from branchyard.session import no_rows
from branchyard.streaming.ingest import run_stream


def stream_windows(
    store: BranchStore,
    ref: str,
    key: str,
    late_key: str,
    path: str,
    name: str,
    schema: StructType,
    *,
    time: str,
    width: str,
    delay: str,
    group_by: Sequence[str] = (),
    sums: dict[str, str] | None = None,
    file_format: str = "parquet",
    files_per_batch: int | None = None,
    **options,
) -> int:
    """Take in all files that are new below ``path``, then stop; the number of micro-batches added.

    ``key`` gets, for each window of ``width`` and each group, window_start, window_end, n_rows, the
    ``sums`` (column to expression) and last_time, the largest time seen in it. The watermark is the largest time
    that micro-batches before have seen, less ``delay``. A row whose window ends at or before it
    comes too late: it goes to ``late_key`` as it is, as does a row without a time, and the window does
    not change any more. Both tables are changed in one commit, which also holds the number of the
    micro-batch: a replay adds nothing, and a restart goes on. Only windows that a micro-batch has rows
    of are written.
    """
    tables = store.at(ref)
    sums = sums or {}
    rows = _windowed(no_rows(store.spark, schema), time, width, group_by, sums)
    tables.create_table(key, _folded(rows, group_by, sums).schema)
    tables.create_table(late_key, schema)

    def add(batch: DataFrame, number: int) -> bool:
        return add_windows(tables, key, late_key, batch, name, number, time=time, width=width, delay=delay, group_by=group_by, sums=sums)

    return run_stream(store, ref, key, path, name, schema, add, file_format, files_per_batch, **options)


def _windowed(rows: DataFrame, time: str, width: str, group_by: Sequence[str], sums: dict[str, str]) -> DataFrame:
    span = F.window(F.col(quoted(time)), width)
    kept = [F.col(quoted(name)) for name in group_by]
    values = [F.expr(expression).alias(name) for name, expression in sums.items()]
    out = rows.select(span.alias("span"), *kept, F.lit(1).cast("bigint").alias("n_rows"), *values, F.col(quoted(time)).alias("last_time"))
    return out.select(F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end"), *[quoted(n) for n in group_by], "n_rows", *[quoted(n) for n in sums], "last_time")


def _folded(rows: DataFrame, group_by: Sequence[str], sums: dict[str, str]) -> DataFrame:
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    names = ["window_start", "window_end", *map(quoted, group_by)]
    values = [F.coalesce(F.sum(quoted(n)), F.lit(0)).cast("bigint" if kinds[n].simpleString() in ("int", "smallint", "tinyint") else kinds[n]).alias(n) for n in sums]
    return rows.groupBy(*names).agg(F.sum("n_rows").alias("n_rows"), *values, F.max("last_time").alias("last_time"))


def watermark(windows: DataFrame, delay: str) -> DataFrame:
    """One row, ``watermark``: the largest time in the windows less the delay; NULL if there is none."""
    return windows.agg((F.max("last_time") - F.expr(f"INTERVAL {delay}")).alias("watermark"))


def with_closed(windows: DataFrame, delay: str) -> DataFrame:
    """The windows with ``closed``: whether no row can come to them any more."""
    passed = watermark(windows, delay).first()["watermark"]
    return windows.withColumn("closed", F.lit(False) if passed is None else F.col("window_end") <= F.lit(passed))


def add_windows(
    tables: RefTables, key: str, late_key: str, batch: DataFrame, stream: str, number: int, *, time: str, width: str, delay: str, group_by: Sequence[str], sums: dict[str, str]
) -> bool:
    """Fold one micro-batch into the windows, once."""
    store = tables.store
    state = store.ref_state(tables.ref)
    old, late = store.content_at(state, key), store.content_at(state, late_key)
    name = f"{old.table_id} {stream}"
    if not tables._is_next(state, name, number):
        return False
    closed = watermark(store.scan(old), delay).first()["watermark"]
    timed, untimed = batch.where(F.col(quoted(time)).isNotNull()), batch.where(F.col(quoted(time)).isNull())
    ends = timed.withColumn("window~", F.window(F.col(quoted(time)), width)["end"])
    passed = F.lit(False) if closed is None else F.col("`window~`") <= F.lit(closed)
    late_batches = store.write_batch(late, ends.where(passed).drop("window~").union(untimed), new_batch_id())
    fresh = _folded(_windowed(ends.where(~passed).drop("window~"), time, width, group_by, sums), group_by, sums)
    names = ["window_start", *group_by]
    keys = fresh.select([F.col(quoted(n)) for n in names])
    had = _with_keys(store.scan(old, with_batch=True), keys)
    delete = tables._written_delete(old, had.select("_batch", *[F.col(quoted(n)) for n in names]).distinct(), names)
    folded = _folded(had.drop("_batch").unionByName(fresh), group_by, sums).select([F.col(quoted(n)) for n in old.schema.names])
    batches = store.write_batch(old, folded, new_batch_id())
    new = (old if delete is None else old.deleting(delete)).adding(*batches)
    ids = {key: store.save_content(new, old, batches), late_key: store.save_content(late.adding(*late_batches), late, late_batches)}
    store.commit(tables.ref, f"stream {stream} to {key}", ids, base=state, stream=name, stream_batch=number)
    return True
