"""Sessions by gap over a stream of files, kept as a table at a ref.

As with windows, the state of the stream is the table itself: a row for each session of a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from branchyard.functions.expressions import quoted
from branchyard.operators.content import new_batch_id
from branchyard.operators.store import BranchStore
from branchyard.operators.tables import RefTables, _with_keys
from branchyard.session import no_rows
from branchyard.streaming.ingest import run_stream
from branchyard.streaming.windows import watermark


def stream_sessions(
    store: BranchStore,
    ref: str,
    key: str,
    late_key: str,
    path: str,
    name: str,
    schema: StructType,
    *,
    time: str,
    gap: str,
    delay: str,
    group_by: Sequence[str],
    sums: dict[str, str] | None = None,
    file_format: str = "parquet",
    files_per_batch: int | None = None,
    **options,
) -> int:
    """Take in all files that are new below ``path``, then stop; the number of micro-batches added.

    A session of a group is a longest run of rows each less than ``gap`` after the one before. ``key`` gets for
    each session_start, session_end (``gap`` after its last row), the group, n_rows, the ``sums`` (column to
    expression) and last_time. The watermark is the largest time that micro-batches before have seen, less
    ``delay``. A row before it comes too late and goes to ``late_key`` as it is, as does a row without a time. A
    session that ends at or before the watermark is closed: no row can come to it. Other sessions grow,
    and a row between two makes them one. So without late rows the sessions are the same however the rows are
    dealt out to micro-batches. Both tables are changed in one commit that holds the
    micro-batch's number: a replay adds nothing, and a restart goes on.

    Rows of a group within one stretch of ``gap`` are always of one session, so they are combined
    before sessions are put together: of a hot group one task gets one row per stretch.
    """
    if not group_by:
        raise ValueError("sessions need a group")
    tables = store.at(ref)
    sums = sums or {}
    tables.create_table(key, _sessions(no_rows(store.spark, schema), None, time, gap, group_by, sums).schema)
    tables.create_table(late_key, schema)

    def add(batch: DataFrame, number: int) -> bool:
        return add_sessions(tables, key, late_key, batch, name, number, time=time, gap=gap, delay=delay, group_by=group_by, sums=sums)

    return run_stream(store, ref, key, path, name, schema, add, file_format, files_per_batch, **options)


def closed_sessions(sessions: DataFrame, delay: str) -> DataFrame:
    """The sessions with ``closed``: whether no row can come to them any more."""
    passed = watermark(sessions, delay).first()["watermark"]
    return sessions.withColumn("closed", F.lit(False) if passed is None else F.col("session_end") <= F.lit(passed))


def _combined(rows: DataFrame, by: Sequence[str], sums: dict[str, str]) -> DataFrame:
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    small = ("int", "smallint", "tinyint")
    values = [F.coalesce(F.sum(quoted(n)), F.lit(0)).cast("bigint" if kinds[n].simpleString() in small else kinds[n]).alias(n) for n in sums]
    return rows.groupBy(*map(quoted, by)).agg(F.min("session_start").alias("session_start"), F.sum("n_rows").alias("n_rows"), *values, F.max("last_time").alias("last_time"))


def _sessions(rows: DataFrame, open_before: DataFrame | None, time: str, gap: str, group_by: Sequence[str], sums: dict[str, str]) -> DataFrame:
    """The sessions that rows and open sessions of their groups make together."""
    at = F.col(quoted(time))
    groups = [F.col(quoted(name)) for name in group_by]
    values = [F.expr(expression).alias(name) for name, expression in sums.items()]
    rows = rows.select(F.window(at, gap).alias("stretch~"), *groups, at.alias("session_start"), F.lit(1).cast("bigint").alias("n_rows"), *values, at.alias("last_time"))
    parts = _combined(rows, ["stretch~", *group_by], sums).drop("stretch~")
    if open_before is not None:
        parts = parts.unionByName(open_before.select(parts.columns))
    order = Window.partitionBy(*groups).orderBy("session_start", "last_time")
    before = F.max("last_time").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("session_start") >= before + F.expr(f"INTERVAL {gap}"), F.lit(True)).cast("bigint")
    numbered = parts.withColumn("begins~", begins)
    numbered = numbered.withColumn("session~", F.sum("begins~").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    made = _combined(numbered, [*group_by, "session~"], sums)
    end = (F.col("last_time") + F.expr(f"INTERVAL {gap}")).alias("session_end")
    return made.select("session_start", end, *groups, "n_rows", *map(quoted, sums), "last_time")


def add_sessions(
    tables: RefTables, key: str, late_key: str, batch: DataFrame, stream: str, number: int, *, time: str, gap: str, delay: str, group_by: Sequence[str], sums: dict[str, str]
) -> bool:
    """Fold one micro-batch into the sessions, once."""
    store = tables.store
    state = store.ref_state(tables.ref)
    old, late = store.content_at(state, key), store.content_at(state, late_key)
    name = f"{old.table_id} {stream}"
    if not tables._is_next(state, name, number):
        return False
    closed = watermark(store.scan(old), delay).first()["watermark"]
    passed = F.lit(False) if closed is None else F.col(quoted(time)) < F.lit(closed)
    passed = F.coalesce(passed, F.lit(False)) | F.col(quoted(time)).isNull()
    late_batches = store.write_batch(late, batch.where(passed), new_batch_id())
    fresh = batch.where(~passed)
    had = store.scan(old, with_batch=True)
    if closed is not None:
        had = had.where(F.col("session_end") > F.lit(closed))
    had = _with_keys(had, fresh.select([F.col(quoted(n)) for n in group_by]).distinct())
    names = ["session_start", *group_by]
    delete = tables._written_delete(old, had.select("_batch", *[F.col(quoted(n)) for n in names]), names)
    made = _sessions(fresh, had, time, gap, group_by, sums).select([F.col(quoted(n)) for n in old.schema.names])
    batches = store.write_batch(old, made, new_batch_id())
    new = (old if delete is None else old.deleting(delete)).adding(*batches)
    ids = {key: store.save_content(new, old, batches), late_key: store.save_content(late.adding(*late_batches), late, late_batches)}
    store.commit(tables.ref, f"stream {stream} to {key}", ids, base=state, stream=name, stream_batch=number)
    return True
