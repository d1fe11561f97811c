"""Tables at one ref: reading, creating, writing, changing."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import reduce
from operator import and_
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from branchyard.errors import AlreadyExists, StaleHead
from branchyard.functions.expressions import quoted
from branchyard.operators.content import PLACE, Content, Delete, new_batch_id, partition_of
from branchyard.operators.ledger import NAMESPACE
from branchyard.session import no_rows, rows_frame

if TYPE_CHECKING:
    from branchyard.operators.store import BranchStore


class RefTables:
    """A handle on a ref. It keeps no state: every call looks where the ref points."""

    def __init__(self, store: BranchStore, ref: str):
        self.store = store
        self.ref = ref

    def _at(self, key: str) -> tuple[RefTables, str]:
        """Where a key lies: ``ns.table@ref`` lies at that ref."""
        name, _, ref = key.partition("@")
        return (self.store.at(ref) if ref else self), name

    # ---- reading ------------------------------------------------------------------

    def table(self, key: str, partitions: Sequence | None = None) -> DataFrame:
        """All columns of a table as a lazy DataFrame.

        A key of the form ``ns.table@ref`` reads that ref instead. ``partitions`` names the only
        values of a partitioned table to read: no folder of another is listed.
        """
        name, _, pinned = key.partition("@")
        state = self.store.state(pinned or self.ref)
        return self.store.scan(self.store.content_at(state, name), partitions=partitions)

    def partitions(self, key: str) -> DataFrame:
        """partition, n_batches of a partitioned table, from metadata alone; the value as text."""
        content = self.store.content_at(self.store.state(self.ref), key)
        if content.partition is None:
            raise ValueError(f"{key} is not partitioned")
        name = F.substring_index("_batch", "~", -1)
        value = F.url_decode(F.replace(F.substring(name, 2, 1 << 20), F.lit("!"), F.lit("%")))
        rows = self.store.batch_list(content).groupBy(F.when(name != "n", value).alias("partition"))
        return rows.agg(F.count(F.lit(1)).alias("n_batches"))

    def table_keys(self) -> list[str]:
        state = self.store.state(self.ref)
        return sorted(key for key, content in state["tables"].items() if content != NAMESPACE)

    def list_tables(self) -> DataFrame:
        """ref, table of every table at the ref."""
        rows = [{"ref": self.ref, "table": key} for key in self.table_keys()]
        return rows_frame(self.store.spark, rows, "ref string, table string")

    def create_views(self, current: bool = True) -> list[str]:
        """Session views for SQL: `ns.table@ref`, and `ns.table` if this is the current ref.

        A table whose name is in one namespace only can also be named without it. Views
        that an earlier call made for the ref, or for the ref that was current, go first,
        so SQL finds no table that its ref does not have. They show the tables as they
        are now; call again after a write.
        """
        state, spark = self.store.state(self.ref), self.store.spark
        tables = {key: value for key, value in state["tables"].items() if value != NAMESPACE}
        shorts = Counter(key.partition(".")[2] for key in tables)
        made: dict[str, list[str]] = {self.ref: [], **({"": []} if current else {})}
        for group in made:
            for name in self.store.views.get(group, []):
                spark.catalog.dropTempView(name)
        for key, content_id in tables.items():
            rows = self.store.scan(self.store.content_of(content_id))
            short = key.partition(".")[2]
            for name in [key] + ([short] if shorts[short] == 1 else []):
                for group, view in ((self.ref, f"{name}@{self.ref}"), ("", name)):
                    if group in made:
                        rows.createOrReplaceTempView(f"`{view}`")
                        made[group].append(view)
        self.store.views.update(made)
        return [name for names in made.values() for name in names]

    # ---- defining -----------------------------------------------------------------

    def create_table(
        self, key: str, schema: StructType | str, if_not_exists: bool = True, partitioned_by: str | None = None
    ) -> None:
        """An empty table with declared columns; an existing one is left as it is.

        ``partitioned_by`` is an expression over the columns, such as ``year(day)``. Each write
        then makes one batch for each of its values.
        """
        self, key = self._at(key)
        state = self.store.ref_state(self.ref)
        if key in state["tables"]:
            if not if_not_exists:
                raise AlreadyExists(key)
            return
        if isinstance(schema, str):
            schema = StructType.fromDDL(schema)
        if partitioned_by is not None:
            no_rows(self.store.spark, schema).select(F.expr(partitioned_by).cast("string"))
        content_id = self.store.save_content(self.store.new_table(key, schema, state, partitioned_by))
        self.store.commit(self.ref, f"create table {key}", {key: content_id}, now=state)

    def drop_table(self, key: str) -> None:
        """Gone at this ref only; no file is touched."""
        self, key = self._at(key)
        state = self.store.ref_state(self.ref)
        self.store.content_at(state, key)
        self.store.commit(self.ref, f"drop table {key}", {key: None}, now=state)

    def rename_table(self, key: str, new_key: str) -> None:
        """Move the table to another key at this ref only."""
        self, key = self._at(key)
        new_key, _, ref = new_key.partition("@")
        if ref and ref != self.ref:
            raise ValueError(f"a table of {self.ref} cannot be renamed at {ref}")
        state = self.store.ref_state(self.ref)
        content = self.store.content_at(state, key)
        if new_key in state["tables"]:
            raise AlreadyExists(new_key)
        self.store.new_table(new_key, content.schema, state)
        changes = {key: None, new_key: state["tables"][key]}
        self.store.commit(self.ref, f"rename table {key} to {new_key}", changes, now=state)

    def _change_columns(self, key: str, message: str, change: Callable[[Content], Content]) -> None:
        self, key = self._at(key)
        state = self.store.ref_state(self.ref)
        old = self.store.content_at(state, key)
        content_id = self.store.save_content(change(old), old)
        self.store.commit(self.ref, f"{message} of {key}", {key: content_id}, now=state)

    def drop_column(self, key: str, column: str) -> None:
        """A version that no longer reads the column; files keep it for the other refs."""
        self._change_columns(key, f"drop column {column}", lambda old: old.without_column(column))

    def add_column(self, key: str, column: str, kind: str) -> None:
        """A version with a column more, NULL in the present rows. A dropped column of that name does not come back."""
        self._change_columns(key, f"add column {column}", lambda old: old.with_column(column, _parsed(kind)))

    def rename_column(self, key: str, column: str, new: str) -> None:
        """A version that shows the column under another name; no file is touched."""
        self._change_columns(key, f"rename column {column}", lambda old: old.renamed_column(column, new))

    def widen_column(self, key: str, column: str, kind: str) -> None:
        """A version with a type that holds every value of the old one; present files are read as that type."""
        self._change_columns(key, f"widen column {column}", lambda old: old.widened_column(column, _parsed(kind)))

    # ---- writing ------------------------------------------------------------------

    def append(self, key: str, rows: DataFrame) -> DataFrame:
        """Add the rows of a query, by position. Returns an empty frame, as an insert does.

        Appends commute: if the table moved meanwhile but is still the same table with the
        same columns, the written rows are added to what it has become.
        """
        self, key = self._at(key)
        state = self.store.ref_state(self.ref)
        old = self.store.content_at(state, key)
        self._publish_added(key, state, old, self.store.write_batch(old, rows, new_batch_id()), f"append to {key}")
        return self._no_rows()

    def _publish_added(self, key: str, state: dict, old: Content, batches: list[str], message: str, **more) -> None:
        """Publish written batches; they are added to what the table has become meanwhile."""
        while True:
            content_id = self.store.save_content(old.adding(*batches), old, batches)
            try:
                self.store.commit(self.ref, message, {key: content_id}, base=state, **more)
                return
            except StaleHead:
                before, state = (state, old), self.store.ref_state(self.ref)
                old = self.store.content_at(state, key)
                same = state["ref_lane"] == before[0]["ref_lane"] and old.table_id == before[1].table_id
                if not same or old.columns != before[1].columns:
                    raise
                if more and not self._is_next(state, more["stream"], more["stream_batch"]):
                    return

    def append_values(self, key: str, values: Sequence[tuple]) -> DataFrame:
        """Add a few literal rows, as one file."""
        self, key = self._at(key)
        schema = self.store.content_at(self.store.ref_state(self.ref), key).schema
        return self.append(key, self.store.spark.createDataFrame(list(values), schema).coalesce(1))

    def overwrite(self, key: str, rows: DataFrame) -> DataFrame:
        """Replace the table's rows with those of a query, which may read the table itself."""
        self, key = self._at(key)
        state = self.store.ref_state(self.ref)
        old = self.store.content_at(state, key)
        batches = self.store.write_batch(old, rows, new_batch_id())
        content_id = self.store.save_content(replace(old, deletes=()).holding(*batches))
        self.store.commit(self.ref, f"overwrite {key}", {key: content_id}, base=state)
        return self._no_rows()

    def overwrite_partitions(self, key: str, rows: DataFrame) -> DataFrame:
        """Replace the partitions that the rows of a query lie in; the batches of all others stay."""
        self, key = self._at(key)
        state = self.store.ref_state(self.ref)
        old = self.store.content_at(state, key)
        if old.partition is None:
            raise ValueError(f"{key} is not partitioned")
        batches = self.store.write_batch(old, rows, new_batch_id())
        replaced = {partition_of(batch) for batch in batches}
        if old.batches is not None:
            kept = old.holding(*[batch for batch in old.batches if partition_of(batch) not in replaced])
            content_id = self.store.save_content(kept.adding(*batches))
        else:
            kept = self.store.batch_list(old).where(~F.substring_index("_batch", "~", -1).isin(sorted(replaced)))
            kept = self.store.save_listed(old, kept)
            content_id = self.store.save_content(kept.adding(*batches), kept, batches)
        self.store.commit(self.ref, f"overwrite partitions of {key}", {key: content_id}, base=state)
        return self._no_rows()

    # ---- deleting and changing rows ---------------------------------------------------

    def delete(self, key: str, condition: Column | str, by: Sequence[str] | None = None) -> DataFrame:
        """Remove the rows for which the condition is true. No batch is rewritten.

        What is written is one row for each row that goes: all its columns, or those of ``by``, which
        have to tell these rows from the others of their batch, and its place in the files.
        """
        self, key = self._at(key)
        condition = F.expr(condition) if isinstance(condition, str) else condition
        return self._change_rows(key, f"delete from {key}", lambda rows: rows.where(condition), by, condition)

    def delete_keys(self, key: str, keys: DataFrame) -> DataFrame:
        """Remove the rows that have the values of a row of ``keys`` in its columns; NULL is a value."""
        self, key = self._at(key)
        return self._change_rows(key, f"delete keys from {key}", lambda rows: _with_keys(rows, keys), keys.columns)

    def update(
        self, key: str, condition: Column | str, values: dict[str, Column | str], by: Sequence[str] | None = None
    ) -> DataFrame:
        """Set columns in the rows for which the condition is true, to expressions over the old row.

        The old rows go as in ``delete``, the new ones are a batch of their own, in one commit.
        """
        self, key = self._at(key)
        condition = F.expr(condition) if isinstance(condition, str) else condition
        set_to = {name.lower(): F.expr(v) if isinstance(v, str) else v for name, v in values.items()}

        def changed(rows: DataFrame) -> DataFrame:
            unknown = set_to.keys() - {name.lower() for name in rows.columns}
            if unknown:
                raise ValueError(f"no columns {sorted(unknown)}")
            names = [name for name in rows.columns if name != "_batch"]
            return rows.where(condition).select([set_to.get(name.lower(), F.col(quoted(name))).alias(name) for name in names])

        return self._change_rows(key, f"update {key}", lambda rows: rows.where(condition), by, condition, changed)

    def upsert(self, key: str, rows: DataFrame, by: Sequence[str]) -> DataFrame:
        """Put rows, by position, in the place of those with the same values of ``by``."""
        self, key = self._at(key)
        new = rows.toDF(*self.store.content_at(self.store.ref_state(self.ref), key).schema.names)
        keys = new.select([F.col(quoted(name)) for name in by])
        return self._change_rows(key, f"upsert into {key}", lambda old: _with_keys(old, keys), by, None, lambda _: new)

    def _change_rows(
        self,
        key: str,
        message: str,
        gone: Callable[[DataFrame], DataFrame],
        by: Sequence[str] | None,
        condition: Column | None = None,
        added: Callable[[DataFrame], DataFrame] | None = None,
    ) -> DataFrame:
        """Commit that the rows of ``gone`` go and those of ``added`` come; both are of the rows with their batch."""
        state = self.store.ref_state(self.ref)
        old = self.store.content_at(state, key)
        rows = self.store.scan(old, with_batch=True)
        names = [name for name in old.schema.names if by is None or name.lower() in {b.lower() for b in by}]
        if by is not None and len(names) != len(by):
            raise ValueError(f"{key} has no columns {sorted(set(by) - set(names))}")
        keys = ["_batch", *[F.col(quoted(name)) for name in names]]
        if by is not None and condition is not None:
            others = rows.where(~F.coalesce(condition, F.lit(False)))
            if not _with_keys(others, gone(rows).select(*keys).distinct()).isEmpty():
                raise ValueError(f"{list(by)} do not tell the rows from others of {key}")
        placed = gone(self.store.scan(old, with_batch=True, with_place=True))
        delete = self._written_delete(old, placed.select(*keys, F.col(quoted(PLACE))), names)
        batches = self.store.write_batch(old, added(rows), new_batch_id()) if added else []
        if delete is None and not batches:
            return self._no_rows()
        new = (old if delete is None else old.deleting(delete)).adding(*batches)
        self.store.commit(self.ref, message, {key: self.store.save_content(new, old, batches)}, base=state)
        return self._no_rows()

    def _written_delete(self, old: Content, keys: DataFrame, names: Sequence[str]) -> Delete | None:
        """A delete of the rows with these batches and keys; None if there are none. If the rows show their places, these are marked."""
        kinds = {name: (file, kind) for name, kind, file in old.columns}
        columns, marked = tuple(kinds[name] for name in names), PLACE in keys.columns
        delete, limit = Delete.new_id(marked), self.store.path_limit
        path = self.store.delete_path(old.table_id, delete)
        keys.toDF("_batch", *[file for file, _ in columns], *[PLACE] * marked).write.parquet(path)
        if marked:
            path = self.store.write_marks(old.table_id, delete)
        named = self.store.spark.read.schema("_batch string").parquet(path).distinct().limit(limit + 1).collect()
        batches = tuple(sorted(row["_batch"] for row in named))
        return Delete(delete, columns, batches if len(batches) <= limit else None) if batches else None

    # ---- streams ---------------------------------------------------------------------

    def append_stream_batch(self, key: str, rows: DataFrame, stream: str, number: int) -> bool:
        """Add one micro-batch once: a replay of a published number changes nothing.

        A replay of an unpublished one overwrites what the first try left. A stream
        belongs to the table, not to its name: a renamed table goes on with it, and a
        new table of an old name starts anew. As with ``append``, other appends may come between.
        """
        state = self.store.ref_state(self.ref)
        old = self.store.content_at(state, key)
        name = f"{old.table_id} {stream}"
        if not self._is_next(state, name, number):
            return False
        batch = f"s{state['ref_lane']}-{stream}-{number}"
        if old.partition is not None:
            batch = f"{batch}-{uuid.uuid4().hex}"  # a try of its own, as its folders are many
        batches = self.store.write_batch(old, rows, batch, mode="overwrite")
        self._publish_added(key, state, old, batches, f"stream {stream} to {key}", stream=name, stream_batch=number)
        return True

    def _is_next(self, state: dict, name: str, number: int) -> bool:
        """Whether no micro-batch of that number was published; only moves not looked at before are read."""
        seen, last = self.store.stream_numbers.get((state["ref_lane"], name), (-1, None))
        if state["seq"] > seen:
            moves = self.store.moves(self.ref).filter((F.col("ref_lane") == state["ref_lane"]) & (F.col("seq") > seen))
            newest = moves.filter(F.col("stream") == name).agg(F.max("stream_batch")).first()[0]
            last = max((n for n in (last, newest) if n is not None), default=None)
            self.store.stream_numbers[state["ref_lane"], name] = (state["seq"], last)
        return last is None or number > last

    def _no_rows(self) -> DataFrame:
        return self.store.spark.range(0).drop("id")


def _parsed(kind: str) -> DataType:
    return StructType.fromDDL(f"c {kind}").fields[0].dataType


def _with_keys(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows that have the values of a row of ``keys`` in its columns."""
    same = [F.col(f"l.{quoted(name)}").eqNullSafe(F.col(f"w.{quoted(name)}")) for name in keys.columns]
    return rows.alias("l").join(keys.alias("w"), reduce(and_, same), "left_semi")
