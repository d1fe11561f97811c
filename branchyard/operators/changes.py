"""What a commit did to the rows of a table: undoing it, doing it again elsewhere, and the history of keys.

A change is a signed bag of rows: each distinct row with how many copies of it came (+n) or went (-n).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from branchyard.errors import MergeConflict, UnknownTable
from branchyard.functions.expressions import quoted
from branchyard.operators import ledger as lg
from branchyard.operators.content import PLACE, Content, Delete, new_batch_id
from branchyard.session import no_rows, work_folder

if TYPE_CHECKING:
    from branchyard.operators.store import BranchStore
    from branchyard.operators.tables import RefTables

# ---- one commit ---------------------------------------------------------------------


def _versions(store: BranchStore, key: str, commit: str) -> tuple[Content | None, Content | None]:
    """The table before and after a commit; before is that of its first parent."""
    after = store.state(commit)
    states = [store.state(after["parent"]) if after["parent"] else None, after]
    ids = [state["tables"].get(key) if state else None for state in states]
    old, new = (None if i is None or i == lg.NAMESPACE else store.content_of(i) for i in ids)
    if old is None and new is None:
        raise UnknownTable(f"{key} at {commit} and before")
    return old, new


def row_changes(store: BranchStore, key: str, commit: str) -> DataFrame:
    """The columns by number (c0, c1 ..) and net, of the rows whose number the commit changed.

    Batches that stayed as they were cancel out and are not read; copies are combined before the shuffle.
    """
    old, new = _versions(store, key, commit)
    if old is not None and new is not None and old.columns != new.columns:
        raise ValueError(f"{commit} changed the columns of {key}")
    sides = [(old, new, -1), (new, old, 1)]
    frames = [
        store.scan(side, without=other).toDF(*_numbers(side)).withColumn("net", F.lit(sign).cast("bigint"))
        for side, other, sign in sides
        if side is not None
    ]
    rows = reduce(DataFrame.union, frames)
    return rows.groupBy(*_numbers(old or new)).agg(F.sum("net").alias("net")).where("net <> 0")


def _numbers(content: Content) -> list[str]:
    return [f"c{n}" for n in range(len(content.columns))]


def _same(left: str, right: str, names: Sequence[str]) -> Column:
    return reduce(and_, [F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}")) for name in names])


def _compared(store: BranchStore, now: Content, changes: DataFrame, names: Sequence[str]) -> DataFrame:
    """The changes with ``have``, how many copies of a row that goes there are now; written once, as it is read thrice.

    Of the table only rows that are to go are counted.
    """
    less = changes.where("net < 0")
    rows = store.scan(now).toDF(*names).alias("r").join(less.alias("c"), _same("r", "c", names), "left_semi")
    have = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("have"))
    out = changes.alias("c").join(have.alias("h"), (F.col("c.net") < 0) & _same("c", "h", names), "left")
    folder = work_folder(store.spark, "changes")
    out.select("c.*", F.coalesce("have", F.lit(0)).alias("have")).write.parquet(folder)
    return store.spark.read.parquet(folder)


def change_conflicts(tables: RefTables, key: str, commit: str, undo: bool) -> DataFrame:
    """The table's columns, n_missing: rows that would have to go and that the ref does not have, or not so often."""
    store, now, changes = _planned(tables, key, commit, undo)
    names = _numbers(now)
    missing = _compared(store, now, changes, names).where("net < 0 AND have + net < 0")
    shown = [F.col(n).alias(name) for n, name in zip(names, now.schema.names)]
    return missing.select(*shown, (-F.col("net") - F.col("have")).alias("n_missing"))


def _planned(tables: RefTables, key: str, commit: str, undo: bool) -> tuple[BranchStore, Content, DataFrame]:
    store = tables.store
    now = store.content_at(store.ref_state(tables.ref), key)
    old, new = _versions(store, key, commit)
    if (new or old).columns != now.columns:
        raise ValueError(f"{key} has other columns at {tables.ref} than at {commit}")
    changes = row_changes(store, key, commit)
    return store, now, changes.withColumn("net", -F.col("net")) if undo else changes


def copies(rows: DataFrame, n: str) -> DataFrame:
    """Each row as often as its column ``n`` says, without an array of that length."""
    block = 10_000
    some = rows.where(F.col(n) > 0).withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(n) - 1) / block))))
    here = F.least(F.lit(block), F.col(n) - F.col("_block") * block).cast("int")
    return some.withColumn("_copy", F.explode(F.array_repeat(F.lit(True), here))).drop("_block", "_copy", n)


def _by_place(store: BranchStore, key: str, commit: str, undo: bool, now: Content) -> tuple[DataFrame, DataFrame] | None:
    """The rows of ``now`` that go, with batch and place, and those that come, where each row that goes is still where the commit put or found it.

    None where rows have to be looked for by their values: they may be elsewhere, or not at all.
    """
    old, new = _versions(store, key, commit)
    theirs, others = (new, old) if undo else (old, new)
    three = [theirs, others, now]
    if any(c is None or c.batches is None or c.table_id != now.table_id for c in three) or not all(d.marked for c in three for d in c.deletes):
        return None
    held = {b: others.deletes_of(b) for b in others.batches}
    apart = [b for b in theirs.batches if held.get(b, {""}) and held.get(b) != theirs.deletes_of(b)]
    if not set(apart).issubset(now.batches):
        return None
    going = store.scan(theirs, without=others, with_batch=True, with_place=True)
    later = [d for d in now.deletes if d not in theirs.deletes and any(map(d.touches, apart))]
    if later and not store.marked_rows(now, later, going).isEmpty():
        return None
    return going, store.scan(others, without=theirs)


def _apply(tables: RefTables, key: str, commit: str, undo: bool, message: str) -> str:
    store = tables.store
    state = store.ref_state(tables.ref)
    _, now, changes = _planned(tables, key, commit, undo)
    names = _numbers(now)
    by_place = _by_place(store, key, commit, undo, now)
    if by_place is not None:
        going, coming = by_place[0].toDF(*names, "_batch", PLACE), by_place[1]
    else:
        compared = _compared(store, now, changes, names)
        missing = compared.where("net < 0 AND have + net < 0").count()
        if missing:
            raise MergeConflict(f"{missing} rows that {message} takes away are not in {key} at {tables.ref}", [key])
        rows = store.scan(now, with_batch=True, with_place=True).toDF(*names, "_batch", PLACE)
        going = rows.alias("r").join(compared.where("net < 0").alias("c"), _same("r", "c", names), "left_semi")
        coming = copies(compared.select(*names, (F.col("have") + F.col("net")).alias("left")), "left")
    delete = tables._written_delete(now, going.select("_batch", *names, F.col(quoted(PLACE))), now.schema.names)
    batches = [] if coming.isEmpty() else store.write_batch(now, coming, new_batch_id())
    if delete is None and not batches:
        return state["hash"]
    new = (now if delete is None else now.deleting(delete)).adding(*batches)
    return store.commit(tables.ref, message, {key: store.save_content(new, now, batches)}, base=state)


def revert_rows(tables: RefTables, key: str, commit: str) -> str:
    """Undo what a commit did to a table's rows, whatever came after it; the new commit's hash.

    A row that the commit added has to be there as often as it was added, or ``MergeConflict`` is
    raised and nothing published. Only batches that hold rows that go are named in the new version's
    deletes; none is rewritten. Rows that are still where the commit put them are taken away there;
    only if some are not, rows are compared by their values.
    """
    return _apply(tables, key, commit, True, f"revert {key} of {commit[:12]}")


def pick_rows(tables: RefTables, key: str, commit: str) -> str:
    """Do to a table's rows at this ref what a commit, of any ref, did; as ``revert_rows`` otherwise."""
    return _apply(tables, key, commit, False, f"pick {key} of {commit[:12]}")


# ---- history ------------------------------------------------------------------------


def first_parents(store: BranchStore, ref: str) -> DataFrame:
    """The commits that led to where the ref is, each the first parent of the next.

    Commits of a lane follow each other, so the chain is one stretch of each lane it passes: one small
    lookup per lane, not per commit.
    """
    state, stretches = store.state(ref), []
    lane, pos = state["lane"], state["pos"]
    while lane is not None:
        stretches.append((F.col("lane") == lane) & (F.col("pos") <= pos))
        parent = store.commits().where(F.col("lane") == lane).agg(F.min_by("parent", "pos")).first()[0]
        before = store.commits_of([parent])[parent] if parent else {"lane": None, "pos": None}
        lane, pos = before["lane"], before["pos"]
    return store.commits().where(reduce(or_, stretches))


def _membership(store: BranchStore, key: str, ref: str, table_id: str) -> DataFrame:
    """depth, _batch, without, sign: the batches that came to the table or left it with a commit.

    ``without`` names the deletes that hold for the batch; with another list it counts as another batch.
    """
    chain = first_parents(store, ref).select("hash", "parent", "depth", F.col("tables").getItem(key).alias("content_id"))
    was = chain.select(F.col("hash").alias("parent"), F.col("content_id").alias("old_id"))
    steps = chain.join(was, "parent", "left").where("NOT content_id <=> old_id")
    touching = lambda b: F.filter("deletes", lambda d: d["batches"].isNull() | F.array_contains(d["batches"], b))
    units = F.transform("batches", lambda b: F.struct(b.alias("_batch"), F.array_sort(F.transform(touching(b), lambda d: d["id"])).alias("without")))
    held = store.all_contents().where(F.col("table_id") == table_id).select("content_id", units.alias("units"))
    both = steps.join(held, "content_id", "left").withColumnRenamed("units", "new")
    both = both.join(held.select(F.col("content_id").alias("old_id"), F.col("units").alias("old")), "old_id", "left")
    none = F.slice(F.coalesce("new", "old"), 1, 0)
    new, old = F.coalesce("new", none), F.coalesce("old", none)
    came = both.select("depth", F.inline(F.array_except(new, old))).withColumn("sign", F.lit(1))
    return came.union(both.select("depth", F.inline(F.array_except(old, new))).withColumn("sign", F.lit(-1)))


def row_history(store: BranchStore, key: str, ref: str, keys: Sequence[str]) -> DataFrame:
    """The table's columns, valid_from, valid_to: each row with the depths of the commits that brought and ended it.

    Columns are those the ref has now. ``valid_to`` is NULL for a row that is still there. Each batch
    is read once, however many commits hold it; the signed rows of a commit are netted, so a row that
    was only rewritten goes on. A key may not stand twice in a state. Of a table that was dropped
    and made anew only the present one counts.
    """
    now = store.content_at(store.state(ref), key)
    missing = [name for name in keys if name not in now.schema.names]
    if missing or not keys:
        raise ValueError(f"{key} has no key {list(keys)}")
    member = _membership(store, key, ref, now.table_id)
    rows = _with_deletes(store, now, member)
    signed = rows.join(member, "_batch").where("NOT arrays_overlap(without, gone)")
    numbers = _numbers(now)
    net = signed.groupBy(*numbers, "depth").agg(F.sum("sign").alias("net")).where("net <> 0")
    by = [F.col(numbers[now.schema.names.index(name)]) for name in keys]
    ordered = Window.partitionBy(*by).orderBy("depth", "net")
    there = F.sum("net").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    twice = F.when(there > 1, F.raise_error(F.lit(f"rows are not unique by {list(keys)}"))).otherwise(F.lead("depth").over(ordered))
    spans = net.withColumn("valid_to", twice).where("net > 0")
    shown = [F.col(n).alias(name) for n, name in zip(numbers, now.schema.names)]
    return spans.select(*shown, F.col("depth").alias("valid_from"), "valid_to")


def _with_deletes(store: BranchStore, now: Content, member: DataFrame) -> DataFrame:
    """_batch, the columns by number, gone: every row of the batches, and the deletes that name it."""
    limit = store.path_limit
    named = member.select("_batch").distinct()
    few = [row["_batch"] for row in named.limit(limit + 1).collect()]
    wide = now
    deletes = {}
    for row in store.all_contents().where((F.col("table_id") == now.table_id) & (F.size("deletes") > 0)).select(F.explode("deletes").alias("d")).distinct().collect():
        found = row["d"]
        deletes[found["id"]] = Delete(found["id"], tuple((k["file"], k["type"]) for k in found["keys"]), None)
        wide = wide.deleting(deletes[found["id"]])
    if not few:
        return no_rows(store.spark, now.schema).toDF(*_numbers(now)).select("*", F.lit("").alias("_batch"), F.array().cast("array<string>").alias("gone"))
    if len(few) <= limit:
        rows = store._read(wide, few, True)
    else:
        schema = store._read_schema(wide).add("_batch", "string")
        rows = store.spark.read.schema(schema).parquet(f"{store.root}/data/table={now.table_id}").join(named, "_batch", "left_semi")
    by_keys: dict[tuple, list[Delete]] = {}
    for delete in deletes.values():
        by_keys.setdefault(tuple(file for file, _ in delete.keys), []).append(delete)
    marks = []
    for number, (files, group) in enumerate(by_keys.items()):
        named_keys = store.deleted_keys(now, group, with_id=True)
        keys = [f"k{n}" for n in range(len(files))]
        marked = named_keys.groupBy("_batch", *keys).agg(F.collect_set("_delete").alias("ids"))
        same = [F.col(f"r.{quoted(file)}").eqNullSafe(F.col(f"g.{k}")) for file, k in zip(files, keys)]
        mark = f"_gone{number}~"
        joined = rows.alias("r").join(marked.alias("g"), reduce(and_, [F.col("r._batch") == F.col("g._batch"), *same]), "left")
        rows = joined.select("r.*", F.col("g.ids").alias(mark))
        marks.append(F.coalesce(F.col(quoted(mark)), F.array().cast("array<string>")))
    gone = F.concat(*marks) if marks else F.array().cast("array<string>")
    shown = [F.col(quoted(file)).alias(n) for (_, _, file), n in zip(now.columns, _numbers(now))]
    return rows.select("_batch", *shown, gone.alias("gone"))
