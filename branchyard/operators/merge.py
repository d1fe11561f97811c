"""Merging: whole tables between refs, and rows of one table by key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce
from operator import and_
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from branchyard.errors import MergeConflict, StaleHead
from branchyard.functions.expressions import quoted, same_row
from branchyard.operators import ledger as lg
from branchyard.operators.content import new_batch_id, require_names, type_of, widens

if TYPE_CHECKING:
    from branchyard.operators.content import Content
    from branchyard.operators.store import BranchStore

# ---- tables --------------------------------------------------------------------


def merge_base(store: BranchStore, a: dict, b: dict) -> dict:
    """The last commit that both states include."""
    if lg.includes(a, b):
        return b
    if lg.includes(b, a):
        return a
    return store.commit_of_lane(*lg.last_common(a, b))


def three_way_tables(base: dict, source: dict, target: dict) -> tuple[dict, list[str]]:
    """Changes to apply to the target, and the keys both sides changed differently."""
    changes, conflicts = {}, []
    for key in sorted({*base["tables"], *source["tables"], *target["tables"]}):
        old, theirs, ours = (side["tables"].get(key) for side in (base, source, target))
        if theirs == old or theirs == ours:
            continue
        if ours == old:
            changes[key] = theirs
        else:
            conflicts.append(key)
    return changes, conflicts


def merge_ref(
    store: BranchStore, source_ref: str, target_ref: str, message: str | None, by_key: dict[str, Sequence[str]]
) -> str:
    """Bring the target to the source's state, table by table.

    If the target did not move since the refs parted, it now points at the
    source's commit. Otherwise one commit with both parents takes each table from
    the side that changed it. A table changed on both sides stops the merge,
    unless its key is given and no row was changed on both sides.
    """
    plan = planned_merge(store, source_ref, target_ref, message, by_key)
    return publish_merge(store, plan)


def planned_merge(
    store: BranchStore, source_ref: str, target_ref: str, message: str | None, by_key: dict[str, Sequence[str]]
) -> dict:
    """The merge's commit, written but not published: its hash can be read and checked first."""
    source, target = store.ref_state(source_ref), store.ref_state(target_ref)
    plan = {"source": source, "target": target, "hash": target["hash"], "action": None}
    if lg.includes(target, source):
        return plan
    if lg.includes(source, target):
        return {**plan, "hash": source["hash"], "action": "forwarded"}
    base = merge_base(store, source, target)
    changes, conflicts = three_way_tables(base, source, target)
    by_row = []
    for key in [key for key in conflicts if _on_all_sides(key, base, source, target)]:
        merged = merge_versions(store, key, base, source, target)
        if merged is not None:
            changes[key] = merged
        elif key in by_key:
            by_row.append(key)
    left = [key for key in conflicts if key not in by_row and key not in changes]
    if left:
        raise MergeConflict(f"changed on {source_ref} and on {target_ref}: {left}", left)
    for key in by_row:
        changes[key] = merge_rows(store, key, by_key[key], base, source, target)
    tables = {key: value for key, value in {**target["tables"], **changes}.items() if value is not None}
    text = message or f"merge {source_ref} into {target_ref}"
    commit = lg.new_commit([target, source], target["ref_lane"], target["seq"] + 1, text, tables)
    store.save_commit(commit)
    return {**plan, "hash": commit["hash"], "action": "merged"}


def publish_merge(store: BranchStore, plan: dict) -> str:
    """Point the target at the planned commit; ``StaleHead`` if a side moved since it was planned."""
    source, target = plan["source"], plan["target"]
    for side in (source, target):
        if store.ref_state(side["ref"])["hash"] != side["hash"]:
            raise StaleHead(f"{side['ref']} moved while {source['ref']} was merged into {target['ref']}")
    if plan["action"]:
        # the move takes the number after the target's planned one, which only one writer can get
        store._add_move(lg.next_move(target["ref"], target, plan["action"], plan["hash"]))
    return plan["hash"]


def _on_all_sides(key: str, *states: dict) -> bool:
    contents = [state["tables"].get(key) for state in states]
    return all(content is not None and content != lg.NAMESPACE for content in contents)


def merged_columns(key: str, base: Content, source: Content, target: Content) -> tuple:
    """The columns of the target with what the source changed since the base.

    A column is the same on all sides by its name in the files. Dropped on one side it goes; a
    name or type is that of the side that changed it, of two wider types the widest. A column that
    one side dropped and the other changed, a name changed twice, or two columns of one name are conflicts.
    """
    old, theirs, ours = ({file: (name, kind) for name, kind, file in side.columns} for side in (base, source, target))

    def conflict(file: str):
        name = (ours.get(file) or theirs.get(file))[0]
        return MergeConflict(f"column {name} of {key} was changed on both sides", [key])

    def one(file: str, was, a, b, wider: bool = False):
        if a == b or b == was:
            return a
        if a == was or wider and widens(type_of(a), type_of(b)):
            return b
        if wider and widens(type_of(b), type_of(a)):
            return a
        raise conflict(file)

    out = []
    for file in [*ours, *(file for file in theirs if file not in ours)]:
        if file in ours and file in theirs:
            was = old.get(file, (None, None))
            names, kinds = ((was[k], ours[file][k], theirs[file][k]) for k in (0, 1))
            out.append((one(file, *names), one(file, *kinds, wider=True), file))
        elif file not in old:
            out.append((*(ours.get(file) or theirs[file]), file))
        elif (ours.get(file) or theirs[file]) != old[file]:
            raise conflict(file)
    try:
        return require_names(tuple(out))
    except ValueError as clash:
        raise MergeConflict(f"columns of {key}: {clash}", [key]) from None


def merge_versions(store: BranchStore, key: str, base: dict, source: dict, target: dict) -> str | None:
    """A version with the rows of the side that changed them and the columns of both; None if both changed rows."""
    old, theirs, ours = (store.content_at(side, key) for side in (base, source, target))
    if len({(c.table_id, c.partition) for c in (old, theirs, ours)}) > 1:
        return None
    rows = [(c.digest, c.n_batches, frozenset(d.id for d in c.deletes)) for c in (old, theirs, ours)]
    if rows[1] == rows[0] or rows[1] == rows[2]:
        held = ours
    elif rows[2] == rows[0]:
        held = theirs
    else:
        return None
    return store.save_content(replace(held, columns=merged_columns(key, old, theirs, ours)), held)


def conflicting_tables(store: BranchStore, source_ref: str, target_ref: str) -> DataFrame:
    """table, rows_base, rows_source, rows_target of the tables that stop a merge.

    A side without the table (dropped, or not there yet) has NULL rows.
    """
    from branchyard.operators.audit import count_tables

    source, target = store.state(source_ref), store.state(target_ref)
    base = merge_base(store, source, target)
    _, conflicts = three_way_tables(base, source, target)
    sides = {"base": base, "source": source, "target": target}
    states = [{**state, "side": name} for name, state in sides.items()]
    counts = count_tables(store, states, ["side"], keys=conflicts)
    wide = counts.groupBy("table").pivot("side", list(sides)).agg(F.first("n_rows"))
    return wide.select("table", *[F.col(name).alias(f"rows_{name}") for name in sides])


# ---- rows ----------------------------------------------------------------------

SIDES = ("base", "ours", "theirs")


def three_way_rows(base: DataFrame, ours: DataFrame, theirs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the rows of the three sides and what to do.

    The sides are stacked and grouped by key once, so each row is shuffled once;
    a join of the three would shuffle the joined rows again. As a key has at most
    one row per side, there is nothing to combine before the shuffle: the explicit
    repartition spares the sort that a partial aggregate of rows would need.
    ``verdict`` is ``same``, ``ours``, ``theirs`` or ``conflict``. Equal changes on
    both sides are no conflict. A key that a side holds twice is an error.
    """
    taken = {*SIDES, "verdict", "_side", "_row", "_copies"}.intersection(keys)
    if taken:
        raise ValueError(f"key columns cannot be named {sorted(taken)}")
    rest = [F.col(quoted(name)) for name in ours.columns if name not in keys]
    # without other columns a row is only there or not
    row = F.struct(*rest) if rest else F.struct(F.lit(True).alias("present"))
    key_columns = [F.col(quoted(k)) for k in keys]
    frames = {"base": base, "ours": ours, "theirs": theirs}
    stacked = None
    for name, frame in frames.items():
        part = frame.select(*key_columns, F.lit(name).alias("_side"), row.alias("_row"))
        stacked = part if stacked is None else stacked.unionByName(part)

    def of(side: str) -> Column:
        return F.when(F.col("_side") == side, F.col("_row"))

    grouped = stacked.repartition(*key_columns).groupBy(*key_columns).agg(
        *[F.any_value(of(side), F.lit(True)).alias(side) for side in SIDES],
        F.greatest(*[F.count(of(side)) for side in SIDES]).alias("_copies"),
    )
    old, a, b = (F.col(side) for side in SIDES)
    verdict = (
        F.when(F.col("_copies") > 1, F.raise_error(F.lit(f"rows are not unique by {list(keys)}")))
        .when(same_row(a, b), F.when(same_row(a, old), "same").otherwise("ours"))
        .when(same_row(b, old), "ours")
        .when(same_row(a, old), "theirs")
        .otherwise("conflict")
    )
    return grouped.withColumn("verdict", verdict).drop("_copies")


def require_unique(frames: Sequence[DataFrame], keys: Sequence[str]) -> None:
    """Raise if a side holds a key twice, before any whole row is shuffled.

    Only the key columns are read, and copies are combined before the shuffle, so
    a key with very many rows costs no more than others.
    """
    key_columns = [F.col(quoted(k)) for k in keys]
    stacked = None
    for number, frame in enumerate(frames):
        part = frame.select(*key_columns, F.lit(number).alias("_side"))
        stacked = part if stacked is None else stacked.union(part)
    twice = stacked.groupBy("_side", *key_columns).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    if twice.limit(1).count():
        raise ValueError(f"rows are not unique by {list(keys)}")


def resolved_rows(compared: DataFrame, names: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """The rows of the merged table, without the keys in conflict."""
    kept = compared.filter(F.col("verdict") != "conflict")
    row = F.when(F.col("verdict") == "theirs", F.col("theirs")).otherwise(F.col("ours"))
    rows = kept.withColumn("_row", row).filter(F.col("_row").isNotNull())
    return rows.select(
        [F.col(quoted(n)) if n in keys else F.col("_row").getField(n).alias(n) for n in names]
    )


def conflicting_rows(compared: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, base, ours, theirs of the rows that both sides changed differently.

    A side without the row has NULL there.
    """
    rows = compared.filter(F.col("verdict") == "conflict")
    return rows.select([F.col(quoted(k)) for k in keys] + [F.col(side) for side in SIDES])


def compare_by_key(
    store: BranchStore, key: str, keys: Sequence[str], source_ref: str, target_ref: str
) -> DataFrame:
    """Three-way comparison of a table between two refs; ours is the target.

    Rows in batches that all three versions share did not change and are left out.
    """
    source, target = store.state(source_ref), store.state(target_ref)
    return _compare(store, key, keys, merge_base(store, source, target), source, target)[0]


def _shared(store: BranchStore, contents: Sequence[Content]) -> Content:
    """A version with the batches that all sides hold with the same rows deleted: their rows did not change.

    Lists that are too long to hold here are intersected in Spark; the outcome is the same.
    """
    first, *others = contents
    if len({c.table_id for c in contents}) > 1:
        return first.holding()
    if all(c.batches is not None for c in contents):
        common = set(first.batches).intersection(*[c.batches for c in others])
        common = {b for b in common if len({c.deletes_of(b) for c in contents}) == 1}
        return first.holding(*[batch for batch in first.batches if batch in common])
    everywhere = set(first.deletes).intersection(*[c.deletes for c in others])
    other = {d for c in contents for d in c.deletes} - everywhere
    if any(d.batches is None for d in other):
        return first.holding()
    first = replace(first, deletes=tuple(d for d in first.deletes if d in everywhere))
    lists = store.batch_list(contents[0]).where(~F.col("_batch").isin(sorted({b for d in other for b in d.batches})))
    for other in others:
        lists = lists.join(store.batch_list(other), "_batch", "left_semi")
    return store.save_listed(first, lists)


def require_apart(own: Sequence[DataFrame], shared: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a row of a side has the key of a row in the batches that all sides share.

    Only key columns are read; each side's keys are made distinct before they are shuffled.
    """
    key_columns = [F.col(quoted(k)) for k in keys]
    stacked = None
    for frame in own:
        part = frame.select(*key_columns)
        stacked = part if stacked is None else stacked.union(part)
    left = stacked.distinct().toDF(*[f"_k{n}" for n in range(len(keys))])
    right = shared.select(*key_columns).toDF(*[f"_s{n}" for n in range(len(keys))])
    same = reduce(and_, [F.col(f"_k{n}").eqNullSafe(F.col(f"_s{n}")) for n in range(len(keys))])
    if left.join(right, same, "left_semi").limit(1).count():
        raise ValueError(f"rows are not unique by {list(keys)}")


def _compare(store, key, keys, base, source, target) -> tuple[DataFrame, Content]:
    """The compared rows, and a version with the batches that need no comparison."""
    sides = [store.content_at(state, key) for state in (base, target, source)]
    if len({(side.table_id, side.partition) for side in sides}) == 1:
        columns = merged_columns(key, sides[0], sides[2], sides[1])
        sides = [replace(side, columns=columns) for side in sides]
    elif len({side.columns for side in sides}) > 1:
        raise MergeConflict(f"{key} has different columns on the sides", [key])
    ours = sides[1]
    missing = [name for name in keys if name not in ours.schema.names]
    if missing or not keys:
        raise ValueError(f"{key} cannot be merged by key {list(keys)}")
    kept = _shared(store, [ours, sides[0], sides[2]])
    frames = [store.scan(side, without=kept) for side in sides]
    require_unique(frames, keys)
    if kept.n_batches:
        require_apart(frames, store.scan(kept), keys)
    return three_way_rows(*frames, keys), kept


def merge_rows(
    store: BranchStore, key: str, keys: Sequence[str], base: dict, source: dict, target: dict
) -> str:
    """A version of one table with the row changes of both sides; its content id.

    Batches that all sides share stay as they are; the other rows are written as
    one new batch. Conflicts are counted by the same job that writes, so the rows
    are compared once; if there is one, no version is made and the files of the
    batch are left for the cleanup.
    """
    compared, kept = _compare(store, key, keys, base, source, target)
    seen = Observation("rows of the merge")
    counted = compared.observe(seen, F.count_if(F.col("verdict") == "conflict").alias("conflicts"))
    batch = new_batch_id()
    batches = store.write_batch(kept, resolved_rows(counted, kept.schema.names, keys), batch)
    conflicts = seen.get["conflicts"]
    if conflicts:
        raise MergeConflict(f"{conflicts} rows of {key} changed on both sides", [key])
    return store.save_content(kept.adding(*batches), kept, batches)
