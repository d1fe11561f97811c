"""The checks between a write and its publication.

Counts are always taken from the rows, never from stored numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from branchyard.errors import AuditFailed
from branchyard.functions.expressions import counted_once, matches_fully, member_of, quoted
from branchyard.operators import ledger as lg
from branchyard.operators.content import Content, type_of, widens
from branchyard.operators.merge import planned_merge, publish_merge
from branchyard.operators.profiles import DriftLimits, drifted
from branchyard.session import rows_frame

if TYPE_CHECKING:
    from branchyard.operators.store import BranchStore

# ---- counts --------------------------------------------------------------------


def rows_per_batch(files: DataFrame) -> DataFrame:
    """table_id, _batch, n_rows from the file footers alone."""
    groups = files.groupBy(F.col("table").alias("table_id"), "_batch")
    return groups.agg(F.count(F.lit(1)).alias("n_rows"))


def batch_counts(store: BranchStore, batches: DataFrame) -> DataFrame:
    """table_id, _batch, n_rows of distinct batches, each read once.

    A few batches are named to the reader; a longer list stays in Spark.
    """
    few = batches.limit(store.path_limit + 1).collect()
    if len(few) <= store.path_limit:
        return named_batch_counts(store, [(b["table_id"], b["_batch"]) for b in few])
    wanted = batches.select(F.col("table_id").alias("table"), "_batch")
    if wanted.limit(store.broadcast_limit + 1).count() <= store.broadcast_limit:
        wanted = F.broadcast(wanted)
    return rows_per_batch(store.stored_rows().join(wanted, ["table", "_batch"], "left_semi"))


def named_batch_counts(store: BranchStore, batches: Sequence[tuple[str, str]]) -> DataFrame:
    if not batches:
        return rows_frame(store.spark, [], "table_id string, _batch string, n_rows bigint")
    paths = [store.batch_path(table_id, batch) for table_id, batch in sorted(batches)]
    files = store.spark.read.schema("table string, _batch string").option("basePath", f"{store.root}/data")
    return rows_per_batch(files.parquet(*paths))


def count_tables(
    store: BranchStore, states: Sequence[dict], labels: Sequence[str], keys: Sequence[str] | None = None
) -> DataFrame:
    """The labels, table and n_rows of every table (or of ``keys``) of several states.

    A batch that several states share is counted once. A version with deleted rows is
    counted by a scan of its own, in which batches without such rows read no column. Few tables and batches are
    named in the plan; longer lists are read from the store's metadata by Spark.
    """
    wanted = None if keys is None else set(keys)
    places = [
        {**{label: state[label] for label in labels}, "table": key, "content_id": content_id}
        for state in states
        for key, content_id in state["tables"].items()
        if content_id != lg.NAMESPACE and (wanted is None or key in wanted)
    ]
    ids = {place["content_id"] for place in places}
    contents = store.contents_of(ids) if len(ids) <= store.path_limit else []
    less = [c for c in contents if c.deletes]
    contents = [c for c in contents if not c.deletes]
    held = {(c.table_id, batch) for c in contents for batch in c.batches or ()}
    fields = ", ".join(f"`{label}` string" for label in labels)
    if len(places) <= store.path_limit:
        named = rows_frame(store.spark, places, f"{fields}, `table` string, content_id string")
    else:
        heads = [{**{label: state[label] for label in labels}, "hash": state["hash"]} for state in states]
        commits = store.commit_rows({state["hash"] for state in states})
        tables = commits.select("hash", F.explode("tables").alias("table", "content_id"))
        tables = tables.filter(F.col("content_id") != lg.NAMESPACE)
        if keys is not None:
            tables = tables.filter(F.col("table").isin(list(keys)))
        named = rows_frame(store.spark, heads, f"{fields}, hash string").join(tables, "hash").drop("hash")
    if (contents or less) and len(held) <= store.path_limit and all(c.batches is not None for c in contents):
        lists = [
            {"content_id": c.content_id, "table_id": c.table_id, "_batch": batch}
            for c in contents
            for batch in c.batches
        ]
        lists = rows_frame(store.spark, lists, "content_id string, table_id string, _batch string")
        counts = named_batch_counts(store, sorted(held))
    else:
        rows = store.content_rows(ids) if len(ids) <= store.path_limit else store.all_contents()
        some = F.size(F.coalesce("deletes", F.array())) > 0
        if len(ids) > store.path_limit:
            less = [Content.from_row(row) for row in rows.where(some).withColumn("batches", F.lit(None).cast("array<string>")).collect() if row["content_id"] in ids]
        rows = rows.where(~some).join(named.select("content_id").distinct(), "content_id", "left_semi")
        lists = rows.select("content_id", "table_id", F.explode("batches").alias("_batch"))
        counts = batch_counts(store, lists.select("table_id", "_batch").distinct())
    per_content = (
        lists.join(counts, ["table_id", "_batch"]).groupBy("content_id").agg(F.sum("n_rows").alias("n_rows"))
    )
    for content in less:
        left = store.scan(content).agg(F.count(F.lit(1)).alias("n_rows"))
        per_content = per_content.unionByName(left.select(F.lit(content.content_id).alias("content_id"), "n_rows"))
    rows = named.join(per_content, "content_id", "left")
    return rows.select(*labels, "table", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def count_rows(store: BranchStore, refs: Sequence[str] | None = None) -> DataFrame:
    """ref, table, n_rows of every table at the given refs, or at all live ones."""
    states = store.live_states() if refs is None else [{**store.state(r), "ref": r} for r in refs]
    return count_tables(store, states, ["ref"])


def reconcile(table: DataFrame, source: DataFrame) -> DataFrame:
    """source_rows, table_rows, ok in one pass over both."""
    rows = source.select(F.lit(True).alias("from_source")).union(table.select(F.lit(False)))
    counts = rows.agg(
        counted_once(F.col("from_source")).alias("source_rows"),
        counted_once(~F.col("from_source")).alias("table_rows"),
    )
    return counts.withColumn("ok", F.col("source_rows") == F.col("table_rows"))


def require_reconciled(table: DataFrame, source: DataFrame) -> int:
    """The common count; different counts raise."""
    counts = reconcile(table, source).first()
    if not counts["ok"]:
        raise AuditFailed(f"the table has {counts['table_rows']} rows, its source {counts['source_rows']}")
    return counts["table_rows"]


# ---- refs ----------------------------------------------------------------------


def isolation(store: BranchStore, ref: str, other: str | None = None) -> DataFrame:
    """table, rows_on_<ref>, rows_on_<other>: which tables each ref shows; 0 if absent."""
    other = other or store.default
    counts = count_rows(store, [ref, other])
    wide = counts.groupBy("table").pivot("ref", [ref, other]).agg(F.first("n_rows"))
    columns = [F.coalesce(F.col(quoted(r)), F.lit(0)).alias(f"rows_on_{r}") for r in (ref, other)]
    return wide.select("table", *columns)


def heads_equal(store: BranchStore) -> DataFrame:
    """ref, same_as_default: does the ref point at the default ref's commit?"""
    head = store.head(store.default)
    return store.list_refs().select(
        F.col("name").alias("ref"), (F.col("hash") == head).alias("same_as_default")
    )


def commit_log(store: BranchStore, ref: str, with_rows: bool = True) -> DataFrame:
    """depth, hash, message, rows_added of every commit in the ref's history.

    ``rows_added`` counts the rows of the batches that the commit's tables have
    and the same tables at its first parent do not; without it no data is read.
    """
    commits = store.history(store.state(ref)["seen"])
    if not with_rows:
        return commits.select("depth", "hash", "message")
    parents = commits.select(F.col("hash").alias("parent"), F.col("tables").alias("had"))
    pairs = commits.select("hash", "parent", "tables").join(parents, "parent", "left")
    changed = F.map_filter(
        "tables", lambda key, content: ~content.eqNullSafe(F.try_element_at("had", key))
    )
    tables = pairs.select("hash", "had", F.explode(changed).alias("key", "content_id"))
    tables = tables.withColumn("old_id", F.try_element_at("had", F.col("key")))
    contents = store.all_contents()
    new = contents.select("content_id", "table_id", "batches")
    old = contents.select(F.col("content_id").alias("old_id"), F.col("batches").alias("old_batches"))
    lists = tables.join(new, "content_id").join(old, "old_id", "left")
    none = F.array().cast("array<string>")
    fresh = F.array_except("batches", F.coalesce("old_batches", none))
    added = lists.select("hash", "table_id", F.explode(fresh).alias("_batch"))
    # the history holds nearly every batch, so all footers are read, without a list to join
    counts = rows_per_batch(store.stored_rows())
    per_commit = added.join(counts, ["table_id", "_batch"]).groupBy("hash").agg(F.sum("n_rows").alias("rows_added"))
    rows = commits.join(per_commit, "hash", "left")
    return rows.select("depth", "hash", "message", F.coalesce("rows_added", F.lit(0)).alias("rows_added"))


# ---- differences -----------------------------------------------------------------


def row_diff(store: BranchStore, key: str, old_ref: str, new_ref: str) -> DataFrame:
    """change, the common columns, n_rows: rows only one of two refs has.

    Batches that both versions hold cancel out and are not read, so the cost
    follows what changed. Of the rest each side is read once and one grouping
    nets equal rows; copies of a row are combined before the shuffle and come
    out as one row with their number.
    """
    old, new = (store.content_at(store.state(ref), key) for ref in (old_ref, new_ref))
    kinds = {file: kind for _, kind, file in old.columns}
    columns = []
    for name, kind, file in new.columns:
        was = kinds.get(file)
        if was is not None and (was == kind or widens(type_of(was), type_of(kind))):
            columns.append((name, kind, file))
        elif was is not None and widens(type_of(kind), type_of(was)):
            columns.append((name, was, file))
    names = [name for name, _, _ in columns]
    old, new = (replace(content, columns=tuple(columns)) for content in (old, new))
    if not names:
        raise ValueError(f"the two versions of {key} have no column in common")
    taken = {"change", "n_rows"}.intersection(name.lower() for name in names)
    if taken:
        raise ValueError(f"the result of a row diff has columns {sorted(taken)} itself; rename those of {key}")
    # columns go by number within, so that they may have any name
    inner = [f"_{n}" for n in range(len(names))]
    columns = [F.col(quoted(name)).alias(alias) for name, alias in zip(names, inner)]
    removed = store.scan(old, without=new).select(*columns, F.lit(-1).cast("bigint").alias("net"))
    added = store.scan(new, without=old).select(*columns, F.lit(1).cast("bigint").alias("net"))
    net = removed.union(added).groupBy(*inner).agg(F.sum("net").alias("net")).filter(F.col("net") != 0)
    change = F.when(F.col("net") > 0, "added").otherwise("removed")
    named = [F.col(alias).alias(name) for name, alias in zip(names, inner)]
    return net.select(change.alias("change"), *named, F.abs("net").alias("n_rows"))


def schema_diff(store: BranchStore, key: str, ref: str, other: str, with_values: bool = False) -> DataFrame:
    """column, type_<ref>, type_<other>: the types of a table's columns at two refs.

    A side without the column has a NULL type. Only metadata is read, unless
    ``with_values`` asks for values_<ref> and values_<other>, the numbers of
    non-NULL values: one pass over each side.
    """
    tables = {name: store.at(name).table(key) for name in (ref, other)}
    types = {name: {f.name: f.dataType.simpleString() for f in rows.schema.fields} for name, rows in tables.items()}
    columns = sorted({*types[ref], *types[other]})
    listed = [{"column": c, "a": types[ref].get(c), "b": types[other].get(c)} for c in columns]
    diff = rows_frame(store.spark, listed, "`column` string, a string, b string")
    diff = diff.toDF("column", f"type_{ref}", f"type_{other}")
    if not with_values:
        return diff
    for name, rows in tables.items():
        counts = rows.agg(*[F.count(quoted(c)).alias(c) for c in rows.columns])
        fields = [
            F.struct(F.lit(c).alias("column"), F.col(quoted(c)).alias(f"values_{name}")) for c in rows.columns
        ]
        diff = diff.join(counts.select(F.inline(F.array(*fields))), "column", "left")
        diff = diff.withColumn(f"values_{name}", F.coalesce(F.col(quoted(f"values_{name}")), F.lit(0)))
    return diff


# ---- the gate ------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """One check. ``holds`` judges a row; ``unique`` and ``source`` judge the table."""

    name: str
    holds: Column | None = None
    unique: tuple[str, ...] = ()
    source: DataFrame | None = None


def not_null(column: str) -> Rule:
    return Rule(f"{column} not null", holds=F.col(quoted(column)).isNotNull())


def matches(column: str, pattern: str) -> Rule:
    return Rule(f"{column} matches", holds=matches_fully(column, pattern))


def in_set(column: str, values: Sequence) -> Rule:
    return Rule(f"{column} in set", holds=member_of(column, values))


def unique(*columns: str) -> Rule:
    return Rule(f"{', '.join(columns)} unique", unique=columns)


def same_count_as(source: DataFrame) -> Rule:
    return Rule("same count as source", source=source)


def check(table: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """rule, n_failed, passed.

    All row rules share one pass and one aggregate. A key rule groups by its key
    (combined before the shuffle, so a key with very many copies is no hot spot)
    and reports the rows beyond the first of each key.
    """
    parts = []
    by_row = [rule for rule in rules if rule.holds is not None]
    if by_row:
        failed = table.agg(
            *[counted_once(~F.coalesce(rule.holds, F.lit(False))).alias(f"f{i}") for i, rule in enumerate(by_row)]
        )
        fields = [
            F.struct(F.lit(rule.name).alias("rule"), F.col(f"f{i}").alias("n_failed"))
            for i, rule in enumerate(by_row)
        ]
        parts.append(failed.select(F.inline(F.array(*fields))))
    for rule in rules:
        if rule.unique:
            copies = table.groupBy(*[F.col(quoted(c)) for c in rule.unique]).agg(F.count(F.lit(1)).alias("n"))
            extra = F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint")
            parts.append(copies.agg(extra.alias("n_failed")).select(F.lit(rule.name).alias("rule"), "n_failed"))
        if rule.source is not None:
            gap = F.abs(F.col("source_rows") - F.col("table_rows"))
            counts = reconcile(table, rule.source)
            parts.append(counts.select(F.lit(rule.name).alias("rule"), gap.alias("n_failed")))
    if not parts:
        return rows_frame(table.sparkSession, [], "rule string, n_failed bigint, passed boolean")
    results = parts[0]
    for part in parts[1:]:
        results = results.unionByName(part)
    return results.withColumn("passed", F.col("n_failed") == 0)


def publish(
    store: BranchStore,
    source: str,
    rules: dict[str, Sequence[Rule]],
    into: str | None = None,
    by_key: dict[str, Sequence[str]] | None = None,
    drift: dict[str, DriftLimits] | None = None,
) -> DataFrame:
    """Merge ``source`` only if every rule passes on the tables as the merge leaves them.

    The merge's commit is made first and checked by its hash; then exactly that commit is
    published, if neither ref moved meanwhile (else ``StaleHead``). ``drift`` holds the profiles of
    tables after the merge against those before; a table that the target has not yet cannot drift.
    """
    target = into or store.default_ref()
    before = store.ref_state(target)
    plan = planned_merge(store, source, target, None, by_key or {})
    failed = []
    for key, table_rules in rules.items():
        results = check(store.at(plan["hash"]).table(key), table_rules)
        failed += [f"{key}: {row['rule']} ({row['n_failed']})" for row in results.filter("NOT passed").collect()]
    for key, limits in (drift or {}).items():
        if key in before["tables"]:
            columns = [row["column"] for row in drifted(store, key, before["hash"], plan["hash"], limits).collect()]
            failed += [f"{key}: {column} drifted" for column in sorted(columns)]
    if failed:
        raise AuditFailed("; ".join(failed))
    return store._ref_row(target, publish_merge(store, plan))
