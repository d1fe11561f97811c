"""Grouped totals of a table that are kept up to date from what changed, at the same ref as the table."""

from __future__ import annotations

from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from branchyard.functions.expressions import quoted
from branchyard.operators.content import Content
from branchyard.operators.tables import _with_keys
from branchyard.session import no_rows, work_folder

if TYPE_CHECKING:
    from branchyard.operators.store import BranchStore
    from branchyard.operators.tables import RefTables


def _measured(rows: DataFrame, group_by: Sequence[str], measures: dict[str, tuple[str, str]]) -> DataFrame:
    columns = [F.col(quoted(name)) for name in group_by]
    return rows.select(*columns, *[F.expr(expression).alias(name) for name, (_, expression) in measures.items()])


def _aggregates(measures: dict[str, tuple[str, str]]) -> list:
    out = [F.count(F.lit(1)).alias("n_rows")]
    for name, (kind, _) in measures.items():
        value = F.col(quoted(name))
        out.append(F.coalesce(F.sum(value), F.lit(0)).alias(name) if kind == "sum" else (F.min if kind == "min" else F.max)(value).alias(name))
    return out


def _known(store: BranchStore, state: dict, key: str, totals_key: str) -> Content | None:
    """The version of the table that the totals were last brought up to, told by the commit that wrote them."""
    start = f"totals {totals_key} of {key} at "
    wrote = store.history(state["seen"]).where(F.col("tables").getItem(totals_key) == state["tables"][totals_key])
    last = wrote.where(F.startswith("message", F.lit(start))).agg(F.max_by("message", "depth")).first()[0]
    return store.content_of(last.removeprefix(start)) if last else None


def refresh_totals(
    tables: RefTables, key: str, totals_key: str, group_by: Sequence[str], measures: dict[str, tuple[str, str]]
) -> None:
    """Bring a table of totals up to what a table holds now; it is made if it is not there.

    ``measures`` maps a column to ("sum" | "min" | "max", expression over a row). The totals have the
    columns of ``group_by``, n_rows and these; NULL counts as 0 in a sum. Sums have to be of whole
    numbers or decimals, as others depend on the order of the rows.

    Only batches that came or went since the last time are read, each row with a sign; they are
    folded into the groups they touch, and only those groups are written. A group without rows goes.
    A smallest or largest value is looked up in the whole table only for groups that lost the one they had.
    """
    store, spark = tables.store, tables.store.spark
    bad = [kind for kind, _ in measures.values() if kind not in ("sum", "min", "max")]
    if bad or {"n_rows", "sign"}.intersection([*group_by, *measures]):
        raise ValueError(f"not measures of totals: {measures}")
    state = store.ref_state(tables.ref)
    now = store.content_at(state, key)
    old = _known(store, state, key, totals_key) if totals_key in state["tables"] else None
    if old is not None and old.table_id != now.table_id:
        raise ValueError(f"{totals_key} are the totals of another table that was called {key}")
    shape = _measured(no_rows(spark, now.schema), group_by, measures)
    empty = shape.groupBy(*[quoted(name) for name in group_by]).agg(*_aggregates(measures)).schema
    floats = [f.name for f in empty.fields if f.name in measures and measures[f.name][0] == "sum" and isinstance(f.dataType, (DoubleType, FloatType))]
    if floats:
        raise ValueError(f"sums of floating point numbers are not exact: {floats}")
    tables.create_table(totals_key, StructType([f for f in empty.fields]))
    changed = _changed_groups(tables, key, totals_key, old, now, group_by, measures, empty)
    folder = work_folder(spark, "totals")
    changed.write.parquet(folder)
    changed = spark.read.schema(empty).parquet(folder)
    if changed.isEmpty():
        return
    keys = changed.select([F.col(quoted(name)) for name in group_by])
    message = f"totals {totals_key} of {key} at {now.content_id}"
    tables._change_rows(totals_key, message, lambda rows: _with_keys(rows, keys), group_by, None, lambda _: changed.where("n_rows > 0"))


def _changed_groups(tables, key, totals_key, old, now, group_by, measures, empty) -> DataFrame:
    """New totals of the groups with a row that came or went; n_rows is 0 where none is left."""
    store = tables.store
    names = [quoted(name) for name in group_by]
    came = _measured(store.scan(now, without=old), group_by, measures).withColumn("sign", F.lit(1))
    if old is None:
        return came.groupBy(*names).agg(*_aggregates(measures))
    went = _measured(store.scan(old, without=now), group_by, measures).withColumn("sign", F.lit(-1))
    # rows that were only rewritten meet themselves here
    net = came.union(went).groupBy(*names, *[quoted(name) for name in measures]).agg(F.sum("sign").alias("sign")).where("sign <> 0")
    folds = [F.sum("sign").alias("n_rows")]
    for name, (kind, _) in measures.items():
        value = F.col(quoted(name))
        if kind == "sum":
            folds.append(F.coalesce(F.sum(value * F.col("sign")), F.lit(0)).alias(name))
        else:
            best = F.min if kind == "min" else F.max
            folds.append(best(F.when(F.col("sign") > 0, value)).alias(name))
            folds.append(best(F.when(F.col("sign") < 0, value)).alias(f"lost {name}"))
    delta = net.groupBy(*names).agg(*folds)
    had = tables.table(totals_key)
    same = [F.col(f"d.{name}").eqNullSafe(F.col(f"t.{name}")) for name in names]
    both = delta.alias("d").join(had.alias("t"), same, "left")
    out, lost = [F.col(f"d.{name}") for name in names], F.lit(False)
    n_rows = F.coalesce(F.col("t.n_rows"), F.lit(0)) + F.col("d.n_rows")
    for field in [f for f in empty.fields if f.name in measures]:
        kind, name = measures[field.name][0], quoted(field.name)
        new, was = F.col(f"d.{name}"), F.col(f"t.{name}")
        if kind == "sum":
            out.append((F.coalesce(was, F.lit(0)) + new).cast(field.dataType).alias(field.name))
        else:
            gone = F.col(f"d.{quoted(f'lost {field.name}')}")
            lost = lost | F.coalesce(gone <= was if kind == "min" else gone >= was, F.lit(False))
            out.append((F.least if kind == "min" else F.greatest)(was, new).alias(field.name))
    folded = both.select(*out, n_rows.alias("n_rows"), lost.alias("lost")).select(*[quoted(f.name) for f in empty.fields], "lost")
    kept = folded.where("NOT lost OR n_rows = 0").drop("lost")
    if all(kind == "sum" for kind, _ in measures.values()):
        return kept
    again = folded.where("lost AND n_rows > 0").select(*names)
    whole = _measured(_with_keys(store.scan(now), again), group_by, measures).groupBy(*names).agg(*_aggregates(measures))
    return kept.unionByName(whole)
