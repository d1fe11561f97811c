"""Where two refs differ: the smallest groups of rows that hold much of the change."""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from branchyard.operators.audit import row_diff
from branchyard.session import work_folder

if TYPE_CHECKING:
    from branchyard.operators.store import BranchStore


def explain_difference(store: BranchStore, key: str, old_ref: str, new_ref: str, by: dict[str, str], share: float = 0.1) -> DataFrame:
    """fixed, the columns of ``by``, n_added, n_removed, n_total: the smallest groups with ``share`` of the changed rows.

    ``by`` maps names to expressions over a row. A group fixes some of them; ``fixed`` names these, and
    the others are NULL. Of all groups with at least ``share`` of the rows that were added or removed, those are
    returned that no group with one more fixed value is within. Where nothing else has that
    share it is the one group of all rows, with an empty ``fixed``. ``n_total`` is the number of all
    changed rows. An updated row counts once as removed and once as added. Equal refs give no rows.

    Only batches that differ are read. Their netted rows are grouped by all values once. A value that has not the
    share by itself has it in no group, so such values become one before the grouping by all
    subsets: what that gets is bounded by the number of names and the share, whatever the table.
    """
    if not 0 < share <= 1:
        raise ValueError(f"not a share: {share}")
    clash = {"fixed", "n_added", "n_removed", "n_total"}.intersection(name.lower() for name in by)
    if not by or clash or len({name.lower() for name in by}) < len(by):
        raise ValueError(f"not names of groups: {list(by)}")
    at = [f"c{k}" for k in range(len(by))]
    sums = [F.sum("n_added").alias("n_added"), F.sum("n_removed").alias("n_removed")]
    signed = [F.when(F.col("change") == kind, F.col("n_rows")).otherwise(0).alias(f"n_{kind}") for kind in ("added", "removed")]
    values = [F.struct(F.expr(e).alias("value"), F.lit(True).alias("heavy")).alias(c) for e, c in zip(by.values(), at)]
    cells = _written(row_diff(store, key, old_ref, new_ref).select(*values, *signed).groupBy(*at).agg(*sums))
    total = cells.agg(F.sum(F.col("n_added") + F.col("n_removed"))).first()[0] or 0
    enough = F.col("n_added") + F.col("n_removed") >= F.lit(float(share)) * F.lit(total)

    # at most 1 / share values of each name
    single = _written(cells.groupingSets([[F.col(c)] for c in at], *[F.col(c) for c in at]).agg(*sums).where(enough).select(*at))
    for name in at:
        heavy = F.broadcast(single.where(F.col(name).isNotNull()).select(F.col(name).alias("known")))
        light = F.struct(F.lit(None).cast(cells.schema[name].dataType["value"].dataType).alias("value"), F.lit(False).alias("heavy"))
        cells = cells.join(heavy, F.col(name).eqNullSafe(F.col("known")), "left")
        cells = cells.withColumn(name, F.when(F.col("known").isNotNull(), F.col(name)).otherwise(light)).drop("known")
    known = reduce(and_, [F.col(c).isNull() | F.col(c)["heavy"] for c in at])
    groups = _written(cells.groupBy(*at).agg(*sums).cube(*at).agg(*sums).where(known & enough))

    around = F.explode(F.array(*[_without(at, k, groups) for k in range(len(at))])).alias("up")
    held = groups.select(around).where("up.here").select(*[F.col(f"up.{c}").alias(f"u{c}") for c in at]).distinct()
    least = groups.join(held, reduce(and_, [F.col(c).eqNullSafe(F.col(f"u{c}")) for c in at]), "left_anti").where(F.lit(total) > 0)
    fixed = F.concat_ws(", ", *[F.when(F.col(c).isNotNull(), F.lit(name)) for name, c in zip(by, at)])
    shown = [F.col(c)["value"].alias(name) for name, c in zip(by, at)]
    return least.select(fixed.alias("fixed"), *shown, "n_added", "n_removed", F.lit(total).cast("bigint").alias("n_total"))


def _without(at: list[str], k: int, groups: DataFrame) -> Column:
    """The group with its k-th value left open, and whether it had one."""
    left = [F.lit(None).cast(groups.schema[c].dataType).alias(c) if n == k else F.col(c).alias(c) for n, c in enumerate(at)]
    return F.struct(F.col(at[k]).isNotNull().alias("here"), *left)


def _written(rows: DataFrame) -> DataFrame:
    folder = work_folder(rows.sparkSession, "explain")
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)
