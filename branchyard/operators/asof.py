"""As-of join: to each row the last row of another table at or before its time, by key.

Both sides are put together, sorted by time within pieces of key and time, and the last row of the other
side is carried forward. What a piece begins with comes from the pieces of its key before it: one row per
piece. So a key with very many rows is as many pieces as it has stretches of time, and no join has
a condition other than equality.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from branchyard.functions.expressions import quoted


def _micros(column: str) -> Column:
    return F.unix_micros(F.col(quoted(column)).cast("timestamp"))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: dict[str, str],
    left_time: str,
    right_time: str,
    columns: dict[str, str],
    piece_seconds: int = 86_400,
    ties: Sequence[str] = (),
) -> DataFrame:
    """The rows of ``left`` with ``columns`` (name in the result to column) of the right row that holds at their time.

    ``on`` maps key columns of the left to those of the right. Rows of the left without a match, with a
    NULL key or time among them, have NULL there. Of right rows of one time the one with the largest
    ``ties`` holds. Copies of left rows stay.
    """
    taken = set(left.columns).intersection(columns)
    if taken:
        raise ValueError(f"the left side has columns {sorted(taken)} itself")
    keys = [f"k{n}" for n in range(len(on))]
    order = F.struct(_micros(right_time).alias("t"), *[F.col(quoted(name)).alias(f"tie{n}") for n, name in enumerate(ties)])
    kept = F.struct(*[F.col(quoted(column)).alias(name) for name, column in columns.items()])
    known = [F.col(quoted(name)) for name in on.values()]
    values = right.select(
        *[c.alias(k) for c, k in zip(known, keys)], _micros(right_time).alias("t"), F.lit(0).alias("kind"), order.alias("order"), kept.alias("value")
    ).dropna(subset=[*keys, "t"])
    rows = left.select(
        *[F.col(quoted(name)).alias(k) for name, k in zip(on, keys)], _micros(left_time).alias("t"), F.lit(1).alias("kind"),
        F.struct(*[F.col(quoted(name)) for name in left.columns]).alias("row"),
    )
    both = values.unionByName(rows, allowMissingColumns=True)
    both = both.withColumn("piece", F.floor(F.col("t") / (piece_seconds * 1_000_000)))
    carried = F.last("value", ignorenulls=True)
    within = Window.partitionBy(*keys, "piece").orderBy("t", "kind", "order").rowsBetween(Window.unboundedPreceding, 0)
    inside = both.withColumn("within", carried.over(within)).where("kind = 1")
    ends = both.groupBy(*keys, "piece").agg(F.max_by("value", "order").alias("value"))
    before = Window.partitionBy(*keys).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(*keys, "piece", carried.over(before).alias("before"))
    found = inside.join(starts, [*keys, "piece"], "left").withColumn("found", F.coalesce("within", "before"))
    return found.select("row.*", *[F.col("found").getField(name).alias(name) for name in columns])
