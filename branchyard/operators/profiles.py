"""Column profiles of table versions, put together from sketches that are made once for each batch."""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

from branchyard.functions.expressions import quoted
from branchyard.operators.content import Content, type_of
from branchyard.session import rows_frame

if TYPE_CHECKING:
    from branchyard.operators.store import BranchStore

#: a quantile is off by at most this share of itself; all sketches of a store have it, else they could not be merged
ACCURACY = 0.01
#: log2 of the counters of a distinct count: its standard error is 0.8 %
DISTINCT_BITS = 14

_STEP = math.log((1 + ACCURACY) / (1 - ACCURACY))
_OFFSET = int(746 / _STEP) + 2  # more than the logarithm of any double in steps
_ENDLESS = 2 * _OFFSET + 1

KEYS = ["_batch", "state", "file", "kind"]
SKETCH_SCHEMA = (
    "_batch string, state string, file string, kind string, n_rows bigint, n_values bigint, smallest string,"
    " largest string, distinct binary, buckets array<struct<bucket:int,n:bigint>>"
)


# ---- one value -----------------------------------------------------------------------


def bucket_of(x: Column) -> Column:
    """The bucket of a double. Buckets are in the order of the values, and each spans a factor of (1 + a) / (1 - a)."""
    size = (F.ceil(F.log(F.abs(x)) / _STEP) + _OFFSET).cast("int")
    signed = F.when(x == 0, 0).when(x > 0, size).otherwise(-size)
    endless = F.when(x > 0, _ENDLESS).otherwise(-_ENDLESS)
    return F.when(F.isnan(x), _ENDLESS + 1).when(F.abs(x) == float("inf"), endless).otherwise(signed)


def value_of(bucket: Column) -> Column:
    """The double that no value of the bucket differs from by more than ``ACCURACY`` of itself."""
    size = F.least(F.exp((F.abs(bucket) - _OFFSET) * _STEP + math.log1p(-ACCURACY)), F.lit(sys.float_info.max))
    endless = F.when(bucket > _ENDLESS, float("nan")).when(F.abs(bucket) == _ENDLESS, F.signum(bucket) * float("inf"))
    return F.when(F.abs(bucket) >= _ENDLESS, endless).when(bucket == 0, 0.0).otherwise(F.signum(bucket) * size)


def _numeric(kind: str) -> bool:
    return isinstance(type_of(kind), NumericType)


def _ordered(kind: str) -> bool:
    return isinstance(type_of(kind), (NumericType, StringType, BooleanType, DateType, TimestampType, TimestampNTZType))


def _hashed(kind: str) -> bool:
    return '"map"' not in kind and "variant" not in kind


def _text(value: Column, kind: str) -> Column:
    instant = isinstance(type_of(kind), TimestampType)
    return (F.unix_micros(value) if instant else value).cast("string")


def _parsed(text: Column, kind: str) -> Column:
    if isinstance(type_of(kind), TimestampType):
        return F.timestamp_micros(text.cast("bigint"))
    return text.cast(type_of(kind))


# ---- batches -------------------------------------------------------------------------


def _states(store: BranchStore, content: Content) -> DataFrame:
    """_batch, state of each batch of a version; the state tells which deletes name the batch."""
    everywhere = [F.lit(d.id) for d in content.deletes if d.batches is None]
    named = [{"_batch": b, "id": d.id} for d in content.deletes for b in d.batches or ()]
    batches = store.batch_list(content)
    if not named and not everywhere:
        return batches.withColumn("state", F.lit(""))
    by_batch = rows_frame(store.spark, named, "_batch string, id string").groupBy("_batch").agg(F.collect_set("id").alias("ids"))
    ids = F.concat(F.coalesce("ids", F.expr("CAST(array() AS array<string>)")), F.array(*everywhere).cast("array<string>"))
    state = F.when(F.size(ids) > 0, F.sha2(F.array_join(F.sort_array(ids), ","), 256)).otherwise("")
    return batches.join(by_batch, "_batch", "left").select("_batch", state.alias("state"))


def _columns(content: Content) -> Column:
    """The columns of a version as an array of name, file and kind."""
    fields = [F.struct(F.lit(name).alias("column"), F.lit(file).alias("file"), F.lit(kind).alias("kind")) for name, kind, file in content.columns]
    return F.array(*fields)


def _sketches(store: BranchStore, table_id: str) -> DataFrame:
    """Stored sketches of a table; two writers may both have made one, which is then the same."""
    read = store.spark.read.schema(SKETCH_SCHEMA)
    return store._or_empty(lambda: read.parquet(f"{store.root}/profiles/table={table_id}"), SKETCH_SCHEMA).dropDuplicates(KEYS)


def sketch_batches(store: BranchStore, content: Content) -> int:
    """Make the sketches of a version's batches that are not there yet; the number of batches read."""
    wanted = _states(store, content).select("_batch", "state", F.inline(_columns(content))).drop("column")
    missing = wanted.join(_sketches(store, content.table_id), KEYS, "left_anti").select("_batch", "state").distinct()
    few = missing.limit(store.path_limit + 1).collect()
    if not few:
        return 0
    if len(few) <= store.path_limit:
        content_of_missing = content.holding(*sorted(r["_batch"] for r in few))
        missing = rows_frame(store.spark, [r.asDict() for r in few], "_batch string, state string")
        n_missing = len(few)
    else:
        content_of_missing, n_missing = content, missing.count()
    rows = store.scan(content_of_missing, with_batch=True)
    small = F.broadcast(missing) if n_missing <= store.broadcast_limit else missing
    rows = rows.select("_batch", *[F.col(quoted(name)).alias(f"c{k}") for k, (name, _, _) in enumerate(content.columns)])
    rows = rows.join(small.select("_batch"), "_batch", "left_semi")
    made = missing.select("_batch", "state", F.inline(_columns(content))).drop("column")
    made = made.join(_summed(rows, content), ["_batch", "file"], "left").join(_bucketed(rows, content), ["_batch", "file"], "left")
    made = made.withColumns({n: F.coalesce(n, F.lit(0)) for n in ("n_rows", "n_values")})
    made = made.select(*KEYS, "n_rows", "n_values", "smallest", "largest", "distinct", "buckets")
    made.hint("rebalance", "_batch").write.mode("append").partitionBy("_batch").parquet(f"{store.root}/profiles/table={content.table_id}")
    return n_missing


def _summed(rows: DataFrame, content: Content) -> DataFrame:
    """_batch, file and all but the buckets, from one aggregate over all columns."""
    aggregates, fields = [F.count(F.lit(1)).alias("n_rows")], []
    for k, (_, kind, file) in enumerate(content.columns):
        value = F.col(f"c{k}")
        nothing = F.lit(None).cast("string")
        ordered, hashed = _ordered(kind), _hashed(kind)
        aggregates.append(F.count(value).alias(f"n{k}"))
        if ordered:
            aggregates += [F.min(value).alias(f"s{k}"), F.max(value).alias(f"l{k}")]
        if hashed:
            aggregates.append(F.hll_sketch_agg(F.when(value.isNotNull(), F.xxhash64(value)), DISTINCT_BITS).alias(f"d{k}"))
        fields.append(
            F.struct(
                F.lit(file).alias("file"),
                F.col(f"n{k}").alias("n_values"),
                (_text(F.col(f"s{k}"), kind) if ordered else nothing).alias("smallest"),
                (_text(F.col(f"l{k}"), kind) if ordered else nothing).alias("largest"),
                (F.col(f"d{k}") if hashed else nothing.cast("binary")).alias("distinct"),
            )
        )
    return rows.groupBy("_batch").agg(*aggregates).select("_batch", "n_rows", F.inline(F.array(*fields)))


def _bucketed(rows: DataFrame, content: Content) -> DataFrame:
    """_batch, file, buckets of the columns of numbers: values counted by bucket before the shuffle."""
    numbers = [
        F.struct(F.lit(file).alias("file"), bucket_of(F.col(f"c{k}").cast("double")).alias("bucket"))
        for k, (_, kind, file) in enumerate(content.columns)
        if _numeric(kind)
    ]
    numbers = numbers or [F.struct(F.lit("").alias("file"), F.lit(None).cast("int").alias("bucket"))]
    each = rows.select("_batch", F.inline(F.array(*numbers))).where("bucket IS NOT NULL")
    counted = each.groupBy("_batch", "file", "bucket").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("_batch", "file").agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("buckets"))


# ---- versions ------------------------------------------------------------------------


def _parts(store: BranchStore, key: str, refs: Sequence[str]) -> tuple[DataFrame, DataFrame, set[str]]:
    """ref and column of each ref's table, the sketches of these, and the kinds of columns there are."""
    heads, parts, kinds = [], [], set()
    contents = {ref: store.content_at(store.state(ref), key) for ref in refs}
    for content in contents.values():
        sketch_batches(store, content)
    # only now, as Spark takes two scans of one folder for the same, even if files came between
    for ref, content in contents.items():
        columns = rows_frame(store.spark, [{"ref": ref}], "ref string").select("ref", F.inline(_columns(content)))
        heads.append(columns)
        batches = _states(store, content).select(F.lit(ref).alias("ref"), "_batch", "state", F.inline(_columns(content)))
        parts.append(batches.join(_sketches(store, content.table_id), KEYS))
        kinds |= {kind for _, kind, _ in content.columns}
    return reduce(DataFrame.union, heads), reduce(DataFrame.unionByName, parts), kinds


def _buckets(parts: DataFrame) -> DataFrame:
    """ref, column, bucket, n: at most as many rows of a column as there are buckets."""
    each = parts.select("ref", "column", F.inline("buckets"))
    return each.groupBy("ref", "column", "bucket").agg(F.sum("n").alias("n"))


def profile(store: BranchStore, key: str, refs: Sequence[str], quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """ref, column, n_rows, n_values, n_distinct, smallest, largest, quantiles of a table at refs or commits.

    n_rows, n_values (those not NULL), smallest and largest (as text) are exact. n_distinct has a standard error of
    0.8 %. A quantile q is the value of rank ceil(q * n_values), off by at most ``ACCURACY`` of itself; NaN is the
    largest value. Quantiles are given for numbers, smallest and largest also for texts, booleans, dates and
    timestamps, n_distinct for all but maps and variants; elsewhere, and where there is no value, they are
    NULL (n_distinct 0). A table without rows has a row per column.

    Each batch is read once for all refs and all calls, when it is first profiled. What is merged is a row
    per batch and column; a batch of which rows were deleted is profiled anew as it is left.
    """
    if any(not 0 <= q <= 1 for q in quantiles):
        raise ValueError(f"not quantiles: {list(quantiles)}")
    heads, parts, kinds = _parts(store, key, refs)
    ordered = sorted(filter(_ordered, kinds))

    def best(of, name: str) -> Column:
        typed = [of(F.when(F.col("kind") == kind, _parsed(F.col(name), kind))).cast("string") for kind in ordered]
        return F.coalesce(*typed, F.lit(None).cast("string")).alias(name)

    merged = parts.groupBy("ref", "column").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_values").alias("n_values"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n_distinct"),
        best(F.min, "smallest"),
        best(F.max, "largest"),
    )
    so_far = Window.partitionBy("ref", "column").orderBy("bucket")
    ranked = _buckets(parts).withColumns({"upto": F.sum("n").over(so_far), "n_all": F.sum("n").over(Window.partitionBy("ref", "column"))})
    found = [F.min(F.when(F.col("upto") >= F.greatest(F.lit(1), F.ceil(F.lit(float(q)) * F.col("n_all"))), F.col("bucket"))) for q in quantiles]
    values = F.array(*[value_of(b) for b in found]) if found else F.expr("CAST(array() AS array<double>)")
    spread = ranked.groupBy("ref", "column").agg(values.alias("quantiles"))
    hashed = F.col("kind").isin(sorted(filter(_hashed, kinds)))
    rows = heads.join(merged, ["ref", "column"], "left").join(spread, ["ref", "column"], "left")
    counts = [F.coalesce(n, F.lit(0)).alias(n) for n in ("n_rows", "n_values")]
    distinct = F.when(hashed, F.coalesce("n_distinct", F.lit(0))).alias("n_distinct")
    return rows.select("ref", "column", *counts, distinct, "smallest", "largest", "quantiles")


# ---- drift ---------------------------------------------------------------------------


@dataclass(frozen=True)
class DriftLimits:
    """What a column may change by: the distance of its numbers' distributions, and its share of NULL values."""

    distance: float = 0.1
    nulls: float = 0.01
    columns: tuple[str, ...] | None = None


def drift(store: BranchStore, key: str, old: str, new: str) -> DataFrame:
    """column, old_nulls, new_nulls, distance of the columns that a table has at both refs or commits.

    The first two are shares of the rows, NULL for a side without rows. ``distance`` is the largest
    difference of the two distribution functions over all bucket borders (0 equal, 1 apart), NULL for
    columns that are no numbers on both sides, or where one has no value.
    """
    old, new = (store.state(name)["hash"] for name in (old, new))
    heads, parts, _ = _parts(store, key, [old, new])
    share = F.when(F.sum("n_rows") > 0, 1 - F.sum("n_values") / F.sum("n_rows"))
    counted = parts.groupBy("ref", "column").agg(share.alias("nulls"))
    nulls = [F.max(F.when(F.col("ref") == side, F.col("nulls"))).alias(name) for side, name in ((old, "old_nulls"), (new, "new_nulls"))]
    shares = heads.join(counted, ["ref", "column"], "left").groupBy("column").agg(F.count_distinct("ref").alias("sides"), *nulls)
    by_column = Window.partitionBy("column")
    sized = _buckets(parts).withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("ref", "column")))
    signed = [F.sum(F.when(F.col("ref") == side, F.col("share")).otherwise(0.0)).alias(name) for side, name in ((old, "a"), (new, "b"))]
    apart = sized.groupBy("column", "bucket").agg(*signed)
    gap = F.abs(F.sum(F.col("a") - F.col("b")).over(by_column.orderBy("bucket")))
    apart = apart.withColumn("gap", gap).groupBy("column").agg(F.max("gap").alias("gap"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    distance = F.when((F.col("a") > 0) & (F.col("b") > 0), F.col("gap")).alias("distance")
    both = F.lit(1 if old == new else 2)
    return shares.where(F.col("sides") == both).drop("sides").join(apart.select("column", distance), "column", "left")


def drifted(store: BranchStore, key: str, old: str, new: str, limits: DriftLimits) -> DataFrame:
    """The rows of ``drift`` beyond the limits."""
    rows = drift(store, key, old, new)
    if limits.columns is not None:
        rows = rows.where(F.col("column").isin(list(limits.columns)))
    more_nulls = F.abs(F.coalesce("new_nulls", F.lit(0.0)) - F.coalesce("old_nulls", F.lit(0.0))) > limits.nulls
    return rows.where(more_nulls | (F.coalesce("distance", F.lit(0.0)) > limits.distance))
