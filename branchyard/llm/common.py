"""Helpers that several operators share: word hashes, bounded batches, written tables, components."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchyard.functions.expressions import quoted
from branchyard.session import work_folder

#: Bytes that Spark hands to Python at once at most: a batch has to fit a Python worker.
BATCH_BYTES = 8 << 20

#: How many ways the rows of a key are dealt out before they meet the key's one row.
SALTS = 32


def python_tasks(spark: SparkSession) -> None:
    """Make ready for tasks in Python.

    The bytes that Spark hands to Python at once are lowered, unless they are lower already.
    Workers on this machine are told where the package is; on a cluster it has to be
    installed or sent with ``--py-files``.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(str(spark.conf.get(name, str(1 << 30))).rstrip("b"))
    if now <= 0 or now > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))
    root, paths = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in paths.get("PYTHONPATH", "").split(os.pathsep):
        paths["PYTHONPATH"] = os.pathsep.join(filter(None, [paths.get("PYTHONPATH"), root]))


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: its lineage ends there, and it is computed once."""
    spark = frame.sparkSession
    folder = work_folder(spark, name)
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def free_name(frame: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as no column of the frame has."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def row_ids(docs: DataFrame, id_col: str) -> tuple[DataFrame, str]:
    """The rows, and a column whose values that are not null name one row each, in the order of the ids.

    That is the id itself unless an id stands in two rows. Then the rows are written with a number
    that grows with the id, in a column of a name that they do not have; null ids have a null number.
    Rows of one id stand by a hash of the row, so columns may have any type; equal rows are
    dealt out by where they were read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id")).where("id IS NOT NULL")
    if rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return docs, id_col
    name = free_name(docs, "_row_id")
    columns = [F.col(quoted(c)) for c in docs.columns]
    key = F.col(id_col).cast("long")
    placed = docs.select(F.struct(*columns).alias("row"), key.alias("id"), F.xxhash64(F.to_json(F.struct(*columns))).alias("digest"), F.monotonically_increasing_id().alias("place"))
    number = F.when(F.col("id").isNotNull(), F.monotonically_increasing_id())
    return stored(placed.orderBy("id", "digest", "place").select("row.*", number.alias(name)), "rows"), name


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    """The texts of a batch as UTF-8; null is empty."""
    for text in column(batch, name):
        yield (text.as_py() or "").encode()


# ---- words as spans of bytes, and their hashes -------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit hash of 64-bit numbers (the public splitmix64 finaliser)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_CODES = mixed(np.arange(256, dtype=np.uint64))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
FACTOR = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(FACTOR, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** n modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        steps = np.full(max(1 << 16, 2 * n) + 1, base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[: n + 1]


def lower_ascii(data: bytes) -> np.ndarray:
    return LOWER[np.frombuffer(data, np.uint8)]


def word_spans(data: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest runs of bytes that ``in_word`` marks."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = in_word[data]
    steps = np.diff(inside)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, the same wherever the span stands."""
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_CODES[data] * powers(FACTOR, len(data))[:-1], out=sums[1:])
        raw = (sums[ends] - sums[starts]) * powers(INVERSE, len(data))[starts]
        return mixed(raw ^ (ends - starts).astype(np.uint64) * np.uint64(FACTOR))


def window_hashes(words: np.ndarray, offsets: tuple[int, ...], span: int) -> np.ndarray:
    """For each run of ``span`` words a hash of those that stand at ``offsets`` within it."""
    n = len(words) - span + 1
    with np.errstate(over="ignore"):
        out = np.zeros(max(n, 0), np.uint64)
        for k in offsets:
            out = mixed(out * np.uint64(FACTOR) + words[k : k + len(out)])
    return out


# ---- filters of fixed size ----------------------------------------------------------------

#: Bits of a filter, whatever goes into it: 2 MB, so it may be broadcast at any scale.
FILTER_BITS = 1 << 24


def bit_filter(keys: DataFrame, name: str) -> np.ndarray:
    """Which of FILTER_BITS slots the 64-bit keys of a column fall into.

    The driver gets at most one row of two numbers for each 64 slots, 4 MB in one job,
    however many keys there are.
    """
    slots = keys.select(F.pmod(F.col(name), F.lit(FILTER_BITS)).alias("slot"))
    words = slots.select(F.expr("CAST(slot DIV 64 AS INT) AS at"), F.expr("shiftleft(1L, CAST(slot % 64 AS INT)) AS bits"))
    found = words.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[found.column("at").to_numpy()] = found.column("bits").to_numpy()
    return bits.view(np.uint64)


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the slot of each 64-bit key is taken; keys of the filter always pass."""
    slot = keys.astype(np.uint64) & np.uint64(FILTER_BITS - 1)
    return (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


# ---- groups -----------------------------------------------------------------------------


def with_group_min(rows: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Rows with the smallest ``value`` of all rows of the same ``key``; null keys get null.

    Rows are combined before the shuffle. A group of many rows is dealt out over SALTS
    tasks before it meets its one smallest value; groups of one row need no join partner.
    """
    salt = F.pmod(F.xxhash64(value), F.lit(SALTS)).cast("int")
    groups = (
        rows.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.min(value).alias("_min"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .select("_key", "_min", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    )
    joined = rows.withColumn("_own_salt", F.coalesce(salt, F.lit(0))).join(
        groups, (F.col(key) == F.col("_key")) & (F.col("_own_salt") == F.col("_salt")), "left"
    )
    found = F.when(F.col(key).isNotNull(), F.coalesce("_min", value))
    return joined.withColumn(out, found).drop("_key", "_min", "_salt", "_own_salt")


def _stars(links: DataFrame) -> bool:
    """Whether no node is between a smaller and a greater one, or has two smaller ones."""
    ends = links.select(F.col("a").alias("u"), F.lit(1).alias("smaller"), F.lit(0).alias("greater"))
    ends = ends.union(links.select("b", F.lit(0), F.lit(1)))
    around = ends.groupBy("u").agg(F.sum("smaller").alias("smaller"), F.sum("greater").alias("greater"))
    return around.where("smaller > 1 OR smaller > 0 AND greater > 0").isEmpty()


def connected(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that links (a, b) reach, for each node with a link.

    Alternating star steps (Kiveris et al., 2014): neighbours move to the smallest node
    around them until every component is a star. Each step is a grouping and a join, and
    ends in a written table; links never come to the driver.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _stars(now):
        both = now.union(now.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(large, "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select("v", "m").union(least.select("u", "m")).toDF("a", "b")
        now = stored(small.where("a <> b").distinct(), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(now.select("b", "b").distinct())
