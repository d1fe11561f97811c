"""Exact top-k search by MaxScore.

A vector is a bag of terms: dimension d with a positive or a negative value. A shard keeps its
vectors and, for each term, the postings: the rows that have it, and the largest value among them.
For a query, a term whose sign agrees with the query's weight can add at most weight times largest
value to a score; other terms only take away. With the terms sorted by that bound, as many of the
lowest as together stay below the k-th best score so far are non-essential: a row in none of the
other, essential postings cannot compete. The essential postings are traversed, their scores are
added up, and the rest of a row's terms is probed, highest bounds first, only while its score with
all open bounds still competes. Shards are searched in slices of rows, so that the k-th best score
rises early. Each shard returns its k best; the best of all shards are merged.

Shards and blocks of queries are of bounded size; each block of queries meets each shard in a task
of its own. Nothing is broadcast and no candidate is left out: only rows whose bound is below the
k-th best score are passed over, so scores and ties are exact.

Defined results: vectors that are null or hold a null or non-finite component take no part, nor do
rows without an id. Missing trailing components are zero. A query never finds rows of its own id;
repeated rows are candidates each. A query id in several rows is searched with the smallest of its
vectors. With fewer than k candidates, all are returned; empty tables give no rows. Only the two
named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from branchyard.llm.common import python_tasks

SHARD_ROWS = 8192
QUERY_ROWS = 2048
SLICE_ROWS = 1024
#: Terms that are probed between two looks at who still competes.
PROBES = 8


def scaled(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, vector array<long>): floor(scale * component) of the vectors that take part."""
    value = F.col(vector_col)
    whole = value.isNotNull() & F.forall(value, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(x))
    rows = vectors.where(whole & F.col(id_col).isNotNull())
    return rows.select(F.col(id_col).cast("long").alias("id"), F.transform(value, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("vector"))


def matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    out = np.zeros((len(lists), width), np.int64)
    for k, row in enumerate(lists.to_pylist()):
        out[k, : len(row)] = row
    return out


class Slice:
    """Rows of a shard with their postings by term."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        self.ids, self.rows = ids, rows
        self.has = (rows > 0).T.copy(), (rows < 0).T.copy()
        self.most = np.maximum(rows.max(0), 0), np.maximum(-rows.min(0), 0)

    def search(self, own: int, query: np.ndarray, least: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of rows that may reach ``least``; all rows if it is None."""
        bounds = np.where(query > 0, query * self.most[0], -query * self.most[1])
        order = np.argsort(bounds, kind="stable")
        split = 0
        if least is not None:
            split = int(np.searchsorted(np.cumsum(bounds[order]), least, side="left"))  # these stay below least together
        essential, others = order[split:], order[:split][::-1]
        alive = self.ids != own
        if least is not None and least > 0:
            postings = [self.has[0 if query[d] > 0 else 1][d] for d in essential if query[d]]
            alive = alive & np.logical_or.reduce(postings) if postings else np.zeros(len(self.ids), bool)
        at = np.flatnonzero(alive)
        scores, rest = np.zeros(len(at), np.int64), int(bounds.sum())
        for terms in [*np.array_split(essential, max(1, -(-len(essential) // PROBES))), *np.array_split(others, max(1, -(-len(others) // PROBES)))]:
            if not len(terms):
                continue
            scores = scores + self.rows[at[:, None], terms] @ query[terms]
            rest -= int(bounds[terms].sum())
            if least is not None:
                competes = scores + rest >= least
                at, scores = at[competes], scores[competes]
            if not len(at):
                break
        return self.ids[at], scores


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _searched(queries: pa.Table, shard: pa.Table, k: int) -> pa.Table:
    out = [[], [], []]
    if queries.num_rows and shard.num_rows:
        lists = queries.column("vector"), shard.column("vector")
        width = max(1, *(max(map(len, x.to_pylist())) for x in lists))
        wanted, rows = (matrix(x, width) for x in lists)
        ids = shard.column("id").to_numpy()
        slices = [Slice(ids[s : s + SLICE_ROWS], rows[s : s + SLICE_ROWS]) for s in range(0, len(ids), SLICE_ROWS)]
        for own, query in zip(queries.column("id").to_pylist(), wanted):
            top = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for part in slices:
                found = part.search(own, query, int(top[1][-1]) if len(top[1]) == k else None)
                top = best(np.concatenate([top[0], found[0]]), np.concatenate([top[1], found[1]]), k)
            out[0].append(np.full(len(top[0]), own, np.int64))
            out[1].append(top[0])
            out[2].append(top[1])
    columns = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
    return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, columns))))


def top_k(vectors: DataFrame, queries: DataFrame, *, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of ``vectors`` with the highest integer inner products for each row of ``queries``.

    Components x count as floor(scale * x); ties go to the smaller id.
    """
    python_tasks(vectors.sparkSession)
    vectors = scaled(vectors, id_col, vector_col, scale)
    queries = scaled(queries, id_col, vector_col, scale).groupBy("id").agg(F.min("vector").alias("vector"))
    shards = max(1, -(-vectors.count() // SHARD_ROWS))
    blocks = max(1, -(-queries.count() // QUERY_ROWS))
    all_of = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    rows = vectors.select("*", F.pmod(F.xxhash64("id"), F.lit(shards)).alias("shard"), all_of(blocks).alias("block"))
    wanted = queries.select("*", all_of(shards).alias("shard"), F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"))

    def searched(left, right):
        return _searched(left, right, k)

    found = wanted.groupBy("shard", "block").cogroup(rows.groupBy("shard", "block")).applyInArrow(searched, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
