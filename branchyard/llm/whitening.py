"""Whitening of embeddings by shifted CholeskyQR.

The rows are vectors of whole numbers x = floor(scale * component) + shift, centred by their mean.
Let A be the centred rows. A first pass over them adds up the Gram matrix of A; its Cholesky factor,
taken of the matrix with a small shift so that it exists however ill-conditioned A is, gives R1, and
A R1^-1 is nearly orthogonal. Further passes solve each row against the factors found so far, one
triangular solve for each factor, add up the Gram matrix of the result and factor it again, until
that matrix is the identity. Then A = Q R with R the product of the factors, and the singular values
and right vectors of the small matrix R are those of A: eigenvalues e = s^2 / n and unit eigenvectors
of the covariance, to double precision, though A was never in one place (Fukaya et al., 2020).

Rows are never shuffled: each pass is one scan whose tasks send one matrix of width x width numbers,
and Spark adds them up. The driver holds a few such matrices, whatever the number of rows; the width
is that of a vector. A pass that is run again after a lost executor gives the same sums.

Directions in which A has no extent (fewer rows than dimensions, constant or dependent dimensions)
cannot be whitened. They show after the first, shifted pass as eigenvalues of the Gram matrix that are
rounding alone, and are left out: such tables have fewer components.

Defined results: vectors that are null or hold a null or non-finite component take no part. Missing
trailing components count as 0, so a vector may be empty. Null ids stay null; repeated rows are rows
each. One row, equal rows and empty tables have no components and give no rows. Only the two named
columns are read. Components outside 2^52 / scale are an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchyard.llm.common import column, python_tasks, stored

#: Rows that are centred, solved and multiplied at a time.
BLOCK_ROWS = 4096
#: Gram matrices of unit scale are done when they are this near to the identity.
ORTHOGONAL = 1e-13
#: Below this share of the largest, an eigenvalue after the shifted pass is rounding: such directions
#: have less than about 1e-12 of the extent of the widest.
NO_EXTENT = 1e-14
PASSES = 8


def whole_numbers(batch: pa.RecordBatch, scale: int, shift: int, width: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Which rows take part, and their vectors as whole numbers, as wide as ``width`` or the widest of them."""
    lists = column(batch, "vector")
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    parents = pc.list_parent_indices(lists).to_numpy()
    fits = np.array(lists.is_valid())
    fits[parents[~np.isfinite(flat)]] = False
    sizes = np.where(fits, pc.fill_null(pc.list_value_length(lists), 0).to_numpy(), 0)
    flat, parents = flat[fits[parents]], parents[fits[parents]]
    scaled = np.floor(scale * flat)
    if len(scaled) and np.abs(scaled).max() > 2.0**52:
        raise ValueError("a component is too large to be a whole number of this scale")
    out = np.zeros((len(fits), width or max(1, int(sizes.max(initial=0)))), np.int64)
    out[parents, np.arange(len(parents)) - (np.cumsum(sizes) - sizes)[parents]] = scaled.astype(np.int64)
    return np.flatnonzero(fits), out[fits] + shift


def solved(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """rows @ factor^-1 by forward substitution, for an upper triangular factor."""
    out = np.empty((rows.shape[1], len(rows)))
    for k in range(len(out)):
        out[k] = (rows[:, k] - factor[:k, k] @ out[:k]) / factor[k, k]
    return out.T


#: What has been found of R so far: upper triangular factors to solve against, and bases of the
#: directions with extent to go over to.
Steps = list[tuple[str, np.ndarray]]


def orthogonalised(rows: np.ndarray, steps: Steps) -> np.ndarray:
    for kind, matrix in steps:
        rows = solved(rows, matrix) if kind == "solve" else rows @ matrix
    return rows


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n with one rounding, as n * x - sums is a whole number."""
    if n * int(np.abs(x).max(initial=0)) + int(max(map(abs, sums), default=0)) < 2**62:
        return (n * x - np.array(sums, np.int64)).astype(np.float64) / n
    return ((n * x.astype(object) - np.array(sums, object)) / n).astype(np.float64)


def squared_distances(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """The exact sum of (n * x - sums)^2 of each row."""
    if n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0) < 2**62:
        away = n * x - np.array(sums, np.int64)
        if int(np.abs(away).max(initial=0)) ** 2 * max(1, len(sums)) < 2**63:
            return (away * away).sum(1).tolist()
    away = n * x.astype(object) - np.array(sums, object)
    return [int(d) for d in (away * away).sum(1)]


def _sums(batches: Iterator[pa.RecordBatch], scale: int, shift: int) -> Iterator[pa.RecordBatch]:
    """Of a task: rows, and sums of the components without the shift, as a narrower batch adds nothing to the rest."""
    n, sums = 0, []
    for batch in batches:
        _, x = whole_numbers(batch, scale, 0, None)
        n += len(x)
        if len(x):
            own = [int(s) for s in x.sum(0)] if np.abs(x).max() < 2**62 // len(x) else [int(s) for s in x.astype(object).sum(0)]
            sums = [a + b for a, b in zip(sums + [0] * (len(own) - len(sums)), own + [0] * (len(sums) - len(own)))]
    if n:
        whole = pa.array([sums], pa.list_(pa.decimal128(38)))
        yield pa.record_batch({"n": pa.array([n], pa.int64()), "sums": whole})


def _gram(batches: Iterator[pa.RecordBatch], rows_of: Callable, steps: Steps) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        rows = rows_of(batch)
        for at in range(0, len(rows), BLOCK_ROWS):
            q = orthogonalised(rows[at : at + BLOCK_ROWS], steps)
            total = q.T @ q if total is None else total + q.T @ q
    if total is not None:
        yield pa.record_batch({"i": pa.array(range(len(total)), pa.int32()), "row": pa.array(list(total), pa.list_(pa.float64()))})


def gram(vectors: DataFrame, rows_of: Callable, steps: Steps, width: int) -> np.ndarray:
    """The Gram matrix of all rows after the steps: one matrix a task, added up by Spark."""
    parts = vectors.mapInArrow(lambda batches: _gram(batches, rows_of, steps), "i int, row array<double>")
    cells = parts.select("i", F.posexplode("row").alias("j", "value"))
    found = cells.groupBy("i", "j").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros((width, width))
    out[found.column("i").to_numpy(), found.column("j").to_numpy()] = found.column("value").to_numpy()
    return (out + out.T) / 2


def triangular_factor(vectors: DataFrame, rows_of: Callable, width: int) -> np.ndarray:
    """R with A^T A = R^T R, of as many rows as A has directions with extent; none for A = 0."""
    product = gram(vectors, rows_of, [], width)
    largest = float(np.linalg.eigvalsh(product)[-1])
    if largest <= 0:
        return np.zeros((0, width))
    steps: Steps = []
    r = np.eye(width)
    for number in range(PASSES):
        if number:
            product = gram(vectors, rows_of, steps, len(r))
            values, directions = np.linalg.eigh(product)
            some = values > NO_EXTENT * values[-1]
            if not some.all():
                basis = directions[:, some]
                steps.append(("basis", basis))
                r, product = basis.T @ r, np.diag(values[some])
            if np.abs(product - np.eye(len(r))).max() <= ORTHOGONAL:
                break
        values = np.linalg.eigvalsh(product)
        rounding = 11 * len(r) * (BLOCK_ROWS + len(r) + 1) * np.finfo(float).eps * values[-1]
        shift = rounding if not number or values[0] < 1e3 * rounding else 0.0
        factor = np.linalg.cholesky(product + shift * np.eye(len(r))).T
        steps.append(("solve", factor))
        r = factor @ r
    return r


def whiten(
    vectors: DataFrame, *, components: int = 8, scale: int = 1024, shift: int = 100_000, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of each row and component.

    ``n`` rows take part. ``deviation``, a decimal, is the exact sum over dimensions of
    (n * x - sum of x)^2. Components are numbered from 1 by falling eigenvalue e; ``whitened`` is
    (x - mean) projected on the component, over sqrt(e); ``explained`` is e over the sum of all.
    ``identity_error`` is one value for all rows: the largest absolute entry of the covariance of
    ``whitened`` minus the identity, measured on the rows as they are returned.
    """
    spark = vectors.sparkSession
    python_tasks(spark)
    vectors = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    parts = vectors.mapInArrow(lambda batches: _sums(batches, scale, shift), "n long, sums array<decimal(38,0)>")
    parts = parts.select("n", F.posexplode_outer("sums").alias("j", "value"))
    sums = parts.groupBy("j").agg(F.sum("n").alias("n"), F.sum("value").alias("value")).collect()
    n = max((row["n"] for row in sums if row["j"] == 0), default=0)
    width = len(sums)
    totals = [0] * width
    for row in sums:
        totals[row["j"]] = int(row["value"]) + shift * n

    def rows_of(batch):
        return centred(whole_numbers(batch, scale, shift, width)[1], n, totals)

    r = triangular_factor(vectors, rows_of, width) if n else np.zeros((0, 0))
    _, singular, axes = np.linalg.svd(r, full_matrices=False) if r.size else (None, np.zeros(0), np.zeros((0, width)))
    eigenvalues = singular**2 / max(n, 1)
    first = axes[:components].T / np.sqrt(eigenvalues[:components])
    k = first.shape[1]
    explained = (eigenvalues / eigenvalues.sum())[:k] if k else eigenvalues

    def projected(batches):
        for batch in batches:
            at, x = whole_numbers(batch, scale, shift, width)
            a = centred(x, n, totals)
            yield pa.record_batch({
                "vec_id": column(batch, "vec_id").take(pa.array(at)),
                "deviation": pa.array(squared_distances(x, n, totals), pa.decimal128(38)),
                "whitened": pa.array(list(a @ first), pa.list_(pa.float64())),
            })

    if not k:
        vectors = vectors.limit(0)
    rows = stored(vectors.mapInArrow(projected, "vec_id long, deviation decimal(38,0), whitened array<double>"), "whitened")
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    error = 0.0
    if pairs:
        # covar_pop centres as it goes, over all returned rows
        entries = [F.abs(F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]) - float(i == j)).alias(f"c{i}_{j}") for i, j in pairs]
        error = max(rows.agg(*entries).first())
    shares = F.array(*[F.lit(float(e)) for e in explained]).cast("array<double>")
    rows = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(float(error)).alias("identity_error"),
    )
