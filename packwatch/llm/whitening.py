"""Embedding whitening by shifted Cholesky QR: Gram passes over centred rows, then an SVD of R."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packwatch.llm.common import settle, table

#: Fixed-point steps in one unit of a component.
SCALE = 256
COMPONENTS = 4
#: Groups in which the tasks' matrices are added before the driver adds the rest.
GROUPS = 32
#: Largest entry of Q'Q - I at which Q counts as orthonormal, and the most Gram passes until then.
ORTHONORMAL = 1e-12
PASSES = 8
#: Share of the largest eigenvalue below which a component has no variance.
FLAT = 1e-14
#: Bound on integers that numpy may add without care.
SAFE = float(1 << 62)
UNIT = float(np.finfo(float).eps) / 2


def _lists(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def fixed_point(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """Rows (id, x): floor(256 c) of each component; rows without a value for each are left out."""
    rows = vectors.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector_column}`").cast("array<double>").alias("c"))
    step = F.transform("c", lambda c: F.floor(c * F.lit(float(SCALE))))
    # a component beyond the range of a long is as useless as an infinite one; NaN is greater than all
    whole = F.forall("c", lambda c: c.isNotNull() & (F.abs(c) < F.lit(SAFE / SCALE)))
    return rows.where(F.col("c").isNotNull() & (F.size("c") > 0) & whole).select("id", step.alias("x"))


def summed(rows: DataFrame, column: str, size: int, part) -> np.ndarray:
    """The sum over all rows of an array of ``size`` doubles that ``part`` makes of a batch.

    Tasks add up their own rows, GROUPS tasks of a second step those of the first, the driver the rest.
    """

    def first(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += part(batch.column(column))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    def second(batches):
        total = np.zeros(size)
        for batch in batches:
            for one in batch.column("total").to_pylist():
                total += np.frombuffer(one)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    tasks = rows.mapInArrow(first, "total binary").withColumn("at", F.pmod(F.spark_partition_id(), F.lit(GROUPS)))
    found = tasks.repartition(GROUPS, "at").select("total").mapInArrow(second, "total binary").collect()
    return sum((np.frombuffer(r["total"]) for r in found), np.zeros(size))


def sums_of(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """The number of rows and the exact sum of each dimension."""

    def run(batches):
        rows, total = 0, [0] * dims
        for batch in batches:
            x = _lists(batch.column("x"), dims)
            if not len(x):
                continue
            rows += len(x)
            if float(np.abs(x).max()) * len(x) >= SAFE:
                x = x.astype(object)
            total = [a + int(b) for a, b in zip(total, x.sum(axis=0), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([rows] * dims, pa.int64()),
                pa.array(range(dims), pa.int32()),
                pa.array([str(t) for t in total], pa.string()),
            ],
            ["rows", "dim", "total"],
        )

    parts = fit.mapInArrow(run, "rows long, dim int, total string")
    found = parts.groupBy("dim").agg(F.sum("rows").alias("rows"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    by_dim = {r["dim"]: r for r in found.collect()}
    return (by_dim[0]["rows"] if by_dim else 0), [int(by_dim[i]["total"]) for i in range(len(by_dim))]


def _scaled(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: 64-bit where it fits."""
    if (float(np.abs(x).max(initial=0)) * n + max(map(abs, sums), default=0)) < SAFE:
        return x * n - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n, rounded once."""
    return (_scaled(x, n, sums) / n).astype(float)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum of (n x - S)^2 of each row, exact."""
    y = _scaled(x, n, sums)
    if float(np.abs(y).max(initial=0)) ** 2 * max(y.shape[1], 1) >= SAFE:
        y = y.astype(object)
    return [int(v) for v in (y * y).sum(axis=1)]


def solved(y: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """Rows of Q = Y inv(R1) inv(R2) ...: a triangular solve for each factor."""
    for r in factors:
        y = np.linalg.solve(r.T, y.T).T
    return y


def gram_of(fit: DataFrame, dims: int, n: int, sums: list[int], factors: list[np.ndarray]) -> np.ndarray:
    def part(column: pa.Array) -> np.ndarray:
        q = solved(centred(_lists(column, dims), n, sums), factors)
        return (q.T @ q).ravel()

    return summed(fit, "x", dims * dims, part).reshape(dims, dims)


def triangular(fit: DataFrame, dims: int, n: int, sums: list[int]) -> tuple[np.ndarray, int]:
    """R of the centred rows Y = Q R (Q'Q = I), and the Gram passes it took.

    Each pass factors the Gram matrix of Q so far; the first, and any whose factor fails, is shifted so that
    Cholesky cannot break down. What is left of Q'Q after the last pass enters by its symmetric root,
    which also serves rows of deficient rank, where no pass makes Q orthonormal.
    """
    factors: list[np.ndarray] = []
    r = np.eye(dims)
    for done in range(1, PASSES + 1):
        gram = gram_of(fit, dims, n, sums, factors)
        if np.abs(gram - np.eye(dims)).max() <= ORTHONORMAL or not np.trace(gram):
            break
        shift = 11 * (n * dims + dims * (dims + 1)) * UNIT * float(np.trace(gram))
        try:
            if not factors:
                raise np.linalg.LinAlgError
            factor = np.linalg.cholesky(gram).T
        except np.linalg.LinAlgError:
            # a shift above the trace would be none: many rows let it grow with n
            factor = np.linalg.cholesky(gram + min(shift, 1e-4 * float(np.trace(gram))) * np.eye(dims)).T
        if done == PASSES:
            break
        factors.append(factor)
        r = factor @ r
    values, vectors = np.linalg.eigh(gram)
    return np.sqrt(np.maximum(values, 0))[:, None] * (vectors.T @ r), done


def components_of(r: np.ndarray, n: int, count: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues of the covariance, falling, their vectors as rows, and the trace.

    The entry of a vector that is largest without its sign is positive.
    """
    _, singular, vectors = np.linalg.svd(r)
    values = singular**2 / n
    for row in vectors:
        if row[np.argmax(np.abs(row))] < 0:
            row *= -1
    return values[:count], vectors[:count], float(values.sum())


def whitened(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", count: int = COMPONENTS
) -> DataFrame:
    """Rows (id, component, n, deviation, whitened, explained, identity_error) of every usable vector.

    Vectors that are null or empty, or hold a null, a non-finite component or one beyond the range of a
    long, are left out; so are those whose length is not the most frequent one (of equally frequent ones the
    greatest). Repeated ids and vectors are all returned; statistics are over each distinct fixed-point vector once.
    A component without variance has null ``whitened`` and stays out of ``identity_error``, which is
    null if none is left; without any variance ``explained`` is null. A deviation beyond a long is null. Fewer
    dimensions than ``count`` give fewer components. Other columns may have any name; an empty table
    gives no rows.

    Distinct vectors are found by one shuffle and stored once. Every pass over them leaves a matrix
    of dims x dims per task, added in two steps.
    """
    id_kind = vectors.schema[id_column].dataType.simpleString()
    columns = f"id {id_kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    spark = vectors.sparkSession
    rows = fixed_point(vectors, id_column, vector_column)
    fit = settle(rows.select("x").distinct(), "whitening-fit")
    lengths = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.col("count").desc(), F.col("dims").desc()).first()
    if lengths is None:
        return spark.createDataFrame([], columns)
    dims = lengths["dims"]
    fit, rows = (df.where(F.size("x") == dims) for df in (fit, rows))
    n, sums = sums_of(fit, dims)
    r, _ = triangular(fit, dims, n, sums)
    values, axes, trace = components_of(r, n, count)
    seen = values > FLAT * max(float(values.max(initial=0)), 0.0)
    roots = np.sqrt(np.where(seen, values, 1.0))

    def projected(x: np.ndarray) -> np.ndarray:
        return centred(x, n, sums) @ axes.T / roots

    def moments(column: pa.Array) -> np.ndarray:
        w = projected(_lists(column, dims))
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    k = len(values)
    total = summed(fit, "x", k + k * k, moments)
    mean, second = total[:k] / n, total[k:].reshape(k, k) / n
    rest = np.abs(second - np.outer(mean, mean) - np.eye(k))[np.ix_(seen, seen)]
    error = float(rest.max()) if rest.size else None
    shares = [float(v) / trace if trace else None for v in values]

    def run(batches):
        for batch in batches:
            x = _lists(batch.column("x"), dims)
            if not len(x):
                continue
            w = np.where(seen, projected(x), np.nan).ravel()
            each = np.repeat(np.arange(len(x)), k)
            far = [d if d < 1 << 63 else None for d in deviations(x, n, sums)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), n)),
                    pa.array(far, pa.int64()).take(pa.array(each)),
                    pa.array(w, pa.float64(), mask=np.isnan(w)),
                    pa.array(shares * len(x), pa.float64()),
                    pa.array([error] * len(each), pa.float64()),
                ],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, columns)


def whitened_embeddings(spark, folder: str) -> DataFrame:
    """op11: the first four whitened components of every vector."""
    return whitened(table(spark, folder, "embeddings")).withColumnRenamed("id", "vec_id")

