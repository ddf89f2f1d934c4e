"""Whitening of embeddings by principal components found in exact arithmetic.

Entries become whole numbers (steps of 1/64), so their products add up without rounding: tasks emit the sums of all products
of two dimensions, Spark adds them, and the driver holds n times the scatter matrix exactly, whatever the order of rows. Its characteristic
polynomial is computed modulo one prime per row of a small job, the residues are put together on the driver, roots are isolated to 96
bits after the point and each component is solved in a task of its own (``exact_spectrum``). The number of primes grows with the square of the
dimension, not with the corpus. Rows are then centred with whole numbers and projected in doubles.

Cases. A row whose vector is null or holds null or non-finite entries is dropped, and so is one with an entry that does not fit a long
after scaling or with another length than the most frequent one (of equally frequent lengths, the longest). Repeated rows count as often as they
occur. Components of eigenvalue zero have no scale and are left out; equal eigenvalues share a space, in which any orthonormal vectors are chosen.
Empty tables, and those whose vectors are all equal, give no rows. All columns are kept in ``doc``, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import ROW, map_batches, schema_of, written
from tallyloom.llm.exact_spectrum import FRACTION, Roots, combined, enough_primes, null_space, polynomial_modulo

STEPS, SHIFT = 64, 1_000_000
#: Sums of products of numbers below 2 ** LIMB over BLOCK rows are whole in doubles; FLUSH blocks fit an int64.
LIMB, BLOCK, FLUSH = 20, 8192, 64


@dataclass(frozen=True)
class Whitening:
    dims: int
    n: int
    sums: list[int]  #: of the scaled entries without SHIFT
    vectors: np.ndarray  #: one component a row, by falling eigenvalue
    deviations: np.ndarray  #: square roots of the eigenvalues
    explained: list[float]


def scaled_rows(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the usable vectors in a batch, and their entries as whole steps."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(lengths) - lengths
    at = np.flatnonzero((lengths == dims) & column.is_valid().to_numpy(zero_copy_only=False))
    with np.errstate(over="ignore", invalid="ignore"):
        steps = np.floor(STEPS * entries[starts[at][:, None] + np.arange(dims)])
        usable = (np.abs(steps) < 2.0**62).all(axis=1)  # false for NaN and infinity too
    return at[usable], steps[usable].astype(np.int64)


def _limbs(y: np.ndarray) -> list[np.ndarray]:
    """``y`` as a sum of parts times powers of 2 ** LIMB, the last part with the sign."""
    out = []
    while np.abs(y).max(initial=0) >> LIMB:
        out.append(y & ((1 << LIMB) - 1))
        y = y >> LIMB
    return [x.astype(np.float64) for x in [*out, y]]


def products(vectors: DataFrame, dims: int) -> np.ndarray:
    """Exact sums of y_i * y_j over all usable rows, with a last dimension that is always one; at most dims squared rows reach the driver."""
    width = dims + 1

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        blocks = 0

        def out():
            upper = np.triu_indices(width)
            for level, total in held.items():
                value = total[upper]
                some = np.flatnonzero(value)
                columns = [upper[0][some], upper[1][some], np.full(len(some), level), value[some]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["i", "j", "level", "value"])
            held.clear()

        for batch in batches:
            _, y = scaled_rows(batch.column(0), dims)
            for a in range(0, len(y), BLOCK):
                block = y[a : a + BLOCK]
                parts = _limbs(np.hstack([block, np.ones((len(block), 1), np.int64)]))
                for p, left in enumerate(parts):
                    for q, right in enumerate(parts):
                        total = held.setdefault(p + q, np.zeros((width, width), np.int64))
                        total += (left.T @ right).astype(np.int64)
                blocks += 1
                if blocks % FLUSH == 0:
                    yield from out()
        yield from out()

    summed = map_batches(vectors, add, "i long, j long, level long, value long").groupBy("i", "j", "level").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    total = np.zeros((width, width), dtype=object)
    for r in summed.collect():
        total[r.i, r.j] += int(r.value) << (LIMB * r.level)
    for i in range(width):
        total[i + 1 :, i] = total[i, i + 1 :]
    return total


def _each(rows: DataFrame, fn, schema: str) -> list:
    """``fn`` of every row's values, each in a task of its own as far as there are tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key, values = fn(*row)
                yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([values])], names=["key", "values"])

    return map_batches(rows, run, schema).collect()


def characteristic_polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(xI - matrix), lowest first: one row per prime, so what is collected depends on the dimension alone."""
    primes = enough_primes(matrix)
    shared = spark.sparkContext.broadcast(matrix)

    def residues(p: int):
        return p, polynomial_modulo(np.array([[x % p for x in r] for r in shared.value], np.int64).reshape(len(shared.value), -1), p).tolist()

    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(min(len(primes), spark.sparkContext.defaultParallelism))
    return combined({r.key: r["values"] for r in _each(rows, residues, "key long, values array<long>")})


def fit(vectors: DataFrame, vec_col: str = "embedding", components: int = 32) -> Whitening | None:
    """Mean and up to ``components`` components over all usable rows; None if there is no component."""
    spark = vectors.sparkSession
    held = vectors.select(F.col(f"`{vec_col}`").cast("array<double>").alias("v")).where("v is not null and size(v) > 0")
    most = held.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).head()
    if most is None:
        return None
    dims = most.dims
    total = products(held, dims)
    n, sums = int(total[dims, dims]), [int(s) for s in total[:dims, dims]]
    matrix = [[n * int(total[i, j]) - sums[i] * sums[j] for j in range(dims)] for i in range(dims)]
    trace = sum(matrix[i][i] for i in range(dims))
    if not trace:
        return None
    found = Roots(characteristic_polynomial(spark, matrix)).largest(components)
    shared = spark.sparkContext.broadcast(matrix)
    rows = spark.createDataFrame([(i, str(root), times) for i, (root, times) in enumerate(found)], "at int, root string, times int")
    rows = rows.repartition(min(len(found), spark.sparkContext.defaultParallelism))
    solved = _each(rows, lambda at, root, times: (at, null_space(shared.value, int(root), times).tolist()), "key long, values array<array<double>>")
    vector = np.array([v for r in sorted(solved) for v in r["values"]])[:components]
    roots = [root for root, times in found for _ in range(times)][:components]
    deviations = np.array([isqrt(root << FRACTION) / (n << FRACTION) for root in roots])  # roots are those of n * n * covariance
    return Whitening(dims, n, sums, vector, deviations, [root / (trace << FRACTION) for root in roots])


def _centred(y: np.ndarray, model: Whitening) -> np.ndarray:
    """n * y - sums, exact: int64 where it fits, else whole numbers of any size."""
    largest = max(int(np.abs(y).max(initial=0)) * model.n, *(abs(s) for s in model.sums))
    if largest < 1 << 61:
        return model.n * y - np.array(model.sums, np.int64)
    return model.n * y.astype(object) - np.array(model.sums, dtype=object)


def projected(vectors: DataFrame, model: Whitening, vec_col: str, keep: list[str] | None) -> DataFrame:
    """``doc``, ``deviation`` (exact sum of squares of n * x - sums) and ``w``, the whitened vector, of every usable row."""
    row = F.struct(*[F.col(f"`{c}`") for c in keep or vectors.columns]).alias(ROW)
    rows = vectors.select(row, F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            at, y = scaled_rows(batch.column(1), m.dims)
            c = _centred(y, m)
            square = c * c if c.dtype == object or np.abs(c).max(initial=0) < isqrt((1 << 62) // m.dims) else c.astype(object) ** 2
            deviation = pa.array([int(x) for x in square.sum(axis=1)], pa.decimal128(38, 0))
            w = (c / m.n).astype(np.float64) @ m.vectors.T / m.deviations
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), deviation, lists], names=[ROW, "deviation", "w"])

    return map_batches(rows, project, f"{schema_of(rows.select(ROW))}, deviation: decimal(38,0), w: array<double>")


def identity_error(whitened: DataFrame, n: int, components: int) -> float:
    """Largest entry of the covariance of column ``w`` minus the identity: means first, then products of centred values, both summed by Spark."""

    def summed(fn) -> np.ndarray:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0.0
            for batch in batches:
                total = total + fn(batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, components))
            values = np.atleast_1d(total).ravel()
            if np.ndim(total):
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["at", "value"])

        rows = map_batches(whitened.select("w"), add, "at long, value double").groupBy("at").agg(F.sum("value")).collect()
        return np.array([v for _, v in sorted(tuple(r) for r in rows)]) / n

    mean = summed(lambda w: w.sum(axis=0))
    covariance = summed(lambda w: (w - mean).T @ (w - mean)).reshape(components, components)
    return float(np.abs(covariance - np.eye(components)).max())


def with_whitened(vectors: DataFrame, vec_col: str = "embedding", components: int = 32, keep: list[str] | None = None) -> DataFrame:
    """One row per usable vector and component: ``doc`` (all columns or ``keep``), ``component`` from 1, ``n``, ``deviation`` (38-digit
    decimal), ``whitened``, ``explained`` and ``identity_error``."""
    spark = vectors.sparkSession
    row = vectors.select(F.struct(*[F.col(f"`{c}`") for c in keep or vectors.columns]).alias(ROW))
    model = fit(vectors, vec_col, components)
    if model is None:
        columns = "component: int, n: long, deviation: decimal(38,0), whitened: double, explained: double, identity_error: double"
        return spark.createDataFrame([], f"{schema_of(row)}, {columns}")
    rows = written(projected(vectors, model, vec_col, keep), "whitened")
    error = identity_error(rows, model.n, len(model.explained))
    laid = rows.select(ROW, "deviation", F.posexplode("w").alias("at", "whitened"))
    return laid.select(
        ROW,
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(F.array(*[F.lit(e) for e in model.explained]), F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
