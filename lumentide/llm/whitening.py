"""Whitening of embeddings with components from an exact characteristic polynomial.

Vectors become integers; the distinct ones are the sample. Their scatter matrix, in exact
integers, is summed by tasks and by Spark; it has as many rows as a vector has components
and is all that reaches the driver. Its characteristic polynomial is computed modulo
primes dealt out to tasks (see `spectrum`).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lumentide.llm.common import on_own_columns, with_arrow_columns, written
from lumentide.llm.spectrum import (
    coefficient_bound, eigenvectors, enough_primes, from_residues, largest_roots,
    polynomial_modulo,
)
from lumentide.llm.vectors import (
    exact_gram, is_valid, join_decimal, magnitude, matrix, most_common_size, split_decimal,
    to_integers,
)
from lumentide.session import remove_dir, shared_dir


@dataclass(frozen=True)
class Whitening:
    """A fitted projection: `n` distinct vectors of `dim` components with their `sums`.

    `directions` has a unit eigenvector of the covariance per component, `variances` its
    eigenvalues, falling, `explained` their share in the trace (NULL where that is zero).
    `identity_error` is the largest entry, in magnitude, of the sample's whitened covariance
    minus the identity; NULL where no component varies.
    """

    dim: int
    n: int
    sums: tuple[int, ...]
    directions: tuple[tuple[float, ...], ...]
    variances: tuple[float, ...]
    explained: tuple[float | None, ...]
    identity_error: float | None = None

    @property
    def varying(self) -> int:
        """Components whose variance is not zero: the first ones."""
        return sum(v > 0 for v in self.variances)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """`n * x - sums`, as long where that is exact, else as Python integers."""
        reach = self.n * magnitude(x) + max(map(abs, self.sums), default=0)
        sums = np.array(self.sums, object)
        if reach >> 62:
            return self.n * x.astype(object) - sums
        return self.n * x - sums.astype(np.int64)

    def squared(self, y: np.ndarray) -> list[int | None]:
        """Exact sums of squares of each row of deviations, None beyond a long."""
        top, bits = magnitude(y), self.dim.bit_length()
        if not (top * top * self.dim) >> 62:
            return (y * y).sum(axis=1).tolist()
        width = (62 - bits) // 2
        if top >> (2 * width):
            sums = [sum(v * v for v in row) for row in y.tolist()]
        else:  # two limbs: their products are exact, the sums are put together exactly
            high, low = y >> width, y & ((1 << width) - 1)
            sums = [(a << 2 * width) + (b << width + 1) + c for a, b, c in zip(
                (high * high).sum(axis=1).tolist(), (high * low).sum(axis=1).tolist(),
                (low * low).sum(axis=1).tolist())]
        return [s if s < 1 << 63 else None for s in sums]

    def project(self, y: np.ndarray) -> np.ndarray:
        """Whitened values of rows of deviations, for the varying components."""
        k = self.varying
        directions = np.array(self.directions[:k]).reshape(k, self.dim).T
        centred = (y.astype(np.float64) / self.n)
        return centred @ directions / np.sqrt(np.array(self.variances[:k]))


def _scatter(x: DataFrame, dim: int) -> tuple[int, list[int], list[list[int]]]:
    """Number of vectors, their sums and sums of products, all exact.

    A task sends one row for each pair of components, whatever the number of its vectors.
    """
    schema = "i int, j int, high decimal(38,0), low decimal(38,0)"
    arrow = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("high", pa.decimal128(38, 0)),
                       ("low", pa.decimal128(38, 0))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim + 1, dim + 1), object)  # the last column is all ones
        for batch in batches:
            if batch.num_rows:
                rows = matrix(batch.column(0), dim)
                total += exact_gram(np.hstack([rows, np.ones((len(rows), 1), np.int64)]))
        if total[dim, dim]:
            at_i, at_j = np.triu_indices(dim + 1)
            parts = [split_decimal(int(v)) for v in total[at_i, at_j]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(at_i, pa.int32()), pa.array(at_j, pa.int32()),
                 pa.array([p[0] for p in parts], pa.decimal128(38, 0)),
                 pa.array([p[1] for p in parts], pa.decimal128(38, 0))], schema=arrow)

    sums = x.mapInArrow(run, schema).groupBy("i", "j").agg(
        F.sum("high").alias("high"), F.sum("low").alias("low"))
    g = [[0] * (dim + 1) for _ in range(dim + 1)]
    for r in sums.collect():
        g[r["i"]][r["j"]] = g[r["j"]][r["i"]] = join_decimal(r["high"], r["low"])
    return g[dim][dim], g[dim][:dim], [row[:dim] for row in g[:dim]]


def _polynomial(spark, a: list[list[int]]) -> list[int]:
    """The characteristic polynomial, its primes dealt out to tasks."""
    primes = enough_primes(coefficient_bound(a))
    shared = spark.sparkContext.broadcast(a)
    d, at_once = len(a), max(1, (1 << 19) // len(a) ** 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_pylist()
            for i in range(0, len(own), at_once):
                found = polynomial_modulo(shared.value, own[i:i + at_once])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[i:i + at_once], pa.int64()),
                     pa.array(found.tolist(), pa.list_(pa.int64()))], names=["p", "residues"])

    tasks = -(-len(primes) // at_once) if d > 8 else 1
    dealt = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks, "p")
    by = {r["p"]: r["residues"] for r in
          dealt.mapInArrow(run, "p long, residues array<long>").collect()}
    shared.destroy()
    return from_residues(primes, [by[p] for p in primes])


def _identity_error(x: DataFrame, model: Whitening) -> float | None:
    """Measured on the whitened sample in one more pass over it."""
    k = model.varying
    if not k:
        return None
    schema = T.StructType([T.StructField(f"s{i}", T.DoubleType()) for i in range(k + k * k)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k)
        for batch in batches:
            if batch.num_rows:
                w = model.project(model.deviations(matrix(batch.column(0), model.dim)))
                total += np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array([v]) for v in total], names=schema.fieldNames())

    # The values are centred: their means are rounding errors, and products of them less.
    sums = np.array(x.mapInArrow(run, schema).agg(
        *[F.sum(c).alias(c) for c in schema.fieldNames()]).first(), float) / model.n
    covariance = sums[k:].reshape(k, k) - np.outer(sums[:k], sums[:k])
    return float(np.abs(covariance - np.eye(k)).max())


def fit_whitening(
    df: DataFrame, components: int = 4, vec_col: str = "embedding",
) -> Whitening | None:
    """Learn the projection from all distinct vectors; None if there are none.

    A vector counts if it has components, none NULL or not finite, and is as long as most
    distinct vectors are (the longer of two lengths as common). Copies are dropped before
    the shuffle, so a vector in a third of all rows is one row per task.

    Integers are exact throughout, so centring before or after multiplying is the same: the
    matrix n * sum(x x') - sum(x) sum(x)' is n squared times the covariance.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "whitening")
    x = df.filter(is_valid(vec_col)).select(to_integers(vec_col).alias("x")).distinct()
    written_x = written(x.withColumn("size", F.size("x")), path=path)
    try:
        dim = most_common_size(written_x, "size")
        if dim is None:
            return None
        sample = written_x.filter(F.col("size") == dim).select("x")
        n, sums, products = _scatter(sample, dim)
        a = [[n * products[i][j] - sums[i] * sums[j] for j in range(dim)] for i in range(dim)]
        trace, k = sum(a[i][i] for i in range(dim)), min(components, dim)
        values: list[Fraction] = []
        directions: list[tuple[float, ...]] = []
        for root, times in largest_roots(_polynomial(spark, a), k) if trace else []:
            for vector in eigenvectors(a, root, min(times, k - len(values))):
                values.append(root)
                directions.append(tuple(vector.tolist()))
        idle = k - len(values)
        model = Whitening(
            dim, n, tuple(sums), (*directions, *[(0.0,) * dim] * idle),
            (*(float(v / n ** 2) for v in values), *[0.0] * idle),
            tuple(float(v / trace) if trace else None for v in [*values, *[Fraction()] * idle]))
        return Whitening(**{**vars(model), "identity_error": _identity_error(sample, model)})
    finally:
        remove_dir(spark, path)


def whiten(df: DataFrame, model: Whitening | None, vec_col: str = "embedding") -> DataFrame:
    """Add `whitened` (array, a value per component) and `deviation` to rows that count.

    `deviation` is the sum over components of (n * x - sums) squared, exact, NULL where it
    is too large for a long. Values of a component without variance are NULL. Rows whose
    vector doesn't count (see `fit_whitening`; also one of another length) are dropped; rows
    with a NULL id or label and repeated rows stay. Columns named like the two are replaced.
    Narrow: no shuffle.
    """
    added = [T.StructField("whitened", T.ArrayType(T.DoubleType())),
             T.StructField("deviation", T.LongType())]
    dim = model.dim if model else -1

    def computed(lists: pa.Array) -> list[pa.Array]:
        y = model.deviations(matrix(lists, dim))
        idle = [None] * (len(model.variances) - model.varying)
        values = [[*row, *idle] for row in model.project(y).tolist()]
        return [pa.array(values, pa.list_(pa.float64())), pa.array(model.squared(y), pa.int64())]

    def apply(own: DataFrame) -> DataFrame:
        x = own.filter(is_valid(vec_col)).withColumn("_x", to_integers(vec_col)).filter(
            F.size("_x") == dim)
        return with_arrow_columns(x, computed, ["_x"], added, drop=["_x"])

    return on_own_columns(df, apply, keep=[vec_col], add=["whitened", "deviation"])
