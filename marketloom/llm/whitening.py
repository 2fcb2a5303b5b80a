"""Whitening of embeddings with eigenvectors of their covariance to double precision.

Vectors are whole numbers, so sums and products are exact whatever the partitions: every task
adds up the products of its centred rows, and the driver gets one sum per pair of dimensions. The
eigenvectors are first found in single precision and then corrected by the iteration of Ogita
and Aishima, which needs matrix products only and doubles the right digits each time, in double
and then in extended precision. Eigenvalues too close for a correction are a cluster: the
matrix in the space of its vectors, less the cluster's mean, is solved on its own, where their
differences are large.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.work import stored

#: Entries become floor(SCALE * c) + SHIFT; components that are returned at most.
SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
#: Entries from here on could make a sum inexact.
LIMIT = 1 << 31
#: Corrections at most in one precision, and the eigenvalue below which a component is noise.
ROUNDS, NOISE = 12, 1e-15
WIDE = np.longdouble


def usable(vector: Column) -> Column:
    """Whether every entry is there, finite and small enough for exact sums."""
    good = F.forall(
        vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) * SCALE < LIMIT - SHIFT), F.lit(False))
    )
    return F.coalesce(good & (F.size(vector) > 0), F.lit(False))


def whole_numbers(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, x`` of the rows that take part."""
    vector = F.col("_v")
    rows = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("_v"))
    x = F.transform(vector, lambda c: (F.floor(c.cast("double") * SCALE) + SHIFT).cast("int"))
    return rows.where(usable(vector)).select("vec_id", x.alias("x"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.int64)


def _sums(rows: DataFrame, dims: int) -> list[int]:
    """Exact sum per dimension."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims, np.int64)
        for batch in parts:
            total += _matrix(batch.column("x"), dims).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims), pa.int32()), pa.array(total)], ["i", "total"])

    parts = rows.select("x").mapInArrow(batches, "i int, total long")
    found = parts.groupBy("i").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    return [int(row["total"]) for row in sorted(found, key=lambda row: row["i"])]


def _products(rows: DataFrame, middle: np.ndarray) -> np.ndarray:
    """Exact sums of the products of every two dimensions, less ``middle``, as whole numbers."""
    dims = len(middle)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims), object)
        for batch in parts:
            centred = _matrix(batch.column("x"), dims) - middle
            # Products of doubles are exact while the sums stay below their whole numbers.
            most = max(1, int(np.abs(centred).max(initial=0)))
            step = (1 << 53) // most**2
            for low in range(0, len(centred), max(1, step)):
                part = centred[low : low + max(1, step)]
                part = part.astype(np.float64) if step else part.astype(object)
                total += (part.T @ part).astype(np.int64 if step else object).astype(object)
        i, j = np.triu_indices(dims)
        sums = pa.array(list(map(str, total[i, j])), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), sums], ["i", "j", "total"])

    parts = rows.select("x").mapInArrow(batches, "i int, j int, total string")
    found = np.zeros((dims, dims), object)
    for row in parts.groupBy("i", "j").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        found[row["i"], row["j"]] = found[row["j"], row["i"]] = int(row["total"])
    return found


def _clusters(values: np.ndarray, delta: float) -> list[np.ndarray]:
    """Places of eigenvalues that follow each other within ``delta``, by value."""
    order = np.argsort(values)
    borders = np.flatnonzero(np.diff(values[order]) > delta) + 1
    return [part for part in np.split(order, borders) if len(part) > 1]


def corrected(matrix: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors in the precision of ``matrix`` from approximate vectors."""
    size, kind = len(matrix), matrix.dtype
    precision, norm = np.finfo(kind).eps, np.linalg.norm(matrix.astype(np.float64))
    vectors, identity, last = vectors.astype(kind), np.eye(size, dtype=kind), np.inf
    values = np.zeros(size, kind)
    for _ in range(ROUNDS):
        rest = identity - vectors.T @ vectors
        product = vectors.T @ (matrix @ vectors)
        # Halves that differ by rounding would be far apart after a division by a small gap.
        rest, product = (rest + rest.T) / 2, (product + product.T) / 2
        values = np.diag(product) / (1 - np.diag(rest))
        off = np.linalg.norm((product - np.diag(values)).astype(np.float64))
        delta = 2 * (off + norm * np.linalg.norm(rest.astype(np.float64)))
        # Below the rounding of the products nothing can be told apart.
        delta = max(delta, size * float(precision) * norm)
        gaps = values[None, :] - values[:, None]
        far = np.abs(gaps) > delta
        change = np.where(far, (product + values[None, :] * rest) / np.where(far, gaps, 1), rest / 2)
        clusters = _clusters(values, delta)
        vectors = vectors + vectors @ change
        for places in clusters:
            vectors[:, places] = _sub_solved(matrix, vectors[:, places], values[places].mean(), size * float(precision) * norm)
        step = float(np.abs(change).max())
        if not clusters and (step <= 4 * precision or step >= last):
            break
        last = step if not clusters else np.inf
    return values, vectors


def _sub_solved(matrix: np.ndarray, vectors: np.ndarray, mean: np.floating, noise: float) -> np.ndarray:
    """The vectors of a cluster, turned to the eigenvectors inside the space they span."""
    inside = vectors.T @ (matrix @ vectors - mean * vectors)
    inside = (inside + inside.T) / 2
    spread = np.abs(inside).max()
    if spread <= noise:
        return vectors  # equal eigenvalues: any basis is one of eigenvectors
    _, turn = np.linalg.eigh((inside / spread).astype(np.float64))
    return vectors @ turn.astype(matrix.dtype)


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns; ``matrix`` is in extended precision.

    The largest entry of a vector is positive.
    """
    scale = np.abs(matrix).max()
    if not scale:
        return np.zeros(len(matrix), WIDE), np.eye(len(matrix), dtype=WIDE)
    matrix = matrix / scale
    _, vectors = np.linalg.eigh(matrix.astype(np.float32))
    for kind in (np.float64, WIDE):
        values, vectors = corrected(matrix.astype(kind), vectors)
    vectors = vectors @ (3 * np.eye(len(matrix), dtype=WIDE) - vectors.T @ vectors) / 2
    vectors = vectors / np.sqrt((vectors * vectors).sum(axis=0))
    values = (vectors * (matrix @ vectors)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order] * scale, vectors[:, order]
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))]
    return values, vectors * np.where(largest < 0, -1, 1)


@dataclass(frozen=True)
class Whitening:
    """What tasks need to whiten a row: ``count`` vectors of ``dims`` dimensions were fitted.

    ``sums`` are per dimension, ``middle`` the whole numbers next to their means; ``weights`` has
    a column per component, the eigenvector over the root of its eigenvalue.
    """

    count: int
    sums: tuple[int, ...]
    middle: np.ndarray
    weights: np.ndarray
    explained: tuple[float, ...]

    def rest(self) -> np.ndarray:
        """Exact ``sums - count * middle``."""
        return np.array([s - self.count * m for s, m in zip(self.sums, self.middle.tolist(), strict=True)], object)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        means = (self.rest() / self.count).astype(np.float64)
        return ((x - self.middle) - means) @ self.weights

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of the squares of ``count * x - sums``, None if it is no 64-bit number."""
        centred, rest = x - self.middle, self.rest()
        most = self.count * int(np.abs(centred).max(initial=0)) + max(map(abs, rest.tolist()))
        kind = np.int64 if most**2 * len(rest) < 1 << 63 else object
        parts = self.count * centred.astype(kind) - rest.astype(kind)
        return [int(n) if n < 1 << 63 else None for n in (parts * parts).sum(axis=1)]


def fitted(fit: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of the stored distinct vectors ``x``; every one has ``dims`` entries."""
    count, sums = fit.count(), _sums(fit, dims)
    middle = np.array([round(s / count) if s < 1 << 53 else s // count for s in sums], np.int64)
    products = _products(fit, middle)
    rest = np.array([s - count * m for s, m in zip(sums, middle.tolist(), strict=True)], object)
    exact = count * products - rest[:, None] * rest[None, :]
    covariance = np.array([[WIDE(v) for v in row] for row in exact], WIDE) / WIDE(count) / WIDE(count)
    values, vectors = eigen(covariance)
    kept = [i for i in range(min(components, dims)) if values[i] > dims * NOISE * values[0] and values[i] > 0]
    weights = (vectors[:, kept] / np.sqrt(values[kept])).astype(np.float64)
    trace = np.trace(covariance)
    return Whitening(count, tuple(sums), middle, weights, tuple(float(values[i] / trace) for i in kept))


def identity_error(fit: DataFrame, whitening: Whitening) -> float:
    """Largest entry of the fitted vectors' covariance after whitening, less the identity."""
    dims, size = whitening.weights.shape
    if not size:
        return 0.0

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size))
        for batch in parts:
            found = whitening.whitened(_matrix(batch.column("x"), dims))
            total[:size] += found.T @ found
            total[size] += found.sum(axis=0)
        i, j = np.indices(total.shape)
        columns = [pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "total"])

    parts = fit.select("x").mapInArrow(batches, "i int, j int, total double")
    total = np.zeros((size + 1, size))
    for row in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        total[row["i"], row["j"]] = row["total"]
    means = total[size] / whitening.count
    return float(np.abs(total[:size] / whitening.count - np.outer(means, means) - np.eye(size)).max())


OUTPUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whiten(
    rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """A row per vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Vectors that are null or empty, hold null or non-finite entries, or entries of more than
    some thirty million, take no part; where lengths differ, only vectors of the most frequent
    one (the longest of several) do. Each distinct vector is fitted once; repeated rows and rows
    without an id give rows as any other. Components whose eigenvalue is zero, as with fewer
    vectors than dimensions or equal ones, are left out; ``deviation`` is null beyond 64 bits.
    Empty input gives no rows; other columns are not read.
    """
    numbers = stored(whole_numbers(rows, id_col, vector_col), "whole-numbers")
    size = F.size("x")
    lengths = numbers.groupBy(size.alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if lengths is None:
        return rows.sparkSession.createDataFrame([], OUTPUT)
    dims = lengths["dims"]
    numbers = numbers.where(size == dims)
    # Copies are combined before the shuffle.
    fit = stored(numbers.select("x").distinct(), "distinct-vectors")
    whitening = fitted(fit, dims, components)
    error = identity_error(fit, whitening)
    count, explained = len(whitening.explained), whitening.explained

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            x = _matrix(batch.column("x"), dims)
            ids = batch.column("vec_id").take(pa.array(np.repeat(np.arange(len(x)), count)))
            deviations = pa.array(np.repeat(np.array(whitening.deviations(x), object), count), pa.int64())
            columns = [
                ids, pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(x) * count, whitening.count, np.int64)), deviations,
                pa.array(whitening.whitened(x).ravel()), pa.array(np.tile(np.array(explained, np.float64), len(x))),
                pa.array(np.full(len(x) * count, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [name.split()[0] for name in OUTPUT.split(", ")])

    return numbers.mapInArrow(batches, OUTPUT)
