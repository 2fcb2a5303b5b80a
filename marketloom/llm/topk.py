"""Exact top-k inner products by columnar branch and bound.

Vectors lie in blocks in vertical layout, one row per dimension. For a block of queries and a
block of candidates the products are accumulated a block of dimensions at a time. What the rest
of the dimensions can still add or take is bounded by the product of the rests' lengths; the
candidates whose best case is below the k-th best worst case are dropped and the survivors are
compacted before the next dimensions are read. Dimensions with most mass come first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.work import stored

#: Candidates and queries in a block, dimensions accumulated at a time.
CANDIDATES, QUERIES, DIMENSIONS = 4096, 512, 16
#: Blocks of queries that a task holds at a time, on average.
TOGETHER = 16
#: Vectors that decide the order of dimensions; any order gives the same result.
ORDER_SAMPLE = 10_000
LONG_MAX = 2**63 - 1


def quantised(embedding: Column) -> Column:
    """floor(256 x) of every component, x as double."""
    return F.transform(embedding, lambda x: F.floor(F.lit(256.0) * x.cast("double")))


def _usable(embedding: Column) -> Column:
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    return embedding.isNotNull() & F.coalesce(F.forall(embedding, lambda x: finite(x.cast("double"))), F.lit(False))


def _blocked(rows: DataFrame, number: Column, columns: list[str]) -> DataFrame:
    grouped = rows.withColumn("block", number).groupBy("dims", "block")
    return grouped.agg(F.collect_list(F.struct(*columns)).alias("rows"))


def _dealt(blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks))


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best candidates of every query.

    ``is_query`` is a condition on column ``vec_id``. Candidates are all rows with another id;
    ties go to the smaller id. Rows with a null id or vector, or a null or non-finite component,
    take no part, and vectors of another length than the query's are no candidates of it.
    Queries repeated with the same vector are one query; repeated candidates each count. Empty
    input gives no rows; other columns are not read. Products beyond a long are its limits.
    """
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("embedding")
    )
    rows = rows.where(F.col("vec_id").isNotNull() & _usable(F.col("embedding")))
    rows = stored(
        rows.select("vec_id", quantised(F.col("embedding")).alias("v"), F.size("embedding").alias("dims")), "vectors"
    )
    queries = rows.where(is_query).distinct()
    queries = stored(queries.withColumn("query", F.monotonically_increasing_id()), "queries")
    candidate_blocks = max(1, -(-rows.count() // CANDIDATES))
    query_blocks = max(1, -(-queries.count() // QUERIES))
    candidates = _blocked(rows, _dealt(candidate_blocks), ["vec_id", "v"])
    asked = _blocked(queries, _dealt(query_blocks), ["query", "vec_id", "v"]).select("dims", F.col("rows").alias("asked"))
    asked = asked.repartition(-(-query_blocks // TOGETHER))
    order = _dimension_order(rows)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for row in range(batch.num_rows):
                asked_rows, rows_ = batch.column("asked")[row].values, batch.column("rows")[row].values
                dims = batch.column("dims")[row].as_py()
                found = best_of_block(
                    asked_rows.field("vec_id").to_numpy(), _matrix(asked_rows, dims),
                    rows_.field("vec_id").to_numpy(), _matrix(rows_, dims), k, order.get(dims),
                )
                numbers = asked_rows.field("query").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers[found[0]]), pa.array(asked_rows.field("vec_id").to_numpy()[found[0]]),
                     pa.array(found[1]), pa.array(found[2])],
                    ["query", "query_id", "vec_id", "score"],
                )

    # Every block of candidates meets every block of queries where it lies. A copy of the queries for each
    # block of candidates was more than a driver holds, since Spark took it for small and broadcast it.
    pairs = candidates.join(asked.hint("shuffle_replicate_nl"), "dims").select("asked", "rows", "dims")
    best = pairs.mapInArrow(batches, "query long, query_id long, vec_id long, score long")
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = best.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def _matrix(rows: pa.StructArray, dims: int) -> np.ndarray:
    return rows.field("v").flatten().to_numpy().reshape(len(rows), dims)


def _dimension_order(rows: DataFrame) -> dict[int, np.ndarray]:
    """Dimensions by falling mass, per vector length; one short row per dimension."""
    count = rows.count()
    some = rows.sample(min(1.0, ORDER_SAMPLE / count), 3) if count else rows
    mass = some.select("dims", F.posexplode("v").alias("at", "x")).groupBy("dims", "at")
    found: dict[int, list[tuple[float, int]]] = {}
    for row in mass.agg(F.sum(F.col("x").cast("double") * F.col("x")).alias("mass")).collect():
        found.setdefault(row.dims, []).append((-row.mass, row.at))
    return {dims: np.array([at for _, at in sorted(parts)]) for dims, parts in found.items() if len(parts) == dims}


def best_of_block(
    query_ids: np.ndarray,
    queries: np.ndarray,
    ids: np.ndarray,
    vectors: np.ndarray,
    k: int,
    order: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query position, candidate id and score of the ``k`` best candidates of each query."""
    dims = queries.shape[1]
    order = np.arange(dims) if order is None else order
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * dims
    if largest >= 2**52:  # beyond what doubles add exactly
        return _best_of_large(query_ids, queries, ids, vectors, k)
    q = queries[:, order].astype(np.float64)
    c = np.ascontiguousarray(vectors[:, order].T, np.float64)  # a row per dimension
    edges = [*range(DIMENSIONS, dims, DIMENSIONS), dims]
    q_rest = [np.sqrt((q[:, e:] ** 2).sum(axis=1)) for e in edges]
    c_rest = [np.sqrt((c[e:] ** 2).sum(axis=0)) for e in edges]
    first = q[:, : edges[0]] @ c[: edges[0]]
    who, which, scores = [], [], []
    for i, own in enumerate(query_ids):
        alive = np.flatnonzero(ids != own)
        sums = first[i, alive]
        for step, edge in enumerate(edges):
            if step:
                low = edges[step - 1]
                sums = sums + q[i, low:edge] @ c[low:edge, alive]
            if len(alive) > k and edge < dims:
                # A little wider than exact, for the rounding of the square roots.
                rest = q_rest[step][i] * c_rest[step][alive] * (1 + 1e-9) + 1e-6
                worst = np.partition(sums - rest, len(sums) - k)[len(sums) - k]
                stay = sums + rest >= worst
                alive, sums = alive[stay], sums[stay]
        chosen = np.lexsort((ids[alive], -sums))[:k]
        who.append(np.full(len(chosen), i))
        which.append(ids[alive[chosen]])
        scores.append(sums[chosen].astype(np.int64))
    return tuple(np.concatenate([np.empty(0, np.int64), *x]).astype(np.int64) for x in (who, which, scores))


def _best_of_large(query_ids, queries, ids, vectors, k):
    """The same with whole numbers of any size, for components that are out of proportion."""
    who, which, scores = [], [], []
    large = vectors.astype(object)
    for i, own in enumerate(query_ids):
        sums = (large * queries[i].astype(object)).sum(axis=1) if len(ids) else []
        found = sorted((-s, int(v)) for s, v in zip(sums, ids, strict=True) if v != own)[:k]
        who += [i] * len(found)
        which += [v for _, v in found]
        scores += [max(-LONG_MAX - 1, min(LONG_MAX, -s)) for s, _ in found]
    return tuple(np.array(x, np.int64) for x in (who, which, scores))
