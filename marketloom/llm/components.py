"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.work import stored


def components(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """``node, root`` of every node of ``links`` (``a, b``, any order); root is the smallest.

    A round hangs the neighbours of every node first below their smallest neighbour, upwards,
    then downwards, and ends when the links no longer change. The links of a round are a
    stored table, so a lost executor costs one round. Minima are combined before the shuffle,
    and the joins are on a node with its minimum, which Spark splits if a node is hot.
    """
    smaller, larger = F.least("a", "b"), F.greatest("a", "b")
    now = links.where(F.col("a") != F.col("b")).select(larger.alias("a"), smaller.alias("b"))
    now = stored(now.distinct(), "links")
    mark = _mark(now)
    for _ in range(most_rounds):
        if not mark[0]:
            break
        now = stored(_small_star(_large_star(now)), "links")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    else:
        raise RuntimeError("components did not settle")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.unionByName(roots)


def _mark(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("hash"),
        F.expr("sum(cast(xxhash64(b, a) as decimal(38,0)))").alias("sum"),
    ).first()
    return row.n, row.hash, row.sum


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    found = both.join(least, "a").where(F.col("b") > F.col("a"))
    return found.select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").where(F.col("b") != F.col("least"))
    moved = moved.select(F.col("b").alias("a"), F.col("least").alias("b"))
    kept = least.select("a", F.col("least").alias("b"))
    return moved.unionByName(kept).distinct()
