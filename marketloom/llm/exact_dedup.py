"""Exact dedup by content sort.

Sampled splitters range-partition the normalised bytes, each range is sorted externally so
that equal texts are adjacent, and comparing every text with its neighbour in full finds the
runs. Only DataFrame functions run.

The order is: leading bytes, digest of all bytes, all bytes, identifier. Equal texts are
adjacent under it, and the splitters, which end with the identifier, stay short. A text held
by a third of all rows is thus cut at identifiers into many ranges; a run that crosses range
borders is put together again from the two outer runs of each range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.work import shuffle_partitions, stored, whole_text

WHITE = r"[\x20\x09-\x0D]+"
HEAD_BYTES = 16
#: Rows sampled per range to choose splitters, and the most rows sampled in all.
SAMPLE_PER_RANGE, SAMPLE_ROWS = 20, 200_000


def normal_text(name: str) -> Column:
    """The text with each run of white space as one space; null is empty."""
    return F.regexp_replace(whole_text(name), WHITE, " ")


def _head(text: Column) -> Column:
    return F.substring(text.cast("binary"), 1, HEAD_BYTES)


def _sort_key(text: Column, identifier: Column) -> Column:
    """Leading bytes, digest and identifier as one text of fixed width, null ids last."""
    place = identifier.cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")
    return F.concat(
        F.rpad(F.hex(_head(text)), 2 * HEAD_BYTES, "0"),
        F.sha2(text, 256),
        F.coalesce(F.lpad(place.cast("decimal(20,0)").cast("string"), 20, "0"), F.lit("~")),
    )


def _range_of(key: Column, splitters: list[str]) -> Column:
    """The number of splitters at or below the key, looked up in two steps."""
    if not splitters:
        return F.lit(0)
    step = max(1, int(len(splitters) ** 0.5))
    blocks = [splitters[i : i + step] for i in range(0, len(splitters), step)]
    first = F.array(*[F.lit(block[0]) for block in blocks])
    rest = F.array(*[F.array(*[F.lit(x) for x in block]) for block in blocks])

    def search(k: Column) -> Column:
        block = F.size(F.filter(first, lambda x: x <= k))
        inside = F.size(F.filter(F.get(rest, block - 1), lambda x: x <= k))
        return F.when(block == 0, 0).otherwise((block - 1) * step + inside)

    # The one-element array makes the key be computed once, not at every comparison.
    return F.get(F.transform(F.array(key), search), 0)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row of ``docs``.

    Null texts are empty texts and equal to them. In a group the row with the smallest id
    stays; null ids come last, and a group of null ids only keeps one row with a null
    ``keep_id``. Of rows equal in id and text one stays. Empty input gives no rows; other
    columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), normal_text(text_col).alias("norm"))
    ranges = shuffle_partitions(spark)
    splitters = _splitters(rows, ranges)
    placed = rows.select(
        _range_of(_sort_key(F.col("norm"), F.col("doc_id")), splitters).cast("int").alias("range"),
        "doc_id",
        "norm",
        F.unhex(F.sha2("norm", 256)).alias("sha"),
    ).repartitionById(len(splitters) + 1, "range")

    # Neighbours are compared in full: a run starts where the text differs from the one before.
    order = Window.partitionBy("range").orderBy(
        _head(F.col("norm")), "sha", "norm", F.col("doc_id").asc_nulls_last()
    )
    before, after = F.lag("norm").over(order), F.lead("norm").over(order)
    compared = placed.select(
        "range",
        "doc_id",
        "sha",
        F.row_number().over(order).alias("place"),
        F.when(before.isNull() | (before != F.col("norm")), 1).otherwise(0).alias("starts"),
        F.when(before.isNull(), F.col("norm")).alias("first_text"),
        F.when(after.isNull(), F.col("norm")).alias("last_text"),
    )
    numbered = compared.withColumn(
        "run", F.sum("starts").over(Window.partitionBy("range").orderBy("place"))
    )
    run = Window.partitionBy("range", "run")
    runs = numbered.select(
        "*", F.min("doc_id").over(run).alias("run_keep"), F.count(F.lit(1)).over(run).alias("run_size")
    )
    runs = stored(runs, "content-sort")
    joined = _across_ranges(runs)
    found = runs.join(F.broadcast(joined), ["range", "run"], "left")
    return found.select(
        "doc_id",
        F.when(F.col("size").isNull(), F.col("run_keep")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("size", "run_size").alias("group_size"),
        ((F.col("starts") == 1) & ~F.coalesce("continues", F.lit(False))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def _splitters(rows: DataFrame, ranges: int) -> list[str]:
    """At most ``ranges - 1`` keys of a bounded sample, at even distances."""
    count = rows.count()
    wanted = min(SAMPLE_PER_RANGE * ranges, SAMPLE_ROWS)
    some = rows.sample(min(1.0, wanted / count), 7) if count else rows
    keys = some.select(_sort_key(F.col("norm"), F.col("doc_id")).alias("key"))
    sample = sorted(row.key for row in keys.collect())
    return sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)}) if sample else []


def _across_ranges(runs: DataFrame) -> DataFrame:
    """``range, run, keep, size, continues`` of each range's first and last run.

    Two rows per range, so the ordered window over them and the broadcast are bounded by the
    number of ranges.
    """
    last = F.col("last_text").isNotNull()
    first = F.col("first_text").isNotNull()
    edges = runs.where(first | last).groupBy("range").agg(
        F.max("run").alias("runs"),
        F.max("first_text").alias("first_text"),
        F.max("last_text").alias("last_text"),
        F.max(F.when(first, F.col("run_keep"))).alias("first_keep"),
        F.max(F.when(first, F.col("run_size"))).alias("first_size"),
        F.max(F.when(last, F.col("run_keep"))).alias("last_keep"),
        F.max(F.when(last, F.col("run_size"))).alias("last_size"),
    )
    order = Window.orderBy("range")
    edges = edges.withColumn(
        "continues", F.coalesce(F.lag("last_text").over(order) == F.col("first_text"), F.lit(False))
    )
    whole = F.col("continues") & (F.col("runs") == 1)
    edges = edges.withColumn("chain", F.sum(F.when(whole, 0).otherwise(1)).over(order))
    edges = edges.withColumn("chain_before", F.lag("chain").over(order))
    pieces = edges.select(
        "range",
        F.explode(
            F.array(
                F.struct(
                    F.col("runs").alias("run"), "chain", F.col("last_keep").alias("keep"),
                    F.col("last_size").alias("size"), whole.alias("continues"),
                ),
                F.when(
                    F.col("continues") & (F.col("runs") > 1),
                    F.struct(
                        F.lit(1).cast("long").alias("run"), F.col("chain_before").alias("chain"),
                        F.col("first_keep").alias("keep"), F.col("first_size").alias("size"),
                        F.lit(True).alias("continues"),
                    ),
                ),
            )
        ).alias("piece"),
    ).where(F.col("piece").isNotNull()).select("range", "piece.*")
    chain = Window.partitionBy("chain")
    return pieces.select(
        "range", "run", F.min("keep").over(chain).alias("keep"),
        F.sum("size").over(chain).alias("size"), "continues",
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows that agree in id and normalised text are one row; which one is arbitrary.
    """
    kept = exact_dedup(docs, id_col, text_col).where("kept")
    verdict = kept.select(F.col("doc_id").alias("_id"), F.unhex("text_sha256").alias("_sha"))
    keyed = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"),
        docs[f"`{id_col}`"].cast("long").alias("_id"),
        F.unhex(F.sha2(normal_text(text_col), 256)).alias("_sha"),
    )
    same = keyed["_id"].eqNullSafe(verdict["_id"]) & (keyed["_sha"] == verdict["_sha"])
    found = keyed.join(verdict, same, "left_semi")
    return found.dropDuplicates(["_id", "_sha"]).select("_row.*")
