"""Places of rows in a total order, and sums of all that comes before a partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.work import shuffle_partitions, stored

#: Partitions whose totals are added up by one task.
SPAN = 1024
#: Bits of ``monotonically_increasing_id`` that count rows inside a partition.
_ROW_BITS = 33


def sums_before(totals: DataFrame, part: str, value: str, name: str) -> DataFrame:
    """``totals``, a row per partition, with the sum of ``value`` over all smaller ``part``.

    Two passes: sums inside spans of partitions, then over the spans, so that a task reads a
    thousandth of the partitions at most.
    """
    span = F.floor(F.col(part) / SPAN)
    inside = Window.partitionBy("_span").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    rows = totals.withColumn("_span", span)
    spans = rows.groupBy("_span").agg(F.sum(value).alias("_total"))
    spans = spans.select("_span", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_earlier"))
    rows = rows.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    found = rows.join(spans, "_span").withColumn(name, F.col("_earlier") + F.col("_inside"))
    return found.drop("_span", "_earlier", "_inside")


def in_order(rows: DataFrame, keys: list[Column], label: str) -> DataFrame:
    """``rows`` stored in the order of ``keys`` with ``_part`` and ``_place``, the row's number there.

    Partitions are ranges of the keys; end them with one that tells equal rows apart, or a
    large group of equal rows is one task.
    """
    ranged = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    ranged = ranged.withColumn("_id", F.monotonically_increasing_id())
    placed = ranged.select(
        *rows.columns,
        F.shiftright("_id", _ROW_BITS).alias("_part"),
        F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_place"),
    )
    return stored(placed, label)
