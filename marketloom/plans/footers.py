"""Counts and newest times of stored tables from Parquet footers and the days in their folders.

Counting rows reads no row: the count per day is pushed down to the files' footers. Only the day in
which a range starts and the newest day are scanned, one column of each.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketloom.plans.ranges import instant_literal
from marketloom.plans.serving import TIME_COLUMNS
from marketloom.sources.tables import read_table

DAY = "window_date"
_PUSHDOWN, _OLD_READERS = "spark.sql.parquet.aggregatePushdown", "spark.sql.sources.useV1SourceList"


@contextmanager
def _new_reader(spark: SparkSession) -> Iterator[None]:
    """Frames made inside read Parquet with the reader that takes aggregates."""
    before = spark.conf.get(_OLD_READERS)
    spark.conf.set(_OLD_READERS, ",".join(name for name in before.split(",") if name != "parquet"))
    try:
        yield
    finally:
        spark.conf.set(_OLD_READERS, before)


def rows_by_day(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """``window_date, rows`` of a table stored by day, from its footers; None where there is none.

    A table that is not stored by day has one row with a null day.
    """
    # Harmless to other queries: it only lets this reader answer counts from footers.
    spark.conf.set(_PUSHDOWN, "true")
    with _new_reader(spark):
        table = read_table(spark, path, schema)
        if table is None:
            return None
        counted = F.count("*").alias("rows")
        if DAY in table.columns:
            return table.groupBy(DAY).agg(counted)
        return table.agg(counted).select(F.lit(None).cast("date").alias(DAY), "rows")


def _row(spark: SparkSession, name: str, path: str, schema: StructType, start: datetime | None) -> DataFrame:
    days = rows_by_day(spark, path, schema)
    zero, no_time = F.lit(0).cast("bigint"), F.lit(None).cast("timestamp")
    if days is None:
        return spark.range(1).select(
            F.lit(name).alias("table"), F.lit(False).alias("table_exists"), zero.alias("row_count"),
            zero.alias("total_row_count"), no_time.alias("latest_time"),
        )
    table = read_table(spark, path, schema)
    at = next((F.col(name) for name in TIME_COLUMNS if name in table.columns), no_time)
    by_day, first_day = DAY in table.columns, start and start.astimezone(timezone.utc).date()
    later = F.lit(True) if start is None else F.col(DAY) > F.lit(first_day)
    parts = [days.agg(
        F.coalesce(F.sum(F.when(later, F.col("rows"))), zero).alias("row_count"),
        F.coalesce(F.sum("rows"), zero).alias("total_row_count"), F.max(no_time).alias("latest_time"),
    )]
    newest = table.where(F.col(DAY) == days.agg(F.max(DAY)).scalar()) if by_day else table
    parts.append(newest.agg(F.max(at).alias("latest_time")).select(zero.alias("row_count"), zero.alias("total_row_count"), "latest_time"))
    if start is not None:
        # Of the day in which the range starts a part counts; without days any row may.
        border = table.where(F.col(DAY) == F.lit(first_day)) if by_day else table
        border = border.where(at >= instant_literal(start))
        parts.append(border.agg(F.count("*").alias("row_count")).select("row_count", zero.alias("total_row_count"), no_time.alias("latest_time")))
    united = reduce(DataFrame.unionByName, parts)
    return united.agg(
        F.sum("row_count").alias("row_count"), F.sum("total_row_count").alias("total_row_count"),
        F.max("latest_time").alias("latest_time"),
    ).select(F.lit(name).alias("table"), F.lit(True).alias("table_exists"), "row_count", "total_row_count", "latest_time")


def stored_health(
    spark: SparkSession, paths: Mapping[str, str], schemas: Mapping[str, StructType], *, start: datetime | None = None
) -> DataFrame:
    """As ``serving.table_health``, of tables stored by ``window_date``, without reading their rows.

    ``start`` has a zone. Tables that do not exist count zero rows.
    """
    return reduce(DataFrame.unionByName, [_row(spark, name, path, schemas[name], start) for name, path in paths.items()])


def stored_inventory(spark: SparkSession, paths: Mapping[str, str], schemas: Mapping[str, StructType]) -> DataFrame:
    """As ``inspection.table_inventory``, from footers; a table's own columns count, not its day."""
    found = []
    for name, path in paths.items():
        days = rows_by_day(spark, path, schemas[name])
        exists = days is not None
        rows = F.coalesce(F.sum("rows"), F.lit(0)) if exists else F.lit(0)
        counted = (days if exists else spark.range(1)).agg(rows.cast("bigint").alias("rows"))
        found.append(counted.select(
            F.lit(name).alias("table"), F.lit(exists).alias("table_exists"), "rows",
            F.lit(len(schemas[name].names) if exists else 0).alias("columns"), F.lit(path).alias("path"),
        ))
    return reduce(DataFrame.unionByName, found).orderBy("table")
