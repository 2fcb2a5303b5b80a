"""Queries for looking into stored tables and raw topics."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.plans.serving import INSPECTION_ROWS


def topic_activity(raw: DataFrame) -> DataFrame:
    """Records per topic and key with the first and latest bus time, busiest first."""
    return raw.sparkSession.sql(
        """
        SELECT topic, key AS symbol, count(*) AS row_count,
               min(kafka_timestamp) AS first_kafka_timestamp,
               max(kafka_timestamp) AS latest_kafka_timestamp
        FROM {raw}
        GROUP BY topic, key
        ORDER BY row_count DESC, topic, symbol
        """,
        raw=raw,
    )


def newest_watchlist(watchlist: DataFrame, limit: int = INSPECTION_ROWS) -> DataFrame:
    return watchlist.sparkSession.sql(
        "SELECT * FROM {watchlist} ORDER BY last_updated_time DESC, symbol LIMIT {limit}",
        watchlist=watchlist,
        limit=limit,
    )


def newest_spike_rows(spikes: DataFrame, limit: int = INSPECTION_ROWS) -> DataFrame:
    return spikes.sparkSession.sql(
        """
        SELECT * FROM {spikes}
        ORDER BY window_end DESC, volume_spike_ratio DESC, symbol LIMIT {limit}
        """,
        spikes=spikes,
        limit=limit,
    )


def newest_price_alert_rows(alerts: DataFrame, limit: int = INSPECTION_ROWS) -> DataFrame:
    return alerts.sparkSession.sql(
        """
        SELECT * FROM {alerts}
        ORDER BY window_end DESC, abs(price_change_pct) DESC, symbol LIMIT {limit}
        """,
        alerts=alerts,
        limit=limit,
    )


def table_inventory(
    tables: Mapping[str, DataFrame | None],
    paths: Mapping[str, str] | None = None,
    spark: SparkSession | None = None,
) -> DataFrame:
    """Per table: whether it exists, its rows and its number of columns, by name.

    ``paths`` adds where each table is stored. ``spark`` defaults to the active session.
    """
    spark = spark or SparkSession.active()
    rows = []
    for name, table in tables.items():
        counted = (
            spark.range(1).select(F.lit(0).cast("bigint").alias("rows"))
            if table is None
            else table.agg(F.count("*").alias("rows"))
        )
        rows.append(
            counted.select(
                F.lit(name).alias("table"),
                F.lit(table is not None).alias("table_exists"),
                "rows",
                F.lit(0 if table is None else len(table.columns)).alias("columns"),
                *([F.lit(paths[name]).alias("path")] if paths else []),
            )
        )
    return reduce(DataFrame.unionByName, rows).orderBy("table")


def table_sample(table: DataFrame, limit: int = 20, order_by: str | None = None) -> DataFrame:
    """Some rows of a table, the newest by ``order_by`` if it has that column."""
    if order_by and order_by in table.columns:
        table = table.orderBy(F.col(order_by).desc())
    return table.limit(limit)


def table_detail(spark: SparkSession, table: str, table_format: str = "parquet") -> DataFrame:
    """Physical detail of a registered table."""
    if table_format == "delta":
        return spark.sql(f"DESCRIBE DETAIL {table}")
    return spark.sql(f"DESCRIBE EXTENDED {table}")
