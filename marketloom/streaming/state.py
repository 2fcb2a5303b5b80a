"""What running queries keep: the rows of their state stores, read from their checkpoints.

Read with Spark's state data source, so that open windows and dedup keys can be looked at, joined
and counted like any table, while the query runs or after it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def state_rows(
    spark: SparkSession, checkpoint: str, *, operator: int = 0, batch: int | None = None, store: str | None = None
) -> DataFrame:
    """``key, value, partition_id`` of one stateful operator after a batch, the last one by default."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch is not None:
        reader = reader.option("batchId", batch)
    if store is not None:
        reader = reader.option("storeName", store)
    return reader.load(checkpoint)


def open_windows(spark: SparkSession, checkpoint: str, **options) -> DataFrame:
    """``symbol, window_start, window_end`` of the windows that wait for the watermark."""
    rows = state_rows(spark, checkpoint, **options)
    # A grouping key has no stable name in the state; it is told by its type.
    names = {field.dataType.typeName(): field.name for field in rows.schema["key"].dataType.fields}
    window, symbol = F.col("key")[names["struct"]], F.col("key")[names["string"]]
    return rows.select(symbol.alias("symbol"), window["start"].alias("window_start"), window["end"].alias("window_end"))


def dedup_keys(spark: SparkSession, checkpoint: str, **options) -> DataFrame:
    """The key columns of remembered rows and ``expires``, the event time from which they are forgotten."""
    rows = state_rows(spark, checkpoint, **options)
    micros = F.col("value")[rows.schema["value"].dataType.fields[0].name]
    return rows.select("key.*", F.timestamp_micros(micros).alias("expires"))


def state_metadata(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a checkpoint: name, store, partitions, first and last batch."""
    return spark.read.format("state-metadata").load(checkpoint)
