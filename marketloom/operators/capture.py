"""Raw capture: bus records to the append-only raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def capture(records: DataFrame) -> DataFrame:
    """Keep the bus position, read key and value as text, stamp arrival time and date."""
    return records.select(
        "topic",
        "partition",
        "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.current_timestamp().alias("ingest_time"),
        F.current_date().alias("process_date"),
    )
