"""Appending streams and idempotent batch appends."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from marketloom.sources.tables import move_into_place, path_exists


def paced(
    writer: DataStreamWriter, interval: str | None, available_now: bool = False
) -> DataStreamWriter:
    """Set the trigger: all that is there now and stop, a fixed interval, or as fast as possible."""
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval) if interval else writer


def by_partition(rows: DataFrame, partition_by: Sequence[str], spread_by: str, files: int) -> DataFrame:
    """The rows dealt so that each partition of a table is written by ``files`` tasks at most.

    Otherwise every task of the last shuffle writes a file of its own into every partition, and
    their product grows with the days a batch spans: writers and readers then wait for files.
    Rows of one partition are told apart by the values of ``spread_by``.
    """
    part = F.pmod(F.xxhash64(spread_by), F.lit(files))
    return rows.repartition(*map(F.col, partition_by), part)


def append_stream(
    rows: DataFrame,
    path: str,
    *,
    checkpoint: str,
    name: str,
    table_format: str = "parquet",
    partition_by: Sequence[str] = (),
    interval: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Append a stream to a table. The sink's log makes a restart write nothing twice."""
    writer = (
        rows.writeStream.format(table_format)
        .outputMode("append")
        .queryName(name)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return paced(writer, interval, available_now).start()


def append_batch_once(
    batch: DataFrame, batch_id: int, path: str, *, application: str, table_format: str = "parquet"
) -> bool:
    """Append one micro-batch of a ``foreachBatch`` query; a replay of it adds nothing.

    ``application`` names the query and its checkpoint, since batch numbers start anew with
    either. With Delta the transaction id does that. With files the batch is written to a hidden
    folder and renamed to its own partition ``application=<a>/batch_id=<n>``, and a partition
    that is already there is left alone, so a reader never meets a half-written or rewritten
    batch. ``without_batch`` reads such a table. Returns whether the batch was written.
    """
    if table_format == "delta":
        (
            batch.write.format("delta")
            .mode("append")
            .option("txnAppId", application)
            .option("txnVersion", batch_id)
            .save(path)
        )
        return True
    spark = batch.sparkSession
    name = quote(application, safe="")
    target = f"{path.rstrip('/')}/application={name}/batch_id={batch_id}"
    if path_exists(spark, target):
        return False
    pending = f"{path.rstrip('/')}/_pending_{name}_{batch_id}"
    batch.write.format(table_format).mode("overwrite").save(pending)
    move_into_place(spark, pending, target)
    return True


def application_id(name: str, checkpoint: str) -> str:
    """A query and its checkpoint as one name: a fresh checkpoint starts batches at zero."""
    return f"{name}-{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}"


def without_batch(table: DataFrame) -> DataFrame:
    """A table written by ``append_batch_once`` without the columns of its partitions."""
    return table.drop("application", "batch_id")
