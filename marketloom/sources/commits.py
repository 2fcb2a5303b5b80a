"""Tables whose batches count from the moment a commit file names them.

Data is written to ``data/application=<a>/batch_id=<n>/attempt=<x>``, where no other attempt
writes, and then one small file in ``log`` names the attempt. Nothing is renamed after Spark's own
write, so a store without atomic renames is safe: readers take the attempts that the log names,
and what a killed writer left behind is never read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from marketloom.sources.tables import path_exists

_PLACE = StructType(
    [StructField("application", StringType()), StructField("batch_id", LongType()), StructField("attempt", StringType())]
)
#: A commit covers the batches from ``first_batch`` to ``batch_id``, one unless it is compacted.
_COMMIT = StructType([*_PLACE.fields, StructField("first_batch", LongType())])


def _data(path: str) -> str:
    return f"{path.rstrip('/')}/data"


def _log(path: str) -> str:
    return f"{path.rstrip('/')}/log"


def commits(spark: SparkSession, path: str) -> DataFrame:
    """``application, first_batch, batch_id, attempt`` of every commit that counts.

    A commit inside the range of a compacted one no longer counts, nor does a file that was cut
    off while it was written.
    """
    columns = ("application", "first_batch", "batch_id", "attempt")
    if not path_exists(spark, _log(path)):
        return spark.createDataFrame([], _COMMIT).select(*columns)
    found = spark.read.schema(_COMMIT).option("mode", "DROPMALFORMED").json(_log(path))
    found = found.where(F.col("attempt").isNotNull()).select(*columns)
    # Of attempts that two drivers committed for one batch, one counts.
    found = found.groupBy("application", "first_batch", "batch_id").agg(F.min("attempt").alias("attempt"))
    wide = found.where(F.col("first_batch") < F.col("batch_id")).alias("w")
    one = found.alias("c")
    covered = (
        (F.col("w.application") == F.col("c.application"))
        & (F.col("w.first_batch") <= F.col("c.first_batch"))
        & (F.col("w.batch_id") >= F.col("c.batch_id"))
        & (F.col("w.attempt") != F.col("c.attempt"))
    )
    return one.join(wide, covered, "left_anti").select(*columns)


def _attempt_folder(path: str, application: str, batch_id: int, attempt: str) -> str:
    name = quote(application, safe="")
    return f"{_data(path)}/application={name}/batch_id={batch_id}/attempt={attempt}"


def write_attempt(
    batch: DataFrame, batch_id: int, path: str, application: str, partition_by: Sequence[str] = ()
) -> str:
    """Write the rows of a batch where no reader looks yet; returns the attempt's name."""
    # A name that starts with a letter is never read as a number.
    attempt = f"a{uuid.uuid4().hex}"
    batch.write.partitionBy(*partition_by).parquet(_attempt_folder(path, application, batch_id, attempt))
    return attempt


def commit(
    spark: SparkSession, path: str, application: str, batch_id: int, attempt: str, first_batch: int | None = None
) -> None:
    """Name an attempt in the log, from when on it counts."""
    first = batch_id if first_batch is None else first_batch
    line = json.dumps(
        {"application": application, "first_batch": first, "batch_id": batch_id, "attempt": attempt}
    )
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{_log(path)}/{attempt}.json")
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, False)
    try:
        stream.write(bytearray(line.encode()))
    finally:
        stream.close()


def is_committed(spark: SparkSession, path: str, application: str, batch_id: int) -> bool:
    inside = F.lit(batch_id).between(F.col("first_batch"), F.col("batch_id"))
    return not commits(spark, path).where((F.col("application") == application) & inside).isEmpty()


def append_committed(
    batch: DataFrame,
    batch_id: int,
    path: str,
    *,
    application: str,
    partition_by: Sequence[str] = (),
) -> bool:
    """Append a micro-batch of a ``foreachBatch`` query; a replay of it adds nothing.

    A batch is written by one query at a time, as Structured Streaming does it; ``application``
    tells queries and checkpoints apart. Returns whether the batch was written.
    """
    spark = batch.sparkSession
    if is_committed(spark, path, application, batch_id):
        return False
    attempt = write_attempt(batch, batch_id, path, application, partition_by)
    commit(spark, path, application, batch_id, attempt)
    return True


def read_committed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of all committed batches; empty if there is no such table.

    The log is a small table that is joined on the partition columns of the data, so the folders
    of attempts that do not count are pruned, and no list of commits reaches the driver.
    """
    if not path_exists(spark, _data(path)):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(StructType([*schema.fields, *_PLACE.fields])).parquet(_data(path))
    return rows.join(commits(spark, path), _PLACE.names, "left_semi").select(*schema.names)


def compact(
    spark: SparkSession, path: str, schema: StructType, application: str, partition_by: Sequence[str] = ()
) -> int | None:
    """Rewrite all committed batches of an application as one commit with few files.

    The new commit covers the range of the old ones, so readers change over at once, replays of
    covered batches still add nothing, and a job killed before the commit changes nothing. Spark
    sizes the files by ``spark.sql.adaptive.advisoryPartitionSizeInBytes``. The folders it replaces
    stay until ``remove_replaced``, for readers that have them open. Returns the last batch.
    """
    counting = commits(spark, path).where(F.col("application") == application)
    bounds = counting.agg(F.min("first_batch").alias("first"), F.max("batch_id").alias("last"), F.count("*").alias("n")).first()
    if bounds["n"] < 2:
        return bounds["last"]
    rows = spark.read.schema(StructType([*schema.fields, *_PLACE.fields])).parquet(_data(path))
    rows = rows.where(F.col("application") == application).join(counting, _PLACE.names, "left_semi")
    rows = rows.select(*schema.names).hint("rebalance", *partition_by)
    attempt = write_attempt(rows, bounds["last"], path, application, partition_by)
    commit(spark, path, application, bounds["last"], attempt, bounds["first"])
    return bounds["last"]


def remove_replaced(spark: SparkSession, path: str, application: str) -> int:
    """Delete the commits of an application that a compacted one replaced, and their folders.

    Call it when no reader from before the compaction runs any more. What a killed writer left of
    a batch that was committed later goes too; a batch that is being written is not touched.
    Returns how many folders went.
    """
    if not path_exists(spark, _log(path)):
        return 0
    counting = {r.attempt for r in commits(spark, path).where(F.col("application") == application).collect()}
    folder = spark._jvm.org.apache.hadoop.fs.Path
    root = folder(f"{_data(path)}/application={quote(application, safe='')}")
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    removed = 0
    for batch in files.listStatus(root) if files.exists(root) else ():
        batch_id = int(batch.getPath().getName().removeprefix("batch_id="))
        if not is_committed(spark, path, application, batch_id):
            continue
        for attempt in files.listStatus(batch.getPath()):
            name = attempt.getPath().getName().removeprefix("attempt=")
            if name not in counting:
                # The commit goes last, so that a folder without one is found again.
                files.delete(attempt.getPath(), True)
                files.delete(folder(f"{_log(path)}/{name}.json"), False)
                removed += 1
    return removed
