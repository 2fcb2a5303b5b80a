"""Bus topics as streams and bounded reads.

The format is configuration. Kafka is the default; any file format whose rows have the
columns of ``schemas.BUS_RECORD`` works the same way, and is what can be tested without a
broker.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from marketloom import schemas
from marketloom.plans.ranges import since
from marketloom.sources.sinks import paced


@dataclass(frozen=True)
class Bus:
    """Where the bus is. File formats need ``path``; Kafka needs its servers in options."""

    format: str = "kafka"
    options: Mapping[str, str] = field(default_factory=dict)
    path: str | None = None
    schema: StructType = schemas.BUS_RECORD
    starting_offsets: str = "latest"
    fail_on_data_loss: str = "false"
    max_offsets_per_trigger: str | None = None
    max_files_per_trigger: str | None = None


def stream_options(bus: Bus, topics: Sequence[str]) -> dict[str, str]:
    """Options of a subscription: Kafka's own, or how many files a batch takes."""
    options = dict(bus.options)
    if bus.format != "kafka":
        return options | ({"maxFilesPerTrigger": bus.max_files_per_trigger} if bus.max_files_per_trigger else {})
    options |= {
        "subscribe": ",".join(topics),
        "startingOffsets": bus.starting_offsets,
        "failOnDataLoss": bus.fail_on_data_loss,
    }
    return options | ({"maxOffsetsPerTrigger": bus.max_offsets_per_trigger} if bus.max_offsets_per_trigger else {})


def read_options(bus: Bus, topic: str, start: datetime | None = None) -> dict[str, str]:
    """Options of a bounded read, from ``start`` if given; records before it are not fetched."""
    options = dict(bus.options)
    if bus.format != "kafka":
        return options
    options |= {"subscribe": topic, "endingOffsets": "latest"}
    if start is None:
        return options | {"startingOffsets": "earliest"}
    return options | {
        "startingTimestamp": str(_millis(start)),
        "startingOffsetsByTimestampStrategy": "latest",
    }


def _millis(moment: datetime) -> int:
    aware = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    return int(aware.timestamp() * 1000)


def stream_topics(spark: SparkSession, bus: Bus, topics: Sequence[str]) -> DataFrame:
    """One subscription to one or several topics."""
    reader = spark.readStream.format(bus.format).options(**stream_options(bus, topics))
    if bus.format == "kafka":
        return reader.load()
    return reader.schema(bus.schema).load(bus.path).where(F.col("topic").isin(*topics))


def read_topic(spark: SparkSession, bus: Bus, topic: str, start: datetime | None = None) -> DataFrame:
    """What a topic holds now, since ``start`` if given; empty when a file bus is not there yet.

    The start goes to the source: Kafka seeks to it, files are skipped by their statistics. A
    format that does not exist, a missing connector or an unreachable broker is an error.
    """
    reader = spark.read.format(bus.format).options(**read_options(bus, topic, start))
    if bus.format == "kafka":
        return reader.load()
    try:
        rows = reader.schema(bus.schema).load(bus.path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], bus.schema)
    return since(rows.where(F.col("topic") == topic), "timestamp", start)


def publish(
    messages: DataFrame,
    bus: Bus,
    topic: str,
    *,
    checkpoint: str,
    name: str | None = None,
    interval: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Append a stream of ``key, value`` to a topic, with a checkpoint of its own."""
    writer = (
        messages.writeStream.format(bus.format)
        .queryName(name or f"publish-{topic}")
        .options(**bus.options)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if bus.format == "kafka":
        writer = writer.option("topic", topic)
    else:
        writer = writer.option("path", f"{bus.path.rstrip('/')}/topic={topic}")
    return paced(writer, interval, available_now).start()
