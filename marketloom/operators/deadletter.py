"""Dead-letter records, context of unreadable messages, and dead-letter metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom import schemas
from marketloom.config import Feed
from marketloom.functions.values import iso_millis
from marketloom.operators.normalize import (
    UNKNOWN_TOPIC,
    event_type_of,
    headers,
    invalid_events,
    message_text,
    topic_of,
    unwrap,
    valid_events,
    vendor_type,
)
from marketloom.operators.rows import computed_once, with_json


def with_error_context(messages: DataFrame, feed: Feed = Feed(), *, value: str = "value") -> DataFrame:
    """Add ``source_topic, symbol``: the topic and symbol a raw message was meant for.

    The topic is ``unknown`` and the symbol null where that cannot be told. The message is
    parsed once for both.
    """
    columns = messages.columns
    texts = computed_once(messages, F.struct(message_text(F.col(value)).alias("_text")), *columns)
    parsed = with_json(texts, "_text", "_document", *columns, "_text")
    payload = unwrap(F.col("_document"))
    topic = F.coalesce(topic_of(event_type_of(vendor_type(payload)), feed), F.lit(UNKNOWN_TOPIC))
    context = F.struct(
        topic.alias("source_topic"), F.upper(F.try_variant_get(payload, "$.s", "string")).alias("symbol")
    )
    return computed_once(parsed, context, *columns)


def _letter_columns(feed: Feed, error_time: Column | None) -> list[Column]:
    stamp = F.current_timestamp() if error_time is None else error_time
    return [
        F.lit(feed.schema_version).alias("schema_version"),
        F.col("source_topic"),
        F.col("error_type"),
        F.col("error_message"),
        F.col("raw_payload"),
        iso_millis(stamp).alias("error_time"),
        F.when(F.col("symbol") != "", F.col("symbol")).alias("symbol"),
    ]


def _letter_key() -> Column:
    known = F.col("source_topic") != UNKNOWN_TOPIC
    return F.when(known, F.col("source_topic")).otherwise(F.col("error_type"))


def dead_letter_records(
    failures: DataFrame,
    feed: Feed = Feed(),
    *,
    error_time: Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Bus records for failed messages: key, JSON value, headers, plus the value's columns.

    Needs ``raw_payload, source_topic, error_type, error_message, symbol``. The JSON leaves
    out a missing symbol, since null fields are not written.
    """
    event = failures.select(*keep, *_letter_columns(feed, error_time))
    return event.select(
        *keep,
        F.lit(feed.invalid_topic).alias("topic"),
        _letter_key().alias("key"),
        F.to_json(F.struct(*schemas.INVALID_EVENT.names)).alias("value"),
        headers(feed, F.lit("invalid"), F.col("error_type")).alias("headers"),
        *schemas.INVALID_EVENT.names,
    )


def route(
    normalized: DataFrame,
    feed: Feed = Feed(),
    *,
    error_time: Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """All messages as bus records in one pass: valid ones to their topic, the rest to the
    dead-letter topic. One output instead of two filtered copies, so input is read once."""
    failed = F.col("error_type").isNotNull()
    letter = F.to_json(F.struct(*_letter_columns(feed, error_time)))
    letter_headers = headers(feed, F.lit("invalid"), F.col("error_type"))
    return normalized.select(
        *keep,
        F.when(failed, feed.invalid_topic).otherwise(F.col("topic")).alias("topic"),
        F.when(failed, _letter_key()).otherwise(F.col("key")).alias("key"),
        F.when(failed, letter).otherwise(F.col("value")).alias("value"),
        F.when(failed, letter_headers).otherwise(F.col("headers")).alias("headers"),
    )


def dead_letter_metrics(failures: DataFrame) -> DataFrame:
    """Failed messages per error type and source topic."""
    return failures.groupBy("error_type", "source_topic").agg(F.count("*").alias("messages"))
