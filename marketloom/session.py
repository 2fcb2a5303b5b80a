"""Spark session settings this library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Instants are written as text with a literal "Z", so the session zone must be UTC.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A repeated property in a message takes its last value instead of failing the message.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str, **overrides: str) -> SparkSession:
    """A session with the settings above; master and memory come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Make a session that somebody else built read and print instants in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
