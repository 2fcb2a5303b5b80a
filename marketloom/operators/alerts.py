"""Signals to alert events and bus messages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom import schemas
from marketloom.functions.values import iso_millis

# What identifies an alert, for consumers that must ignore a repeated delivery.
ALERT_KEY = ("symbol", "window_end", "alert_type")


def _alert(
    signals: DataFrame,
    alert_type: Column,
    severity: Column,
    metric: Column,
    description: Column,
    schema_version: str,
    created_at: Column | None,
) -> DataFrame:
    columns = {
        "schema_version": F.lit(schema_version),
        "symbol": F.col("symbol"),
        "alert_type": alert_type,
        "severity": severity,
        "window_start": iso_millis(F.col("window_start")),
        "window_end": iso_millis(F.col("window_end")),
        "metric_value": metric.cast("double"),
        "description": description,
        "created_at": iso_millis(F.current_timestamp() if created_at is None else created_at),
    }
    return signals.select(*(columns[name].alias(name) for name in schemas.ALERT_EVENT.names))


def volume_alerts(
    spikes: DataFrame, *, schema_version: str = "1.0", created_at: Column | None = None
) -> DataFrame:
    """Alert events for spikes of medium and high strength."""
    ratio = F.col("volume_spike_ratio")
    text = F.concat(
        F.col("symbol"),
        F.lit(" volume is "),
        F.format_number(ratio, 2),
        F.lit("x above recent baseline"),
    )
    strong = spikes.where(F.col("signal_strength").isin("MEDIUM", "HIGH"))
    kind = F.lit("VOLUME_SPIKE")
    return _alert(strong, kind, F.col("signal_strength"), ratio, text, schema_version, created_at)


def price_move_alerts(
    alerts: DataFrame, *, schema_version: str = "1.0", created_at: Column | None = None
) -> DataFrame:
    """Alert events for price moves, one per input row."""
    change = F.col("price_change_pct")
    text = F.concat(
        F.col("symbol"),
        F.lit(" moved "),
        F.format_number(change, 2),
        F.lit("% within the 5-minute window"),
    )
    return _alert(
        alerts, F.col("alert_type"), F.col("severity"), change, text, schema_version, created_at
    )


def alert_messages(
    events: DataFrame, keep: Mapping[str, Column] | None = None
) -> DataFrame:
    """Bus key and JSON value of alert events; ``keep`` adds further columns by name."""
    return events.select(
        F.col("symbol").cast("string").alias("key"),
        F.to_json(F.struct(*schemas.ALERT_EVENT.names)).alias("value"),
        *(column.alias(name) for name, column in (keep or {}).items()),
    )
