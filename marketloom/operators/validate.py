"""Validation of normalised events that arrive as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions import rules
from marketloom.operators.rows import computed_once, with_json

_RULES = {"trade": rules.TRADE_RULES, "kline": rules.KLINE_RULES, "ticker": rules.TICKER_RULES}


def event_errors(event: Column) -> Column:
    """Joined error text of a normalised event given as VARIANT; empty when it is valid."""

    def field(name: str) -> Column:
        return F.try_variant_get(event, f"$.{name}", "string")

    event_type = field("event_type")
    text = F.when(event_type.isNull(), rules.unsupported_type(event_type))
    for name, checks in _RULES.items():
        fields = {field_name: field(field_name) for field_name, _ in checks}
        text = text.when(event_type == name, rules.error_text(checks, fields))
    return text.otherwise(rules.unsupported_type(event_type))


def validate(events: DataFrame, value: str = "value") -> DataFrame:
    """Add ``is_valid`` and ``errors`` (array, in rule order) to normalised JSON events."""
    columns = events.columns
    parsed = with_json(events, value, "_event", *columns)
    checked = computed_once(
        parsed, F.struct(event_errors(F.col("_event")).alias("_errors")), *columns
    )
    return checked.select(
        *columns,
        (F.col("_errors") == "").alias("is_valid"),
        rules.error_list(F.col("_errors")).alias("errors"),
    )
