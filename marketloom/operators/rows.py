"""Small row-level helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.values import sealed_json, unsealed


def computed_once(
    rows: DataFrame, record: Column, *keep: str, names: Sequence[str] | None = None
) -> DataFrame:
    """The fields of the struct ``record`` as columns, evaluated once per row.

    A filter placed on a plain projection is pushed below it, and Catalyst then evaluates
    the projected expressions twice. Parsing JSON is far too costly for that, so the
    struct goes through a one-element ``inline``, which filters do not cross. It also
    keeps adjacent steps apart, so that each compiles to a method small enough for the
    JIT. ``names`` renames the fields by position; a null struct gives null fields.
    """
    fields = F.inline(F.array(record))
    return rows.select(*keep, fields.alias(*names) if names else fields)


def with_json(rows: DataFrame, text: str, name: str, *keep: str) -> DataFrame:
    """``keep`` and ``name``: the text column as VARIANT, null unless one whole JSON value."""
    sealed = computed_once(rows, F.struct(sealed_json(F.col(text)).alias("_sealed")), *keep)
    return computed_once(
        sealed, F.struct(unsealed(F.col("_sealed"), F.col(text)).alias(name)), *keep
    )


def watermarked(rows: DataFrame, event_time: str, delay: str | None) -> DataFrame:
    """Put a watermark on a stream; batch input is returned as it is."""
    return rows.withWatermark(event_time, delay) if delay and rows.isStreaming else rows
