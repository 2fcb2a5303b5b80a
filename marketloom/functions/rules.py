"""Field rules that yield an error text, or null when the field is fine."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketloom.functions.values import is_blank, is_instant_text, is_number


def present(name: str, value: Column) -> Column:
    return F.when(value.isNull(), f"{name} is missing")


def non_empty(name: str, value: Column) -> Column:
    return F.when(is_blank(value), f"{name} is missing")


def instant(name: str, value: Column) -> Column:
    return non_empty(name, value).when(
        ~is_instant_text(value), f"{name} is not a valid UTC timestamp"
    )


def number(name: str, value: Column) -> Column:
    return non_empty(name, value).when(~is_number(value), f"{name} is not numeric")


def _sign(value: Column) -> Column:
    """Sign of a number's text, exact however small or large it is."""
    digits = F.regexp_extract(value, r"^\s*[+-]?([0-9.]*)", 1)
    zero = ~digits.rlike("[1-9]")
    return F.when(zero, 0).when(F.ltrim(value).startswith("-"), -1).otherwise(1)


def positive(name: str, value: Column) -> Column:
    return number(name, value).when(
        _sign(value) <= 0, f"{name} must be greater than zero"
    )


def not_negative(name: str, value: Column) -> Column:
    return number(name, value).when(
        _sign(value) < 0, f"{name} must be greater than or equal to zero"
    )


# Rules per event type, in reporting order.
TRADE_RULES = (
    ("symbol", non_empty),
    ("event_time", instant),
    ("trade_id", present),
    ("price", positive),
    ("quantity", positive),
)
KLINE_RULES = (
    ("symbol", non_empty),
    ("kline_start_time", instant),
    ("open_price", number),
    ("high_price", number),
    ("low_price", number),
    ("close_price", number),
    ("volume", not_negative),
)
TICKER_RULES = (
    ("symbol", non_empty),
    ("event_time", instant),
    ("last_price", positive),
    ("volume", not_negative),
)


def error_text(rules, fields: Mapping[str, Column]) -> Column:
    """All violated rules joined by ``; ``, at most one per field; empty when none is.

    Joining text, unlike filtering an array with a lambda, stays inside generated code.
    """
    return F.concat_ws("; ", *(rule(name, fields[name]) for name, rule in rules))


def error_list(text: Column) -> Column:
    """Joined error text as an array, empty when there is no error."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "; "))


def unsupported_type(event_type: Column) -> Column:
    return F.concat(F.lit("unsupported event_type: "), F.coalesce(event_type, F.lit("None")))
