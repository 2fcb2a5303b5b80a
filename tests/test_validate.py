from __future__ import annotations

import json

import pytest

from marketloom.operators.validate import validate
from tests.builders import kline_event, messages, ticker_event, trade_event, without


def errors(spark, event) -> list[str]:
    row = validate(messages(spark, event)).first()
    assert row.is_valid == (not row.errors)
    return row.errors


CASES = [
    (trade_event(), []),
    (kline_event(), []),
    (ticker_event(), []),
    (without(trade_event(), "event_time"), ["event_time is missing"]),
    (trade_event(event_time="2024-04-30T10:05:30"), ["event_time is not a valid UTC timestamp"]),
    (trade_event(event_time="soon"), ["event_time is not a valid UTC timestamp"]),
    (trade_event(event_time="2024-13-30T10:05:30Z"), ["event_time is not a valid UTC timestamp"]),
    (trade_event(trade_id=None), ["trade_id is missing"]),
    (
        trade_event(symbol="", price="0", quantity="-2"),
        [
            "symbol is missing", "price must be greater than zero",
            "quantity must be greater than zero",
        ],
    ),
    (trade_event(price="NaN"), ["price is not numeric"]),
    (kline_event(open_price="high"), ["open_price is not numeric"]),
    (kline_event(volume="-1"), ["volume must be greater than or equal to zero"]),
    (kline_event(volume="0"), []),
    # Close and event time of a kline are not checked here, only in the typed layer.
    (without(kline_event(), "kline_close_time"), []),
    (ticker_event(last_price="0"), ["last_price must be greater than zero"]),
    ({"event_type": "book_ticker"}, ["unsupported event_type: book_ticker"]),
    ({"symbol": "X"}, ["unsupported event_type: None"]),
    ("not json", ["unsupported event_type: None"]),
]


@pytest.fixture(scope="module")
def found(spark):
    """All cases through one job, by position."""
    rows = validate(messages(spark, *(case[0] for case in CASES))).collect()
    assert all(row.is_valid == (not row.errors) for row in rows)
    return {row.id: row.errors for row in rows}


@pytest.mark.parametrize("position", range(len(CASES)))
def test_errors(found, position):
    assert found[position] == CASES[position][1]


def test_all_fields_are_reported_once(spark):
    event = json.dumps({"event_type": "trade"})
    assert errors(spark, event) == [
        f"{name} is missing" for name in ("symbol", "event_time", "trade_id", "price", "quantity")
    ]
