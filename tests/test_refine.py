from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketloom import schemas
from marketloom.operators import refine
from marketloom.operators.capture import capture
from tests.builders import at, kline_event, raw_records, ticker_event, trade_event, without


def test_capture_reads_text_and_stamps_arrival(spark):
    record = ("t", 1, 5, b"key", b"value", at("2024-04-30T10:00:00"))
    row = capture(spark.createDataFrame([record], schemas.BUS_RECORD)).first()
    assert (row.topic, row.partition, row.offset, row.key, row.value) == ("t", 1, 5, "key", "value")
    assert row.ingest_time is not None and row.process_date is not None


def test_trades_are_typed_and_filtered(spark):
    records = raw_records(
        spark,
        "market.trades.raw",
        [
            trade_event(symbol="nearusdt"),
            trade_event(trade_id=78, price="0"),
            trade_event(trade_id=79, quantity="-1"),
            trade_event(trade_id=80, price="cheap"),
            trade_event(trade_id=81, event_time="yesterday"),
            trade_event(trade_id=82, symbol="  "),
            trade_event(trade_id=None),
            trade_event(trade_id="83"),
            "{broken",
        ],
    )
    rows = refine.refine_trades(records).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.symbol, row.trade_id) == ("NEARUSDT", 77)
    assert row.price == Decimal("7.25") and row.trade_value == Decimal("293.625")
    assert row.event_time == datetime(2024, 4, 30, 10, 5, 30, 123000)
    assert (row.bronze_topic, row.bronze_partition, row.bronze_offset) == ("market.trades.raw", 0, 0)
    assert refine.refine_trades(records).schema.names == schemas.TRADES.names


def test_trade_value_has_six_digits_and_ignores_the_payload(spark):
    event = trade_event(price="0.12345678", quantity="0.12345678", trade_value="9")
    row = refine.refine_trades(raw_records(spark, "t", [event])).first()
    assert row.trade_value == Decimal("0.015242")


def test_bare_number_price_is_read(spark):
    row = refine.refine_trades(raw_records(spark, "t", [trade_event(price=7.5)])).first()
    assert row.price == Decimal("7.5")


def test_klines(spark):
    records = raw_records(
        spark,
        "market.klines.raw",
        [
            kline_event(),
            without(kline_event(), "kline_start_time"),
            without(kline_event(), "event_time"),
            kline_event(volume="-0.01", kline_start_time="2024-04-30T10:04:00Z"),
        ],
    )
    rows = refine.refine_klines(records)
    assert rows.schema.names == schemas.KLINES.names
    assert [(r.symbol, r.open_price, r.is_closed) for r in rows.collect()] == [
        ("DOTUSDT", Decimal("6.9"), True)
    ]


def test_tickers(spark):
    records = raw_records(
        spark,
        "market.tickers.raw",
        [ticker_event(), ticker_event(last_price="0"), ticker_event(volume="-1")],
    )
    rows = refine.refine_tickers(records)
    assert rows.schema.names == schemas.TICKERS.names
    assert [r.price_change for r in rows.collect()] == [Decimal("-0.15")]


@pytest.mark.parametrize(
    "transform, event, change",
    [
        (refine.refine_trades, trade_event, {"event_time": "2024-04-30T10:07:00Z"}),
        (refine.refine_klines, kline_event, {"close_price": "6.99"}),
        (refine.refine_tickers, ticker_event, {"last_price": "8.99"}),
    ],
)
def test_one_row_per_key_and_the_flag(spark, transform, event, change):
    records = raw_records(spark, "t", [event(), event(**change), event()])
    assert transform(records).count() == 1
    assert transform(records, dedup=False).count() == 3


def test_earliest_position_wins(spark):
    records = raw_records(spark, "t", [trade_event(source="a"), trade_event(source="b")])
    assert refine.refine_trades(records).first().source == "a"


def test_rejected_rows_are_the_complement(spark):
    typed = refine.typed_trades(
        raw_records(spark, "t", [trade_event(), trade_event(price="0"), trade_event(price=None)])
    )
    good = refine.is_good_trade()
    assert typed.where(good).count() == 1
    assert refine.rejected(typed, good).count() == 2


def test_one_key_holding_most_rows_loses_nothing_else(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id")).alias("key"), F.col("id").alias("o")
    )
    kept = refine.first_per_key(rows, ["key"], ["o"])
    assert kept.count() == rows.select("key").distinct().count()
    assert kept.where("key = 0").first().o == 0
