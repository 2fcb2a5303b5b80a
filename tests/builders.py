"""Small inputs written for these tests."""

from __future__ import annotations

import json
from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from marketloom import schemas


def at(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def messages(spark: SparkSession, *texts) -> DataFrame:
    rows = [(i, text if isinstance(text, str) else json.dumps(text)) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "id INT, value STRING")


def trade_message(**changes) -> dict:
    data = {
        "e": "trade", "E": 1714471530123, "s": "NEARUSDT", "t": 77, "p": "7.25", "q": "40.5",
        "T": 1714471530120, "m": False, "M": True,
    }
    data.update(changes)
    return {"stream": "nearusdt@trade", "data": data}


def kline_message(head: dict | None = None, **changes) -> dict:
    bar = {
        "t": 1714471500000, "T": 1714471559999, "s": "DOTUSDT", "i": "1m", "f": 1, "L": 9,
        "o": "6.90", "c": "6.95", "h": "7.00", "l": "6.85", "v": "310", "n": 21, "x": True,
        "q": "2150.5", "V": "120", "Q": "830.25", "B": "0",
    }
    bar.update(changes)
    data = {"e": "kline", "E": 1714471560001, "s": "DOTUSDT", "k": bar}
    data.update(head or {})
    return {"stream": "dotusdt@kline_1m", "data": data}


def ticker_message(**changes) -> dict:
    data = {
        "e": "24hrTicker", "E": 1714471530123, "s": "ATOMUSDT", "p": "-0.15", "P": "-1.80",
        "w": "8.31", "x": "8.40", "c": "8.25", "Q": "3", "b": "8.24", "B": "1", "a": "8.26",
        "A": "2", "o": "8.40", "h": "8.60", "l": "8.10", "v": "9000", "q": "74790", "O": 1714385130123,
        "C": 1714471530123, "F": 11, "L": 320, "n": 310,
    }
    data.update(changes)
    return {"stream": "atomusdt@ticker", "data": data}


def trade_event(**changes) -> dict:
    event = {
        "schema_version": "1.0", "event_type": "trade", "symbol": "NEARUSDT",
        "event_time": "2024-04-30T10:05:30.123Z", "trade_id": 77, "price": "7.25",
        "quantity": "40.5", "trade_value": "293.625", "is_buyer_market_maker": False,
        "source": "binance", "ingest_time": "2024-04-30T10:05:31.000Z",
    }
    event.update(changes)
    return event


def kline_event(**changes) -> dict:
    event = {
        "schema_version": "1.0", "event_type": "kline", "symbol": "DOTUSDT",
        "event_time": "2024-04-30T10:06:00.001Z", "kline_start_time": "2024-04-30T10:05:00.000Z",
        "kline_close_time": "2024-04-30T10:05:59.999Z", "interval": "1m", "open_price": "6.90",
        "high_price": "7.00", "low_price": "6.85", "close_price": "6.95", "volume": "310",
        "quote_asset_volume": "2150.5", "number_of_trades": 21,
        "taker_buy_base_asset_volume": "120", "taker_buy_quote_asset_volume": "830.25",
        "is_closed": True, "source": "binance", "ingest_time": "2024-04-30T10:06:01.000Z",
    }
    event.update(changes)
    return event


def ticker_event(**changes) -> dict:
    event = {
        "schema_version": "1.0", "event_type": "ticker", "symbol": "ATOMUSDT",
        "event_time": "2024-04-30T10:05:30.123Z", "price_change": "-0.15",
        "price_change_percent": "-1.80", "weighted_avg_price": "8.31", "last_price": "8.25",
        "last_quantity": "3", "open_price": "8.40", "high_price": "8.60", "low_price": "8.10",
        "volume": "9000", "quote_volume": "74790", "open_time": "2024-04-29T10:05:30.123Z",
        "close_time": "2024-04-30T10:05:30.123Z", "first_trade_id": 11, "last_trade_id": 320,
        "trade_count": 310, "source": "binance", "ingest_time": "2024-04-30T10:05:31.000Z",
    }
    event.update(changes)
    return event


def without(event: dict, name: str) -> dict:
    return {key: value for key, value in event.items() if key != name}


def raw_records(spark: SparkSession, topic: str, events: list) -> DataFrame:
    moment = at("2024-04-30T10:06:00")
    rows = [
        (
            topic, i % 2, i, "k", event if isinstance(event, str) else json.dumps(event), moment,
            moment, moment.date(),
        )
        for i, event in enumerate(events)
    ]
    return spark.createDataFrame(rows, schemas.RAW_RECORD)


TRADE_COLUMNS = "symbol STRING, event_time TIMESTAMP, trade_id BIGINT, price DECIMAL(38,18), quantity DECIMAL(38,18), trade_value DECIMAL(38,18)"


def trades(spark: SparkSession, *rows: tuple) -> DataFrame:
    """Trades from ``(time, id, price, quantity)`` or with a symbol in front."""
    full = []
    for row in rows:
        symbol, time, trade_id, price, quantity = row if len(row) == 5 else ("NEARUSDT", *row)
        price, quantity = Decimal(price), Decimal(quantity)
        full.append((symbol, at(time), trade_id, price, quantity, price * quantity))
    return spark.createDataFrame(full, TRADE_COLUMNS)


def summary(spark: SparkSession, *rows: tuple) -> DataFrame:
    """Summary rows from ``(symbol, start, end, volume)``."""
    full = [
        (symbol, at(start), at(end), Decimal(volume), 3, Decimal(1), Decimal(1), Decimal(1))
        for symbol, start, end, volume in rows
    ]
    return spark.createDataFrame(full, schemas.TRADE_SUMMARY)
