"""Declared schemas of bus records, payloads and tables; nothing is inferred."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

from marketloom import config

_TYPES: dict[str, DataType] = {
    "STRING": StringType(),
    "BINARY": BinaryType(),
    "BOOLEAN": BooleanType(),
    "INT": IntegerType(),
    "BIGINT": LongType(),
    "DOUBLE": DoubleType(),
    "DECIMAL(38,18)": DecimalType(38, 18),
    "DECIMAL(38,22)": DecimalType(38, 22),
    "DECIMAL(38,6)": DecimalType(38, 6),
    "DATE": DateType(),
    "TIMESTAMP": TimestampType(),
}


def _schema(columns: str) -> StructType:
    """Schema from ``name TYPE, ...``; unlike Spark's own reader it needs no session."""
    schema = StructType()
    for column in columns.split(", "):
        name, type_name = column.split(" ")
        schema.add(name, _TYPES[type_name])
    return schema


# Shape of a bus source; any file source with these columns can stand in for it.
BUS_RECORD = _schema(
    "topic STRING, partition INT, offset BIGINT, key BINARY, value BINARY, timestamp TIMESTAMP"
)

RAW_RECORD = _schema(
    "topic STRING, partition INT, offset BIGINT, key STRING, value STRING, "
    "kafka_timestamp TIMESTAMP, ingest_time TIMESTAMP, process_date DATE"
)

# Payload schemas. Decimals and instants travel as text, so no rounding happens on the wire.
TRADE_EVENT = _schema(
    "schema_version STRING, event_type STRING, symbol STRING, event_time STRING, "
    "trade_id BIGINT, price STRING, quantity STRING, trade_value STRING, "
    "is_buyer_market_maker BOOLEAN, source STRING, ingest_time STRING"
)

KLINE_EVENT = _schema(
    "schema_version STRING, event_type STRING, symbol STRING, event_time STRING, "
    "kline_start_time STRING, kline_close_time STRING, interval STRING, open_price STRING, "
    "high_price STRING, low_price STRING, close_price STRING, volume STRING, "
    "quote_asset_volume STRING, number_of_trades BIGINT, taker_buy_base_asset_volume STRING, "
    "taker_buy_quote_asset_volume STRING, is_closed BOOLEAN, source STRING, ingest_time STRING"
)

TICKER_EVENT = _schema(
    "schema_version STRING, event_type STRING, symbol STRING, event_time STRING, "
    "price_change STRING, price_change_percent STRING, weighted_avg_price STRING, "
    "last_price STRING, last_quantity STRING, open_price STRING, high_price STRING, "
    "low_price STRING, volume STRING, quote_volume STRING, open_time STRING, "
    "close_time STRING, first_trade_id BIGINT, last_trade_id BIGINT, trade_count BIGINT, "
    "source STRING, ingest_time STRING"
)

ALERT_EVENT = _schema(
    "schema_version STRING, symbol STRING, alert_type STRING, severity STRING, "
    "window_start STRING, window_end STRING, metric_value DOUBLE, description STRING, "
    "created_at STRING"
)

INVALID_EVENT = _schema(
    "schema_version STRING, source_topic STRING, error_type STRING, error_message STRING, "
    "raw_payload STRING, error_time STRING, symbol STRING"
)

TRADES = _schema(
    "symbol STRING, event_time TIMESTAMP, trade_id BIGINT, price DECIMAL(38,18), "
    "quantity DECIMAL(38,18), trade_value DECIMAL(38,18), is_buyer_market_maker BOOLEAN, "
    "source STRING, ingest_time TIMESTAMP, bronze_topic STRING, bronze_partition INT, "
    "bronze_offset BIGINT, process_time TIMESTAMP"
)

KLINES = _schema(
    "symbol STRING, kline_start_time TIMESTAMP, kline_close_time TIMESTAMP, "
    "open_price DECIMAL(38,18), high_price DECIMAL(38,18), low_price DECIMAL(38,18), "
    "close_price DECIMAL(38,18), volume DECIMAL(38,18), number_of_trades BIGINT, "
    "is_closed BOOLEAN, event_time TIMESTAMP, source STRING, process_time TIMESTAMP"
)

TICKERS = _schema(
    "symbol STRING, event_time TIMESTAMP, last_price DECIMAL(38,18), "
    "price_change DECIMAL(38,18), price_change_percent DECIMAL(38,18), "
    "weighted_avg_price DECIMAL(38,18), high_price DECIMAL(38,18), low_price DECIMAL(38,18), "
    "volume DECIMAL(38,18), quote_volume DECIMAL(38,18), source STRING, process_time TIMESTAMP"
)

OHLC = _schema(
    "symbol STRING, window_start TIMESTAMP, window_end TIMESTAMP, open_price DECIMAL(38,18), "
    "high_price DECIMAL(38,18), low_price DECIMAL(38,18), close_price DECIMAL(38,18), "
    "trade_count BIGINT, total_quantity DECIMAL(38,18), total_trade_value DECIMAL(38,18)"
)

TRADE_SUMMARY = _schema(
    "symbol STRING, window_start TIMESTAMP, window_end TIMESTAMP, total_volume DECIMAL(38,18), "
    "number_of_trades BIGINT, average_trade_value DECIMAL(38,22), "
    "max_trade_value DECIMAL(38,18), min_trade_value DECIMAL(38,18)"
)

VOLATILITY = _schema(
    "symbol STRING, window_start TIMESTAMP, window_end TIMESTAMP, avg_price DECIMAL(38,22), "
    "min_price DECIMAL(38,18), max_price DECIMAL(38,18), price_stddev DOUBLE, "
    "price_change_pct DECIMAL(38,6), volatility_level STRING"
)

PRICE_ALERTS = _schema(
    "symbol STRING, window_start TIMESTAMP, window_end TIMESTAMP, start_price DECIMAL(38,18), "
    "end_price DECIMAL(38,18), price_change_pct DECIMAL(38,6), alert_type STRING, severity STRING"
)

WATCHLIST = _schema(
    "symbol STRING, latest_price DECIMAL(38,18), price_change_5m_pct DECIMAL(38,6), "
    "volume_5m DECIMAL(38,18), volatility_level STRING, latest_signal STRING, "
    "last_updated_time TIMESTAMP"
)

SPIKES = _schema(
    "symbol STRING, window_start TIMESTAMP, window_end TIMESTAMP, current_volume DECIMAL(38,18), "
    "baseline_volume DECIMAL(38,22), volume_spike_ratio DECIMAL(38,6), signal_strength STRING, "
    "number_of_trades BIGINT"
)

WINDOW_MEASURES = _schema(
    "symbol STRING, window_start TIMESTAMP, window_end TIMESTAMP, start_price DECIMAL(38,18), "
    "end_price DECIMAL(38,18), min_price DECIMAL(38,18), max_price DECIMAL(38,18), "
    "avg_price DECIMAL(38,22), price_stddev DOUBLE, number_of_trades BIGINT, "
    "total_volume DECIMAL(38,18), average_trade_value DECIMAL(38,22), "
    "max_trade_value DECIMAL(38,18), min_trade_value DECIMAL(38,18)"
)

TABLE_SCHEMAS: dict[str, StructType] = {
    config.BRONZE_TRADES: RAW_RECORD,
    config.BRONZE_KLINES: RAW_RECORD,
    config.BRONZE_TICKERS: RAW_RECORD,
    config.BRONZE_INVALID: RAW_RECORD,
    config.BRONZE_ALL: RAW_RECORD,
    config.SILVER_TRADES: TRADES,
    config.SILVER_KLINES: KLINES,
    config.SILVER_TICKERS: TICKERS,
    config.GOLD_OHLC: OHLC,
    config.GOLD_SUMMARY: TRADE_SUMMARY,
    config.GOLD_VOLATILITY: VOLATILITY,
    config.GOLD_PRICE_ALERTS: PRICE_ALERTS,
    config.GOLD_WATCHLIST: WATCHLIST,
    config.GOLD_SPIKES: SPIKES,
    config.GOLD_WINDOW_MEASURES: WINDOW_MEASURES,
}


def subset(schema: StructType, names: Iterable[str]) -> StructType:
    """The named fields of ``schema``, so a JSON parser need not build the others."""
    return StructType([schema[name] for name in names])
