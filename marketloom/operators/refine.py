"""Raw records to typed, filtered and deduplicated trades, klines and tickers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketloom import schemas
from marketloom.functions.values import MONEY, to_instant, to_money
from marketloom.operators.rows import computed_once, watermarked

TRADE_KEY = ("symbol", "trade_id")
KLINE_KEY = ("symbol", "kline_start_time", "kline_close_time")
TICKER_KEY = ("symbol", "event_time")

_POSITION = ("topic", "partition", "offset")
_ARRIVAL = ("_partition", "_offset")


def parse_payload(records: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Add ``payload``: the JSON text read by ``schema``, null where it does not fit."""
    return records.withColumn("payload", F.from_json(F.col(value), schema))


def _typed(
    records: DataFrame, schema: StructType, columns: dict[str, Column], keep: Sequence[str]
) -> DataFrame:
    """Parse only the payload fields in use, cast each of them once."""
    parsed = records.select(
        *keep, F.from_json(F.col("value"), schema).alias("payload")
    )
    return computed_once(
        parsed, F.struct(*(column.alias(name) for name, column in columns.items())), *keep
    )


def _field(name: str) -> Column:
    return F.col(f"payload.{name}")


def _has_symbol() -> Column:
    return F.length(F.trim("symbol")) > 0


def typed_trades(records: DataFrame) -> DataFrame:
    """Trades with decimals and instants, before the quality filter."""
    used = ("symbol", "event_time", "trade_id", "price", "quantity", "is_buyer_market_maker")
    typed = _typed(
        records,
        schemas.subset(schemas.TRADE_EVENT, (*used, "source", "ingest_time")),
        {
            "symbol": F.upper(_field("symbol")),
            "event_time": to_instant(_field("event_time")),
            "trade_id": _field("trade_id"),
            "price": to_money(_field("price")),
            "quantity": to_money(_field("quantity")),
            "is_buyer_market_maker": _field("is_buyer_market_maker"),
            "source": _field("source"),
            "ingest_time": to_instant(_field("ingest_time")),
        },
        _POSITION,
    )
    # The product of two decimal(38,18) keeps six fraction digits; the payload's own
    # trade_value is not used.
    value = F.try_multiply("price", "quantity").try_cast(MONEY)
    return typed.select(
        "symbol",
        "event_time",
        "trade_id",
        "price",
        "quantity",
        value.alias("trade_value"),
        "is_buyer_market_maker",
        "source",
        "ingest_time",
        F.col("topic").alias("bronze_topic"),
        F.col("partition").alias("bronze_partition"),
        F.col("offset").alias("bronze_offset"),
        F.current_timestamp().alias("process_time"),
    )


def typed_klines(records: DataFrame) -> DataFrame:
    typed = _typed(
        records,
        schemas.subset(
            schemas.KLINE_EVENT,
            (
                "symbol", "event_time", "kline_start_time", "kline_close_time", "open_price",
                "high_price", "low_price", "close_price", "volume", "number_of_trades",
                "is_closed", "source",
            ),
        ),
        {
            "symbol": F.upper(_field("symbol")),
            "kline_start_time": to_instant(_field("kline_start_time")),
            "kline_close_time": to_instant(_field("kline_close_time")),
            "open_price": to_money(_field("open_price")),
            "high_price": to_money(_field("high_price")),
            "low_price": to_money(_field("low_price")),
            "close_price": to_money(_field("close_price")),
            "volume": to_money(_field("volume")),
            "number_of_trades": _field("number_of_trades"),
            "is_closed": _field("is_closed"),
            "event_time": to_instant(_field("event_time")),
            "source": _field("source"),
        },
        _POSITION,
    )
    return _with_arrival(typed, schemas.KLINES)


def typed_tickers(records: DataFrame) -> DataFrame:
    money = (
        "last_price", "price_change", "price_change_percent", "weighted_avg_price",
        "high_price", "low_price", "volume", "quote_volume",
    )
    typed = _typed(
        records,
        schemas.subset(schemas.TICKER_EVENT, ("symbol", "event_time", *money, "source")),
        {
            "symbol": F.upper(_field("symbol")),
            "event_time": to_instant(_field("event_time")),
            **{name: to_money(_field(name)) for name in money},
            "source": _field("source"),
        },
        _POSITION,
    )
    return _with_arrival(typed, schemas.TICKERS)


def _with_arrival(typed: DataFrame, schema: StructType) -> DataFrame:
    """Table columns, plus the bus position for choosing among duplicates."""
    return typed.select(
        *(name for name in schema.names if name != "process_time"),
        F.current_timestamp().alias("process_time"),
        F.col("partition").alias("_partition"),
        F.col("offset").alias("_offset"),
    )


def is_good_trade() -> Column:
    return (
        _has_symbol()
        & F.col("event_time").isNotNull()
        & F.col("trade_id").isNotNull()
        & (F.col("price") > 0)
        & (F.col("quantity") > 0)
    )


def is_good_kline() -> Column:
    required = (
        "kline_start_time", "kline_close_time", "event_time",
        "open_price", "high_price", "low_price", "close_price",
    )
    good = _has_symbol() & (F.col("volume") >= 0)
    for name in required:
        good = good & F.col(name).isNotNull()
    return good


def is_good_ticker() -> Column:
    return (
        _has_symbol()
        & F.col("event_time").isNotNull()
        & (F.col("last_price") > 0)
        & (F.col("volume") >= 0)
    )


def first_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of every key by ``order``.

    The rank limit is applied before the shuffle as well, so a key with very many copies
    sends one row per map task.
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def deduplicate(rows: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key.

    Batch input keeps the first by ``order``. A stream keeps the first to arrive and
    forgets a key once the watermark has passed it, so state stays bounded; a copy that
    comes later than the watermark delay passes through.
    """
    if rows.isStreaming:
        return rows.dropDuplicatesWithinWatermark(list(key))
    return first_per_key(rows, key, order)


def unseen(
    batch: DataFrame, stored: DataFrame, key: Sequence[str], order: Sequence[str], *,
    day: str, reach_days: int = 1,
) -> DataFrame:
    """The first row of every key of ``batch`` that ``stored`` does not have, however late it is.

    ``stored`` is partitioned by the date column ``day``. Two dates of the batch are passed to its
    scan as literals, ``reach_days`` wider on either side, so a copy is found if its day and the
    stored row's are no further apart than that, and no other day is read. Stored keys first meet
    the keys of the batch, where Spark broadcasts those of a small batch or filters the scan by a
    Bloom filter of those of a large one; only keys found twice go on. No state is kept. The
    batch is read three times, so persist it. Rows with a null in the key are never copies of a
    stored row; an empty batch gives no rows.
    """
    first = first_per_key(batch, key, order)
    bounds = batch.agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
    if bounds["first"] is None:
        return first
    reach = timedelta(days=reach_days)
    near = stored.where(F.col(day).between(F.lit(bounds["first"] - reach), F.lit(bounds["last"] + reach)))
    seen = near.select(*key).join(first.select(*key), list(key), "left_semi").distinct()
    return first.join(seen, list(key), "left_anti").select(*batch.columns)


def _refined(
    typed: DataFrame,
    good: Column,
    key: Sequence[str],
    order: Sequence[str],
    watermark_delay: str | None,
    dedup: bool,
) -> DataFrame:
    rows = watermarked(typed.where(good), "event_time", watermark_delay)
    if dedup and rows.isStreaming and not watermark_delay:
        raise ValueError("deduplicating a stream needs a watermark delay")
    return deduplicate(rows, key, order) if dedup else rows


def refine_trades(
    records: DataFrame, *, watermark_delay: str | None = None, dedup: bool = True
) -> DataFrame:
    """Typed trades with a symbol, time, id, and positive price and quantity."""
    order = ("event_time", "bronze_partition", "bronze_offset")
    rows = _refined(
        typed_trades(records), is_good_trade(), TRADE_KEY, order, watermark_delay, dedup
    )
    return rows.select(*schemas.TRADES.names)


def refine_klines(
    records: DataFrame, *, watermark_delay: str | None = None, dedup: bool = True
) -> DataFrame:
    """Typed klines with a symbol, all times and prices, and a volume that is not negative."""
    rows = _refined(
        typed_klines(records), is_good_kline(), KLINE_KEY, ("event_time", *_ARRIVAL),
        watermark_delay, dedup,
    )
    return rows.select(*schemas.KLINES.names)


def refine_tickers(
    records: DataFrame, *, watermark_delay: str | None = None, dedup: bool = True
) -> DataFrame:
    """Typed tickers with a symbol, time, positive last price, volume not negative."""
    rows = _refined(
        typed_tickers(records), is_good_ticker(), TICKER_KEY, _ARRIVAL, watermark_delay, dedup
    )
    return rows.select(*schemas.TICKERS.names)


def rejected(typed: DataFrame, good: Column) -> DataFrame:
    """The rows a quality filter drops, where a condition that is null counts as failed."""
    return typed.where(~F.coalesce(good, F.lit(False)))
