"""Event-time window measures over trades, and the tables cut from them.

Four five-minute tables share one grouping key, so all their measures come from a single
aggregate: one scan, one shuffle, one state store. Used on its own, each table lets
Catalyst drop the measures it does not read. A sum or change that does not fit its type is
null for its symbol and window; it does not end the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions import signals
from marketloom.functions.values import moment_key
from marketloom.operators.rows import watermarked


def _keyed(trades: DataFrame, watermark_delay: str | None) -> DataFrame:
    trade_id = F.col("trade_id") if "trade_id" in trades.columns else F.lit(0).cast("bigint")
    rows = watermarked(trades, "event_time", watermark_delay)
    return rows.withColumn("_moment", moment_key(F.col("event_time"), trade_id))


def _flattened(grouped: DataFrame) -> DataFrame:
    measures = [name for name in grouped.columns if name not in ("symbol", "_window")]
    return grouped.select(
        "symbol",
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
        *measures,
    )


def ohlc_bars(
    trades: DataFrame, *, width: str = "1 minute", watermark_delay: str | None = None
) -> DataFrame:
    """Open, high, low, close, count and totals per symbol and window."""
    grouped = (
        _keyed(trades, watermark_delay)
        .groupBy("symbol", F.window("event_time", width).alias("_window"))
        .agg(
            F.min_by("price", "_moment").alias("open_price"),
            F.max("price").alias("high_price"),
            F.min("price").alias("low_price"),
            F.max_by("price", "_moment").alias("close_price"),
            F.count("*").alias("trade_count"),
            F.try_sum("quantity").alias("total_quantity"),
            F.try_sum("trade_value").alias("total_trade_value"),
        )
    )
    return _flattened(grouped)


def window_measures(
    trades: DataFrame, *, width: str = "5 minutes", watermark_delay: str | None = None
) -> DataFrame:
    """Every measure the five-minute tables need, per symbol and window."""
    grouped = (
        _keyed(trades, watermark_delay)
        .groupBy("symbol", F.window("event_time", width).alias("_window"))
        .agg(
            F.min_by("price", "_moment").alias("start_price"),
            F.max_by("price", "_moment").alias("end_price"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
            F.try_avg("price").alias("avg_price"),
            F.stddev_pop("price").alias("price_stddev"),
            F.count("*").alias("number_of_trades"),
            F.try_sum("quantity").alias("total_volume"),
            F.try_avg("trade_value").alias("average_trade_value"),
            F.max("trade_value").alias("max_trade_value"),
            F.min("trade_value").alias("min_trade_value"),
        )
    )
    return _flattened(grouped)


def _change():
    return signals.percent_change(F.col("start_price"), F.col("end_price"))


def trade_summary(measures: DataFrame) -> DataFrame:
    """Volume, number of trades, and average, largest and smallest trade value."""
    return measures.select(
        "symbol",
        "window_start",
        "window_end",
        "total_volume",
        "number_of_trades",
        "average_trade_value",
        "max_trade_value",
        "min_trade_value",
    )


def volatility(measures: DataFrame) -> DataFrame:
    """Price spread, change over the window, and the level of that change."""
    changed = measures.withColumn("price_change_pct", _change())
    return changed.select(
        "symbol",
        "window_start",
        "window_end",
        "avg_price",
        "min_price",
        "max_price",
        "price_stddev",
        "price_change_pct",
        signals.volatility_level(F.col("price_change_pct")).alias("volatility_level"),
    )


def price_alerts(measures: DataFrame) -> DataFrame:
    """Windows whose price moved beyond the alert threshold."""
    change = F.col("price_change_pct")
    changed = measures.withColumn("price_change_pct", _change())
    return changed.select(
        "symbol",
        "window_start",
        "window_end",
        "start_price",
        "end_price",
        "price_change_pct",
        signals.price_alert_type(change).alias("alert_type"),
        signals.alert_severity(change).alias("severity"),
    ).where(F.col("alert_type").isNotNull())


def watchlist(measures: DataFrame) -> DataFrame:
    """Latest price, change, volume, level and signal of each window."""
    change = F.col("price_change_5m_pct")
    changed = measures.withColumn("price_change_5m_pct", _change())
    return changed.select(
        "symbol",
        F.col("end_price").alias("latest_price"),
        "price_change_5m_pct",
        F.col("total_volume").alias("volume_5m"),
        signals.volatility_level(change).alias("volatility_level"),
        F.coalesce(signals.price_alert_type(change), F.lit("NONE")).alias("latest_signal"),
        F.col("window_end").alias("last_updated_time"),
    )
