"""Queries behind the market views: snapshot, rankings, histories, health, alerts.

Every function takes and returns DataFrames. Rankings end in a top-k, so no more than the
rows shown ever leave the executors.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom import schemas
from marketloom.functions import signals
from marketloom.operators.refine import first_per_key
from marketloom.plans.ranges import instant_literal, since

# Row limits of the histories and charts.
OHLC_HISTORY_ROWS = 120
HISTORY_ROWS = 60
CHART_ROWS = 12
VIEW_ROWS = 50
INSPECTION_ROWS = 30

TIME_COLUMNS = ("window_end", "last_updated_time")


def latest_per_symbol(rows: DataFrame, time_column: str) -> DataFrame:
    """The newest row of every symbol."""
    return first_per_key(rows, ["symbol"], [F.col(time_column).desc()])


# --- market snapshot ---------------------------------------------------------------------


def _attention(rows: DataFrame) -> DataFrame:
    inputs = (
        F.col("price_change_5m_pct"),
        F.col("volume_spike_ratio"),
        F.col("signal_strength"),
        F.col("volatility_level"),
    )
    return rows.withColumns(
        {
            "attention_score": signals.attention_score(*inputs),
            "market_direction": signals.market_direction(F.col("price_change_5m_pct")),
            "attention_reason": signals.attention_reason(*inputs),
        }
    )


def _by_attention() -> list[Column]:
    return [F.col("attention_score").desc(), F.col("volume_5m").desc(), F.col("symbol").asc()]


def rate_attention(rows: DataFrame) -> DataFrame:
    """Add score, direction and reason."""
    return _attention(rows)


def market_snapshot(
    watchlist: DataFrame,
    spikes: DataFrame | None = None,
    *,
    limit: int = VIEW_ROWS,
    start: datetime | None = None,
) -> DataFrame:
    """The latest state of every symbol with its latest spike, ranked by attention.

    Both sides are reduced to one row per symbol first and are then already partitioned by
    symbol, so the join adds no shuffle.
    """
    latest = latest_per_symbol(
        since(watchlist, "last_updated_time", start), "last_updated_time"
    )
    if spikes is None:
        joined = latest.withColumns(
            {
                "volume_spike_ratio": F.lit(None).cast("double"),
                "signal_strength": F.lit(None).cast("string"),
            }
        )
    else:
        latest_spike = latest_per_symbol(since(spikes, "window_end", start), "window_end")
        joined = latest.join(
            latest_spike.select(
                "symbol",
                F.col("volume_spike_ratio").cast("double").alias("volume_spike_ratio"),
                "signal_strength",
            ),
            "symbol",
            "left",
        )
    columns = (
        "symbol",
        "latest_price",
        "price_change_5m_pct",
        "volume_5m",
        "volatility_level",
        "latest_signal",
        "volume_spike_ratio",
        "signal_strength",
        "last_updated_time",
    )
    return rate_attention(joined.select(*columns)).orderBy(*_by_attention()).limit(limit)


def symbol_state(snapshot: DataFrame, symbol: str) -> DataFrame:
    """The snapshot row of one symbol."""
    return snapshot.where(F.col("symbol") == symbol)


def symbol_list(rows: DataFrame) -> DataFrame:
    """All symbols in order."""
    return rows.select("symbol").where(F.col("symbol").isNotNull()).distinct().orderBy("symbol")


def signal_leaders(snapshot: DataFrame) -> DataFrame:
    """The symbol with the strongest volume ratio and the one with the largest move."""
    ratio = F.col("volume_spike_ratio").cast("double")
    move = F.abs(F.col("price_change_5m_pct").cast("double"))
    best = snapshot.agg(
        F.max_by("symbol", F.struct(ratio, F.col("attention_score"), "symbol")).alias("r_symbol"),
        F.max(ratio).alias("r_value"),
        F.max_by("symbol", F.struct(move, F.col("attention_score"), "symbol")).alias("m_symbol"),
        F.coalesce(F.max(move), F.lit(0.0)).alias("m_value"),
    )
    leaders = F.array(
        F.struct(
            F.lit("Strongest volume spike").alias("signal"),
            F.col("r_symbol").alias("symbol"),
            F.col("r_value").alias("value"),
        ),
        F.struct(
            F.lit("Largest 5m price move").alias("signal"),
            F.col("m_symbol").alias("symbol"),
            F.col("m_value").alias("value"),
        ),
    )
    return best.select(F.inline(leaders)).where(F.col("symbol").isNotNull())


def chart_input(snapshot: DataFrame, column: str, *, limit: int = CHART_ROWS) -> DataFrame:
    """The first symbols in snapshot order that have a value to draw."""
    return (
        snapshot.where(F.col(column).isNotNull())
        .orderBy(*_by_attention())
        .limit(limit)
        .select("symbol", F.col(column).cast("double").alias(column))
    )


# --- newest signals ----------------------------------------------------------------------


def newest_spikes(
    spikes: DataFrame, *, limit: int = VIEW_ROWS, start: datetime | None = None
) -> DataFrame:
    """Newest windows first, strongest ratio first within a window."""
    order = F.col("window_end").desc(), F.col("volume_spike_ratio").desc(), F.col("symbol")
    return since(spikes, "window_end", start).orderBy(*order).limit(limit)


def newest_price_alerts(
    alerts: DataFrame, *, limit: int = VIEW_ROWS, start: datetime | None = None
) -> DataFrame:
    """Newest windows first, largest move first within a window."""
    order = F.col("window_end").desc(), F.abs("price_change_pct").desc(), F.col("symbol")
    return since(alerts, "window_end", start).orderBy(*order).limit(limit)


# --- history of one symbol ---------------------------------------------------------------


def symbol_history(
    rows: DataFrame,
    symbol: str,
    *,
    limit: int = HISTORY_ROWS,
    start: datetime | None = None,
    tie_break: tuple[Column, ...] = (),
) -> DataFrame:
    """The newest windows of one symbol, oldest of them first."""
    newest = (
        since(rows, "window_end", start)
        .where(F.col("symbol") == symbol)
        .orderBy(F.col("window_end").desc(), *tie_break)
        .limit(limit)
    )
    return newest.orderBy("window_end")


def ohlc_history(bars: DataFrame, symbol: str, **options) -> DataFrame:
    return symbol_history(bars, symbol, **{"limit": OHLC_HISTORY_ROWS, **options})


def summary_history(summary: DataFrame, symbol: str, **options) -> DataFrame:
    return symbol_history(summary, symbol, **options)


def spike_history(spikes: DataFrame, symbol: str, **options) -> DataFrame:
    order = (F.col("volume_spike_ratio").desc(),)
    return symbol_history(spikes, symbol, tie_break=order, **options)


# --- health and overview -----------------------------------------------------------------


def _time_column(rows: DataFrame) -> str | None:
    return next((name for name in TIME_COLUMNS if name in rows.columns), None)


def _health_row(name: str, table: DataFrame | None, start: datetime | None, spark: SparkSession):
    if table is None:
        return spark.range(1).select(
            F.lit(name).alias("table"),
            F.lit(False).alias("table_exists"),
            F.lit(0).cast("bigint").alias("row_count"),
            F.lit(0).cast("bigint").alias("total_row_count"),
            F.lit(None).cast("timestamp").alias("latest_time"),
        )
    time_column = _time_column(table)
    rows = table.select(F.col(time_column).alias("at")) if time_column else table.select(
        F.lit(None).cast("timestamp").alias("at")
    )
    in_range = F.lit(True)
    if time_column and start is not None:
        # A condition instead of a filter, so that one pass gives both counts.
        in_range = F.col("at") >= instant_literal(start)
    return rows.agg(
        F.count_if(in_range).alias("row_count"),
        F.count("*").alias("total_row_count"),
        F.max("at").alias("latest_time"),
    ).select(
        F.lit(name).alias("table"),
        F.lit(True).alias("table_exists"),
        "row_count",
        "total_row_count",
        "latest_time",
    )


def table_health(
    tables: Mapping[str, DataFrame | None],
    *,
    start: datetime | None = None,
    paths: Mapping[str, str] | None = None,
    spark: SparkSession | None = None,
) -> DataFrame:
    """Per table: whether it exists, rows in range, all rows, newest time. One pass each.

    ``paths`` adds where each table is stored. ``spark`` defaults to the active session, which
    a fresh deployment without any table needs.
    """
    session = spark or SparkSession.active()
    rows = [_health_row(name, table, start, session) for name, table in tables.items()]
    if paths:
        rows = [
            row.withColumn("path", F.lit(paths[name])) for name, row in zip(tables, rows)
        ]
    return reduce(DataFrame.unionByName, rows)


def with_freshness(health: DataFrame, now: Column) -> DataFrame:
    return health.withColumn("freshness", signals.freshness(F.col("latest_time"), now))


def overview(
    snapshot: DataFrame,
    spikes: DataFrame,
    alerts: DataFrame,
    health: DataFrame,
    *,
    now: Column,
) -> DataFrame:
    """Headline numbers over the given frames, as one row.

    Each frame is reduced to a partial row with the same columns; the partial rows are
    united and folded, which needs no join.
    """
    parts = (
        snapshot.agg(
            F.count_distinct("symbol").alias("symbols"),
            F.coalesce(F.max(F.col("volume_spike_ratio").cast("double")), F.lit(0.0)).alias(
                "strongest_spike"
            ),
            F.coalesce(
                F.max(F.abs(F.col("price_change_5m_pct").cast("double"))), F.lit(0.0)
            ).alias("biggest_abs_move"),
        ),
        spikes.agg(F.count_if(F.col("signal_strength") == "HIGH").alias("high_volume_spikes")),
        alerts.agg(F.count("*").alias("price_alerts")),
        health.agg(F.max("latest_time").alias("latest_gold_time")),
    )
    united = reduce(lambda one, two: one.unionByName(two, allowMissingColumns=True), parts)
    names = (
        "symbols",
        "high_volume_spikes",
        "price_alerts",
        "strongest_spike",
        "biggest_abs_move",
        "latest_gold_time",
    )
    folded = united.agg(*(F.max(name).alias(name) for name in names))
    return folded.withColumn("freshness", signals.freshness(F.col("latest_gold_time"), now))


# --- published alerts --------------------------------------------------------------------


def alert_rows(records: DataFrame, *, start: datetime | None = None) -> DataFrame:
    """All alert messages created since ``start``, with the JSON fields as columns.

    Pass ``start`` to ``bus.read_topic`` too: an alert is sent after it was created, so older
    records need not be fetched.
    """
    parsed = records.select(
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("key").cast("string").alias("symbol_key"),
        F.from_json(F.col("value").cast("string"), schemas.ALERT_EVENT).alias("alert"),
    ).select("topic", "partition", "offset", "kafka_timestamp", "symbol_key", "alert.*")
    if start is not None:
        parsed = parsed.withColumn("_created", F.try_to_timestamp("created_at"))
        parsed = since(parsed, "_created", start).drop("_created")
    return parsed


def published_alerts(
    records: DataFrame, *, limit: int = VIEW_ROWS, start: datetime | None = None
) -> DataFrame:
    """The newest alert messages of a topic, with the JSON fields as columns."""
    parsed = alert_rows(records, start=start)
    newest = F.col("kafka_timestamp").desc(), F.col("offset").desc(), F.col("partition")
    return parsed.orderBy(*newest).limit(limit)


def raw_messages(records: DataFrame) -> DataFrame:
    """All messages of a topic with key and value as text."""
    return records.select(
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("key").cast("string").alias("symbol_key"),
        F.col("value").cast("string").alias("alert_json"),
    )


def alert_totals(published: DataFrame) -> DataFrame:
    """Number of alerts, symbols and HIGH alerts, and the latest creation time."""
    return published.agg(
        F.count("*").alias("published_alerts"),
        F.count_distinct("symbol").alias("symbols_alerted"),
        F.count_if(F.col("severity") == "HIGH").alias("high_severity"),
        F.max("created_at").alias("latest_alert"),
    )
