"""The streaming queries of the raw, typed, metric and alert layers.

Each function starts the queries of one layer and returns them. Raw records of all topics
go to one table partitioned by topic and date, so the bus is read once and written once;
readers of a topic are pruned to its partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StructField, StructType

from marketloom import config, schemas
from marketloom.config import Settings
from marketloom.operators import alerts, refine, spikes, windows
from marketloom.operators.capture import capture
from marketloom.sources import commits
from marketloom.sources.bus import Bus, publish, stream_topics
from marketloom.sources.sinks import append_batch_once, append_stream, application_id, by_partition, paced
from marketloom.sources.tables import ensure_table, read_table_or_empty, stream_table
from marketloom.streaming.supervision import progress_kept, supervise

Starter = Callable[[SparkSession, Settings], list[StreamingQuery]]


def _append(
    rows: DataFrame, settings: Settings, path: str, query: str, name: str, partition_by=()
) -> StreamingQuery:
    return append_stream(
        rows,
        path,
        checkpoint=settings.checkpoint(query),
        name=name,
        table_format=settings.table_format,
        partition_by=partition_by,
        interval=settings.trigger_interval,
        available_now=settings.available_now,
    )


#: Column of each stored table whose day it is partitioned by, and the partition's name.
EVENT_DATE, WINDOW_DATE = "event_date", "window_date"
KEYED_TRADES = StructType([*schemas.TRADES.fields, StructField(EVENT_DATE, DateType())])


def _dated(rows: DataFrame, time_column: str, date: str) -> DataFrame:
    return rows.withColumn(date, F.to_date(time_column))


def _by_day(rows: DataFrame, settings: Settings, time_column: str, date: str) -> DataFrame:
    """Rows with the day they are stored under, each day dealt to a few tasks that write it."""
    return by_partition(_dated(rows, time_column, date), (date,), time_column, settings.files_per_day)


def bus_of(settings: Settings, path: str | None = None) -> Bus:
    return Bus(
        format=settings.bus_format,
        options=settings.bus_options,
        path=path,
        starting_offsets=settings.starting_offsets,
        fail_on_data_loss=settings.fail_on_data_loss,
        max_offsets_per_trigger=settings.max_offsets_per_trigger,
        max_files_per_trigger=settings.max_files_per_trigger,
    )


# --- raw layer ---------------------------------------------------------------------------


def start_capture(records: DataFrame, settings: Settings) -> StreamingQuery:
    """Capture a stream of bus records of any topics into the raw table."""
    return _append(
        capture(records),
        settings,
        settings.bronze(config.BRONZE_ALL),
        "bronze/all",
        config.BRONZE_ALL,
        partition_by=("topic", "process_date"),
    )


def start_bronze(
    spark: SparkSession, settings: Settings, bus_path: str | None = None
) -> list[StreamingQuery]:
    records = stream_topics(spark, bus_of(settings, bus_path), settings.feed.topics)
    return [start_capture(records, settings)]


def stream_raw(spark: SparkSession, settings: Settings, topic: str) -> DataFrame:
    """Captured records of one topic as a stream, pruned to the topic's partitions."""
    rows = stream_table(
        spark,
        settings.bronze(config.BRONZE_ALL),
        schemas.RAW_RECORD,
        table_format=settings.table_format,
        max_files_per_trigger=settings.max_files_per_trigger,
    )
    return rows.where(F.col("topic") == topic)


def read_raw(spark: SparkSession, settings: Settings, topic: str) -> DataFrame:
    """Captured records of one topic, empty when nothing was captured yet."""
    rows = read_table_or_empty(
        spark,
        settings.bronze(config.BRONZE_ALL),
        schemas.RAW_RECORD,
        table_format=settings.table_format,
    )
    return rows.where(F.col("topic") == topic)


# --- typed layer -------------------------------------------------------------------------


def start_silver(spark: SparkSession, settings: Settings) -> list[StreamingQuery]:
    feed = settings.feed
    jobs = (
        (feed.trades_topic, refine.refine_trades, config.SILVER_TRADES, "event_time", "silver/trades"),
        (feed.klines_topic, refine.refine_klines, config.SILVER_KLINES, "kline_start_time", "silver/klines"),
        (feed.tickers_topic, refine.refine_tickers, config.SILVER_TICKERS, "event_time", "silver/tickers"),
    )
    return [
        _append(
            _by_day(
                transform(stream_raw(spark, settings, topic), watermark_delay=settings.silver_watermark),
                settings,
                time_column,
                EVENT_DATE,
            ),
            settings,
            settings.silver(table),
            query,
            table,
            partition_by=(EVENT_DATE,),
        )
        for topic, transform, table, time_column, query in jobs
    ]


def _keep_new_trades(batch: DataFrame, batch_id: int, settings: Settings) -> None:
    spark = batch.sparkSession
    path = settings.silver(config.SILVER_KEYED_TRADES)
    application = _application(spark, config.SILVER_KEYED_TRADES, settings.checkpoint("silver/keyed_trades"))
    if commits.is_committed(spark, path, application, batch_id):
        return
    stored = commits.read_committed(spark, path, KEYED_TRADES)
    batch.persist()
    try:
        new = refine.unseen(
            batch, stored, refine.TRADE_KEY, ("event_time", "bronze_partition", "bronze_offset"),
            day=EVENT_DATE, reach_days=settings.copy_reach_days,
        )
        attempt = commits.write_attempt(new, batch_id, path, application, (EVENT_DATE,))
        commits.commit(spark, path, application, batch_id, attempt)
    finally:
        batch.unpersist()


def start_keyed_trades(spark: SparkSession, settings: Settings) -> list[StreamingQuery]:
    """Typed trades once per key for good: late trades are kept and late copies dropped.

    The watermarked query of ``start_silver`` drops both. This one keeps no state; every batch is
    held against the stored keys of its days, and a commit file makes it count.
    """
    rows = refine.refine_trades(stream_raw(spark, settings, settings.feed.trades_topic), dedup=False)
    writer = (
        _dated(rows, "event_time", EVENT_DATE)
        .writeStream.queryName(config.SILVER_KEYED_TRADES)
        .foreachBatch(lambda batch, batch_id: _keep_new_trades(batch, batch_id, settings))
        .option("checkpointLocation", settings.checkpoint("silver/keyed_trades"))
    )
    return [paced(writer, settings.trigger_interval, settings.available_now).start()]


def read_keyed_trades(spark: SparkSession, settings: Settings) -> DataFrame:
    """What ``start_keyed_trades`` has committed."""
    return commits.read_committed(spark, settings.silver(config.SILVER_KEYED_TRADES), KEYED_TRADES)


# --- metric layer ------------------------------------------------------------------------


def _stream_trades(spark: SparkSession, settings: Settings) -> DataFrame:
    return stream_table(
        spark,
        settings.silver(config.SILVER_TRADES),
        schemas.TRADES,
        table_format=settings.table_format,
        max_files_per_trigger=settings.max_files_per_trigger,
    )


def start_trade_windows(
    spark: SparkSession,
    settings: Settings,
    *,
    bar_width: str = "1 minute",
    width: str = "5 minutes",
) -> list[StreamingQuery]:
    """The two stateful queries of this layer: one-minute bars and five-minute measures."""
    trades = _stream_trades(spark, settings)
    delay = settings.gold_watermark
    return [
        _append(
            _by_day(
                windows.ohlc_bars(trades, width=bar_width, watermark_delay=delay), settings, "window_end", WINDOW_DATE
            ),
            settings,
            settings.gold(config.GOLD_OHLC),
            "gold/ohlc_1min",
            config.GOLD_OHLC,
            partition_by=(WINDOW_DATE,),
        ),
        _append(
            _by_day(
                windows.window_measures(trades, width=width, watermark_delay=delay), settings, "window_end", WINDOW_DATE
            ),
            settings,
            settings.gold(config.GOLD_WINDOW_MEASURES),
            "gold/window_measures",
            config.GOLD_WINDOW_MEASURES,
            partition_by=(WINDOW_DATE,),
        ),
    ]


def start_window_tables(spark: SparkSession, settings: Settings) -> list[StreamingQuery]:
    """The four five-minute tables: stateless cuts of the shared measures."""
    measures = stream_table(
        spark,
        settings.gold(config.GOLD_WINDOW_MEASURES),
        schemas.WINDOW_MEASURES,
        table_format=settings.table_format,
        max_files_per_trigger=settings.max_files_per_trigger,
    )
    jobs = (
        (windows.trade_summary, config.GOLD_SUMMARY, "window_end", "gold/trade_summary_5min"),
        (windows.volatility, config.GOLD_VOLATILITY, "window_end", "gold/volatility_5min"),
        (windows.price_alerts, config.GOLD_PRICE_ALERTS, "window_end", "gold/price_alerts"),
        (windows.watchlist, config.GOLD_WATCHLIST, "last_updated_time", "gold/watchlist_summary"),
    )
    return [
        _append(
            _by_day(cut(measures), settings, time_column, WINDOW_DATE),
            settings,
            settings.gold(table),
            query,
            table,
            partition_by=(WINDOW_DATE,),
        )
        for cut, table, time_column, query in jobs
    ]


def _application(spark: SparkSession, name: str, checkpoint: str) -> str:
    """The running query by its id, which a fresh checkpoint changes, else by its checkpoint."""
    query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{name}-{query_id}" if query_id else application_id(name, checkpoint)


def _write_spikes(batch: DataFrame, batch_id: int, settings: Settings) -> None:
    # Its bounds and its join both read the batch, which is computed once.
    batch.persist()
    try:
        _write_rated(batch, batch_id, settings)
    finally:
        batch.unpersist()


def _write_rated(batch: DataFrame, batch_id: int, settings: Settings) -> None:
    spark = batch.sparkSession
    summary = read_table_or_empty(
        spark,
        settings.gold(config.GOLD_SUMMARY),
        schemas.TRADE_SUMMARY,
        table_format=settings.table_format,
    )
    lookback = settings.baseline_lookback_minutes
    history = spikes.history_for(batch, summary, lookback)
    append_batch_once(
        spikes.volume_spikes(batch, history, lookback_minutes=lookback),
        batch_id,
        settings.gold(config.GOLD_SPIKES),
        application=_application(spark, "gold-volume-spike-signals", settings.checkpoint("gold/volume_spikes")),
        table_format=settings.table_format,
    )


def start_spikes(spark: SparkSession, settings: Settings) -> list[StreamingQuery]:
    """Rate every new summary window against the summary table as it is then."""
    summary = stream_table(
        spark,
        settings.gold(config.GOLD_SUMMARY),
        schemas.TRADE_SUMMARY,
        table_format=settings.table_format,
        max_files_per_trigger=settings.max_files_per_trigger,
    )
    writer = (
        summary.writeStream.queryName(config.GOLD_SPIKES)
        .foreachBatch(lambda batch, batch_id: _write_spikes(batch, batch_id, settings))
        .option("checkpointLocation", settings.checkpoint("gold/volume_spikes"))
    )
    return [paced(writer, settings.trigger_interval, settings.available_now).start()]


def bootstrap_gold(spark: SparkSession, settings: Settings) -> None:
    """Create the tables that other streams of this layer read, unless they exist.

    A file sink creates its log when its query starts, before the readers below it do, and
    readers then trust that log alone; only a transactional table has to exist beforehand.
    """
    if settings.table_format != "delta":
        return
    for table in (config.GOLD_WINDOW_MEASURES, config.GOLD_SUMMARY):
        ensure_table(
            spark,
            settings.gold(table),
            schemas.TABLE_SCHEMAS[table],
            table_format=settings.table_format,
        )


def start_gold(spark: SparkSession, settings: Settings) -> list[StreamingQuery]:
    bootstrap_gold(spark, settings)
    return [
        *start_trade_windows(spark, settings),
        *start_window_tables(spark, settings),
        *start_spikes(spark, settings),
    ]


# --- alert layer -------------------------------------------------------------------------


def _start_alerts(
    spark: SparkSession,
    settings: Settings,
    bus: Bus,
    table: str,
    build: Callable[[DataFrame], DataFrame],
    query: str,
    repeats_within: str | None,
) -> StreamingQuery:
    rows = stream_table(
        spark,
        settings.gold(table),
        schemas.TABLE_SCHEMAS[table],
        table_format=settings.table_format,
        max_files_per_trigger=settings.max_files_per_trigger,
    )
    if repeats_within:
        kind = ["alert_type"] if "alert_type" in rows.columns else []
        rows = rows.withWatermark("window_end", repeats_within).dropDuplicatesWithinWatermark(
            ["symbol", "window_end", *kind]
        )
    return publish(
        alerts.alert_messages(build(rows)),
        bus,
        settings.feed.alerts_topic,
        checkpoint=settings.checkpoint(query),
        name=f"publish-{table}",
        interval=settings.trigger_interval,
        available_now=settings.available_now,
    )


def start_volume_alerts(
    spark: SparkSession,
    settings: Settings,
    bus: Bus | None = None,
    repeats_within: str | None = None,
) -> list[StreamingQuery]:
    """Publish volume alerts.

    The spike table is never rewritten, so each spike is read once. ``repeats_within``
    additionally drops repeats by alert key within that event-time delay; rows later than
    the delay are then dropped as well, so it is off by default.
    """
    version = settings.feed.schema_version
    return [
        _start_alerts(
            spark,
            settings,
            bus or bus_of(settings),
            config.GOLD_SPIKES,
            lambda rows: alerts.volume_alerts(rows, schema_version=version),
            "alerts/volume_spikes",
            repeats_within,
        )
    ]


def start_price_alerts(
    spark: SparkSession,
    settings: Settings,
    bus: Bus | None = None,
    repeats_within: str | None = None,
) -> list[StreamingQuery]:
    """Publish price-move alerts; see ``start_volume_alerts`` for ``repeats_within``."""
    version = settings.feed.schema_version
    return [
        _start_alerts(
            spark,
            settings,
            bus or bus_of(settings),
            config.GOLD_PRICE_ALERTS,
            lambda rows: alerts.price_move_alerts(rows, schema_version=version),
            "alerts/price_movements",
            repeats_within,
        )
    ]


# --- running -----------------------------------------------------------------------------


def drain(queries: Iterable[StreamingQuery]) -> None:
    """Wait until every query of a bounded run has ended."""
    supervise(queries, bounded=True)


def run_layer(spark: SparkSession, settings: Settings, start: Starter, *, progress_path: str | None = None) -> None:
    """Run a layer until one of its queries ends, or all of a bounded run; then stop the others.

    The error of a query that fails is raised. With ``progress_path`` the progress of the queries
    is kept as a table there (``supervision.progress``).
    """
    with progress_kept(spark, progress_path):
        supervise(start(spark, settings), bounded=settings.available_now)


LAYERS: dict[str, Starter] = {
    "bronze": start_bronze,
    "silver": start_silver,
    "gold": start_gold,
    "alerts-volume": start_volume_alerts,
    "alerts-price": start_price_alerts,
}
