"""Sources, sinks and streaming layers, run over the given tables with bounded triggers.

The bus is stood in for by Parquet files with the columns of a bus record. One bounded run
of all layers is shared by the queries that look at its tables.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from checks import inputs
from checks.inputs import FEED
from checks.layers import _num, spike_columns_sql
from checks.registry import instant_sql as t
from checks.registry import query
from checks.sql import ALERT_TYPE, EV, GOLD, LEVEL, MSG, MSG_TRADES, TRADES, measures
from checks.sql import spikes as spikes_sql
from marketloom import config, schemas
from marketloom.config import Settings
from marketloom.operators import windows
from marketloom.operators.capture import capture
from marketloom.plans import inspection
from marketloom.sources import bus, commits, sinks, tables
from marketloom.streaming import layers, state, supervision

_RUNS: dict[tuple[str, str], Settings] = {}


def settings_in(root: str) -> Settings:
    """Settings of a bounded run with everything under one folder and files as the bus."""
    return Settings(
        bronze_path=f"{root}/bronze",
        silver_path=f"{root}/silver",
        gold_path=f"{root}/gold",
        checkpoint_path=f"{root}/checkpoints",
        bus_format="parquet",
        available_now=True,
    )


def bus_folder(spark: SparkSession, sf_dir: str, root: str) -> str:
    """All messages of the table as bus records on disk."""
    path = f"{root}/bus"
    inputs.bus_records(spark, sf_dir).write.mode("errorifexists").parquet(path)
    return path


def _delivered(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """All messages as bus records, built once for several deliveries of them."""
    return tables.read_table(spark, bus_folder(spark, sf_dir, f"{root}/feed"), schemas.BUS_RECORD)


def all_layers(spark: SparkSession, sf_dir: str) -> Settings:
    """Raw capture to published alerts, each layer drained before the next one starts."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RUNS:
        root = inputs.work_dir(spark, "layers")
        settings = settings_in(root)
        records = bus_folder(spark, sf_dir, root)
        alert_bus = bus.Bus(format="parquet", path=f"{root}/alerts")
        layers.drain(layers.start_bronze(spark, settings, records))
        layers.drain(layers.start_silver(spark, settings))
        with supervision.progress_kept(spark, f"{root}/progress"):
            layers.drain(layers.start_trade_windows(spark, settings))
            layers.drain(layers.start_window_tables(spark, settings))
            layers.drain(layers.start_spikes(spark, settings))
        layers.drain(layers.start_volume_alerts(spark, settings, alert_bus))
        layers.drain(
            layers.start_price_alerts(
                spark, settings, dataclasses.replace(alert_bus, path=f"{root}/price-alerts")
            )
        )
        _RUNS[key] = settings
    return _RUNS[key]


def _gold(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    settings = all_layers(spark, sf_dir)
    schema = schemas.TABLE_SCHEMAS[table]
    return tables.read_table_or_empty(spark, settings.gold(table), schema).select(*schema.names)


# --- bus sources and raw sink ------------------------------------------------------------

_ROUTED = MSG + """,
routed AS (
  SELECT *, CASE WHEN error_type IS NULL THEN topic ELSE 'market.events.invalid' END AS to_topic
  FROM norm
)"""


@query(
    "s1_multi_topic_stream",
    f"""WITH {_ROUTED} SELECT to_topic AS topic, event_id AS "offset", {t('ts')} AS kafka_timestamp
    FROM routed""",
)
def s1_multi_topic_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One subscription to all topics, captured by one query into one table."""
    settings = all_layers(spark, sf_dir)
    raw = tables.read_table(spark, settings.bronze(config.BRONZE_ALL), schemas.RAW_RECORD)
    return raw.select("topic", "offset", "kafka_timestamp")


@query(
    "s2_single_topic_stream",
    f"""WITH {_ROUTED} SELECT to_topic AS topic, event_id AS "offset" FROM routed
    WHERE to_topic = 'market.klines.raw'""",
)
def s2_single_topic_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = inputs.work_dir(spark, "topic")
    source = bus.Bus(format="parquet", path=bus_folder(spark, sf_dir, root))
    records = capture(bus.stream_topics(spark, source, [FEED.klines_topic]))
    layers.drain(
        [
            sinks.append_stream(
                records, f"{root}/raw", checkpoint=f"{root}/checkpoint",
                name=config.BRONZE_KLINES, partition_by=["process_date"], available_now=True,
            )
        ]
    )
    return spark.read.schema(schemas.RAW_RECORD).parquet(f"{root}/raw").select("topic", "offset")


@query(
    "s3_rate_limited_stream",
    f"""WITH {TRADES} SELECT symbol, trade_id, {_num('price')} AS price FROM trades""",
)
def s3_rate_limited_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored trade table streamed one file per batch into another table."""
    root = inputs.work_dir(spark, "limited")
    columns = ("symbol", "trade_id", "price")
    inputs.trades(spark, sf_dir).select(*columns).repartition(4).write.parquet(f"{root}/source")
    rows = tables.stream_table(
        spark,
        f"{root}/source",
        schemas.subset(schemas.TRADES, columns),
        max_files_per_trigger=1,
    )
    layers.drain(
        [
            sinks.append_stream(
                rows, f"{root}/out", checkpoint=f"{root}/checkpoint", name="limited",
                available_now=True,
            )
        ]
    )
    return spark.read.parquet(f"{root}/out")


@query(
    "s4_optional_table",
    "SELECT 'events' AS \"table\", count(*) AS rows FROM events UNION ALL SELECT 'missing', 0",
)
def s4_optional_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that exists and one that does not, which is not an error."""
    stored = tables.read_table(spark, f"{sf_dir}/events.parquet")
    missing = tables.read_table_or_empty(spark, f"{sf_dir}/missing.parquet", schemas.WATCHLIST)
    counts = [
        rows.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, rows in (("events", stored), ("missing", missing))
    ]
    return counts[0].unionByName(counts[1])


@query(
    "s5_bounded_bus_read",
    f"""WITH {_ROUTED} SELECT to_topic AS topic, event_id AS "offset",
      CASE WHEN error_type IS NULL THEN symbol ELSE coalesce(topic, error_type) END AS symbol_key
    FROM routed WHERE to_topic = 'market.events.invalid'""",
)
def s5_bounded_bus_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything on a topic, plus a bus that is not there and reads as empty."""
    from marketloom.plans.serving import raw_messages

    root = inputs.work_dir(spark, "bounded")
    source = bus.Bus(format="parquet", path=bus_folder(spark, sf_dir, root))
    absent = bus.Bus(format="parquet", path=f"{root}/absent")
    records = bus.read_topic(spark, source, FEED.invalid_topic).unionByName(
        bus.read_topic(spark, absent, FEED.invalid_topic)
    )
    return raw_messages(records).select("topic", "offset", "symbol_key")


@query(
    "s6_bootstrap_table",
    f"WITH {GOLD} SELECT symbol, {t('ws')} AS window_start, {_num('volume')} AS total_volume FROM m",
)
def s6_bootstrap_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty typed table, created once only, then filled."""
    path = inputs.work_dir(spark, "bootstrap")
    tables.ensure_table(spark, path, schemas.TRADE_SUMMARY)
    measures_now = windows.window_measures(inputs.trades(spark, sf_dir))
    windows.trade_summary(measures_now).write.mode("append").parquet(path)
    tables.ensure_table(spark, path, schemas.TRADE_SUMMARY)
    rows = tables.read_table(spark, path, schemas.TRADE_SUMMARY)
    return rows.select("symbol", "window_start", "total_volume")


@query(
    "s8_fan_out_by_topic",
    f"WITH {_ROUTED} SELECT to_topic AS topic, count(*) AS rows FROM routed GROUP BY ALL",
)
def s8_fan_out_by_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each topic read through its own partitions of the raw table."""
    settings = all_layers(spark, sf_dir)
    parts = [
        layers.read_raw(spark, settings, topic)
        .agg(F.count("*").alias("rows"))
        .select(F.lit(topic).alias("topic"), "rows")
        for topic in FEED.topics
    ]
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part)
    return united


@query(
    "s9_idempotent_append",
    f"WITH {GOLD} SELECT symbol, {t('ws')} AS window_start, {_num('volume')} AS total_volume FROM m",
)
def s9_idempotent_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batch delivered twice is stored once."""
    path = inputs.work_dir(spark, "once")
    _deliver_twice(spark, sf_dir, path, "summary")
    return spark.read.parquet(path).select("symbol", "window_start", "total_volume")


def _deliver_twice(spark: SparkSession, sf_dir: str, path: str, application: str) -> None:
    summary = windows.trade_summary(windows.window_measures(inputs.trades(spark, sf_dir)))
    first = F.col("symbol").isin("CLICK", "VIEW")
    for batch_id, batch in ((0, summary.where(first)), (1, summary.where(~first))):
        for _ in range(2):
            sinks.append_batch_once(batch, batch_id, path, application=application)


@query(
    "s9_two_applications",
    f"""WITH {GOLD} SELECT a AS application, symbol, {t('ws')} AS window_start,
      {_num('volume')} AS total_volume FROM m, (VALUES ('one'), ('two/2')) AS v(a)""",
)
def s9_two_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two applications append batches of the same numbers to one table."""
    path = inputs.work_dir(spark, "once")
    for application in ("one", "two/2"):
        _deliver_twice(spark, sf_dir, path, application)
    rows = spark.read.parquet(path)
    return rows.select("application", "symbol", "window_start", "total_volume")


@query(
    "s9_commit_log",
    f"""WITH {GOLD} SELECT a AS application, symbol, {t('ws')} AS window_start,
      {_num('volume')} AS total_volume FROM m, (VALUES ('one'), ('two/2')) AS v(a)""",
)
def s9_commit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that count by their commit: killed writers, replays, and a compaction between them."""
    path = inputs.work_dir(spark, "commits")
    summary = windows.trade_summary(windows.window_measures(inputs.trades(spark, sf_dir)))
    summary = summary.select("symbol", "window_start", "total_volume")
    first = F.col("symbol").isin("CLICK", "VIEW")
    stored = StructType([*summary.schema.fields, StructField("writer", StringType(), False)])
    for writer in ("one", "two/2"):
        rows = summary.withColumn("writer", F.lit(writer))
        for batch_id, batch in ((0, rows.where(first)), (1, rows.where(~first))):
            commits.write_attempt(batch, batch_id, path, writer)
            for _ in range(2):
                commits.append_committed(batch, batch_id, path, application=writer)
        commits.compact(spark, path, stored, writer)
        commits.append_committed(rows, 1, path, application=writer)
    found = commits.read_committed(spark, path, stored)
    return found.select(F.col("writer").alias("application"), "symbol", "window_start", "total_volume")


@query(
    "s10_append_and_restart",
    f"""WITH {TRADES} SELECT symbol, trade_id FROM trades""",
)
def s10_append_and_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query started again from its checkpoint adds nothing it has already written."""
    root = inputs.work_dir(spark, "restart")
    columns = ("symbol", "trade_id")
    inputs.trades(spark, sf_dir).select(*columns).write.parquet(f"{root}/source")
    for _ in range(2):
        rows = tables.stream_table(
            spark, f"{root}/source", schemas.subset(schemas.TRADES, columns)
        )
        layers.drain(
            [
                sinks.append_stream(
                    rows, f"{root}/out", checkpoint=f"{root}/checkpoint", name="restarted",
                    available_now=True,
                )
            ]
        )
    return spark.read.parquet(f"{root}/out")


@query(
    "s11_date_partitions",
    f"""WITH {_ROUTED} SELECT to_topic AS topic, CAST(CAST(ts AS DATE) AS VARCHAR) AS process_date,
      count(*) AS rows FROM routed GROUP BY ALL""",
)
def s11_date_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as if captured on the day of their bus time, counted by partition columns alone."""
    root = inputs.work_dir(spark, "dates")
    source = bus.Bus(format="parquet", path=bus_folder(spark, sf_dir, root))
    records = capture(bus.stream_topics(spark, source, FEED.topics))
    folders = ["topic", "process_date"]
    dated = sinks.by_partition(records.withColumn("process_date", F.to_date("kafka_timestamp")), folders, "offset", 4)
    layers.drain(
        [
            sinks.append_stream(
                dated, f"{root}/raw", checkpoint=f"{root}/checkpoint", name="dated", partition_by=folders,
                available_now=True,
            )
        ]
    )
    return spark.read.parquet(f"{root}/raw").groupBy("topic", "process_date").agg(F.count("*").alias("rows"))


# --- typed layer as a stream -------------------------------------------------------------


@query(
    "t6_dedup_stream",
    f"WITH {MSG_TRADES} SELECT symbol, trade_id, {t('event_time')} AS event_time FROM trades",
)
def t6_dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record delivered twice, the second time in a later micro-batch."""
    root = inputs.work_dir(spark, "dedup")
    settings = settings_in(root)
    records = _delivered(spark, sf_dir, root)
    again = records.withColumn("offset", F.col("offset") + F.lit(1 << 40))
    for delivery in (records, again):
        # A run of its own, so that event times of one delivery are not spread over batches.
        delivery.write.mode("append").parquet(f"{root}/bus")
        layers.drain(layers.start_bronze(spark, settings, f"{root}/bus"))
        layers.drain(layers.start_silver(spark, settings))
    rows = tables.read_table(spark, settings.silver(config.SILVER_TRADES), schemas.TRADES)
    return rows.select("symbol", "trade_id", "event_time")


@query(
    "t6_dedup_late",
    f"WITH {MSG_TRADES} SELECT symbol, trade_id, {t('event_time')} AS event_time FROM trades",
)
def t6_dedup_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newer half of the records first, then all: late records are kept, late copies dropped."""
    root = inputs.work_dir(spark, "dedup")
    settings = settings_in(root)
    records = _delivered(spark, sf_dir, root)
    middle = records.select(F.percentile_approx(F.unix_micros("timestamp"), 0.5).alias("middle"))
    newer = records.join(middle, F.unix_micros("timestamp") > F.col("middle")).drop("middle")
    again = records.withColumn("offset", F.col("offset") + F.lit(1 << 40))
    for delivery in (newer, again):
        delivery.write.mode("append").parquet(f"{root}/bus")
        layers.drain(layers.start_bronze(spark, settings, f"{root}/bus"))
        layers.drain(layers.start_keyed_trades(spark, settings))
    return layers.read_keyed_trades(spark, settings).select("symbol", "trade_id", "event_time")


@query(
    "t7_watermarked_trades",
    f"""WITH {MSG_TRADES} SELECT symbol, {t('event_time')} AS event_time, trade_id,
      {_num('price')} AS price, {_num('quantity')} AS quantity, {_num('trade_value')} AS trade_value,
      is_buyer_market_maker, 'market.trades.raw' AS bronze_topic, event_id AS bronze_offset
    FROM trades""",
)
def t7_watermarked_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = all_layers(spark, sf_dir)
    rows = tables.read_table(spark, settings.silver(config.SILVER_TRADES), schemas.TRADES, exact=True)
    return rows.drop("source", "ingest_time", "bronze_partition", "process_time")


# --- metric layer as a stream ------------------------------------------------------------

# Append mode writes a window once the watermark has passed its end.
_CLOSED = "(SELECT max(event_time) - INTERVAL '10 minutes' FROM trades)"
_STREAM_GOLD = (
    MSG_TRADES
    + ","
    + measures("5 minutes", name="every")
    + f", m AS (SELECT * FROM every WHERE we <= {_CLOSED}),"
    + spikes_sql("30 minutes")
)
_WINDOW = f"symbol, {t('ws')} AS window_start, {t('we')} AS window_end"


@query(
    "g1_stream_ohlc",
    f"""WITH {MSG_TRADES}, {measures('1 minute')} SELECT {_WINDOW}, {_num('s / 100.0')} AS open_price,
      {_num('hi')} AS high_price, {_num('lo')} AS low_price, {_num('e / 100.0')} AS close_price,
      n AS trade_count, {_num('volume')} AS total_quantity, {_num('total')} AS total_trade_value
    FROM m WHERE we <= {_CLOSED}""",
)
def g1_stream_ohlc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, config.GOLD_OHLC)


@query(
    "g2_stream_trade_summary",
    f"""WITH {_STREAM_GOLD} SELECT {_WINDOW}, {_num('volume')} AS total_volume,
      n AS number_of_trades, {_num('CAST(total AS DOUBLE) / n')} AS average_trade_value,
      {_num('hi_value')} AS max_trade_value, {_num('lo_value')} AS min_trade_value FROM m""",
)
def g2_stream_trade_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, config.GOLD_SUMMARY)


@query(
    "g3_stream_volatility",
    f"""WITH {_STREAM_GOLD} SELECT {_WINDOW}, {_num('mean')} AS avg_price, {_num('lo')} AS min_price,
      {_num('hi')} AS max_price, {_num('sd')} AS price_stddev, {_num('pct')} AS price_change_pct,
      {LEVEL} AS volatility_level FROM m""",
)
def g3_stream_volatility(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _gold(spark, sf_dir, config.GOLD_VOLATILITY)
    return rows.withColumn("price_stddev", F.round("price_stddev", 6))


@query(
    "g4_stream_price_alerts",
    f"""WITH {_STREAM_GOLD} SELECT {_WINDOW}, {_num('s / 100.0')} AS start_price,
      {_num('e / 100.0')} AS end_price, {_num('pct')} AS price_change_pct,
      {ALERT_TYPE} AS alert_type, 'HIGH' AS severity FROM m WHERE abs(pct) >= 1.5""",
)
def g4_stream_price_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, config.GOLD_PRICE_ALERTS)


@query(
    "g5_stream_watchlist",
    f"""WITH {_STREAM_GOLD} SELECT symbol, {_num('e / 100.0')} AS latest_price,
      {_num('pct')} AS price_change_5m_pct, {_num('volume')} AS volume_5m,
      {LEVEL} AS volatility_level, coalesce({ALERT_TYPE}, 'NONE') AS latest_signal,
      {t('we')} AS last_updated_time FROM m""",
)
def g5_stream_watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, config.GOLD_WATCHLIST)


@query("g7_stream_spikes", f"WITH {_STREAM_GOLD} SELECT {spike_columns_sql()} FROM sp")
def g7_stream_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, config.GOLD_SPIKES)


@query(
    "w1_tumbling_windows",
    f"""WITH {TRADES},
    w AS (SELECT * FROM (VALUES ('1 minute', INTERVAL '1 minute'), ('5 minutes', INTERVAL '5 minutes'),
      ('2 hours', INTERVAL '2 hours')) AS v(width, step))
    SELECT width, symbol, {t("time_bucket(step, event_time)")} AS window_start,
      {t("time_bucket(step, event_time) + step")} AS window_end, count(*) AS trades
    FROM trades, w GROUP BY ALL""",
)
def w1_tumbling_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows of the bars and of the shared measures, at several widths."""
    trades = inputs.trades(spark, sf_dir)
    counted = [
        windows.ohlc_bars(trades, width=width).withColumnRenamed("trade_count", "trades")
        for width in ("1 minute", "2 hours")
    ]
    counted.insert(1, windows.window_measures(trades).withColumnRenamed("number_of_trades", "trades"))
    parts = [
        rows.select(F.lit(width).alias("width"), "symbol", "window_start", "window_end", "trades")
        for width, rows in zip(("1 minute", "5 minutes", "2 hours"), counted, strict=True)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "w2_late_rows_and_restart",
    f"""WITH {GOLD} SELECT {_WINDOW}, {_num('volume')} AS total_volume, n AS number_of_trades
    FROM m""",
)
def w2_late_rows_and_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows after three runs of one query from its checkpoint.

    The second run only sees a trade one day later, which closes every window; the third
    sees all trades again, all of them too late by then.
    """
    root = inputs.work_dir(spark, "late")
    trades = inputs.trades(spark, sf_dir)
    later = F.max("event_time") + F.make_dt_interval(days=F.lit(1))
    flush = trades.agg(later.alias("event_time")).select(
        *(
            F.col("event_time") if field.name == "event_time"
            else F.lit("FLUSH" if field.name == "symbol" else None).cast(field.dataType).alias(field.name)
            for field in trades.schema.fields
        )
    )
    for arriving in (trades, flush, trades):
        arriving.write.mode("append").parquet(f"{root}/source")
        rows = tables.stream_table(spark, f"{root}/source", trades.schema)
        measured = windows.window_measures(rows, watermark_delay="10 minutes")
        layers.drain(
            [
                sinks.append_stream(
                    windows.trade_summary(measured), f"{root}/out",
                    checkpoint=f"{root}/checkpoint", name="late", available_now=True,
                )
            ]
        )
    stored = spark.read.schema(schemas.TRADE_SUMMARY).parquet(f"{root}/out")
    return stored.select("symbol", "window_start", "window_end", "total_volume", "number_of_trades")


@query(
    "w3_closed_windows",
    f"""WITH {_STREAM_GOLD} SELECT count(*) AS windows, {t('max(we)')} AS last_closed FROM m""",
)
def w3_closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What append mode has written: windows the watermark has passed, each once."""
    rows = _gold(spark, sf_dir, config.GOLD_SUMMARY)
    return rows.agg(F.count("*").alias("windows"), F.max("window_end").alias("last_closed"))


# Rows whose windows the last watermark has not passed are in the state, and nothing else.
@query(
    "w4_open_windows",
    f"""WITH {MSG_TRADES}, {measures("5 minutes", name="every")}
    SELECT symbol, {t('ws')} AS window_start, {t('we')} AS window_end FROM every WHERE we > {_CLOSED}""",
)
def w4_open_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows that the measures' query still holds after a bounded run, from its state store."""
    settings = all_layers(spark, sf_dir)
    return state.open_windows(spark, settings.checkpoint("gold/window_measures"))


@query(
    "w4_dedup_keys",
    f"""WITH {MSG_TRADES} SELECT symbol, trade_id, {t("event_time + INTERVAL '10 minutes'")} AS expires
    FROM trades WHERE event_time + INTERVAL '10 minutes' > {_CLOSED}""",
)
def w4_dedup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trades that the dedup still remembers, and until when."""
    settings = all_layers(spark, sf_dir)
    return state.dedup_keys(spark, settings.checkpoint("silver/trades"))


# --- alerts and catalog ------------------------------------------------------------------


@query(
    "a5_published_streams",
    f"""WITH {_STREAM_GOLD}
    SELECT symbol AS key, 'VOLUME_SPIKE' AS alert_type, strength AS severity,
      strftime(we, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS window_end, {_num('ratio')} AS metric_value
    FROM sp WHERE strength IN ('MEDIUM', 'HIGH')
    UNION ALL SELECT symbol, {ALERT_TYPE}, 'HIGH', strftime(we, '%Y-%m-%dT%H:%M:%S.%g') || 'Z',
      {_num('pct')} FROM m WHERE abs(pct) >= 1.5""",
)
def a5_published_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages both alert publishers put on the bus, parsed."""
    settings = all_layers(spark, sf_dir)
    root = settings.gold_path.rsplit("/", 1)[0]
    topic = f"topic={FEED.alerts_topic}"
    messages = spark.read.parquet(f"{root}/alerts/{topic}").unionByName(
        spark.read.parquet(f"{root}/price-alerts/{topic}")
    )
    alert = F.from_json("value", schemas.ALERT_EVENT).alias("a")
    return messages.select("key", alert).select(
        "key", "a.alert_type", "a.severity", "a.window_end",
        F.round("a.metric_value", 6).alias("metric_value"),
    )


@query(
    "s12_bus_sink",
    f"""WITH {MSG} SELECT symbol AS key, event_id AS trade_id FROM norm
    WHERE error_type IS NULL AND kind = 'trade'""",
)
def s12_bus_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and values of one topic streamed to another topic with a checkpoint of its own."""
    settings = all_layers(spark, sf_dir)
    root = inputs.work_dir(spark, "sink")
    rows = layers.stream_raw(spark, settings, FEED.trades_topic).select("key", "value")
    target = bus.Bus(format="parquet", path=f"{root}/bus")
    layers.drain(
        [
            bus.publish(
                rows, target, "copy", checkpoint=f"{root}/checkpoint", available_now=True
            )
        ]
    )
    copied = spark.read.parquet(f"{root}/bus")
    trade_id = F.get_json_object("value", "$.trade_id").cast("bigint")
    return copied.select("key", trade_id.alias("trade_id"))


_STREAM_COUNTS = f"""counts AS (
  SELECT '{config.GOLD_OHLC}' AS "table",
    (SELECT count(*) FROM (SELECT DISTINCT symbol, time_bucket(INTERVAL '1 minute', event_time) AS ws
      FROM trades) WHERE ws + INTERVAL '1 minute' <= {_CLOSED}) AS rows
  UNION ALL SELECT '{config.GOLD_SUMMARY}', (SELECT count(*) FROM m)
  UNION ALL SELECT '{config.GOLD_VOLATILITY}', (SELECT count(*) FROM m)
  UNION ALL SELECT '{config.GOLD_WATCHLIST}', (SELECT count(*) FROM m)
  UNION ALL SELECT '{config.GOLD_PRICE_ALERTS}', (SELECT count(*) FROM m WHERE abs(pct) >= 1.5)
  UNION ALL SELECT '{config.GOLD_SPIKES}', (SELECT count(*) FROM sp)
)"""


@query(
    "s13_registered_tables",
    f"WITH {_STREAM_GOLD}, {_STREAM_COUNTS} SELECT \"table\", rows FROM counts",
)
def s13_registered_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the metric tables read by name after registration; a missing one is skipped."""
    database = _registered(spark, sf_dir)
    parts = [
        spark.table(f"{database}.{name}")
        .agg(F.count("*").alias("rows"))
        .select(F.lit(name).alias("table"), "rows")
        for name in config.GOLD_TABLES
    ]
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part)
    return united


def _registered(spark: SparkSession, sf_dir: str) -> str:
    settings = all_layers(spark, sf_dir)
    # One database per run, since a location belongs to one run.
    database = "market_" + settings.gold_path.rsplit("/", 2)[-2].rsplit("-", 1)[-1]
    paths = {name: settings.gold(name) for name in config.GOLD_TABLES}
    tables.register_tables(
        spark, database, {**paths, "gold_not_written": settings.gold("gold_not_written")}
    )
    return database


@query(
    "s14_layer_runs",
    f"""WITH {_STREAM_GOLD}, {_STREAM_COUNTS},
    silver AS (
      SELECT '{config.SILVER_TRADES}' AS "table", (SELECT count(*) FROM trades) AS rows
      UNION ALL SELECT '{config.SILVER_KLINES}', (SELECT count(*) FROM
        (SELECT DISTINCT symbol, date_trunc('minute', ts) FROM norm
         WHERE error_type IS NULL AND kind = 'kline'))
      UNION ALL SELECT '{config.SILVER_TICKERS}', (SELECT count(*) FROM
        (SELECT DISTINCT symbol, date_trunc('milliseconds', ts) FROM norm
         WHERE error_type IS NULL AND kind = 'ticker'))
    )
    SELECT "table", rows FROM counts UNION ALL SELECT "table", rows FROM silver""",
)
def s14_layer_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every typed and metric table after running the layers one after another."""
    settings = all_layers(spark, sf_dir)
    silver = (config.SILVER_TRADES, config.SILVER_KLINES, config.SILVER_TICKERS)
    stored = {name: settings.silver(name) for name in silver}
    stored |= {name: settings.gold(name) for name in config.GOLD_TABLES}
    inventory = inspection.table_inventory(
        {
            name: tables.read_table_or_empty(spark, path, schemas.TABLE_SCHEMAS[name])
            for name, path in stored.items()
        }
    )
    return inventory.select("table", "rows")


@query(
    "s14_progress_rows",
    f"""WITH {_STREAM_GOLD}
    SELECT query, (SELECT count(*) FROM trades) AS input_rows, 0 AS failures
    FROM (VALUES ('{config.GOLD_OHLC}'), ('{config.GOLD_WINDOW_MEASURES}')) AS v(query)
    UNION ALL SELECT query, (SELECT count(*) FROM m), 0
    FROM (VALUES ('{config.GOLD_SUMMARY}'), ('{config.GOLD_VOLATILITY}')) AS v(query)""",
)
def s14_progress_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the kept progress says that the queries of the metric layer have read."""
    settings = all_layers(spark, sf_dir)
    rows = supervision.progress(spark, f"{settings.gold_path.rsplit('/', 1)[0]}/progress")
    names = (config.GOLD_OHLC, config.GOLD_WINDOW_MEASURES, config.GOLD_SUMMARY, config.GOLD_VOLATILITY)
    return rows.where(F.col("query").isin(*names)).groupBy("query").agg(
        F.sum("input_rows").alias("input_rows"), F.count("error").alias("failures")
    )
