"""Serving and inspection queries over the metric tables built from ``events``."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from checks import inputs
from checks.layers import (
    PRICE_ALERT_SQL,
    VOLUME_ALERT_SQL,
    _num,
    alert_events,
    captured,
    five_minutes,
    spike_columns_sql,
)
from checks.registry import instant_sql as t
from checks.registry import query
from checks.sql import ALERT_TYPE, EV, GOLD, LEVEL, MSG
from marketloom import config, schemas
from marketloom.functions import signals
from marketloom.operators import alerts, windows
from marketloom.operators.spikes import volume_spikes
from marketloom.plans import footers, inspection, ranges, serving

NOW = datetime(2024, 1, 25, 12, 0, tzinfo=timezone.utc)
START = ranges.range_start("last_week", NOW)
START_SQL = "TIMESTAMP '2024-01-18 12:00:00'"
SYMBOL = "CLICK"


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.trade_summary(five_minutes(spark, sf_dir))


def spiking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return volume_spikes(summary(spark, sf_dir))


def watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.watchlist(five_minutes(spark, sf_dir))


def price_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.price_alerts(five_minutes(spark, sf_dir))


_GOLD_RUNS: dict[tuple[str, str], str] = {}


def gold_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The Gold tables as stored by one run over the events, which all queries here share."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _GOLD_RUNS:
        root = inputs.work_dir(spark, "gold")
        trades = inputs.trades(spark, sf_dir)
        windows.window_measures(trades).write.parquet(f"{root}/{config.GOLD_WINDOW_MEASURES}")
        measures = spark.read.parquet(f"{root}/{config.GOLD_WINDOW_MEASURES}")
        made = {
            config.GOLD_OHLC: windows.ohlc_bars(trades),
            config.GOLD_SUMMARY: windows.trade_summary(measures),
            config.GOLD_VOLATILITY: windows.volatility(measures),
            config.GOLD_SPIKES: volume_spikes(windows.trade_summary(measures)),
            config.GOLD_PRICE_ALERTS: windows.price_alerts(measures),
            config.GOLD_WATCHLIST: windows.watchlist(measures),
        }
        for name, table in made.items():
            table.write.parquet(f"{root}/{name}")
        _GOLD_RUNS[key] = root
    root = _GOLD_RUNS[key]
    return {
        name: spark.read.schema(schemas.TABLE_SCHEMAS[name]).parquet(f"{root}/{name}")
        for name in config.GOLD_TABLES
    }


_BY_DAY: dict[tuple[str, str], str] = {}


def gold_by_day(spark: SparkSession, sf_dir: str) -> tuple[dict[str, str], dict[str, StructType]]:
    """Paths and schemas of the same tables as the streams store them, a folder per day, and of one that is not there."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BY_DAY:
        root = inputs.work_dir(spark, "gold-days")
        for name, table in gold_tables(spark, sf_dir).items():
            at = next(c for c in serving.TIME_COLUMNS if c in table.columns)
            dated = table.withColumn(footers.DAY, F.to_date(at))
            dated.repartition(footers.DAY).write.partitionBy(footers.DAY).parquet(f"{root}/{name}")
        _BY_DAY[key] = root
    names = [*config.GOLD_TABLES, "gold_table_not_written"]
    every = {**schemas.TABLE_SCHEMAS, "gold_table_not_written": schemas.SPIKES}
    return {name: f"{_BY_DAY[key]}/{name}" for name in names}, every


def snapshot(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    measures = five_minutes(spark, sf_dir)
    return serving.market_snapshot(
        windows.watchlist(measures), volume_spikes(windows.trade_summary(measures)), **options
    )


# --- ranges ------------------------------------------------------------------------------


@query(
    "q1_range_start",
    f"""WITH {EV} SELECT event_id,
      {t("date_trunc('day', ts + INTERVAL '330 minutes') - INTERVAL '330 minutes'")} AS today,
      {t("ts - INTERVAL '7 days'")} AS last_week, {t("ts - INTERVAL '30 days'")} AS last_month,
      {t("ts - INTERVAL '365 days'")} AS last_year, CAST(NULL AS VARCHAR) AS everything FROM ev""",
)
def q1_range_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event time taken as "now", in the default zone."""
    rows = inputs.feed_events(inputs.table(spark, sf_dir, "events"))
    names = {
        "today": "today",
        "last_week": "last_week",
        "last_month": "last_month",
        "last_year": "last_year",
        "all": "everything",
    }
    return rows.select(
        "event_id",
        *(ranges.range_start_column(key, F.col("at")).alias(name) for key, name in names.items()),
    )


@query(
    "q2_filter_from_time",
    f"""WITH {GOLD} SELECT symbol, {t('we')} AS last_updated_time, {_num('volume')} AS volume_5m
    FROM m WHERE we >= {START_SQL}""",
)
def q2_filter_from_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ranges.since(watchlist(spark, sf_dir), "last_updated_time", START)
    return rows.select("symbol", "last_updated_time", "volume_5m")


# --- snapshot ----------------------------------------------------------------------------

_LATEST = """
lw AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY we DESC) = 1),
ls AS (SELECT * FROM sp QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY we DESC) = 1),
snap AS (
  SELECT lw.symbol, e / 100.0 AS latest_price, pct, lw.volume AS volume_5m,
    """ + LEVEL + """ AS level, coalesce(""" + ALERT_TYPE + """, 'NONE') AS latest_signal,
    ls.ratio AS ratio, ls.strength AS strength, lw.we AS last_updated_time,
    round_even(1000 * (coalesce(abs(pct), 0) * 1.5 + coalesce(ls.ratio, 0)
      + CASE ls.strength WHEN 'HIGH' THEN 3.0 WHEN 'MEDIUM' THEN 1.5 ELSE 0.0 END
      + CASE WHEN abs(pct) >= 1.5 THEN 2.0 WHEN abs(pct) >= 0.5 THEN 1.0 ELSE 0.0 END), 0) / 1000 AS score,
    CASE WHEN pct IS NULL OR abs(pct) < 0.1 THEN 'FLAT' WHEN pct > 0 THEN 'UP' ELSE 'DOWN' END
      AS direction,
    CASE WHEN ls.strength = 'HIGH' OR ls.ratio >= 2 THEN 'Volume spike'
      WHEN abs(pct) >= 1.5 THEN 'Sharp price move'
      WHEN ls.strength = 'MEDIUM' OR ls.ratio >= 1.5 THEN 'Elevated volume' ELSE 'Normal' END AS reason
  FROM lw LEFT JOIN ls ON lw.symbol = ls.symbol
)"""
SNAPSHOT = GOLD + "," + _LATEST


@query(
    "q3_latest_per_symbol",
    f"""WITH {GOLD} SELECT symbol, {t('we')} AS last_updated_time, {_num('e / 100.0')} AS latest_price
    FROM m QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY we DESC) = 1""",
)
def q3_latest_per_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = serving.latest_per_symbol(watchlist(spark, sf_dir), "last_updated_time")
    return rows.select("symbol", "last_updated_time", "latest_price")


@query(
    "q4_market_snapshot",
    f"""WITH {SNAPSHOT} SELECT symbol, {_num('latest_price')} AS latest_price,
      {_num('pct')} AS price_change_5m_pct, {_num('volume_5m')} AS volume_5m,
      level AS volatility_level, latest_signal, {_num('ratio')} AS volume_spike_ratio,
      strength AS signal_strength, {t('last_updated_time')} AS last_updated_time,
      {_num('score')} AS attention_score, direction AS market_direction,
      reason AS attention_reason
    FROM snap ORDER BY score DESC, volume_5m DESC, symbol LIMIT 50""",
)
def q4_market_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot(spark, sf_dir)


@query(
    "q4_snapshot_without_spikes",
    f"""WITH {SNAPSHOT} SELECT symbol, {_num('pct')} AS price_change_5m_pct,
      CAST(NULL AS DOUBLE) AS volume_spike_ratio, CAST(NULL AS VARCHAR) AS signal_strength
    FROM snap""",
)
def q4_snapshot_without_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = serving.market_snapshot(watchlist(spark, sf_dir))
    return rows.select("symbol", "price_change_5m_pct", "volume_spike_ratio", "signal_strength")


def _every_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each watchlist row with the spike of the same window: many rows for Q5 to Q7."""
    measures = five_minutes(spark, sf_dir)
    spikes = volume_spikes(windows.trade_summary(measures)).select(
        "symbol",
        F.col("window_end").alias("last_updated_time"),
        "volume_spike_ratio",
        "signal_strength",
    )
    return windows.watchlist(measures).join(spikes, ["symbol", "last_updated_time"], "left")


_EVERY = GOLD + """,
ev_all AS (SELECT m.symbol, m.we, pct, ratio, strength, m.volume FROM m
           LEFT JOIN sp ON m.symbol = sp.symbol AND m.we = sp.we)"""


@query(
    "q5_attention_score",
    f"""WITH {_EVERY} SELECT symbol, {t('we')} AS last_updated_time,
      round_even(1000 * ((coalesce(CAST(abs(pct) AS DOUBLE), 0) * 1.5 + coalesce(CAST(ratio AS DOUBLE), 0))
        + CASE strength WHEN 'HIGH' THEN 3.0 WHEN 'MEDIUM' THEN 1.5 ELSE 0.0 END
        + CASE WHEN abs(pct) >= 1.5 THEN 2.0 WHEN abs(pct) >= 0.5 THEN 1.0 ELSE 0.0 END), 0) / 1000
        AS attention_score FROM ev_all""",
)
def q5_attention_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = serving.rate_attention(_every_window(spark, sf_dir))
    return rows.select("symbol", "last_updated_time", "attention_score")


@query(
    "q6_market_direction",
    f"""WITH {GOLD} SELECT symbol, {t('we')} AS last_updated_time,
      CASE WHEN pct IS NULL OR abs(pct) < 0.1 THEN 'FLAT' WHEN pct > 0 THEN 'UP' ELSE 'DOWN' END
        AS market_direction FROM m""",
)
def q6_market_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watchlist(spark, sf_dir).select(
        "symbol",
        "last_updated_time",
        signals.market_direction(F.col("price_change_5m_pct")).alias("market_direction"),
    )


@query(
    "q7_attention_reason",
    f"""WITH {_EVERY} SELECT symbol, {t('we')} AS last_updated_time,
      CASE WHEN strength = 'HIGH' OR ratio >= 2 THEN 'Volume spike'
        WHEN abs(pct) >= 1.5 THEN 'Sharp price move'
        WHEN strength = 'MEDIUM' OR ratio >= 1.5 THEN 'Elevated volume' ELSE 'Normal' END
        AS attention_reason FROM ev_all""",
)
def q7_attention_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _every_window(spark, sf_dir).select(
        "symbol",
        "last_updated_time",
        signals.attention_reason(
            F.col("price_change_5m_pct"), F.col("volume_spike_ratio"),
            F.col("signal_strength"), F.col("volatility_level"),
        ).alias("attention_reason"),
    )


# --- newest and history ------------------------------------------------------------------


@query(
    "q8_newest_spikes",
    f"""WITH {GOLD} SELECT {spike_columns_sql()} FROM sp WHERE we >= {START_SQL}
    ORDER BY we DESC, ratio DESC, symbol LIMIT 50""",
)
def q8_newest_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.newest_spikes(spiking(spark, sf_dir), start=START)


_PRICE_ALERT_COLUMNS = f"""symbol, {t('ws')} AS window_start, {t('we')} AS window_end,
  {_num('s / 100.0')} AS start_price, {_num('e / 100.0')} AS end_price,
  {_num('pct')} AS price_change_pct, {ALERT_TYPE} AS alert_type, 'HIGH' AS severity"""


@query(
    "q9_newest_price_alerts",
    f"""WITH {GOLD} SELECT {_PRICE_ALERT_COLUMNS} FROM m
    WHERE abs(pct) >= 1.5 AND we >= {START_SQL} ORDER BY we DESC, abs(pct) DESC, symbol LIMIT 50""",
)
def q9_newest_price_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.newest_price_alerts(price_alerts(spark, sf_dir), start=START)


@query(
    "q10_ohlc_history",
    f"""WITH {GOLD.split(',' + chr(10) + 'm_raw', 1)[0]},
    b AS (SELECT symbol, time_bucket(INTERVAL '1 minute', event_time) AS ws,
        arg_min(price, (event_time, trade_id)) AS o, arg_max(price, (event_time, trade_id)) AS c,
        max(price) AS h, min(price) AS l FROM trades WHERE symbol = '{SYMBOL}' GROUP BY ALL)
    SELECT {t('ws')} AS window_start, {t("ws + INTERVAL '1 minute'")} AS window_end,
      {_num('o')} AS open_price, {_num('h')} AS high_price, {_num('l')} AS low_price,
      {_num('c')} AS close_price FROM b ORDER BY ws DESC LIMIT 120""",
)
def q10_ohlc_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = windows.ohlc_bars(inputs.trades(spark, sf_dir))
    return serving.ohlc_history(bars, SYMBOL).select(
        "window_start", "window_end", "open_price", "high_price", "low_price", "close_price"
    )


@query(
    "q11_summary_history",
    f"""WITH {GOLD} SELECT {t('ws')} AS window_start, {t('we')} AS window_end,
      {_num('volume')} AS total_volume, n AS number_of_trades FROM m WHERE symbol = '{SYMBOL}'
    ORDER BY we DESC LIMIT 60""",
)
def q11_summary_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.summary_history(summary(spark, sf_dir), SYMBOL).select(
        "window_start", "window_end", "total_volume", "number_of_trades"
    )


@query(
    "q12_spike_history",
    f"""WITH {GOLD} SELECT {t('ws')} AS window_start, {t('we')} AS window_end,
      {_num('ratio')} AS volume_spike_ratio, strength AS signal_strength FROM sp
    WHERE symbol = '{SYMBOL}' ORDER BY we DESC LIMIT 60""",
)
def q12_spike_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.spike_history(spiking(spark, sf_dir), SYMBOL).select(
        "window_start", "window_end", "volume_spike_ratio", "signal_strength"
    )


# --- health and overview -----------------------------------------------------------------


def _health_sql(table: str, source: str, time: str) -> str:
    return (
        f"SELECT '{table}' AS \"table\", true AS table_exists, "
        f"count(*) FILTER (WHERE {time} >= {START_SQL}) AS row_count, "
        f"count(*) AS total_row_count, max({time}) AS latest FROM {source}"
    )


_HEALTH = GOLD + f""",
bars AS (SELECT DISTINCT symbol, time_bucket(INTERVAL '1 minute', event_time) + INTERVAL '1 minute' AS we
         FROM trades),
moves AS (SELECT we FROM m WHERE abs(pct) >= 1.5),
health AS (
  {_health_sql(config.GOLD_OHLC, 'bars', 'we')}
  UNION ALL {_health_sql(config.GOLD_SUMMARY, 'm', 'we')}
  UNION ALL {_health_sql(config.GOLD_VOLATILITY, 'm', 'we')}
  UNION ALL {_health_sql(config.GOLD_SPIKES, 'sp', 'we')}
  UNION ALL {_health_sql(config.GOLD_PRICE_ALERTS, 'moves', 'we')}
  UNION ALL {_health_sql(config.GOLD_WATCHLIST, 'm', 'we')}
  UNION ALL SELECT 'gold_table_not_written', false, 0, 0, NULL
)"""


@query(
    "q13_table_health",
    f"""WITH {_HEALTH} SELECT "table", table_exists, row_count, total_row_count,
      {t('latest')} AS latest_time FROM health""",
)
def q13_table_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return footers.stored_health(spark, *gold_by_day(spark, sf_dir), start=START)


_FRESH_SQL = """CASE WHEN {at} IS NULL THEN 'NO_DATA'
  WHEN epoch_us({now}) - epoch_us({at}) <= 120000000 THEN 'FRESH'
  WHEN epoch_us({now}) - epoch_us({at}) <= 900000000 THEN 'LAGGING' ELSE 'STALE' END"""


@query(
    "q14_freshness",
    f"""WITH {EV} SELECT event_id,
      {_FRESH_SQL.format(at='ts', now="TIMESTAMP '2024-01-30 23:50:00'")} AS freshness FROM ev""",
)
def q14_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event's age against a fixed moment near the end of the table."""
    rows = inputs.feed_events(inputs.table(spark, sf_dir, "events"))
    now = ranges.instant_literal(datetime(2024, 1, 30, 23, 50, tzinfo=timezone.utc))
    return rows.select("event_id", signals.freshness(F.col("at"), now).alias("freshness"))


@query(
    "q15_overview",
    f"""WITH {SNAPSHOT},
    s50 AS (SELECT * FROM snap ORDER BY score DESC, volume_5m DESC, symbol LIMIT 50)
    SELECT (SELECT count(DISTINCT symbol) FROM s50) AS symbols,
      (SELECT count(*) FROM sp WHERE strength = 'HIGH' AND we >= {START_SQL}) AS high_volume_spikes,
      (SELECT count(*) FROM m WHERE abs(pct) >= 1.5 AND we >= {START_SQL}) AS price_alerts,
      {_num('(SELECT coalesce(max(ratio), 0) FROM s50)')} AS strongest_spike,
      {_num('(SELECT coalesce(max(abs(pct)), 0) FROM s50)')} AS biggest_abs_move,
      {t('(SELECT max(we) FROM m)')} AS latest_gold_time,
      {_FRESH_SQL.format(at="(SELECT max(we) FROM m)", now="TIMESTAMP '2024-01-31 00:05:00'")}
        AS freshness""",
)
def q15_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over all rows of the range, not only over the rows that a view shows."""
    tables = gold_tables(spark, sf_dir)
    return serving.overview(
        serving.market_snapshot(tables[config.GOLD_WATCHLIST], tables[config.GOLD_SPIKES]),
        ranges.since(tables[config.GOLD_SPIKES], "window_end", START),
        ranges.since(tables[config.GOLD_PRICE_ALERTS], "window_end", START),
        serving.table_health(tables),
        now=ranges.instant_literal(datetime(2024, 1, 31, 0, 5, tzinfo=timezone.utc)),
    )


# --- published alerts --------------------------------------------------------------------


def alert_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All alert messages as bus records, sent five seconds after their window."""
    volume, price = alert_events(spark, sf_dir)
    events = volume.unionByName(price)
    end = F.try_to_timestamp("window_end")
    kind = F.when(F.col("alert_type") == "VOLUME_SPIKE", 200).otherwise(0)
    position = F.unix_seconds(end) * 1000 + F.ascii("symbol") + kind
    messages = alerts.alert_messages(events, keep={"at": end, "offset": position})
    return messages.select(
        F.lit(inputs.FEED.alerts_topic).alias("topic"),
        F.lit(0).alias("partition"),
        "offset",
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        (F.col("at") + F.make_dt_interval(secs=F.lit(5))).alias("timestamp"),
    )


_ALERTS = GOLD + f""",
a AS ({VOLUME_ALERT_SQL} UNION ALL {PRICE_ALERT_SQL}),
msgs AS (
  SELECT *, strptime(window_end, '%Y-%m-%dT%H:%M:%S.%gZ') AS we2,
    CAST(epoch(strptime(window_end, '%Y-%m-%dT%H:%M:%S.%gZ')) AS BIGINT) * 1000 + ascii(symbol)
      + CASE alert_type WHEN 'VOLUME_SPIKE' THEN 200 ELSE 0 END AS "offset"
  FROM a
),
newest AS (SELECT * FROM msgs ORDER BY we2 DESC, "offset" DESC LIMIT 50)"""


@query(
    "q16_published_alerts",
    f"""WITH {_ALERTS} SELECT 'market.signals.alerts' AS topic, 0 AS partition, "offset",
      {t("we2 + INTERVAL '5 seconds'")} AS kafka_timestamp, symbol AS symbol_key, schema_version,
      symbol, alert_type, severity, window_start, window_end, {_num('metric_value')} AS metric_value,
      description, created_at FROM newest""",
)
def q16_published_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.published_alerts(alert_records(spark, sf_dir), start=START)


@query(
    "q17_signal_leaders",
    f"""WITH {SNAPSHOT} SELECT 'Strongest volume spike' AS signal,
      arg_max(symbol, (coalesce(ratio, -1), score, symbol)) AS symbol,
      {_num('max(ratio)')} AS value FROM snap
    UNION ALL SELECT 'Largest 5m price move', arg_max(symbol, (coalesce(abs(pct), -1), score, symbol)),
      {_num('coalesce(max(abs(pct)), 0)')} FROM snap""",
)
def q17_signal_leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.signal_leaders(snapshot(spark, sf_dir))


@query(
    "q18_chart_inputs",
    f"""WITH {SNAPSHOT},
    r AS (SELECT * FROM snap WHERE ratio IS NOT NULL ORDER BY score DESC, volume_5m DESC, symbol LIMIT 12),
    c AS (SELECT * FROM snap WHERE pct IS NOT NULL ORDER BY score DESC, volume_5m DESC, symbol LIMIT 12)
    SELECT 'ratio' AS chart, symbol, {_num('ratio')} AS value FROM r
    UNION ALL SELECT 'change', symbol, {_num('pct')} FROM c""",
)
def q18_chart_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snapshot(spark, sf_dir)
    charts = [
        serving.chart_input(rows, column).select(
            F.lit(chart).alias("chart"), "symbol", F.round(column, 6).alias("value")
        )
        for chart, column in (("ratio", "volume_spike_ratio"), ("change", "price_change_5m_pct"))
    ]
    return charts[0].unionByName(charts[1])


@query(
    "q19_alert_totals",
    f"""WITH {_ALERTS} SELECT count(*) AS published_alerts, count(DISTINCT symbol) AS symbols_alerted,
      count(*) FILTER (WHERE severity = 'HIGH') AS high_severity, max(created_at) AS latest_alert
    FROM msgs WHERE created_at >= '2024-01-18T12:00:00.000Z'""",
)
def q19_alert_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.alert_totals(serving.alert_rows(alert_records(spark, sf_dir), start=START))


@query("q20_symbol_list", f"WITH {GOLD} SELECT DISTINCT symbol FROM m")
def q20_symbol_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.symbol_list(watchlist(spark, sf_dir))


@query(
    "q21_symbol_state",
    f"""WITH {SNAPSHOT} SELECT symbol, {_num('latest_price')} AS latest_price,
      {_num('pct')} AS price_change_5m_pct, {_num('volume_5m')} AS volume_5m,
      {_num('ratio')} AS volume_spike_ratio, level AS volatility_level
    FROM snap WHERE symbol = '{SYMBOL}'""",
)
def q21_symbol_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.symbol_state(snapshot(spark, sf_dir), SYMBOL).select(
        "symbol", "latest_price", "price_change_5m_pct", "volume_5m", "volume_spike_ratio",
        "volatility_level",
    )


# --- inspection --------------------------------------------------------------------------


@query(
    "q22_topic_activity",
    f"""WITH {MSG}, r AS (SELECT ts,
      CASE WHEN error_type IS NULL THEN topic ELSE 'market.events.invalid' END AS to_topic,
      CASE WHEN error_type IS NULL THEN symbol ELSE coalesce(topic, error_type) END AS key FROM norm)
    SELECT to_topic AS topic, key AS symbol, count(*) AS row_count,
      {t('min(ts)')} AS first_kafka_timestamp, {t('max(ts)')} AS latest_kafka_timestamp
    FROM r GROUP BY to_topic, key""",
)
def q22_topic_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspection.topic_activity(captured(spark, sf_dir))


@query(
    "q23_newest_watchlist",
    f"""WITH {GOLD} SELECT symbol, {_num('e / 100.0')} AS latest_price,
      {_num('pct')} AS price_change_5m_pct, {_num('volume')} AS volume_5m,
      {LEVEL} AS volatility_level, coalesce({ALERT_TYPE}, 'NONE') AS latest_signal,
      {t('we')} AS last_updated_time FROM m ORDER BY we DESC, symbol LIMIT 30""",
)
def q23_newest_watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspection.newest_watchlist(watchlist(spark, sf_dir))


@query(
    "q24_newest_spike_rows",
    f"WITH {GOLD} SELECT {spike_columns_sql()} FROM sp ORDER BY we DESC, ratio DESC, symbol LIMIT 30",
)
def q24_newest_spike_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspection.newest_spike_rows(spiking(spark, sf_dir))


@query(
    "q24_newest_price_alert_rows",
    f"""WITH {GOLD} SELECT {_PRICE_ALERT_COLUMNS} FROM m WHERE abs(pct) >= 1.5
    ORDER BY we DESC, abs(pct) DESC, symbol LIMIT 30""",
)
def q24_newest_price_alert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspection.newest_price_alert_rows(price_alerts(spark, sf_dir))


_COLUMN_COUNTS = f"""(VALUES ('{config.GOLD_OHLC}', 10), ('{config.GOLD_SUMMARY}', 8),
  ('{config.GOLD_VOLATILITY}', 9), ('{config.GOLD_SPIKES}', 8), ('{config.GOLD_PRICE_ALERTS}', 8),
  ('{config.GOLD_WATCHLIST}', 7), ('gold_table_not_written', 0)) AS c(name, n)"""


@query(
    "q25_table_inventory",
    f"""WITH {_HEALTH} SELECT "table", table_exists, total_row_count AS rows,
      CAST(c.n AS INTEGER) AS columns FROM health JOIN {_COLUMN_COUNTS} ON c.name = "table" """,
)
def q25_table_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return footers.stored_inventory(spark, *gold_by_day(spark, sf_dir)).drop("path")


@query(
    "q26_table_sample",
    f"""WITH {MSG} SELECT
      CASE WHEN error_type IS NULL THEN topic ELSE 'market.events.invalid' END AS topic,
      event_id AS "offset", {t('ts')} AS kafka_timestamp FROM norm ORDER BY ts DESC LIMIT 20""",
)
def q26_table_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inspection.table_sample(captured(spark, sf_dir), order_by="kafka_timestamp")
    return rows.select("topic", "offset", "kafka_timestamp")
