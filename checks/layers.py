"""Capture, typed layer, window metrics, spikes, classifications, alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs
from checks.registry import instant_sql as t
from checks.registry import query
from checks.sql import EV, GOLD, LEVEL, ALERT_TYPE, MSG, MSG_TRADES, TRADES, measures, two_digits
from checks.sql import spikes as spikes_sql
from marketloom import schemas
from marketloom.functions import signals, values
from marketloom.operators import alerts, refine, windows
from marketloom.operators.capture import capture
from marketloom.operators.spikes import volume_spikes

CREATED_AT = "2024-02-01 00:00:00"


def _num(expression: str) -> str:
    return f"round(CAST({expression} AS DOUBLE), 6)"


def captured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture(inputs.bus_records(spark, sf_dir))


# --- capture and typed layer -------------------------------------------------------------


@query(
    "s7_capture",
    f"""WITH {MSG} SELECT
      CASE WHEN error_type IS NULL THEN topic ELSE 'market.events.invalid' END AS topic,
      CAST(event_id % 3 AS INTEGER) AS partition, event_id AS "offset",
      CASE WHEN error_type IS NULL THEN symbol ELSE coalesce(topic, error_type) END AS key,
      {t('ts')} AS kafka_timestamp
    FROM norm""",
)
def s7_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captured(spark, sf_dir).select("topic", "partition", "offset", "key", "kafka_timestamp")


@query(
    "t1_parse_payload",
    f"""WITH {MSG} SELECT event_id AS "offset", symbol, event_id AS trade_id, ptext AS price,
      CAST(k AS VARCHAR) AS quantity
    FROM norm WHERE error_type IS NULL AND kind = 'trade'""",
)
def t1_parse_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = captured(spark, sf_dir).where(F.col("topic") == inputs.FEED.trades_topic)
    parsed = refine.parse_payload(records, schemas.TRADE_EVENT)
    return parsed.select(
        "offset", "payload.symbol", "payload.trade_id", "payload.price", "payload.quantity"
    )


@query(
    "t2_utc_instant",
    f"""WITH {EV} SELECT event_id, {t("date_trunc('milliseconds', ts)")} AS event_time,
      CAST(NULL AS VARCHAR) AS unreadable FROM ev""",
)
def t2_utc_instant(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.feed_events(inputs.table(spark, sf_dir, "events"))
    return rows.select(
        "event_id",
        values.to_instant(values.iso_millis(F.col("at"))).alias("event_time"),
        values.to_instant(F.concat(F.lit("at "), F.col("event_type"))).alias("unreadable"),
    )


@query(
    "t3_trades",
    f"""WITH {MSG_TRADES} SELECT symbol, {t('event_time')} AS event_time, trade_id,
      {_num('price')} AS price, {_num('quantity')} AS quantity, {_num('trade_value')} AS trade_value,
      is_buyer_market_maker, 'binance' AS source, 'market.trades.raw' AS bronze_topic,
      CAST(event_id % 3 AS INTEGER) AS bronze_partition, event_id AS bronze_offset
    FROM trades""",
)
def t3_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = captured(spark, sf_dir).where(F.col("topic") == inputs.FEED.trades_topic)
    return refine.refine_trades(records).drop("ingest_time", "process_time")


@query(
    "t3_trades_unfiltered_input",
    f"""WITH {EV} SELECT event_id AS trade_id, CASE WHEN price > 0 AND k > 0 THEN 'kept'
      ELSE 'rejected' END AS outcome FROM ev""",
)
def t3_trades_unfiltered_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = inputs.typed_trades(inputs.table(spark, sf_dir, "events"))
    good = refine.is_good_trade()
    kept = typed.where(good).select("trade_id", F.lit("kept").alias("outcome"))
    dropped = refine.rejected(typed, good).select("trade_id", F.lit("rejected").alias("outcome"))
    return kept.unionByName(dropped)


@query(
    "t4_klines",
    f"""WITH {MSG}, k AS (
      SELECT symbol, date_trunc('minute', ts) AS ks, price, k, user_id, ts, event_id,
        row_number() OVER (PARTITION BY symbol, date_trunc('minute', ts)
          ORDER BY date_trunc('milliseconds', ts), event_id % 3, event_id) AS rn
      FROM norm WHERE error_type IS NULL AND kind = 'kline')
    SELECT symbol, {t('ks')} AS kline_start_time,
      {t("ks + INTERVAL '59999 milliseconds'")} AS kline_close_time,
      {_num('price')} AS open_price, {_num('price + k')} AS high_price,
      {_num('greatest(price - 1, 0)')} AS low_price, {_num('price')} AS close_price,
      {_num('k')} AS volume, user_id AS number_of_trades, user_id % 2 = 0 AS is_closed,
      {t("date_trunc('milliseconds', ts)")} AS event_time, 'binance' AS source
    FROM k WHERE rn = 1""",
)
def t4_klines(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = captured(spark, sf_dir).where(F.col("topic") == inputs.FEED.klines_topic)
    return refine.refine_klines(records).drop("process_time")


@query(
    "t5_tickers",
    f"""WITH {MSG} SELECT symbol, {t("date_trunc('milliseconds', ts)")} AS event_time,
      {_num('price')} AS last_price, {_num('price - 50')} AS price_change,
      {_num('k - 50')} AS price_change_percent, {_num('price')} AS weighted_avg_price,
      {_num('price + k')} AS high_price, {_num('greatest(price - 1, 0)')} AS low_price,
      {_num('k')} AS volume, {_num('price * k')} AS quote_volume, 'binance' AS source
    FROM norm WHERE error_type IS NULL AND kind = 'ticker'
    QUALIFY row_number() OVER (PARTITION BY symbol, date_trunc('milliseconds', ts)
      ORDER BY event_id % 3, event_id) = 1""",
)
def t5_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = captured(spark, sf_dir).where(F.col("topic") == inputs.FEED.tickers_topic)
    return refine.refine_tickers(records).drop("process_time")


@query(
    "t6_dedup_trades",
    f"""WITH {MSG_TRADES} SELECT symbol, trade_id, {t('event_time')} AS event_time,
      event_id AS bronze_offset FROM trades""",
)
def t6_dedup_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record delivered twice; the earlier position of each trade stays."""
    records = captured(spark, sf_dir).where(F.col("topic") == inputs.FEED.trades_topic)
    # Both deliveries from one pass over the messages.
    shift = F.explode(F.array(F.lit(0).cast("bigint"), F.lit(1 << 40).cast("bigint")))
    twice = records.select("*", shift.alias("_shift")).withColumn("offset", F.col("offset") + F.col("_shift"))
    rows = refine.refine_trades(twice.drop("_shift"))
    return rows.select("symbol", "trade_id", "event_time", "bronze_offset")


@query(
    "t6_dedup_lineitem",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice, 6) AS l_extendedprice
    FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) = 1""",
)
def t6_dedup_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row of every order line; the table repeats many of them."""
    rows = refine.deduplicate(
        inputs.table(spark, sf_dir, "lineitem"),
        ("l_orderkey", "l_linenumber"),
        ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"),
    )
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round("l_extendedprice", 6).alias("l_extendedprice"),
    )


# --- window metrics ----------------------------------------------------------------------


def ohlc_sql(width: str) -> str:
    return f"""WITH {TRADES}, {measures(width)} SELECT symbol, {t('ws')} AS window_start,
      {t('we')} AS window_end, {_num('s / 100.0')} AS open_price, {_num('hi')} AS high_price,
      {_num('lo')} AS low_price, {_num('e / 100.0')} AS close_price, n AS trade_count,
      {_num('volume')} AS total_quantity, {_num('total')} AS total_trade_value FROM m"""


@query("g1_ohlc_1min", ohlc_sql("1 minute"))
def g1_ohlc_1min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.ohlc_bars(inputs.trades(spark, sf_dir))


@query("g1_ohlc_1hour", ohlc_sql("1 hour"))
def g1_ohlc_1hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.ohlc_bars(inputs.trades(spark, sf_dir), width="1 hour")


@query(
    "g1_ohlc_ties",
    f"""WITH {TRADES}, tied AS (
      SELECT symbol, date_trunc('minute', event_time) AS event_time, price, quantity, trade_value,
        trade_id * 1099511627791 * (CASE WHEN trade_id % 3 = 0 THEN -1 ELSE 1 END) AS trade_id FROM trades
    )
    SELECT symbol, {t("time_bucket(INTERVAL '1 hour', event_time)")} AS window_start,
      {_num('arg_min(price, (event_time, trade_id))')} AS open_price,
      {_num('arg_max(price, (event_time, trade_id))')} AS close_price, count(*) AS trade_count
    FROM tied GROUP BY symbol, time_bucket(INTERVAL '1 hour', event_time)""",
)
def g1_ohlc_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades of one minute at one instant, told apart by ids beyond 2^40 of either sign."""
    wide = F.col("trade_id") * 1099511627791
    tied = inputs.trades(spark, sf_dir).withColumns(
        {
            "event_time": F.date_trunc("minute", "event_time"),
            "trade_id": F.when(F.col("trade_id") % 3 == 0, -wide).otherwise(wide),
        }
    )
    bars = windows.ohlc_bars(tied, width="1 hour")
    return bars.select("symbol", "window_start", "open_price", "close_price", "trade_count")


def five_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_measures(inputs.trades(spark, sf_dir))


_WINDOW = f"symbol, {t('ws')} AS window_start, {t('we')} AS window_end"


@query(
    "g2_trade_summary_5min",
    f"""WITH {GOLD} SELECT {_WINDOW}, {_num('volume')} AS total_volume, n AS number_of_trades,
      {_num('CAST(total AS DOUBLE) / n')} AS average_trade_value, {_num('hi_value')} AS max_trade_value,
      {_num('lo_value')} AS min_trade_value FROM m""",
)
def g2_trade_summary_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.trade_summary(five_minutes(spark, sf_dir))


@query(
    "g3_volatility_5min",
    f"""WITH {GOLD} SELECT {_WINDOW}, {_num('mean')} AS avg_price, {_num('lo')} AS min_price,
      {_num('hi')} AS max_price, {_num('sd')} AS price_stddev, {_num('pct')} AS price_change_pct,
      {LEVEL} AS volatility_level FROM m""",
)
def g3_volatility_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = windows.volatility(five_minutes(spark, sf_dir))
    return rows.withColumn("price_stddev", F.round("price_stddev", 6))


@query(
    "g4_price_alerts_5min",
    f"""WITH {GOLD} SELECT {_WINDOW}, {_num('s / 100.0')} AS start_price,
      {_num('e / 100.0')} AS end_price, {_num('pct')} AS price_change_pct,
      {ALERT_TYPE} AS alert_type, 'HIGH' AS severity FROM m WHERE abs(pct) >= 1.5""",
)
def g4_price_alerts_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.price_alerts(five_minutes(spark, sf_dir))


@query(
    "g5_watchlist_5min",
    f"""WITH {GOLD} SELECT symbol, {_num('e / 100.0')} AS latest_price,
      {_num('pct')} AS price_change_5m_pct, {_num('volume')} AS volume_5m,
      {LEVEL} AS volatility_level, coalesce({ALERT_TYPE}, 'NONE') AS latest_signal,
      {t('we')} AS last_updated_time FROM m""",
)
def g5_watchlist_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.watchlist(five_minutes(spark, sf_dir))


def spike_columns_sql() -> str:
    return f"""{_WINDOW}, {_num('volume')} AS current_volume,
      {_num('CAST(hsum AS DOUBLE) / hn')} AS baseline_volume, {_num('ratio')} AS volume_spike_ratio,
      strength AS signal_strength, n AS number_of_trades"""


@query("g6_volume_spikes", f"WITH {GOLD} SELECT {spike_columns_sql()} FROM sp")
def g6_volume_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return volume_spikes(windows.trade_summary(five_minutes(spark, sf_dir)))


@query(
    "g6_volume_spikes_1hour",
    f"WITH {TRADES}, {measures('1 hour')}, {spikes_sql('6 hours')} SELECT {spike_columns_sql()} FROM sp",
)
def g6_volume_spikes_1hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly windows against the six hours before: full baselines on this table."""
    hourly = windows.window_measures(inputs.trades(spark, sf_dir), width="1 hour")
    return volume_spikes(windows.trade_summary(hourly), lookback_minutes=360)


@query(
    "g8_percent_change",
    f"WITH {TRADES}, {measures('1 hour')} SELECT {_WINDOW}, {_num('pct')} AS price_change_pct FROM m",
)
def g8_percent_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = windows.window_measures(inputs.trades(spark, sf_dir), width="1 hour")
    change = signals.percent_change(F.col("start_price"), F.col("end_price"))
    return rows.select("symbol", "window_start", "window_end", change.alias("price_change_pct"))


def _classified(spark: SparkSession, sf_dir: str, classify, name: str) -> DataFrame:
    rows = five_minutes(spark, sf_dir)
    change = signals.percent_change(F.col("start_price"), F.col("end_price"))
    return rows.select("symbol", "window_start", "window_end", classify(change).alias(name))


@query("c1_price_alert_type", f"WITH {GOLD} SELECT {_WINDOW}, {ALERT_TYPE} AS alert_type FROM m")
def c1_price_alert_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, signals.price_alert_type, "alert_type")


@query(
    "c2_alert_severity",
    f"""WITH {GOLD} SELECT {_WINDOW},
      CASE WHEN abs(pct) >= 1.5 THEN 'HIGH' ELSE 'LOW' END AS severity FROM m""",
)
def c2_alert_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, signals.alert_severity, "severity")


@query("c3_volatility_level", f"WITH {GOLD} SELECT {_WINDOW}, {LEVEL} AS volatility_level FROM m")
def c3_volatility_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, signals.volatility_level, "volatility_level")


@query(
    "c4_spike_strength",
    f"WITH {GOLD} SELECT strength AS signal_strength, count(*) AS windows FROM sp GROUP BY ALL",
)
def c4_spike_strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = volume_spikes(windows.trade_summary(five_minutes(spark, sf_dir)))
    strength = signals.spike_strength(F.col("volume_spike_ratio"))
    return rows.groupBy(strength.alias("signal_strength")).agg(F.count("*").alias("windows"))


# --- alerts ------------------------------------------------------------------------------

_ISO = "'%Y-%m-%dT%H:%M:%S.%g'"
CREATED_SQL = "'2024-02-01T00:00:00.000Z'"
VOLUME_ALERT_SQL = f"""SELECT '1.0' AS schema_version, symbol, 'VOLUME_SPIKE' AS alert_type,
  strength AS severity, strftime(ws, {_ISO}) || 'Z' AS window_start,
  strftime(we, {_ISO}) || 'Z' AS window_end, ratio AS metric_value,
  symbol || ' volume is ' || {two_digits('ratio')} || 'x above recent baseline' AS description,
  {CREATED_SQL} AS created_at FROM sp WHERE strength IN ('MEDIUM', 'HIGH')"""
PRICE_ALERT_SQL = f"""SELECT '1.0' AS schema_version, symbol, {ALERT_TYPE} AS alert_type,
  'HIGH' AS severity, strftime(ws, {_ISO}) || 'Z' AS window_start,
  strftime(we, {_ISO}) || 'Z' AS window_end, pct AS metric_value,
  symbol || ' moved ' || {two_digits('pct')} || '% within the 5-minute window' AS description,
  {CREATED_SQL} AS created_at FROM m WHERE abs(pct) >= 1.5"""


def alert_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    created = F.lit(CREATED_AT).cast("timestamp")
    rows = five_minutes(spark, sf_dir)
    spiking = volume_spikes(windows.trade_summary(rows))
    return (
        alerts.volume_alerts(spiking, created_at=created),
        alerts.price_move_alerts(windows.price_alerts(rows), created_at=created),
    )


@query("a1_volume_alerts", f"WITH {GOLD} {VOLUME_ALERT_SQL}")
def a1_volume_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_events(spark, sf_dir)[0]


@query("a2_price_alerts", f"WITH {GOLD} {PRICE_ALERT_SQL}")
def a2_price_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_events(spark, sf_dir)[1]


@query(
    "a3_alert_time_text",
    f"WITH {EV} SELECT event_id, strftime(ts, {_ISO}) || 'Z' AS alert_time FROM ev",
)
def a3_alert_time_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.feed_events(inputs.table(spark, sf_dir, "events"))
    return rows.select("event_id", values.iso_millis(F.col("at")).alias("alert_time"))


@query(
    "a4_alert_messages",
    f"""WITH {GOLD}, a AS ({VOLUME_ALERT_SQL} UNION ALL {PRICE_ALERT_SQL})
    SELECT symbol AS key, symbol, alert_type, severity, window_start, window_end,
      metric_value, description, created_at,
      'schema_version,symbol,alert_type,severity,window_start,window_end,metric_value,description,created_at'
        AS properties
    FROM a""",
)
def a4_alert_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages read back from their JSON, with the property order."""
    volume, price = alert_events(spark, sf_dir)
    messages = alerts.alert_messages(volume.unionByName(price))
    parsed = messages.select(
        "key",
        F.from_json("value", schemas.ALERT_EVENT).alias("a"),
        F.array_join(F.json_object_keys("value"), ",").alias("properties"),
    )
    return parsed.select(
        "key", "a.symbol", "a.alert_type", "a.severity", "a.window_start", "a.window_end",
        "a.metric_value", "a.description", "a.created_at", "properties",
    )
