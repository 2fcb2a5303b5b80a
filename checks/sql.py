"""SQL fragments shared by the oracles: the same inputs and layers, written for DuckDB."""

from __future__ import annotations

EV = """
ev AS (
  SELECT event_id, ts, user_id, event_type, CAST(value AS DECIMAL(18,2)) AS price,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CASE event_type WHEN 'view' THEN 'kline' WHEN 'signup' THEN 'ticker' ELSE 'trade' END AS kind
  FROM events
)"""

TRADES = EV + """,
trades AS (
  SELECT upper(event_type) AS symbol, ts AS event_time, event_id AS trade_id, price,
         CAST(price * 100 AS BIGINT) AS cents, k AS quantity, price * k AS trade_value,
         user_id % 2 = 0 AS is_buyer_market_maker
  FROM ev WHERE price > 0 AND k > 0
)"""

# Percent change in exact integers: the ratio is rounded half up to six digits first.
CHANGE = """
CASE WHEN s > 0 THEN
  sign(e - s) * ((2 * CAST(abs(e - s) AS HUGEINT) * 1000000 + s) // (2 * CAST(s AS HUGEINT))) / 10000.0
END"""

ALERT_TYPE = "CASE WHEN pct >= 1.5 THEN 'PRICE_SURGE' WHEN pct <= -1.5 THEN 'PRICE_DROP' END"
LEVEL = "CASE WHEN abs(pct) >= 1.5 THEN 'HIGH' WHEN abs(pct) >= 0.5 THEN 'MEDIUM' ELSE 'LOW' END"
STRENGTH = "CASE WHEN ratio >= 2 THEN 'HIGH' WHEN ratio >= 1.5 THEN 'MEDIUM' ELSE 'LOW' END"


def measures(width: str, source: str = "trades", name: str = "m") -> str:
    """CTE with one row per symbol and window, ``pct`` being the change over it."""
    return f"""
{name}_raw AS (
  SELECT symbol, time_bucket(INTERVAL '{width}', event_time) AS ws,
         arg_min(cents, (event_time, trade_id)) AS s, arg_max(cents, (event_time, trade_id)) AS e,
         min(price) AS lo, max(price) AS hi, avg(price) AS mean,
         stddev_pop(CAST(price AS DOUBLE)) AS sd, count(*) AS n, sum(quantity) AS volume,
         sum(trade_value) AS total, min(trade_value) AS lo_value, max(trade_value) AS hi_value
  FROM {source} GROUP BY ALL
),
{name} AS (
  SELECT *, ws + INTERVAL '{width}' AS we, {CHANGE} AS pct FROM {name}_raw
)"""


def spikes(lookback: str, source: str = "m", name: str = "sp") -> str:
    """CTE with the spikes: the range join itself, ratio in exact integers.

    The baseline is rounded half up to 22 digits and the ratio to 6, as decimals are.
    """
    return f"""
{name}_raw AS (
  SELECT c.symbol, c.ws, c.we, c.volume, c.n, sum(h.volume) AS hsum, count(h.volume) AS hn
  FROM {source} c JOIN {source} h
    ON c.symbol = h.symbol AND h.we < c.ws AND h.we >= c.ws - INTERVAL '{lookback}'
  GROUP BY ALL
),
{name}_based AS (
  SELECT *, (2 * CAST(hsum AS HUGEINT) * 10000000000000000000000 + hn) // (2 * CAST(hn AS HUGEINT)) AS b
  FROM {name}_raw WHERE hsum > 0
),
{name}_rated AS (
  SELECT *, (2 * CAST(volume AS HUGEINT) * 10000000000000000000000 * 1000000 + b) // (2 * b) / 1000000.0 AS ratio
  FROM {name}_based
),
{name} AS (SELECT *, {STRENGTH} AS strength FROM {name}_rated)"""


def two_digits(number: str) -> str:
    """Text of a number of at most six digits, rounded half to even to two, with separators."""
    micro = f"abs(CAST(round({number} * 1000000) AS BIGINT))"
    cents = (
        f"({micro} // 10000 + CASE WHEN {micro} % 10000 > 5000 OR "
        f"({micro} % 10000 = 5000 AND ({micro} // 10000) % 2 = 1) THEN 1 ELSE 0 END)"
    )
    sign = f"CASE WHEN {number} < 0 THEN '-' ELSE '' END"
    return f"{sign} || format('{{:,}}', {cents} // 100) || '.' || lpad(CAST({cents} % 100 AS VARCHAR), 2, '0')"


# Gold layer at the deployed widths.
GOLD = TRADES + "," + measures("5 minutes") + "," + spikes("30 minutes")

# What the normaliser makes of the vendor messages of ``inputs.vendor_messages``.
MSG = EV + """,
msg AS (
  SELECT *,
    upper(CASE WHEN k = 6 THEN '  ' ELSE event_type END) AS sym,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS iso,
    CAST(price AS VARCHAR) AS ptext,
    CASE kind WHEN 'trade' THEN 'market.trades.raw' WHEN 'kline' THEN 'market.klines.raw'
              ELSE 'market.tickers.raw' END AS kind_topic,
    CASE
      WHEN k = 1 THEN NULL
      WHEN k IN (2, 11) THEN 'Binance payload is not a JSON object'
      WHEN k = 3 THEN 'Unsupported Binance event type: aggTrade'
      WHEN k = 4 THEN CASE kind WHEN 'trade' THEN '''q''' ELSE '''v''' END
      WHEN k = 5 THEN 'Invalid decimal value: n/a'
      WHEN k = 8 THEN 'invalid literal for int() with base 10: ''x1'''
      WHEN k = 9 AND kind <> 'ticker' THEN 'value is not a JSON boolean'
      WHEN k = 12 THEN 'timestamp out of range: 99999999999999999'
    END AS routing,
    concat_ws('; ',
      CASE WHEN k = 6 THEN 'symbol is missing' END,
      CASE WHEN price <= 0 AND kind = 'trade' THEN 'price must be greater than zero' END,
      CASE WHEN price <= 0 AND kind = 'ticker' THEN 'last_price must be greater than zero' END,
      CASE WHEN k IN (0, 7) AND kind = 'trade' THEN 'quantity must be greater than zero' END,
      CASE WHEN k = 7 AND kind <> 'trade' THEN 'volume must be greater than or equal to zero' END
    ) AS rules
  FROM ev
),
norm AS (
  SELECT *,
    CASE WHEN k = 1 THEN 'JSON_DECODE_ERROR' WHEN routing IS NOT NULL THEN 'ROUTING_ERROR'
         WHEN rules <> '' THEN 'VALIDATION_ERROR' END AS error_type,
    CASE WHEN k = 1 THEN 'message is not valid JSON' WHEN routing IS NOT NULL THEN routing
         WHEN rules <> '' THEN rules END AS error_message,
    CASE WHEN k IN (1, 2, 3, 11) THEN NULL ELSE kind END AS event_kind,
    CASE WHEN k IN (1, 2, 3, 11) THEN NULL ELSE kind_topic END AS topic,
    CASE WHEN k IN (1, 2, 11) THEN NULL ELSE sym END AS symbol,
    CASE WHEN k IN (1, 2, 10) THEN NULL ELSE event_type || '@' || kind END AS raw_stream
  FROM msg
)"""

# Typed trades that come out of those messages (millisecond time).
MSG_TRADES = MSG + """,
trades AS (
  SELECT symbol, date_trunc('milliseconds', ts) AS event_time, event_id AS trade_id, price,
         CAST(price * 100 AS BIGINT) AS cents, k AS quantity, price * k AS trade_value,
         user_id % 2 = 0 AS is_buyer_market_maker, event_id
  FROM norm WHERE error_type IS NULL AND kind = 'trade'
)"""

# Faults of ``inputs.plain_events`` as the validators report them.
PLAIN = EV + """,
plain AS (
  SELECT *, CASE WHEN k = 8 THEN 'book_ticker' WHEN k = 9 THEN NULL ELSE kind END AS etype,
    CASE WHEN k = 1 THEN 'symbol is missing' END AS e_symbol,
    CASE WHEN k = 2 THEN ' is missing' WHEN k = 3 THEN ' is not a valid UTC timestamp' END AS time_fault,
    CASE WHEN k = 5 THEN ' is not numeric' END AS text_fault,
    CASE WHEN k = 5 THEN ' is not numeric' WHEN price <= 0 THEN ' must be greater than zero' END AS price_fault,
    CASE WHEN k = 6 THEN ' is missing' WHEN k IN (0, 7) THEN ' must be greater than zero' END AS size_fault,
    CASE WHEN k = 6 THEN ' is missing' WHEN k = 7 THEN ' must be greater than or equal to zero' END AS volume_fault
  FROM ev
),
checked AS (
  SELECT event_id, kind, etype, k, price,
    CASE
      WHEN etype IS NULL OR etype = 'book_ticker' THEN 'unsupported event_type: ' || coalesce(etype, 'None')
      WHEN kind = 'trade' THEN concat_ws('; ', e_symbol, 'event_time' || time_fault,
        CASE WHEN k = 4 THEN 'trade_id is missing' END, 'price' || price_fault, 'quantity' || size_fault)
      WHEN kind = 'kline' THEN concat_ws('; ', e_symbol, 'kline_start_time' || time_fault,
        'open_price' || text_fault, 'volume' || volume_fault)
      ELSE concat_ws('; ', e_symbol, 'event_time' || time_fault, 'last_price' || price_fault,
        'volume' || volume_fault)
    END AS errors
  FROM plain
)"""
