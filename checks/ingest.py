"""Normalisation, validation, dead letters, contracts."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs
from checks.inputs import FEED
from checks.registry import query
from checks.sql import EV, GOLD, MSG, PLAIN
from marketloom import schemas
from marketloom.functions import values
from marketloom.functions.jsonschema import Property
from marketloom.operators import alerts, contracts, deadletter, spikes, windows
from marketloom.operators.normalize import invalid_events, valid_events
from marketloom.operators.validate import validate


@query(
    "p1_envelope",
    f"WITH {MSG} SELECT event_id, raw_stream, event_kind AS event_type FROM norm",
)
def p1_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.normalized(spark, sf_dir).select("event_id", "raw_stream", "event_type")


@query(
    "p2_type_routing",
    f"WITH {MSG} SELECT event_id, event_kind AS event_type, topic, symbol AS key "
    "FROM norm WHERE error_type IS NULL",
)
def p2_type_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = valid_events(inputs.normalized(spark, sf_dir))
    return events.select("event_id", "event_type", "topic", "key")


def _events_of(spark: SparkSession, sf_dir: str, kind: str, schema) -> DataFrame:
    events = valid_events(inputs.normalized(spark, sf_dir)).where(F.col("event_type") == kind)
    return events.select("event_id", F.from_json("value", schema).alias("e")).select(
        "event_id", "e.*"
    ).drop("ingest_time")


@query(
    "p3_normalize_trade",
    f"""WITH {MSG} SELECT event_id, '1.0' AS schema_version, 'trade' AS event_type, symbol,
      iso AS event_time, event_id AS trade_id, ptext AS price, CAST(k AS VARCHAR) AS quantity,
      CAST(price * k AS VARCHAR) AS trade_value, user_id % 2 = 0 AS is_buyer_market_maker,
      'binance' AS source
    FROM norm WHERE error_type IS NULL AND kind = 'trade'""",
)
def p3_normalize_trade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events_of(spark, sf_dir, "trade", schemas.TRADE_EVENT)


@query(
    "p4_normalize_kline",
    f"""WITH {MSG} SELECT event_id, '1.0' AS schema_version, 'kline' AS event_type, symbol,
      iso AS event_time,
      strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS kline_start_time,
      strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M:') || '59.999Z' AS kline_close_time,
      '1m' AS interval, ptext AS open_price, CAST(price + k AS VARCHAR) AS high_price,
      CAST(greatest(price - 1, 0.00) AS VARCHAR) AS low_price, ptext AS close_price,
      CAST(k AS VARCHAR) AS volume, CAST(price * k AS VARCHAR) AS quote_asset_volume,
      user_id AS number_of_trades, CAST(k AS VARCHAR) AS taker_buy_base_asset_volume,
      ptext AS taker_buy_quote_asset_volume, user_id % 2 = 0 AS is_closed, 'binance' AS source
    FROM norm WHERE error_type IS NULL AND kind = 'kline'""",
)
def p4_normalize_kline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events_of(spark, sf_dir, "kline", schemas.KLINE_EVENT)


@query(
    "p5_normalize_ticker",
    f"""WITH {MSG} SELECT event_id, '1.0' AS schema_version, 'ticker' AS event_type, symbol,
      iso AS event_time, CAST(price - 50 AS VARCHAR) AS price_change,
      CAST(k - 50 AS VARCHAR) AS price_change_percent, ptext AS weighted_avg_price,
      ptext AS last_price, CAST(k AS VARCHAR) AS last_quantity, ptext AS open_price,
      CAST(price + k AS VARCHAR) AS high_price,
      CAST(greatest(price - 1, 0.00) AS VARCHAR) AS low_price, CAST(k AS VARCHAR) AS volume,
      CAST(price * k AS VARCHAR) AS quote_volume,
      strftime(ts - INTERVAL '1 day', '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS open_time,
      iso AS close_time, event_id AS first_trade_id, event_id + k AS last_trade_id,
      k AS trade_count, 'binance' AS source
    FROM norm WHERE error_type IS NULL AND kind = 'ticker'""",
)
def p5_normalize_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events_of(spark, sf_dir, "ticker", schemas.TICKER_EVENT)


@query(
    "p6_iso_millis",
    f"WITH {EV} SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS event_time FROM ev",
)
def p6_iso_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.feed_events(inputs.table(spark, sf_dir, "events"))
    return rows.select(
        "event_id", values.iso_from_millis(F.unix_millis("at")).alias("event_time")
    )


@query(
    "p7_decimal_text",
    f"WITH {MSG} SELECT event_id, error_type, error_message FROM norm "
    "WHERE error_message LIKE 'Invalid decimal value%'",
)
def p7_decimal_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = invalid_events(inputs.normalized(spark, sf_dir))
    return failed.where(F.col("error_message").startswith("Invalid decimal value")).select(
        "event_id", "error_type", "error_message"
    )


@query(
    "p8_decimal_product",
    f"WITH {EV} SELECT event_id, CAST(price * k AS VARCHAR) AS product FROM ev",
)
def p8_decimal_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.feed_events(inputs.table(spark, sf_dir, "events"))
    price, k = F.col("price").cast("string"), F.col("k").cast("string")
    return rows.select("event_id", values.product_text(price, k).alias("product"))


@query(
    "p8_long_products",
    f"""WITH {EV}, f AS (
      SELECT event_id, (event_id * 1000003 + 7)::HUGEINT * (10 * ((k + 1) * 998244353::HUGEINT) + 5) AS n FROM ev
    )
    SELECT event_id, CAST(n // CAST(10000000000000 AS HUGEINT) AS VARCHAR) || '.' ||
      lpad(CAST(CAST(n % CAST(10000000000000 AS HUGEINT) AS HUGEINT) AS VARCHAR), 13, '0') AS product FROM f""",
)
def p8_long_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Factors of up to 13 digits, one with an exponent."""
    rows = inputs.feed_events(inputs.table(spark, sf_dir, "events"))
    left = F.concat((F.col("event_id") * 1000003 + 7).cast("string"), F.lit("e-12"))
    right = F.concat(((F.col("k") + 1) * F.lit(998244353).cast("bigint")).cast("string"), F.lit(".5"))
    return rows.select("event_id", values.product_text(left, right).alias("product"))


@query(
    "p9_key_and_headers",
    f"""WITH {MSG} SELECT event_id, symbol AS key,
      'source=binance; schema_version=1.0; event_type=' || event_kind AS headers
    FROM norm WHERE error_type IS NULL""",
)
def p9_key_and_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = valid_events(inputs.normalized(spark, sf_dir))
    return events.select("event_id", "key", _header_text())


def _header_text():
    pairs = F.transform(
        "headers", lambda h: F.concat(h["key"], F.lit("="), h["value"].cast("string"))
    )
    return F.array_join(pairs, "; ").alias("headers")


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(inputs.plain_events(inputs.table(spark, sf_dir, "events")))


def _validation_sql(condition: str) -> str:
    return (
        f"WITH {PLAIN} SELECT event_id, errors = '' AS is_valid, errors FROM checked "
        f"WHERE {condition}"
    )


@query("v1_validate_trade", _validation_sql("kind = 'trade'"))
def v1_validate_trade(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _validated(spark, sf_dir).where(F.col("kind") == "trade")
    return rows.select("event_id", "is_valid", "errors")


@query("v2_validate_kline", _validation_sql("kind = 'kline'"))
def v2_validate_kline(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _validated(spark, sf_dir).where(F.col("kind") == "kline")
    return rows.select("event_id", "is_valid", "errors")


@query("v3_validate_ticker", _validation_sql("kind = 'ticker'"))
def v3_validate_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _validated(spark, sf_dir).where(F.col("kind") == "ticker")
    return rows.select("event_id", "is_valid", "errors")


@query(
    "v4_dispatch_by_type",
    f"""WITH {PLAIN} SELECT coalesce(etype, 'None') AS event_type, errors = '' AS is_valid,
      count(*) AS events FROM checked GROUP BY ALL""",
)
def v4_dispatch_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _validated(spark, sf_dir)
    event_type = F.coalesce(F.get_json_object("value", "$.event_type"), F.lit("None"))
    return rows.groupBy(event_type.alias("event_type"), "is_valid").agg(
        F.count("*").alias("events")
    )


@query(
    "v5_rule_messages",
    f"""WITH {PLAIN} SELECT error, count(*) AS events
    FROM (SELECT unnest(string_split(errors, '; ')) AS error FROM checked WHERE errors <> '')
    GROUP BY ALL""",
)
def v5_rule_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _validated(spark, sf_dir).select(F.explode("errors").alias("error"))
    return rows.groupBy("error").agg(F.count("*").alias("events"))


@query(
    "v6_dead_letters",
    f"""WITH {MSG} SELECT event_id, 'market.events.invalid' AS topic,
      coalesce(topic, error_type) AS key, coalesce(topic, 'unknown') AS source_topic,
      error_type, error_message, symbol,
      'source=binance; schema_version=1.0; event_type=invalid; error_type=' || error_type AS headers,
      symbol IS NOT NULL AS has_symbol
    FROM norm WHERE error_type IS NOT NULL""",
)
def v6_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = invalid_events(inputs.normalized(spark, sf_dir))
    letters = deadletter.dead_letter_records(failed, FEED, keep=("event_id",))
    has_symbol = F.array_contains(F.json_object_keys("value"), "symbol")
    return letters.select(
        "event_id", "topic", "key", "source_topic", "error_type", "error_message", "symbol",
        _header_text(), has_symbol.alias("has_symbol"),
    )


@query(
    "v7_error_context",
    f"""WITH {MSG} SELECT event_id, coalesce(topic, 'unknown') AS source_topic, symbol FROM norm""",
)
def v7_error_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = inputs.vendor_messages(inputs.table(spark, sf_dir, "events"))
    raw = messages.select("event_id", F.col("value").cast("binary").alias("value"))
    return deadletter.with_error_context(raw, FEED).select("event_id", "source_topic", "symbol")


@query(
    "v8_split_valid_invalid",
    f"""WITH {MSG} SELECT event_id,
      CASE WHEN error_type IS NULL THEN topic ELSE 'market.events.invalid' END AS topic,
      CASE WHEN error_type IS NULL THEN symbol ELSE coalesce(topic, error_type) END AS key,
      error_type, error_message FROM norm""",
)
def v8_split_valid_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = deadletter.route(inputs.normalized(spark, sf_dir), FEED, keep=(
        "event_id", "error_type", "error_message",
    ))
    return routed.select("event_id", "topic", "key", "error_type", "error_message")


@query(
    "v9_contract_published",
    f"""WITH {GOLD.replace('WITH', '')}, {MSG.split('),', 1)[1].lstrip()},
    alerts AS (
      SELECT symbol FROM m WHERE abs(pct) >= 1.5
      UNION ALL SELECT symbol FROM sp WHERE strength <> 'LOW'
    ),
    rows AS (
      SELECT kind || '_event_v1' AS contract, symbol FROM norm WHERE error_type IS NULL
      UNION ALL SELECT 'invalid_event_v1', symbol FROM norm
                WHERE error_type IS NOT NULL AND symbol IS NOT NULL
      UNION ALL SELECT 'alert_event_v1', symbol FROM alerts
    )
    SELECT contract, 'symbol: pattern' AS rule, count(*) AS violations FROM rows
    WHERE NOT regexp_matches(symbol, '^[A-Z0-9]{{5,20}}$') GROUP BY ALL""",
)
def v9_contract_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything the pipeline publishes against its contract: events, dead letters, alerts."""
    normalized = inputs.normalized(spark, sf_dir)
    messages = deadletter.route(normalized, FEED, keep=("event_type", "error_type"))
    named = contracts.contract_name(F.col("event_type"), F.col("error_type").isNotNull())
    measures = windows.window_measures(inputs.trades(spark, sf_dir))
    spiking = spikes.volume_spikes(windows.trade_summary(measures))
    alert_events = alerts.volume_alerts(spiking).unionByName(
        alerts.price_move_alerts(windows.price_alerts(measures))
    )
    alert_name = F.lit(contracts.ALERT_CONTRACT.name)
    feed = messages.select("value", named.alias("contract")).unionByName(
        alerts.alert_messages(alert_events).select("value", alert_name.alias("contract"))
    )
    return contracts.feed_report(feed)


@query(
    "v9_contract_faults",
    f"""WITH {PLAIN},
    broken AS (
      SELECT unnest(list_filter([
        'schema_version: required', 'trade_value: required', 'is_buyer_market_maker: required',
        'source: required', 'ingest_time: required', 'trade_event_v1: additionalProperties',
        CASE WHEN etype IS NULL THEN 'event_type: required' WHEN etype <> 'trade' THEN 'event_type: const' END,
        CASE WHEN k = 1 THEN 'symbol: required' END,
        CASE WHEN k = 2 THEN 'event_time: required' WHEN k = 3 THEN 'event_time: format' END,
        CASE WHEN k = 4 THEN 'trade_id: required' END,
        CASE WHEN k = 5 THEN 'price: pattern' END,
        CASE WHEN k IN (6, 7) THEN 'quantity: pattern' END
      ], lambda x: x IS NOT NULL)) AS rule
      FROM checked WHERE kind = 'trade'
    )
    SELECT 'trade_event_v1' AS contract, rule, count(*) AS violations FROM broken GROUP BY ALL""",
)
def v9_contract_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faulty events against the trade contract: most of its rules are broken somewhere."""
    events = inputs.plain_events(inputs.table(spark, sf_dir, "events"))
    return contracts.contract_report(
        events.where(F.col("kind") == "trade"), contracts.TRADE_CONTRACT
    )


def _good(spec: Property) -> str:
    """JSON text of a value that the property may have."""
    rules = spec.rules
    if "const" in rules or "enum" in rules:
        return json.dumps(rules["const"] if "const" in rules else rules["enum"][0])
    if "format" in rules:
        return '"2024-01-01T00:00:01.500Z"'
    if rules["type"] != "string":
        return {"integer": "3", "boolean": "true", "number": "1.5"}[rules["type"]]
    return '"ABCDE"' if "A-Z" in rules.get("pattern", "") else '"1.5"'


#: JSON text of the right type with a wrong value, by the keyword that it breaks.
_WRONG = {
    "const": lambda given: '"none of them"', "enum": lambda given: '"none of them"',
    "format": lambda given: '"2024-01-01 00:00:01,5+0530"', "minimum": lambda given: str(given - 1),
    "pattern": lambda given: '"x!"', "minLength": lambda given: '""',
}


def _faults(contract: contracts.Contract) -> list[tuple[dict[str, str | None], str | None]]:
    """Properties to change and the rule that breaks: each left out, of wrong type, of wrong value."""
    found: list[tuple[dict[str, str | None], str | None]] = []
    for spec in contract.properties:
        found.append(({spec.name: None}, f"{spec.name}: required" if spec.required else None))
        found.append(({spec.name: "[]"}, f"{spec.name}: type"))
        for word in set(spec.rules) & set(_WRONG):
            found.append(({spec.name: _WRONG[word](spec.rules[word])}, f"{spec.name}: {word}"))
    return [*found, ({"unknown": "1"}, f"{contract.name}: additionalProperties"), ({}, None)]


def _faulty_texts(contract: contracts.Contract) -> list[str]:
    """An event's JSON text for each of the contract's faults."""
    good, texts = {spec.name: _good(spec) for spec in contract.properties}, []
    for changes, _ in _faults(contract):
        fields = {name: text for name, text in (good | changes).items() if text is not None}
        texts.append("{" + ",".join(f'"{name}":{text}' for name, text in fields.items()) + "}")
    return texts


def _faults_sql(contract: contracts.Contract) -> str:
    faults = _faults(contract)
    rows = ", ".join(f"({i}, '{rule}')" for i, (_, rule) in enumerate(faults) if rule)
    return f"""SELECT '{contract.name}' AS contract, rule, count(*) AS violations
      FROM events JOIN (VALUES {rows}) AS f(i, rule) ON event_id % {len(faults)} = i GROUP BY rule"""


@query("v9_faults_of_all_contracts", " UNION ALL ".join(_faults_sql(c) for c in contracts.CONTRACTS))
def v9_faults_of_all_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mixed feed: an event per row of the table and contract, with the fault that follows from its id."""
    made = []
    for contract in contracts.CONTRACTS:
        texts = _faulty_texts(contract)
        fault = (F.col("event_id") % len(texts)).cast("int")
        made.append(F.struct(
            F.lit(contract.name).alias("contract"), F.get(F.array(*map(F.lit, texts)), fault).alias("value")
        ))
    events = inputs.spread(inputs.table(spark, sf_dir, "events").select("event_id"))
    return contracts.feed_report(events.select(F.inline(F.array(*made))))


@query(
    "v10_dead_letter_metrics",
    f"""WITH {MSG} SELECT error_type, coalesce(topic, 'unknown') AS source_topic,
      count(*) AS messages FROM norm WHERE error_type IS NOT NULL GROUP BY ALL""",
)
def v10_dead_letter_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deadletter.dead_letter_metrics(invalid_events(inputs.normalized(spark, sf_dir)))
