"""Vendor messages to normalised events, with the reason where that is impossible.

The vendor's keys differ only by case (``t``/``T``, ``p``/``P``), so messages are parsed to
VARIANT once and read by path, which is case-sensitive without a session switch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketloom import schemas
from marketloom.config import Feed
from marketloom.functions import rules
from marketloom.functions.values import (
    DECIMAL_PATTERN,
    FIRST_MILLI,
    LAST_MILLI,
    iso_from_millis,
    iso_millis,
    is_short_product,
    long_product,
    sealed_json,
    seal_is_whole,
    short_product,
)
from marketloom.operators.rows import computed_once

JSON_DECODE_ERROR = "JSON_DECODE_ERROR"
ROUTING_ERROR = "ROUTING_ERROR"
VALIDATION_ERROR = "VALIDATION_ERROR"
UNKNOWN_TOPIC = "unknown"

# The vendor's event type names and ours.
EVENT_TYPES = {"trade": "trade", "kline": "kline", "24hrTicker": "ticker"}

# Vendor key, our name, kind; in the order in which fields are checked.
TRADE_FIELDS = (
    ("p", "price", "decimal"),
    ("q", "quantity", "decimal"),
    ("s", "symbol", "text"),
    ("E", "event_time", "millis"),
    ("t", "trade_id", "integer"),
    ("m", "is_buyer_market_maker", "boolean"),
)
KLINE_FIELDS = (
    ("s", "symbol", "text"),
    ("E", "event_time", "millis"),
)
KLINE_BAR_FIELDS = (
    ("t", "kline_start_time", "millis"),
    ("T", "kline_close_time", "millis"),
    ("i", "interval", "text"),
    ("o", "open_price", "decimal"),
    ("h", "high_price", "decimal"),
    ("l", "low_price", "decimal"),
    ("c", "close_price", "decimal"),
    ("v", "volume", "decimal"),
    ("q", "quote_asset_volume", "decimal"),
    ("n", "number_of_trades", "integer"),
    ("V", "taker_buy_base_asset_volume", "decimal"),
    ("Q", "taker_buy_quote_asset_volume", "decimal"),
    ("x", "is_closed", "boolean"),
)
TICKER_FIELDS = (
    ("s", "symbol", "text"),
    ("E", "event_time", "millis"),
    ("p", "price_change", "decimal"),
    ("P", "price_change_percent", "decimal"),
    ("w", "weighted_avg_price", "decimal"),
    ("c", "last_price", "decimal"),
    ("Q", "last_quantity", "decimal"),
    ("o", "open_price", "decimal"),
    ("h", "high_price", "decimal"),
    ("l", "low_price", "decimal"),
    ("v", "volume", "decimal"),
    ("q", "quote_volume", "decimal"),
    ("O", "open_time", "millis"),
    ("C", "close_time", "millis"),
    ("F", "first_trade_id", "integer"),
    ("L", "last_trade_id", "integer"),
    ("n", "trade_count", "integer"),
)
UNWRAPPED = ("raw_stream", "_malformed", "_payload", "_vendor_type")
#: The records that are read from a payload: vendor's type name, path, our name, fields.
RECORDS = (
    ("trade", "$", "trade", TRADE_FIELDS),
    ("kline", "$", "kline", KLINE_FIELDS),
    ("kline", "$.k", "bar", KLINE_BAR_FIELDS),
    ("24hrTicker", "$", "ticker", TICKER_FIELDS),
)
VARIANT_TYPES = {
    "decimal": "string",
    "text": "string",
    "millis": "bigint",
    "integer": "bigint",
    "boolean": "boolean",
}


def _vendor_struct(fields) -> str:
    return f"struct<{','.join(f'{key}:{VARIANT_TYPES[kind]}' for key, _, kind in fields)}>"


def _named_struct(fields) -> str:
    """The same with our names, which differ in more than case."""
    return f"struct<{','.join(f'`{name}`:{VARIANT_TYPES[kind]}' for _, name, kind in fields)}>"


def _bad_when(column: str, path: str, kind: str) -> str:
    """SQL condition under which an extracted column is missing or unreadable."""
    node = f"try_variant_get(_payload, '{path}', 'variant')"
    if kind == "decimal":
        return f"{column} IS NULL OR NOT {column} RLIKE r'{DECIMAL_PATTERN}'"
    if kind == "millis":
        return f"{column} IS NULL OR {column} NOT BETWEEN {FIRST_MILLI} AND {LAST_MILLI}"
    if kind == "boolean":
        return f"{column} IS NULL OR schema_of_variant({node}) <> 'BOOLEAN'"
    if kind == "text":
        # A JSON null becomes blank text, which validation reports as missing.
        return f"{column} IS NULL AND {node} IS NULL"
    return f"{column} IS NULL"


def _first_bad_path(fields, prefix: str, parent: str = "$") -> Column:
    """Path and kind of the first field that is missing or unreadable, else null.

    Fields are read from the struct ``_<prefix>``.
    """
    checks = (
        f"CASE WHEN {_bad_when(f'_{prefix}.`{name}`', f'{parent}.{key}', kind)} "
        f"THEN '{parent}.{key} {kind}' END"
        for key, name, kind in fields
    )
    return F.expr(f"coalesce({', '.join(checks)})")


def _routing_message(payload: Column, bad: Column) -> Column:
    """Error text for a path and kind found by ``_first_bad_path``."""
    path, kind = F.substring_index(bad, " ", 1), F.substring_index(bad, " ", -1)
    text = F.try_variant_get(payload, path, "string")
    missing = F.try_variant_get(payload, path, "variant").isNull()
    is_number = F.try_variant_get(payload, path, "bigint").isNotNull()
    # Error texts.
    return (
        F.when(missing, F.concat(F.lit("'"), F.substring_index(path, ".", -1), F.lit("'")))
        .when(kind == "object", "kline is not a JSON object")
        .when(
            kind == "decimal",
            F.concat(F.lit("Invalid decimal value: "), F.coalesce(text, F.lit("None"))),
        )
        .when(kind == "boolean", "value is not a JSON boolean")
        .when(
            text.isNull(),
            "int() argument must be a string, a bytes-like object or a real number, "
            "not 'NoneType'",
        )
        .when(is_number, F.concat(F.lit("timestamp out of range: "), text))
        .otherwise(F.concat(F.lit("invalid literal for int() with base 10: '"), text, F.lit("'")))
    )


def message_text(raw: Column) -> Column:
    """A message as text; bytes that are not UTF-8 become replacement characters."""
    return F.make_valid_utf8(raw.cast("string"))


def unwrap(document: Column) -> Column:
    """The vendor payload: the value under ``data`` if that key exists, else the whole."""
    return F.coalesce(F.try_variant_get(document, "$.data", "variant"), document)


def vendor_type(payload: Column) -> Column:
    return F.try_variant_get(payload, "$.e", "string")


def event_type_of(vendor: Column) -> Column:
    """Our event type for the vendor's, null when unsupported."""
    mapped = F.lit(None).cast("string")
    for theirs, ours in EVENT_TYPES.items():
        mapped = F.when(vendor == theirs, ours).otherwise(mapped)
    return mapped


def topic_of(event_type: Column, feed: Feed) -> Column:
    return (
        F.when(event_type == "trade", feed.trades_topic)
        .when(event_type == "kline", feed.klines_topic)
        .when(event_type == "ticker", feed.tickers_topic)
    )


def headers(feed: Feed, event_type: Column, error_type: Column | None = None) -> Column:
    """Record headers with UTF-8 values: source, schema version, event type, error type."""
    pairs = [
        ("source", F.lit(feed.source)),
        ("schema_version", F.lit(feed.schema_version)),
        ("event_type", event_type),
    ]
    if error_type is not None:
        pairs.append(("error_type", error_type))
    return F.array(
        *(
            F.struct(F.lit(key).alias("key"), F.encode(value, "UTF-8").alias("value"))
            for key, value in pairs
        )
    )


def _unsupported(payload: Column, vendor: Column) -> Column:
    message = F.concat(
        F.lit("Unsupported Binance event type: "), F.coalesce(vendor, F.lit("None"))
    )
    is_object = vendor.isNotNull() | F.schema_of_variant(payload).startswith("OBJECT")
    return F.when(is_object, message).otherwise("Binance payload is not a JSON object")


def _columns(prefix: str, fields) -> dict[str, Column]:
    """Event columns from the struct of vendor fields, instants as ISO text."""
    columns = {}
    for _, name, kind in fields:
        value = F.col(f"_{prefix}")[name]
        columns[name] = iso_from_millis(value) if kind == "millis" else value
    if "symbol" in columns:
        columns["symbol"] = F.upper(F.coalesce(columns["symbol"], F.lit("")))
    return columns


def _open_rules(checks):
    """Rules that a routable event can still break: its instants are written by us."""
    return tuple(check for check in checks if check[1] is not rules.instant)


def _trade_errors(trade: dict[str, Column]) -> Column:
    """Broken rules; a trade that breaks none may still have a value that cannot be written."""
    errors = rules.error_text(_open_rules(rules.TRADE_RULES), trade)
    too_long = (errors == "") & trade["trade_value"].isNull()
    return F.when(too_long, "trade_value has too many digits").otherwise(errors)


def _event_json(
    feed: Feed, event_type: str, schema: StructType, stamp: Column, columns: dict[str, Column]
) -> Column:
    fixed = {
        "schema_version": F.lit(feed.schema_version),
        "event_type": F.lit(event_type),
        "source": F.lit(feed.source),
        "ingest_time": stamp,
    }
    available = {**columns, **fixed}
    return F.to_json(F.struct(*(available[name].alias(name) for name in schema.names)))


def normalize(
    messages: DataFrame,
    feed: Feed = Feed(),
    *,
    value: str = "value",
    ingest_time: Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per message: its normalised event, or why there is none.

    Adds ``raw_payload, raw_stream, event_type, topic, key, value, headers, symbol,
    source_topic, error_type, error_message``. A message fails at the first of: not JSON,
    not routable (unknown type, missing or unreadable field), not valid; ``error_type`` is
    null for events that pass. ``keep`` names input columns to carry along.
    """
    stamp = iso_millis(F.current_timestamp() if ingest_time is None else ingest_time)
    raw = message_text(F.col(value))
    payload, vendor = F.col("_payload"), F.col("_vendor_type")
    decoded = computed_once(
        messages, F.struct(raw.alias("raw_payload"), stamp.alias("_stamp")), *keep
    )
    # Read from inside the seal, since taking a value out of it copies the value.
    sealed = computed_once(
        decoded, F.struct(sealed_json(F.col("raw_payload")).alias("_sealed")), *keep, "raw_payload", "_stamp"
    )
    whole = seal_is_whole(F.col("_sealed"), F.col("raw_payload"))
    document = F.coalesce(
        F.try_variant_get("_sealed", "$[0].data", "variant"), F.try_variant_get("_sealed", "$[0]", "variant")
    )
    unwrapped = computed_once(
        sealed,
        F.when(whole, F.struct(F.try_variant_get("_sealed", "$[0].stream", "string"), document)),
        *keep,
        "raw_payload",
        "_stamp",
        names=("raw_stream", "_payload"),
    )
    carried = [*keep, "raw_payload", "_stamp", "raw_stream", "_payload"]
    # A document is never null, be it a JSON null.
    rows = computed_once(
        unwrapped,
        F.struct(payload.isNull().alias("_malformed"), vendor_type(payload).alias("_vendor_type")),
        *carried,
    )
    carried = [*keep, "raw_payload", "_stamp", *UNWRAPPED]

    # One struct per record, read from the payload in a single pass over its fields. They stay
    # structs: a column for every field makes methods of more parameters than the JIT takes.
    for vendor_name, path, prefix, fields in RECORDS:
        record = F.when(
            vendor == vendor_name, F.try_variant_get(payload, path, _vendor_struct(fields))
        ).cast(_named_struct(fields))
        rows = computed_once(rows, F.struct(record.alias(f"_{prefix}")), *carried)
        carried.append(f"_{prefix}")
        if prefix == "trade":
            # The long way is no generated code, so it has a step of its own while rows are narrow.
            factors = F.struct(F.col("_trade")["price"].alias("_price"), F.col("_trade")["quantity"].alias("_quantity"))
            rows = computed_once(rows, factors, *carried)
            price, quantity = F.col("_price"), F.col("_quantity")
            rows = computed_once(
                rows, F.struct(is_short_product(price, quantity).alias("_is_short")), *carried, "_price", "_quantity"
            )
            short = F.when(F.col("_is_short"), short_product(price, quantity))
            rows = computed_once(rows, F.struct(short.alias("_short")), *carried, "_price", "_quantity")
            value_of_trade = F.coalesce("_short", long_product(price, quantity))
            rows = computed_once(rows, F.struct(value_of_trade.alias("_trade_value")), *carried)
            carried.append("_trade_value")

    bar = F.try_variant_get(payload, "$.k", "variant")
    # The checks of one kind a step, which keeps the generated methods small enough for the JIT.
    no_bar = F.col("_bar").isNull()
    bad_kline = F.coalesce(
        F.when(no_bar & bar.isNull(), "$.k object"),
        _first_bad_path(KLINE_FIELDS, "kline"),
        F.when(no_bar & ~F.schema_of_variant(bar).startswith("OBJECT"), "$.k object"),
    )
    found = F.lit(None).cast("string")
    for vendor_name, bad_field in (
        ("trade", _first_bad_path(TRADE_FIELDS, "trade")),
        ("kline", bad_kline),
        ("kline", _first_bad_path(KLINE_BAR_FIELDS, "bar", "$.k")),
        ("24hrTicker", _first_bad_path(TICKER_FIELDS, "ticker")),
    ):
        bad = F.coalesce(found, F.when(vendor == vendor_name, bad_field))
        rows = computed_once(rows, F.struct(bad.alias("_bad")), *carried)
        found = F.col("_bad")
    carried.append("_bad")

    trade = _columns("trade", TRADE_FIELDS)
    trade["trade_value"] = F.col("_trade_value")
    kline = {**_columns("kline", KLINE_FIELDS), **_columns("bar", KLINE_BAR_FIELDS)}
    ticker = _columns("ticker", TICKER_FIELDS)
    broken = F.when(F.col("_bad").isNotNull(), "")
    for vendor_name, errors in (
        ("trade", _trade_errors(trade)),
        ("kline", rules.error_text(_open_rules(rules.KLINE_RULES), kline)),
        ("24hrTicker", rules.error_text(_open_rules(rules.TICKER_RULES), ticker)),
    ):
        now = F.coalesce(broken, F.when(vendor == vendor_name, errors))
        rows = computed_once(rows, F.struct(now.alias("_rule_errors")), *carried)
        broken = F.col("_rule_errors")
    carried.append("_rule_errors")

    # One step per event type, again to keep the generated methods small, and one column for all.
    stamped, written = F.col("_stamp"), F.lit(None).cast("string")
    for vendor_name, event_type, schema, columns in (
        ("trade", "trade", schemas.TRADE_EVENT, trade),
        ("kline", "kline", schemas.KLINE_EVENT, kline),
        ("24hrTicker", "ticker", schemas.TICKER_EVENT, ticker),
    ):
        json = F.when(
            F.col("_bad").isNull() & (vendor == vendor_name),
            _event_json(feed, event_type, schema, stamped, columns),
        )
        now = F.coalesce(written, json)
        rows = computed_once(rows, F.struct(now.alias("_json")), *carried)
        written = F.col("_json")
    carried.append("_json")

    # Last, so that the steps before carry fewer columns.
    routing_error = (
        F.when(F.col("_malformed"), F.lit(None).cast("string"))
        .when(event_type_of(vendor).isNull(), _unsupported(payload, vendor))
        .when(F.col("_bad").isNotNull(), _routing_message(payload, F.col("_bad")))
    )
    rows = computed_once(
        rows,
        F.struct(
            event_type_of(vendor).alias("event_type"),
            F.upper(F.try_variant_get(payload, "$.s", "string")).alias("symbol"),
            routing_error.alias("_routing_error"),
        ),
        *carried,
    )

    failed = (
        F.when(F.col("_malformed"), JSON_DECODE_ERROR)
        .when(F.col("_routing_error").isNotNull(), ROUTING_ERROR)
        .when(F.col("_rule_errors") != "", VALIDATION_ERROR)
    )
    reason = (
        F.when(F.col("_malformed"), "message is not valid JSON")
        .when(F.col("_routing_error").isNotNull(), F.col("_routing_error"))
        .when(F.col("_rule_errors") != "", F.col("_rule_errors"))
    )
    topic = topic_of(F.col("event_type"), feed)
    return rows.select(
        *keep,
        "raw_payload",
        "raw_stream",
        "event_type",
        topic.alias("topic"),
        F.col("symbol").alias("key"),
        F.col("_json").alias("value"),
        headers(feed, F.col("event_type")).alias("headers"),
        "symbol",
        F.coalesce(topic, F.lit(UNKNOWN_TOPIC)).alias("source_topic"),
        failed.alias("error_type"),
        reason.alias("error_message"),
    )


def valid_events(normalized: DataFrame) -> DataFrame:
    """The messages that passed, ready for their own topic."""
    return normalized.where(F.col("error_type").isNull())


def invalid_events(normalized: DataFrame) -> DataFrame:
    """The messages that failed, with their reasons."""
    return normalized.where(F.col("error_type").isNotNull())
