from __future__ import annotations

import json

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketloom.functions.values import product_text
from marketloom.operators.normalize import normalize, valid_events
from tests.builders import kline_message, messages, ticker_message, trade_message, without


def one(spark, message):
    return normalize(messages(spark, message), keep=("id",)).first()


def test_trade_goes_to_its_topic_with_exact_product(spark):
    row = one(spark, trade_message(p="0.001", q="100"))
    assert (row.topic, row.key, row.event_type) == ("market.trades.raw", "NEARUSDT", "trade")
    assert row.raw_stream == "nearusdt@trade"
    event = json.loads(row.value)
    assert event["trade_value"] == "0.100"
    assert event["event_time"] == "2024-04-30T10:05:30.123Z"
    assert event["trade_id"] == 77 and event["is_buyer_market_maker"] is False
    assert [(h["key"], bytes(h["value"])) for h in row.headers] == [
        ("source", b"binance"), ("schema_version", b"1.0"), ("event_type", b"trade"),
    ]


def test_kline_and_ticker(spark):
    kline = one(spark, kline_message())
    assert (kline.topic, kline.error_type) == ("market.klines.raw", None)
    bar = json.loads(kline.value)
    assert (bar["interval"], bar["open_price"], bar["number_of_trades"]) == ("1m", "6.90", 21)
    assert bar["kline_close_time"] == "2024-04-30T10:05:59.999Z"
    ticker = one(spark, ticker_message())
    event = json.loads(ticker.value)
    assert ticker.topic == "market.tickers.raw"
    assert (event["price_change"], event["trade_count"]) == ("-0.15", 310)


def test_envelope_is_optional_and_symbol_is_upper_case(spark):
    row = one(spark, {**trade_message()["data"], "s": "nearusdt"})
    assert (row.key, row.raw_stream, row.error_type) == ("NEARUSDT", None, None)


def test_bytes_are_decoded_with_replacement(spark):
    frame = messages(spark, trade_message()).select(
        "id", F.concat(F.encode("value", "UTF-8"), F.lit(b"\xff")).alias("value")
    )
    row = normalize(frame).first()
    assert row.error_type == "JSON_DECODE_ERROR"
    assert row.raw_payload.endswith("�")


ERRORS = [
    ("{oops", "JSON_DECODE_ERROR", "message is not valid JSON"),
    ('{"e": "trade"} {"e": "trade"}', "JSON_DECODE_ERROR", "message is not valid JSON"),
    ('{"e": "trade"}, 1', "JSON_DECODE_ERROR", "message is not valid JSON"),
    ('{"e": "trade"}]', "JSON_DECODE_ERROR", "message is not valid JSON"),
    ("1],[2", "JSON_DECODE_ERROR", "message is not valid JSON"),
    ("", "JSON_DECODE_ERROR", "message is not valid JSON"),
    ("[1, 2]", "ROUTING_ERROR", "Binance payload is not a JSON object"),
    ('{"data": null}', "ROUTING_ERROR", "Binance payload is not a JSON object"),
    ('{"x": 1}', "ROUTING_ERROR", "Unsupported Binance event type: None"),
    ('{"e": "depth"}', "ROUTING_ERROR", "Unsupported Binance event type: depth"),
    ({"data": without(trade_message()["data"], "q")}, "ROUTING_ERROR", "'q'"),
    (trade_message(p=None), "ROUTING_ERROR", "Invalid decimal value: None"),
    (trade_message(p="seven"), "ROUTING_ERROR", "Invalid decimal value: seven"),
    (trade_message(p="NaN"), "VALIDATION_ERROR", "price is not numeric"),
    (trade_message(t="x"), "ROUTING_ERROR", "invalid literal for int() with base 10: 'x'"),
    (trade_message(m="yes"), "ROUTING_ERROR", "value is not a JSON boolean"),
    (trade_message(E=10**17), "ROUTING_ERROR", f"timestamp out of range: {10**17}"),
    (trade_message(s=" "), "VALIDATION_ERROR", "symbol is missing"),
    (
        trade_message(p="0", q="-1"),
        "VALIDATION_ERROR",
        "price must be greater than zero; quantity must be greater than zero",
    ),
    (kline_message(v="-0.5"), "VALIDATION_ERROR", "volume must be greater than or equal to zero"),
    (kline_message({"k": 3}), "ROUTING_ERROR", "kline is not a JSON object"),
    ({"e": "kline", "s": "A", "E": 1}, "ROUTING_ERROR", "'k'"),
    (ticker_message(c="0"), "VALIDATION_ERROR", "last_price must be greater than zero"),
]


@pytest.fixture(scope="module")
def outcomes(spark):
    """All faulty messages through one job, by position."""
    rows = normalize(messages(spark, *(case[0] for case in ERRORS)), keep=("id",)).collect()
    return {row.id: (row.error_type, row.error_message) for row in rows}


@pytest.mark.parametrize("position", range(len(ERRORS)), ids=lambda i: ERRORS[i][2][:40])
def test_errors_and_their_precedence(outcomes, position):
    assert outcomes[position] == ERRORS[position][1:]


@pytest.mark.parametrize(
    "left, right, product",
    [
        ("0.001", "100", "0.100"), ("62500.12", "0.005", "312.50060"), ("3", "4", "12"),
        ("-1.5", "2", "-3.0"), ("0.00000001", "0.00000001", "0.0000000000000001"),
        ("123456789012.5", "3", "370370367037.5"), ("1e3", "2", "2000"), ("1e2", "1e-1", "10"),
        ("0.000000001", "0.5", "0.0000000005"), ("1e-5", "1e-3", "0.00000001"), ("0.1234567890", "1", "0.1234567890"),
        ("123456789012345678901", "2", "246913578024691357802"), ("0.00", "5", "0.00"), ("0e5", "1", "0"),
        ("-0", "1.0", "-0.0"), (" +1.50 ", ".5", "0.750"), ("5.", "2", "10"), ("1e-400", "1", None),
        ("99999999999999.99999", "99999999999999.99999", None), ("1e99999999999", "1", None), ("nan", "1", None),
    ],
)
def test_product_keeps_all_fraction_digits(spark, left, right, product):
    if left == "1e-400":
        product = "0." + "0" * 399 + "1"
    if left.startswith("99999"):
        product = format(Decimal(left) * Decimal(right), "f")
    row = spark.createDataFrame([(left, right)], "l STRING, r STRING")
    assert row.select(product_text(F.col("l"), F.col("r"))).first()[0] == product


def test_products_are_those_of_decimal_arithmetic(spark):
    random.seed(1)

    def number():
        digits = "".join(random.choices("0123456789", k=random.randint(1, 19)))
        point = random.randint(0, len(digits))
        return digits[:point] + "." + digits[point:] + random.choice(["", "", "e3", "E-7", "e+12"])

    def long_number():
        digits = "".join(random.choices("0123456789", k=random.randint(1, 90)))
        return random.choice(["", "-"]) + digits + "." + "".join(random.choices("0123456789", k=random.randint(0, 90)))

    rows = [(number(), number()) for _ in range(400)] + [(long_number(), random.choice([number, long_number])()) for _ in range(300)]
    rows += [("9" * 40, "9" * 40), ("5" * 29, "2"), ("0" * 50, "7" * 50), ("0." + "0" * 60, "7"), ("1" + "0" * 80, "1")]
    frame = spark.createDataFrame(rows, "l STRING, r STRING")
    found = frame.select("l", "r", product_text(F.col("l"), F.col("r")).alias("p")).collect()
    assert [(r.l, r.r, r.p) for r in found] == [(a, b, format(Decimal(a) * Decimal(b), "f")) for a, b in rows]


def test_a_product_that_cannot_be_written_is_an_error(spark):
    frame = messages(spark, trade_message(p="1e1000001", q="2"), trade_message(p="1e-400", q="1"), trade_message(p="1" * 30, q="2" * 12))
    rows = normalize(frame, keep=("id",)).orderBy("id").collect()
    assert rows[2].error_type is None
    assert (rows[0].error_type, rows[0].error_message) == ("VALIDATION_ERROR", "trade_value has too many digits")
    assert rows[1].error_type is None


def test_every_message_has_exactly_one_outcome(spark):
    frame = messages(spark, trade_message(), "{", kline_message(), '{"e":"x"}', ticker_message())
    rows = normalize(frame, keep=("id",))
    assert rows.count() == 5
    assert valid_events(rows).count() == 3
