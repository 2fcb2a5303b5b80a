from __future__ import annotations

import json

from pyspark.sql import functions as F

from marketloom.operators import contracts, deadletter
from marketloom.operators.normalize import invalid_events, normalize
from tests.builders import messages, ticker_message, trade_message


def letters(spark, *texts):
    return deadletter.dead_letter_records(invalid_events(normalize(messages(spark, *texts))))


def test_letter_keeps_payload_and_context(spark):
    row = letters(spark, trade_message(p="0")).first()
    event = json.loads(row.value)
    assert row.topic == "market.events.invalid"
    assert row.key == event["source_topic"] == "market.trades.raw"
    assert json.loads(event["raw_payload"]) == trade_message(p="0")
    assert (event["error_type"], event["symbol"]) == ("VALIDATION_ERROR", "NEARUSDT")
    assert event["error_time"].endswith("Z")
    assert [h["key"] for h in row.headers][-1] == "error_type"
    assert bytes(row.headers[-1]["value"]) == b"VALIDATION_ERROR"


def test_unknown_topic_uses_error_type_as_key_and_omits_symbol(spark):
    row = letters(spark, "{nope").first()
    assert row.key == "JSON_DECODE_ERROR"
    assert "symbol" not in json.loads(row.value)


def test_letters_fulfil_their_contract(spark):
    rows = letters(spark, "{nope", trade_message(p="x"), '{"e": "z", "s": "ABCDE"}')
    assert contracts.contract_report(rows, contracts.INVALID_CONTRACT).count() == 0


def test_context_of_bad_messages(spark):
    cases = [
        ('{"data": {"e": "trade", "s": "abc"}}', "market.trades.raw", "ABC"),
        ('{"data": {"e": "kline"}}', "market.klines.raw", None),
        ('{"e": "24hrTicker", "s": "x"}', "market.tickers.raw", "X"),
        ('{"data": {"e": "other", "s": "x"}}', "unknown", "X"),
        ("{bad", "unknown", None),
        ("[]", "unknown", None),
    ]
    frame = messages(spark, *(case[0] for case in cases))
    found = deadletter.with_error_context(frame)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().replace("_", "").count("parsejson(") <= 1
    rows = found.orderBy("id").select("source_topic", "symbol")
    assert [tuple(row) for row in rows.collect()] == [case[1:] for case in cases]


def test_route_puts_every_message_on_one_topic(spark):
    routed = deadletter.route(normalize(messages(spark, trade_message(), "{", ticker_message())))
    assert sorted(row.topic for row in routed.collect()) == [
        "market.events.invalid", "market.tickers.raw", "market.trades.raw",
    ]


def test_metrics(spark):
    failed = invalid_events(normalize(messages(spark, "{", "{{", trade_message(p="0"))))
    rows = {(r.error_type, r.source_topic): r.messages for r in deadletter.dead_letter_metrics(failed).collect()}
    assert rows == {
        ("JSON_DECODE_ERROR", "unknown"): 2, ("VALIDATION_ERROR", "market.trades.raw"): 1,
    }
