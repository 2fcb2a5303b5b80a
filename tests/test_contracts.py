from __future__ import annotations

import json

import pytest

from marketloom.functions import jsonschema as contracts_schema
from marketloom.operators import contracts
from marketloom.operators.contracts import (
    KLINE_CONTRACT,
    TICKER_CONTRACT,
    TRADE_CONTRACT,
    contract_report,
    contract_violations,
)
from tests.builders import kline_event, messages, ticker_event, trade_event, without


def broken(spark, event, contract, **options):
    return contract_violations(messages(spark, event), contract, **options).first().violations


@pytest.mark.parametrize(
    "event, contract",
    [(trade_event(), TRADE_CONTRACT), (kline_event(), KLINE_CONTRACT), (ticker_event(), TICKER_CONTRACT)],
)
def test_good_events(spark, event, contract):
    assert broken(spark, event, contract, extra_rules=True) == []


BROKEN = [
    (without(trade_event(), "source"), "source: required"),
    (trade_event(price=7.25), "price: type"),
    (trade_event(price="07.25"), "price: pattern"),
    (trade_event(price="-7"), "price: pattern"),
    (trade_event(symbol="near"), "symbol: pattern"),
    (trade_event(schema_version="2.0"), "schema_version: const"),
    (trade_event(trade_id=-1), "trade_id: minimum"),
    (trade_event(trade_id="7"), "trade_id: type"),
    (trade_event(trade_id=7.5), "trade_id: type"),
    (trade_event(is_buyer_market_maker="no"), "is_buyer_market_maker: type"),
    (trade_event(event_time="30 April"), "event_time: format"),
    (trade_event(event_time="2024-01-01T00:00:01,5+05:30"), "event_time: format"),
    (trade_event(event_time="2024-01-01 00:00:01.5+05:30"), "event_time: format"),
    (trade_event(event_time="2024-01-01T00:00:01.5+0530"), "event_time: format"),
    (trade_event(event_time="2024-01-01T00:00Z"), "event_time: format"),
    (trade_event(event_time="2024-13-01T00:00:01Z"), "event_time: format"),
    (trade_event(extra=1), "trade_event_v1: additionalProperties"),
    ("[1]", "event: type"),
    ("{", "event: type"),
]


@pytest.fixture(scope="module")
def found(spark):
    """All broken events through one job, by position."""
    frame = messages(spark, *(case[0] for case in BROKEN))
    return {row.id: row.violations for row in contract_violations(frame, TRADE_CONTRACT).collect()}


@pytest.mark.parametrize("position", range(len(BROKEN)), ids=lambda i: BROKEN[i][1])
def test_one_broken_rule(found, position):
    assert found[position] == [BROKEN[position][1]]


def test_null_property_breaks_its_type(spark):
    assert broken(spark, trade_event(price=None), TRADE_CONTRACT) == ["price: type"]


def test_enum_and_optional_symbol(spark):
    letter = {
        "schema_version": "1.0", "source_topic": "elsewhere", "error_type": "ROUTING_ERROR",
        "error_message": "", "raw_payload": "x", "error_time": "2024-04-30T10:05:30Z",
    }
    assert broken(spark, letter, contracts.INVALID_CONTRACT) == [
        "source_topic: enum", "error_message: minLength",
    ]


def test_documented_rules_are_opt_in(spark):
    wrong = trade_event(trade_value="1")
    assert broken(spark, wrong, TRADE_CONTRACT) == []
    assert broken(spark, wrong, TRADE_CONTRACT, extra_rules=True) == [
        "trade_event_v1: trade_value equals price times quantity"
    ]
    crossed = kline_event(high_price="1", low_price="2")
    assert broken(spark, crossed, KLINE_CONTRACT, extra_rules=True) == [
        "kline_event_v1: high_price is not below low_price"
    ]


def test_report_counts_per_rule(spark):
    frame = messages(spark, trade_event(), trade_event(symbol="x"), trade_event(symbol="y", price="p"))
    rows = {row.rule: row.violations for row in contract_report(frame, TRADE_CONTRACT).collect()}
    assert rows == {"symbol: pattern": 2, "price: pattern": 1}


def test_symbol_list(spark):
    frame = spark.createDataFrame([("A",), ("B",), (None,)], "symbol STRING")
    assert contracts.unsupported_symbols(frame, ("A",)).count() == 2


# --- contracts as files ------------------------------------------------------------------


def read_nothing(file):
    raise FileNotFoundError(file)


def breaks(spark, document, *texts, read=read_nothing):
    """The broken rules of each text under a contract given as a document."""
    contract = contracts.contract_of("own", document, read)
    rows = contract_violations(messages(spark, *texts), contract).orderBy("id").collect()
    return [row.violations for row in rows]


KEYWORD_CASES = [
    ({"type": "integer"}, ["3", "3.0", "-1"], ["3.5", '"3"', "true", "null", "[]"], "type"),
    ({"type": ["string", "null"]}, ['"a"', "null"], ["1", "{}"], "type"),
    ({"const": 2}, ["2", "2.0"], ["3", '"2"', "null"], "const"),
    ({"const": None}, ["null"], ["0", '""'], "const"),
    ({"enum": ["a", 1, True]}, ['"a"', "1", "true"], ['"b"', "2", "false", '"1"'], "enum"),
    ({"minimum": 2}, ["2", "2.5", '"1"'], ["1", "-7"], "minimum"),
    ({"exclusiveMinimum": 2}, ["2.5"], ["2"], "exclusiveMinimum"),
    ({"maximum": 2}, ["2", '"9"'], ["2.5"], "maximum"),
    ({"exclusiveMaximum": 2}, ["1"], ["2"], "exclusiveMaximum"),
    ({"minLength": 2}, ['"ab"', "1"], ['"a"', '""'], "minLength"),
    ({"maxLength": 2}, ['"ab"', '"😀é"', "100"], ['"abc"'], "maxLength"),
    ({"pattern": "^[A-Z]+$"}, ['"AB"', "1"], ['"Ab"', r'"AB\n"', '""'], "pattern"),
    ({"pattern": "b"}, ['"abc"'], ['"xyz"'], "pattern"),
    ({"format": "date"}, ['"2024-02-29"', "1"], ['"2023-02-29"', '"2024-2-9"'], "format"),
    ({"format": "date-time"}, ['"2024-02-29T01:02:03Z"'], ['"2024-02-30T01:02:03Z"', '"2024-02-29"'], "format"),
]


@pytest.mark.parametrize("rules, good, bad, keyword", KEYWORD_CASES, ids=[f"{c[3]} {i}" for i, c in enumerate(KEYWORD_CASES)])
def test_a_keyword(spark, rules, good, bad, keyword):
    document = {"type": "object", "properties": {"x": {"description": "no rule", **rules}}}
    texts = [f'{{"x":{value}}}' for value in [*good, *bad]]
    assert breaks(spark, document, *texts) == [[]] * len(good) + [[f"x: {keyword}"]] * len(bad)


def test_nested_objects_and_references(spark):
    shared = {"$defs": {"name": {"type": "string", "minLength": 1}, "loop": {"$ref": "#/$defs/loop"}}}
    document = {
        "type": "object", "required": ["who"], "properties": {
            "who": {
                "type": "object", "additionalProperties": False, "required": ["first name"],
                "properties": {"first name": {"$ref": "common.json#/$defs/name"}, "age": {"$ref": "#/$defs/age"}},
            },
        },
        "$defs": {"age": {"type": "integer", "minimum": 0}},
    }
    texts = [
        '{"who":{"first name":"A","age":3},"more":1}', '{"who":{"first name":"","age":-1}}', '{"who":{"age":1,"x":2}}',
        '{"who":7}', "{}",
    ]
    found = breaks(spark, document, *texts, read={"common.json": shared}.__getitem__)
    assert found == [
        [], ["who.first name: minLength", "who.age: minimum"],
        ["who.first name: required", "own.who: additionalProperties"], ["who: type"], ["who: required"],
    ]
    circle = {"type": "object", "properties": {"x": {"$ref": "#/$defs/loop"}}, **shared}
    with pytest.raises(contracts_schema.UnknownKeyword):
        contracts.contract_of("own", circle)


@pytest.mark.parametrize("document", [
    {"type": "object", "properties": {"x": {"multipleOf": 2}}},
    {"type": "object", "properties": {"x": {"type": "text"}}},
    {"type": "object", "properties": {"x": {"format": "email"}}},
    {"type": "object", "properties": {"x": {"const": [1]}}},
    {"type": "object", "properties": {"x": {"enum": [{}]}}},
    {"type": "object", "oneOf": []},
    {"type": "array"},
    {"type": "object", "required": ["y"], "properties": {}},
    {"type": "object", "additionalProperties": {"type": "string"}},
])
def test_what_is_not_checked_raises(document):
    with pytest.raises(contracts_schema.UnknownKeyword):
        contracts.contract_of("own", document)


def test_a_contract_file_of_ones_own(spark, tmp_path):
    (tmp_path / "shared.json").write_text(json.dumps({"$defs": {"id": {"type": "integer"}}}))
    document = {"type": "object", "required": ["id"], "properties": {"id": {"$ref": "shared.json#/$defs/id"}}}
    (tmp_path / "order_v1.json").write_text(json.dumps(document))
    contract = contracts.read_contract(spark, f"{tmp_path}/order_v1.json")
    assert contract.name == "order_v1"
    rows = contract_report(messages(spark, '{"id":1}', '{"id":"1"}', "{}"), contract).collect()
    assert {(r.contract, r.rule, r.violations) for r in rows} == {("order_v1", "id: type", 1), ("order_v1", "id: required", 1)}


def test_a_mixed_feed_picks_the_contract_by_row(spark):
    feed = spark.createDataFrame([
        ("trade_event_v1", json.dumps(trade_event(symbol="x"))), ("kline_event_v1", json.dumps(kline_event())),
        ("ticker_event_v1", json.dumps(ticker_event(trade_count=-1))), ("kline_event_v1", "[]"),
        ("another", json.dumps(trade_event())), (None, "{}"), ("trade_event_v1", None),
    ], "contract STRING, value STRING")
    rows = contracts.feed_report(feed).collect()
    assert {(r.contract, r.rule): r.violations for r in rows} == {
        ("trade_event_v1", "symbol: pattern"): 1, ("ticker_event_v1", "trade_count: minimum"): 1,
        ("kline_event_v1", "event: type"): 1, ("another", "event: contract"): 1, (None, "event: contract"): 1,
        ("trade_event_v1", "event: type"): 1,
    }


def test_the_feed_is_parsed_once(spark):
    feed = spark.createDataFrame([("trade_event_v1", "{}")], "contract STRING, value STRING")
    plan = contracts.feed_report(feed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1 and "Join" not in plan and "Union" not in plan
