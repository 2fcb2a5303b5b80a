from __future__ import annotations

import re

import pytest

from checks import inputs
from marketloom.functions.values import strict_json
from marketloom.operators import contracts
from marketloom.operators.deadletter import route
from marketloom.operators.normalize import normalize

#: Longest method, in bytes, that the JVM compiles.
JIT_LIMIT = 8000


#: Parameters of a method that the optimizing compiler took in a recorded run of the messages. It has
#: no sharp limit that is known: it refused 98, and some methods of 30 where their callers were as wide.
PARAMETER_LIMIT = 30


def most_parameters(spark, rows) -> int:
    """Parameters of the widest method that Spark generates for a plan."""
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    stages = debug.codegenStringSeq(rows._jdf.queryExecution().executedPlan())
    found = [
        parameters.count(",") + 1
        for i in range(stages.size())
        for parameters in re.findall(r"private void \w+_doConsume_\w+\(([^)]*)\)", stages.apply(i)._2())
    ]
    assert found
    return max(found)


def longest_method(spark, rows) -> int:
    """Bytes of the longest method that Spark generates for a plan."""
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    stages = debug.codegenStringSeq(rows._jdf.queryExecution().executedPlan())
    sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    assert sizes
    return max(sizes)


@pytest.fixture
def plain_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.fixture
def events(spark):
    rows = [(1, "2024-01-01 00:00:01.5", 7, "view", 2.5, '{"k": 3}')]
    frame = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string")
    return frame.withColumn("ts", frame["ts"].cast("timestamp"))


def test_messages_compile_to_methods_that_the_jit_takes(spark, plain_plans, events):
    messages = inputs.vendor_messages(events)
    assert longest_method(spark, messages) <= JIT_LIMIT
    routed = route(normalize(messages, keep=("event_id", "at")), keep=("event_id", "at"))
    assert longest_method(spark, routed) <= JIT_LIMIT


def test_messages_are_carried_in_few_columns(spark, plain_plans, events):
    messages = inputs.vendor_messages(events)
    routed = route(normalize(messages, keep=("event_id", "at")), keep=("event_id", "at"))
    assert most_parameters(spark, routed) <= PARAMETER_LIMIT


def test_only_one_json_value_is_a_document(spark):
    """An element after the value, or a fixed number of them, is never taken for the seal."""
    texts = ['{"a": 1}', "null", "5", '[1, 2]', "1, 2", '{"a": 1}, null', '{"a": 1} x', "", " ", "1,", '"a"']
    rows = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "i int, text string")
    found = rows.select("i", strict_json(rows["text"]).isNotNull().alias("whole"))
    assert sorted(r["i"] for r in found.collect() if r["whole"]) == [0, 1, 2, 3, 10]


def test_contract_rules_compile_to_methods_that_the_jit_takes(spark, plain_plans):
    feed = spark.createDataFrame([("{}", "trade_event_v1")], "value string, contract string")
    assert longest_method(spark, contracts.feed_report(feed)) <= JIT_LIMIT
