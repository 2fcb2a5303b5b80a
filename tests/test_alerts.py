from __future__ import annotations

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketloom import schemas
from marketloom.operators import alerts, contracts
from tests.builders import at

START, END = at("2024-04-30T10:00:00"), at("2024-04-30T10:05:00")


def spikes(spark, ratio_type):
    rows = [
        ("NEARUSDT", START, END, Decimal(10), Decimal(4), Decimal("2.5"), "HIGH", 5),
        ("DOTUSDT", START, END, Decimal(16), Decimal(10), Decimal("1.6"), "MEDIUM", 5),
        ("ATOMUSDT", START, END, Decimal(3), Decimal(3), Decimal("1.0"), "LOW", 5),
    ]
    frame = spark.createDataFrame(rows, schemas.SPIKES)
    return frame.withColumn("volume_spike_ratio", F.col("volume_spike_ratio").cast(ratio_type))


@pytest.mark.parametrize("ratio_type", ["decimal(38,6)", "double"])
def test_volume_alerts(spark, ratio_type):
    messages = alerts.alert_messages(alerts.volume_alerts(spikes(spark, ratio_type)))
    by_key = {row.key: json.loads(row.value) for row in messages.collect()}
    assert set(by_key) == {"NEARUSDT", "DOTUSDT"}
    event = by_key["NEARUSDT"]
    assert list(event) == schemas.ALERT_EVENT.names
    assert (event["alert_type"], event["severity"], event["metric_value"]) == (
        "VOLUME_SPIKE", "HIGH", 2.5,
    )
    assert event["description"] == "NEARUSDT volume is 2.50x above recent baseline"
    assert event["window_start"] == "2024-04-30T10:00:00.000Z"
    assert contracts.contract_report(messages, contracts.ALERT_CONTRACT).count() == 0


@pytest.mark.parametrize("change_type", ["decimal(38,6)", "double"])
def test_price_alerts(spark, change_type):
    rows = [("NEARUSDT", START, END, Decimal(100), Decimal(98), Decimal("-2"), "PRICE_DROP", "HIGH")]
    frame = spark.createDataFrame(rows, schemas.PRICE_ALERTS)
    frame = frame.withColumn("price_change_pct", F.col("price_change_pct").cast(change_type))
    messages = alerts.alert_messages(alerts.price_move_alerts(frame))
    event = json.loads(messages.first().value)
    assert (event["alert_type"], event["metric_value"]) == ("PRICE_DROP", -2.0)
    assert event["description"] == "NEARUSDT moved -2.00% within the 5-minute window"
    assert contracts.contract_report(messages, contracts.ALERT_CONTRACT).count() == 0
