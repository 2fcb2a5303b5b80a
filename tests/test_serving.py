from __future__ import annotations

from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketloom import schemas
from marketloom.functions import signals
from marketloom.plans import inspection, ranges, serving
from tests.builders import at

NOW = datetime(2024, 5, 3, 18, 0, tzinfo=timezone.utc)


def test_today_starts_at_local_midnight():
    assert ranges.range_start("today", NOW) == datetime(2024, 5, 2, 18, 30, tzinfo=timezone.utc)
    late = datetime(2024, 5, 3, 19, 0, tzinfo=timezone.utc)
    assert ranges.range_start("today", late) == datetime(2024, 5, 3, 18, 30, tzinfo=timezone.utc)


def test_relative_ranges():
    for key, days in (("last_week", 7), ("last_month", 30), ("last_year", 365)):
        assert ranges.range_start(key, NOW, "UTC") == NOW - timedelta(days=days)
    assert ranges.range_start("all", NOW) is None
    with pytest.raises(ValueError):
        ranges.range_start("decade", NOW)


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_column_form_agrees(spark, zone):
    moments = [NOW, datetime(2024, 3, 12, 3, 30, tzinfo=timezone.utc)]
    frame = spark.createDataFrame([(m,) for m in moments], "now TIMESTAMP")
    for key in ranges.RANGE_DAYS:
        got = frame.select(ranges.range_start_column(key, F.col("now"), zone)).collect()
        for moment, row in zip(moments, got):
            expected = ranges.range_start(key, moment, zone)
            assert row[0] == (expected and expected.replace(tzinfo=None))


def test_since_without_start_or_column(spark):
    frame = spark.range(3)
    assert ranges.since(frame, "window_end", NOW) is frame
    assert ranges.since(frame, "id", None) is frame


def watchlist(spark, *rows):
    full = [
        (symbol, Decimal(1), Decimal(change) if change is not None else None, Decimal(volume),
         level, "NONE", at(time))
        for symbol, change, volume, level, time in rows
    ]
    return spark.createDataFrame(full, schemas.WATCHLIST)


def spike_rows(spark, *rows):
    full = [
        (symbol, at(time) - timedelta(minutes=5), at(time), Decimal(1), Decimal(1), Decimal(ratio), strength, 1)
        for symbol, ratio, strength, time in rows
    ]
    return spark.createDataFrame(full, schemas.SPIKES)


def snapshot(spark, **options):
    return serving.market_snapshot(
        watchlist(
            spark,
            ("CALM", "0.02", "100", "LOW", "2024-05-03T10:05:00"),
            ("LOUD", "0.3", "300", "MEDIUM", "2024-05-03T10:05:00"),
            ("LOUD", "9", "1", "HIGH", "2024-05-03T10:00:00"),
            ("FALL", "-1.8", "250", "HIGH", "2024-05-03T10:05:00"),
        ),
        spike_rows(
            spark,
            ("CALM", "1.0", "LOW", "2024-05-03T10:05:00"),
            ("LOUD", "2.4", "HIGH", "2024-05-03T10:05:00"),
            ("LOUD", "1.0", "LOW", "2024-05-03T09:05:00"),
        ),
        **options,
    )


def test_snapshot_ranks_latest_rows_by_attention(spark):
    rows = snapshot(spark).collect()
    assert [r.symbol for r in rows] == ["LOUD", "FALL", "CALM"]
    assert [r.attention_reason for r in rows] == ["Volume spike", "Sharp price move", "Normal"]
    assert [r.market_direction for r in rows] == ["UP", "DOWN", "FLAT"]
    assert [r.attention_score for r in rows] == [
        pytest.approx(0.45 + 2.4 + 3 + 1), pytest.approx(2.7 + 2), pytest.approx(0.03 + 1),
    ]
    assert rows[1].volume_spike_ratio is None
    assert snapshot(spark, limit=1).count() == 1
    assert snapshot(spark, start=at("2024-05-03T11:00:00")).count() == 0


def test_snapshot_views(spark):
    rows = snapshot(spark)
    leaders = {r.signal: (r.symbol, r.value) for r in serving.signal_leaders(rows).collect()}
    assert leaders == {
        "Strongest volume spike": ("LOUD", 2.4), "Largest 5m price move": ("FALL", 1.8),
    }
    chart = serving.chart_input(rows, "volume_spike_ratio").collect()
    assert [r.symbol for r in chart] == ["LOUD", "CALM"]
    assert [r.symbol for r in serving.symbol_list(rows).collect()] == ["CALM", "FALL", "LOUD"]
    assert serving.symbol_state(rows, "FALL").count() == 1
    assert serving.signal_leaders(rows.limit(0)).count() == 0


def test_score_ignores_nan_and_null(spark):
    frame = spark.createDataFrame(
        [(float("nan"), None, None, None), (None, float("nan"), "MEDIUM", "HIGH")],
        "change DOUBLE, ratio DOUBLE, strength STRING, level STRING",
    )
    inputs = [F.col(name) for name in ("change", "ratio", "strength", "level")]
    rows = frame.select(
        signals.attention_score(*inputs).alias("score"),
        signals.attention_reason(*inputs).alias("reason"),
        signals.market_direction(F.col("change")).alias("direction"),
    ).collect()
    assert [tuple(r) for r in rows] == [(0.0, "Normal", "FLAT"), (3.5, "High volatility", "FLAT")]


def test_freshness(spark):
    ages = [(60,), (120,), (300,), (900,), (901,), (None,), (-5,)]
    frame = spark.createDataFrame(ages, "age INT")
    now = ranges.instant_literal(NOW)
    latest = F.timestamp_seconds(F.unix_seconds(now) - F.col("age"))
    labels = [r[0] for r in frame.select(signals.freshness(latest, now)).collect()]
    assert labels == ["FRESH", "FRESH", "LAGGING", "LAGGING", "STALE", "NO_DATA", "FRESH"]


def test_histories_are_newest_but_ascending(spark):
    rows = spike_rows(
        spark, *(("LOUD", str(i), "LOW", f"2024-05-03T10:{i:02d}:00") for i in range(1, 40))
    )
    got = serving.spike_history(rows, "LOUD", limit=3).collect()
    assert [int(r.volume_spike_ratio) for r in got] == [37, 38, 39]
    assert serving.spike_history(rows, "NONE").count() == 0


def test_newest_rows(spark):
    rows = spike_rows(
        spark,
        ("A", "1", "LOW", "2024-05-03T10:05:00"), ("B", "3", "HIGH", "2024-05-03T10:05:00"),
        ("C", "9", "HIGH", "2024-05-03T10:00:00"),
    )
    assert [r.symbol for r in serving.newest_spikes(rows, limit=2).collect()] == ["B", "A"]
    assert [r.symbol for r in inspection.newest_spike_rows(rows, 3).collect()] == ["B", "A", "C"]


def test_health_and_overview(spark):
    spikes = spike_rows(spark, ("LOUD", "2.4", "HIGH", "2024-05-03T10:05:00"), ("CALM", "1", "LOW", "2024-05-02T10:05:00"))
    tables = {"spikes": spikes, "missing": None}
    health = serving.table_health(tables, start=at("2024-05-03T00:00:00"))
    assert {r.table: (r.table_exists, r.row_count, r.total_row_count) for r in health.collect()} == {
        "spikes": (True, 1, 2), "missing": (False, 0, 0),
    }
    labelled = serving.with_freshness(health, ranges.instant_literal(at("2024-05-03T10:06:00")))
    assert {r.table: r.freshness for r in labelled.collect()} == {"spikes": "FRESH", "missing": "NO_DATA"}
    alerts = spark.createDataFrame([], schemas.PRICE_ALERTS)
    row = serving.overview(
        snapshot(spark), spikes, alerts, health, now=ranges.instant_literal(at("2024-05-03T12:00:00"))
    ).first()
    assert (row.symbols, row.high_volume_spikes, row.price_alerts) == (3, 1, 0)
    assert (row.strongest_spike, row.biggest_abs_move, row.freshness) == (2.4, 1.8, "STALE")


def test_published_alerts(spark):
    def record(offset, created, severity="HIGH"):
        value = (
            '{"schema_version":"1.0","symbol":"LOUD","alert_type":"VOLUME_SPIKE",'
            f'"severity":"{severity}","metric_value":2.5,"created_at":"{created}"}}'
        )
        return ("alerts", 0, offset, b"LOUD", value.encode(), at("2024-05-03T10:00:00"))

    frame = spark.createDataFrame(
        [
            record(1, "2024-05-01T00:00:00.000Z"), record(2, "2024-05-03T01:00:00.000Z", "LOW"),
            record(3, "2024-05-03T00:30:00.000Z"), ("alerts", 0, 4, None, b"junk", at("2024-05-03T11:00:00")),
        ],
        schemas.BUS_RECORD,
    )
    rows = serving.published_alerts(frame, start=at("2024-05-02T00:00:00"))
    assert [r.offset for r in rows.collect()] == [3, 2]
    assert [r.offset for r in serving.published_alerts(frame, limit=2).collect()] == [4, 3]
    totals = serving.alert_totals(rows).first()
    assert (totals.published_alerts, totals.symbols_alerted, totals.high_severity, totals.latest_alert) == (
        2, 1, 1, "2024-05-03T01:00:00.000Z",
    )
    assert serving.raw_messages(frame).count() == 4


def test_inventory_and_sample(spark):
    frame = spark.range(5)
    rows = inspection.table_inventory({"b": frame, "a": None}).collect()
    assert [(r.table, r.table_exists, r.rows, r.columns) for r in rows] == [
        ("a", False, 0, 0), ("b", True, 5, 1),
    ]
    assert [r.id for r in inspection.table_sample(frame, 2, "id").collect()] == [4, 3]
    assert inspection.table_sample(frame, 2, "other").count() == 2


def test_nothing_is_stored_yet(spark):
    missing = {"one": None, "two": None}
    health = serving.table_health(missing, start=NOW).collect()
    assert [(r.table, r.table_exists, r.row_count, r.latest_time) for r in health] == [
        ("one", False, 0, None), ("two", False, 0, None),
    ]
    inventory = inspection.table_inventory(missing).collect()
    assert [(r.table, r.table_exists, r.rows) for r in inventory] == [("one", False, 0), ("two", False, 0)]
