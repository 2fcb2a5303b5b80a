from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from marketloom import schemas
from marketloom.operators.spikes import history_for, volume_spikes
from tests.builders import summary


def test_ratio_over_the_windows_before(spark):
    current = summary(spark, ("NEARUSDT", "2024-04-30T10:15:00", "2024-04-30T10:20:00", "10"))
    history = summary(
        spark,
        ("NEARUSDT", "2024-04-30T10:00:00", "2024-04-30T10:05:00", "3"),
        ("NEARUSDT", "2024-04-30T10:05:00", "2024-04-30T10:10:00", "2"),
        ("OTHER", "2024-04-30T10:05:00", "2024-04-30T10:10:00", "200"),
    )
    rows = volume_spikes(current, history)
    row = rows.first()
    assert (row.baseline_volume, row.volume_spike_ratio, row.signal_strength) == (
        Decimal("2.5"), Decimal("4"), "HIGH",
    )
    assert rows.count() == 1
    assert rows.schema.simpleString() == schemas.SPIKES.simpleString()


def test_no_baseline_no_row(spark):
    current = summary(spark, ("NEARUSDT", "2024-04-30T10:15:00", "2024-04-30T10:20:00", "10"))
    assert volume_spikes(current, spark.createDataFrame([], schemas.TRADE_SUMMARY)).count() == 0
    # The window that ends where this one starts does not count, one just too old neither.
    near = summary(
        spark,
        ("NEARUSDT", "2024-04-30T10:10:00", "2024-04-30T10:15:00", "5"),
        ("NEARUSDT", "2024-04-30T09:39:00", "2024-04-30T09:44:00", "5"),
    )
    assert volume_spikes(current, near).count() == 0
    edge = summary(spark, ("NEARUSDT", "2024-04-30T09:40:00", "2024-04-30T09:45:00", "5"))
    assert volume_spikes(current, edge).first().volume_spike_ratio == 2


def test_zero_baseline_gives_no_row(spark):
    rows = summary(
        spark,
        ("NEARUSDT", "2024-04-30T10:00:00", "2024-04-30T10:05:00", "0"),
        ("NEARUSDT", "2024-04-30T10:10:00", "2024-04-30T10:15:00", "5"),
    )
    assert volume_spikes(rows).count() == 0


@pytest.mark.parametrize("slice_length", ["1 hour", "3 hours", "1 day", "1 week"])
def test_equals_the_range_join_by_brute_force(spark, slice_length):
    """Random gaps, one symbol with most of the rows, slices shorter and longer than the data."""
    draw = random.Random(5)
    rows, start = [], datetime(2024, 4, 29, 20, 0)
    for symbol, share in (("HOT", 0.9), ("MID", 0.5), ("RARE", 0.1)):
        for i in range(250):
            if draw.random() < share:
                begin = start + timedelta(minutes=5 * i)
                rows.append((symbol, begin, begin + timedelta(minutes=5), draw.randint(1, 50)))
    frame = summary(spark, *((s, b.isoformat(), e.isoformat(), str(v)) for s, b, e, v in rows))
    expected = {}
    for symbol, begin, _, volume in rows:
        past = [
            v for s, _, e, v in rows
            if s == symbol and begin - timedelta(minutes=45) <= e < begin
        ]
        if past:
            expected[(symbol, begin)] = round(volume / (sum(past) / len(past)), 4)
    got = {
        (r.symbol, r.window_start): round(float(r.volume_spike_ratio), 4)
        for r in volume_spikes(frame, lookback_minutes=45, slice_length=slice_length).collect()
    }
    assert got == pytest.approx(expected, abs=2e-4)
    split = volume_spikes(frame, frame, lookback_minutes=45, slice_length=slice_length)
    assert split.count() == len(expected)


def test_history_is_bounded_by_the_batch(spark):
    table = summary(
        spark,
        *(
            ("NEARUSDT", f"2024-04-30T{h:02d}:00:00", f"2024-04-30T{h:02d}:05:00", "1")
            for h in range(12)
        ),
    )
    batch = table.where("hour(window_start) IN (6, 7)")
    kept = history_for(batch, table, 60).collect()
    assert [r.window_start.hour for r in sorted(kept)] == [5, 6]
    assert history_for(table.limit(0), table, 60).count() == 0
