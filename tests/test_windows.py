from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from marketloom import schemas
from marketloom.operators import windows
from marketloom.operators.spikes import volume_spikes
from tests.builders import trades


def test_bars_from_unordered_trades(spark):
    rows = trades(
        spark,
        ("2024-04-30T10:00:40", 3, "105", "1"),
        ("2024-04-30T10:00:05", 1, "100", "2"),
        ("2024-04-30T10:00:20", 2, "110", "3"),
        ("2024-04-30T10:01:00", 4, "90", "1"),
    )
    first, second = windows.ohlc_bars(rows).orderBy("window_start").collect()
    assert (first.open_price, first.high_price, first.low_price, first.close_price) == (
        100, 110, 100, 105,
    )
    assert (first.trade_count, first.total_quantity, first.total_trade_value) == (3, 6, 635)
    assert first.window_start == datetime(2024, 4, 30, 10, 0)
    assert first.window_end == second.window_start
    assert windows.ohlc_bars(rows).schema.names == schemas.OHLC.names


def test_trades_of_one_instant_are_ordered_by_id(spark):
    time = "2024-04-30T10:00:05.000001"
    rows = trades(spark, (time, 9, "9", "1"), (time, 2, "2", "1"), (time, 5, "5", "1"))
    row = windows.ohlc_bars(rows).first()
    assert (row.open_price, row.close_price) == (2, 9)


def test_time_beats_id_even_for_large_ids(spark):
    rows = trades(
        spark,
        ("2024-04-30T10:00:05.000002", 1, "2", "1"),
        ("2024-04-30T10:00:05.000001", 9_000_000_000_000_000_000, "1", "1"),
    )
    for width in ("1 minute", "5 minutes", "1 hour", "1 day", "4 weeks"):
        row = windows.ohlc_bars(rows, width=width).first()
        assert (row.open_price, row.close_price) == (1, 2)


def test_before_1970(spark):
    rows = trades(spark, ("1969-12-31T23:59:01", 1, "3", "1"), ("1969-12-31T23:59:59", 2, "4", "1"))
    row = windows.ohlc_bars(rows).first()
    assert (row.open_price, row.close_price) == (3, 4)


def sample(spark):
    return windows.window_measures(
        trades(
            spark,
            ("2024-04-30T10:00:00", 1, "100", "1"),
            ("2024-04-30T10:02:00", 2, "104", "2"),
            ("2024-04-30T10:04:59.999", 3, "102", "3"),
        )
    )


def test_summary(spark):
    row = windows.trade_summary(sample(spark)).first()
    assert (row.total_volume, row.number_of_trades) == (6, 3)
    assert round(row.average_trade_value, 2) == Decimal("204.67")
    assert (row.max_trade_value, row.min_trade_value) == (306, 100)
    assert windows.trade_summary(sample(spark)).schema.simpleString() == (
        schemas.TRADE_SUMMARY.simpleString()
    )


def test_volatility(spark):
    row = windows.volatility(sample(spark)).first()
    assert (row.avg_price, row.min_price, row.max_price) == (102, 100, 104)
    assert abs(row.price_stddev - (8 / 3) ** 0.5) < 1e-12
    assert (row.price_change_pct, row.volatility_level) == (2, "HIGH")


def test_alert_and_watchlist(spark):
    alert = windows.price_alerts(sample(spark)).first()
    assert (alert.start_price, alert.end_price, alert.alert_type, alert.severity) == (
        100, 102, "PRICE_SURGE", "HIGH",
    )
    row = windows.watchlist(sample(spark)).first()
    assert (row.latest_price, row.price_change_5m_pct, row.volume_5m) == (102, 2, 6)
    assert (row.volatility_level, row.latest_signal) == ("HIGH", "PRICE_SURGE")
    assert row.last_updated_time == datetime(2024, 4, 30, 10, 5)
    for build, schema in (
        (windows.volatility, schemas.VOLATILITY),
        (windows.price_alerts, schemas.PRICE_ALERTS),
        (windows.watchlist, schemas.WATCHLIST),
    ):
        assert build(sample(spark)).schema.simpleString() == schema.simpleString()


def test_small_moves_give_no_alert(spark):
    rows = trades(spark, ("2024-04-30T10:00:00", 1, "1000", "1"), ("2024-04-30T10:01:00", 2, "1014.9", "1"))
    measures = windows.window_measures(rows)
    assert windows.price_alerts(measures).count() == 0
    assert windows.watchlist(measures).first().latest_signal == "NONE"
    assert windows.volatility(measures).first().volatility_level == "MEDIUM"


def test_change_has_four_digits_and_thresholds_apply_to_it(spark):
    rows = trades(spark, ("2024-04-30T10:00:00", 1, "3", "1"), ("2024-04-30T10:01:00", 2, "3.1", "1"))
    row = windows.volatility(windows.window_measures(rows)).first()
    assert row.price_change_pct == Decimal("3.3333")


def test_measures_with_any_width_match_bars(spark):
    rows = spark.range(500).select(
        F.concat(F.lit("S"), F.col("id") % 3).alias("symbol"),
        F.timestamp_seconds(F.col("id") * 37).alias("event_time"),
        F.col("id").alias("trade_id"),
        (F.col("id") % 17 + 1).cast("decimal(38,18)").alias("price"),
        F.lit(1).cast("decimal(38,18)").alias("quantity"),
        F.lit(1).cast("decimal(38,18)").alias("trade_value"),
    )
    bars = windows.ohlc_bars(rows, width="10 minutes").select("symbol", "window_start", "open_price", "close_price")
    measures = windows.window_measures(rows, width="10 minutes").select(
        "symbol", "window_start", "start_price", "end_price"
    )
    assert sorted(map(tuple, bars.collect())) == sorted(map(tuple, measures.collect()))


def test_order_is_exact_for_any_ids_and_width(spark):
    time = "2024-04-30T10:00:05"
    for one, two in ((2, 17179869185), (2, 134217729), (-(2**63), 2**63 - 1), (-5, 4)):
        rows = trades(spark, (time, two, "99", "1"), (time, one, "10", "1"))
        for width in ("5 minutes", "1 day", "7 days"):
            row = windows.window_measures(rows, width=width).first()
            assert (row.start_price, row.end_price) == (10, 99)


def test_one_extreme_trade_does_not_end_the_job(spark):
    good = [("GOODUSDT", f"2024-04-30T10:{m:02d}:05", m, "100", "2") for m in (0, 4, 9, 14)]
    huge = [("BADUSDT", f"2024-04-30T10:00:0{i}", 50 + i, "1", "60000000000000000000") for i in (1, 2)]
    steep = [("BADUSDT", "2024-04-30T10:05:01", 60, "0.000000000000000001", "0.000000000000000001"),
             ("BADUSDT", "2024-04-30T10:05:02", 61, "1000000000000000", "1")]
    rows = trades(spark, *good, *huge, *steep).withColumn("trade_value", F.try_multiply("price", "quantity").try_cast("decimal(38,18)"))
    measures = windows.window_measures(rows)
    bad, fine = (measures.where(F.col("symbol") == s).orderBy("window_start").collect() for s in ("BADUSDT", "GOODUSDT"))
    assert bad[0].total_volume is None and bad[1].total_volume is not None
    assert [r.total_volume for r in fine] == [4, 2, 2]
    changes = {(r.symbol, r.window_start.minute): r.price_change_pct for r in windows.volatility(measures).collect()}
    assert changes["BADUSDT", 5] is None and changes["GOODUSDT", 0] == 0
    assert windows.ohlc_bars(rows).count() == len(windows.ohlc_bars(rows).collect())
    summary = windows.trade_summary(measures)
    assert {r.symbol for r in volume_spikes(summary).collect()} >= {"GOODUSDT"}
