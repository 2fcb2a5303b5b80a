"""What the physical plans must look like to hold at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  registers the queries
from checks.registry import QUERIES
from marketloom import schemas
from marketloom.operators import refine, windows
from marketloom.operators.normalize import normalize, valid_events
from marketloom.operators.spikes import history_for, volume_spikes
from marketloom.plans import serving
from tests.builders import at, messages, raw_records, trade_event, trade_message, trades


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def shuffles(text: str) -> int:
    return len(re.findall(r"Exchange (?:hash|range)partitioning", text))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "trades")
    trades(spark, ("2024-04-30T10:00:00", 1, "5", "1")).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("build", [windows.ohlc_bars, windows.window_measures])
def test_windows_are_one_hash_aggregate_over_one_shuffle(stored, build):
    text = plan(build(stored))
    assert "SortAggregate" not in text and text.count("HashAggregate") == 2
    assert shuffles(text) == 1


def test_a_table_reads_and_computes_only_its_measures(stored):
    text = plan(windows.trade_summary(windows.window_measures(stored)))
    assert "stddev" not in text and "min_by" not in text
    assert "price" not in re.search(r"ReadSchema: struct<(.*)>", text).group(1)


def test_baseline_has_no_join_and_bounded_groups(stored):
    text = plan(volume_spikes(windows.trade_summary(windows.window_measures(stored))))
    assert "Join" not in text
    assert re.search(r"Window \[.*\], \[symbol#\d+, slice#", text)
    # One for the windows, one for the slices.
    assert shuffles(text) == 2


def test_latest_rows_are_limited_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "watchlist")
    spark.createDataFrame([], schemas.WATCHLIST).write.parquet(path)
    rows = spark.read.parquet(path)
    text = plan(serving.market_snapshot(rows, start=at("2024-04-30T00:00:00")))
    assert text.count("WindowGroupLimit") == 2
    assert "GreaterThanOrEqual(last_updated_time" in text
    assert "TakeOrderedAndProject" in text


def test_histories_push_symbol_and_time_and_take_the_top(spark, tmp_path):
    path = str(tmp_path / "ohlc")
    spark.createDataFrame([], schemas.OHLC).write.parquet(path)
    text = plan(serving.ohlc_history(spark.read.parquet(path), "X", start=at("2024-04-30T00:00:00")))
    assert "EqualTo(symbol,X)" in text and "GreaterThanOrEqual(window_end" in text
    assert "TakeOrderedAndProject(limit=120" in text


def test_overview_and_health_need_no_join(spark):
    spikes = spark.createDataFrame([], schemas.SPIKES)
    rows = spark.createDataFrame([], schemas.WATCHLIST)
    text = plan(
        serving.overview(
            serving.market_snapshot(rows), spikes, spark.createDataFrame([], schemas.PRICE_ALERTS),
            serving.table_health({"s": spikes}), now=F.current_timestamp(),
        )
    )
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_payload_is_parsed_once(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw_records(spark, "t", [trade_event()]).write.parquet(path)
    text = plan(refine.refine_trades(spark.read.parquet(path), dedup=False))
    assert text.count("from_json(") == 1
    assert "ReadSchema: struct<topic:string,partition:int,offset:bigint,value:string>" in text


def test_duplicates_are_limited_before_the_shuffle(spark):
    text = plan(refine.refine_trades(raw_records(spark, "t", [trade_event()])))
    assert text.count("WindowGroupLimit") == 2 and shuffles(text) == 1


def test_messages_are_parsed_once_without_python_or_shuffle(spark):
    text = plan(valid_events(normalize(messages(spark, trade_message()))))
    assert text.count("VariantExpressionEvalUtils.parseJson") <= 1
    assert "Python" not in text and "Exchange" not in text


def test_history_of_spikes_is_pruned_by_day(spark, tmp_path):
    path = str(tmp_path / "summary")
    rows = windows.trade_summary(windows.window_measures(trades(spark, ("2024-04-30T10:00:00", 1, "5", "1"))))
    rows.withColumn("window_date", F.to_date("window_end")).write.partitionBy("window_date").parquet(path)
    text = plan(history_for(rows, spark.read.parquet(path), 30))
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters: \[(.*?)\]", text)
    assert "window_date" in filters.group(1) and "window_end" in filters.group(2)


def test_no_round_robin_exchange_in_the_checks(spark):
    for name in ("g1_ohlc_1min", "q4_market_snapshot", "t3_trades", "g6_volume_spikes"):
        assert "RoundRobin" not in plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
