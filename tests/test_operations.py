"""Footers, state stores, supervision and statistics of stored tables."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from marketloom import config, schemas
from marketloom.config import Settings
from marketloom.plans import footers, serving
from marketloom.operators import windows
from marketloom.sources import sinks, tables
from marketloom.streaming import layers, state, supervision

START = datetime(2024, 5, 1, tzinfo=timezone.utc)


def summary_rows(spark, count=600):
    """Windows of two hours' distance over some fifty days."""
    end = F.timestamp_seconds(F.lit(int(START.timestamp())) + F.col("id") * 7200)
    rows = spark.range(count).select(
        F.concat(F.lit("S"), F.col("id") % 3).alias("symbol"), (end - F.expr("INTERVAL 5 MINUTES")).alias("window_start"),
        end.alias("window_end"), *[F.lit(1).cast("decimal(38,18)").alias(n) for n in ("total_volume",)],
        F.col("id").alias("number_of_trades"), F.lit(1).cast("decimal(38,22)").alias("average_trade_value"),
        F.lit(1).cast("decimal(38,18)").alias("max_trade_value"), F.lit(1).cast("decimal(38,18)").alias("min_trade_value"),
    )
    return rows.select(*schemas.TRADE_SUMMARY.names)


@pytest.fixture
def by_day(spark, tmp_path):
    path = str(tmp_path / config.GOLD_SUMMARY)
    summary_rows(spark).withColumn(footers.DAY, F.to_date("window_end")).write.partitionBy(footers.DAY).parquet(path)
    return path


@pytest.mark.parametrize("start", [
    None, START, START + timedelta(days=20, hours=3), START + timedelta(days=20), START + timedelta(days=900),
    datetime(2024, 5, 10, 1, 30, tzinfo=timezone(timedelta(hours=5, minutes=30))),
])
def test_health_from_footers_is_that_of_a_scan(spark, by_day, start):
    paths = {config.GOLD_SUMMARY: by_day, config.GOLD_SPIKES: by_day + "-not-there"}
    found = footers.stored_health(spark, paths, schemas.TABLE_SCHEMAS, start=start)
    scanned = tables.read_tables(spark, paths, schemas.TABLE_SCHEMAS)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, serving.table_health(scanned, start=start).collect()), key=str)


def test_counts_are_pushed_down_to_the_footers(spark, by_day):
    plan = footers.rows_by_day(spark, by_day, schemas.TRADE_SUMMARY)._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and f"PushedGroupBy: [{footers.DAY}]" in plan
    # Other frames still use the reader that they used before.
    assert "BatchScan" not in spark.read.parquet(by_day)._jdf.queryExecution().executedPlan().toString()


def test_tables_without_days_or_rows(spark, tmp_path):
    flat, empty = str(tmp_path / "flat"), str(tmp_path / "empty")
    summary_rows(spark, 30).write.parquet(flat)
    summary_rows(spark, 0).write.parquet(empty)
    every = {"flat": schemas.TRADE_SUMMARY, "empty": schemas.TRADE_SUMMARY}
    paths = {"flat": flat, "empty": empty}
    start = START + timedelta(hours=21)
    rows = {r.table: r for r in footers.stored_health(spark, paths, every, start=start).collect()}
    assert (rows["flat"].row_count, rows["flat"].total_row_count) == (30 - 11, 30)
    assert (rows["empty"].row_count, rows["empty"].total_row_count, rows["empty"].latest_time) == (0, 0, None)
    inventory = footers.stored_inventory(spark, {**paths, "none": empty + "-not"}, {**every, "none": schemas.SPIKES})
    assert [(r.table, r.table_exists, r.rows, r.columns) for r in inventory.collect()] == [
        ("empty", True, 0, 8), ("flat", True, 30, 8), ("none", False, 0, 0),
    ]


# --- state stores ------------------------------------------------------------------------


def trades_frame(spark, minutes):
    rows = [("AAA", START + timedelta(minutes=m), i) for i, m in enumerate(minutes)]
    frame = spark.createDataFrame(rows, "symbol STRING, event_time TIMESTAMP, trade_id BIGINT")
    one = F.lit(1).cast("decimal(38,18)")
    return frame.select("*", one.alias("price"), one.alias("quantity"), one.alias("trade_value"))


def test_state_of_windows_and_dedup_is_what_the_watermark_left(spark, tmp_path):
    source = str(tmp_path / "trades")
    trades_frame(spark, [0, 1, 30, 31, 44, 52, 60]).coalesce(1).write.parquet(source)
    schema = spark.read.parquet(source).schema
    rows = tables.stream_table(spark, source, schema)
    counted = windows.window_measures(rows, watermark_delay="10 minutes")
    checkpoint = str(tmp_path / "windows")
    for _ in range(2):  # a restart finds the same state
        sinks.append_stream(counted, str(tmp_path / "out"), checkpoint=checkpoint, name="w", available_now=True).awaitTermination()
        found = state.open_windows(spark, checkpoint).collect()
        assert {r.window_end.replace(tzinfo=timezone.utc) for r in found} <= {START + timedelta(minutes=m) for m in (55, 65)}
        assert len(found) == 2
    once = rows.withWatermark("event_time", "10 minutes").dropDuplicatesWithinWatermark(["symbol", "trade_id"])
    checkpoint = str(tmp_path / "dedup")
    sinks.append_stream(once, str(tmp_path / "once"), checkpoint=checkpoint, name="d", available_now=True).awaitTermination()
    assert sorted(r.trade_id for r in state.dedup_keys(spark, checkpoint).collect()) == [4, 5, 6]
    assert state.state_metadata(spark, checkpoint).first()["operatorName"] == "dedupeWithinWatermark"


# --- supervision -------------------------------------------------------------------------


def test_a_failing_query_ends_its_layer_and_leaves_its_error(spark, tmp_path):
    source, progress = str(tmp_path / "in"), str(tmp_path / "progress")
    spark.range(5).write.parquet(source)
    stream = spark.readStream.schema("id BIGINT").parquet(source)

    def start(session, settings):
        def query(rows, name):
            return sinks.append_stream(rows, str(tmp_path / name), checkpoint=str(tmp_path / f"{name}-c"), name=name)

        good = query(stream, "good_one")
        return [good, query(stream.select(F.raise_error(F.lit("broken on purpose")).alias("x")), "bad_one")]

    settings = Settings(checkpoint_path=str(tmp_path / "c"))
    with pytest.raises(StreamingQueryException, match="broken on purpose"):
        layers.run_layer(spark, settings, start, progress_path=progress)
    assert not [q for q in spark.streams.active if q.name in ("good_one", "bad_one")]
    rows = supervision.progress(spark, progress).collect()
    assert any(r["query"] == "bad_one" and "broken on purpose" in (r["error"] or "") for r in rows)


def test_progress_of_a_bounded_run(spark, tmp_path):
    source, progress = str(tmp_path / "in"), str(tmp_path / "progress")
    spark.range(7).write.parquet(source)
    stream = spark.readStream.schema("id BIGINT").parquet(source)

    def start(session, settings):
        return [sinks.append_stream(stream, str(tmp_path / "out"), checkpoint=str(tmp_path / "c"), name="all_rows", available_now=True)]

    settings = Settings(checkpoint_path=str(tmp_path / "k"), available_now=True)
    layers.run_layer(spark, settings, start, progress_path=progress)
    rows = supervision.progress(spark, progress).where("query = 'all_rows'")
    assert rows.agg(F.sum("input_rows"), F.count("error")).first() == (7, 0)


# --- statistics --------------------------------------------------------------------------


def test_registered_tables_have_a_size_and_chosen_statistics(spark, by_day, tmp_path):
    database = f"stat_{abs(hash(str(tmp_path)))}"
    name = config.GOLD_SUMMARY
    tables.register_tables(spark, database, {name: by_day}, statistics={name: ("symbol", "number_of_trades")})
    table = spark.table(f"{database}.{name}")
    on_disk = sum(f.stat().st_size for f in (tmp_path / name).rglob("*.parquet"))
    stats = table._jdf.queryExecution().optimizedPlan().stats()
    assert on_disk / 2 <= int(str(stats.sizeInBytes())) <= on_disk * 2
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {database}.{name}").collect()}
    assert facts["Statistics"].endswith("600 rows")
    described = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {database}.{name} symbol").collect()}
    assert described["distinct_count"] == "3"
    # A day that comes later is found by registering again.
    late = summary_rows(spark, 1).withColumn(footers.DAY, F.lit("2030-01-01").cast("date"))
    late.write.mode("append").partitionBy(footers.DAY).parquet(by_day)
    tables.register_tables(spark, database, {name: by_day})
    assert spark.table(f"{database}.{name}").count() == 601
