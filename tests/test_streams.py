"""Streams against the batch form: late rows, duplicates, restarts, replays, a whole run."""

from __future__ import annotations

import dataclasses
import json
import os
import threading
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marketloom import config, schemas
from marketloom.config import Settings
from marketloom.operators import refine, windows
from marketloom.operators.deadletter import route
from marketloom.operators.normalize import normalize
from marketloom.operators.spikes import volume_spikes
from marketloom.sources import sinks, tables
from marketloom.sources.bus import Bus, read_topic
from marketloom.sources.sinks import without_batch
from marketloom.streaming import layers
from tests.builders import at, messages, raw_records, trade_event, trade_message, trades


@pytest.fixture
def settings(tmp_path):
    return Settings(
        bronze_path=f"{tmp_path}/bronze", silver_path=f"{tmp_path}/silver",
        gold_path=f"{tmp_path}/gold", checkpoint_path=f"{tmp_path}/checkpoints",
        bus_format="parquet", available_now=True,
    )


def add_files(folder: Path, *frames, first: int = 0) -> None:
    """One Parquet file per frame, in this order of modification time."""
    folder.mkdir(parents=True, exist_ok=True)
    for i, frame in enumerate(frames, start=first):
        staged = folder.parent / f"staged-{folder.name}-{i}"
        frame.coalesce(1).write.parquet(str(staged))
        target = folder / f"part-{i:03d}.parquet"
        os.link(next(staged.glob("part-*.parquet")), target)
        moment = time.time() - 10_000 + i * 10
        os.utime(target, (moment, moment))


def run(rows, root, name="q"):
    query = sinks.append_stream(
        rows, f"{root}/{name}", checkpoint=f"{root}/{name}-checkpoint", name=name, available_now=True
    )
    query.awaitTermination()
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{root}/{name}")


def stream(spark, folder, schema):
    return tables.stream_table(spark, str(folder), schema, max_files_per_trigger=1)


FLUSH = ("FLUSH", "2024-05-01T00:00:00", 10**6, "1", "1")


def test_stream_equals_batch_after_a_flush(spark, tmp_path):
    parts = [
        trades(spark, *(("2024-04-30T10:%02d:%02d" % divmod(s, 60), s, str(1 + s % 7), "2")
                        for s in range(start, start + 400, 9)))
        for start in (0, 400, 800)
    ]
    add_files(tmp_path / "in", *parts, trades(spark, FLUSH))
    batch = parts[0].unionByName(parts[1]).unionByName(parts[2])
    source = stream(spark, tmp_path / "in", batch.schema)
    for name, build in (("bars", windows.ohlc_bars), ("measures", windows.window_measures)):
        got = run(build(source, watermark_delay="10 minutes"), tmp_path, name)
        expected = build(batch).select(*got.columns)
        if name == "measures":  # partial deviations merge in another order
            got, expected = (
                rows.withColumn("price_stddev", F.round("price_stddev", 9)) for rows in (got, expected)
            )
        assert sorted(map(str, got.where("symbol <> 'FLUSH'").collect())) == sorted(
            map(str, expected.collect())
        )


def test_late_rows_update_open_windows_and_miss_closed_ones(spark, tmp_path):
    row = lambda minute, trade_id: (f"2024-04-30T{minute}", trade_id, "5", "1")
    add_files(
        tmp_path / "in",
        trades(spark, row("10:01:00", 1), row("10:14:00", 2)),
        trades(spark, row("10:06:00", 3)),  # late, but within ten minutes
        trades(spark, row("11:00:00", 4)),
        trades(spark, row("11:01:00", 5)),
        trades(spark, row("10:02:00", 6)),  # far too late
        trades(spark, FLUSH),
    )
    source = stream(spark, tmp_path / "in", trades(spark, FLUSH).schema)
    got = run(windows.window_measures(source, watermark_delay="10 minutes"), tmp_path)
    counts = {r.window_start.strftime("%H:%M"): r.number_of_trades
              for r in got.where("symbol <> 'FLUSH'").collect()}
    assert counts == {"10:00": 1, "10:05": 1, "10:10": 1, "11:00": 2}


def test_duplicates_across_batches_are_dropped(spark, tmp_path):
    first = [trade_event(trade_id=i) for i in range(5)]
    add_files(
        tmp_path / "in",
        raw_records(spark, "t", first),
        raw_records(spark, "t", [*first, trade_event(trade_id=9)]),
    )
    source = stream(spark, tmp_path / "in", schemas.RAW_RECORD)
    got = run(refine.refine_trades(source, watermark_delay="10 minutes"), tmp_path)
    assert sorted(r.trade_id for r in got.collect()) == [0, 1, 2, 3, 4, 9]
    with pytest.raises(ValueError):
        refine.refine_trades(source)
    assert refine.refine_trades(source, dedup=False).isStreaming


def test_restart_reads_only_what_is_new(spark, tmp_path):
    add_files(tmp_path / "in", raw_records(spark, "t", [trade_event(trade_id=1)]))
    for extra in (2, 3):
        source = stream(spark, tmp_path / "in", schemas.RAW_RECORD)
        got = run(refine.refine_trades(source, watermark_delay="10 minutes"), tmp_path)
        assert got.count() == extra - 1
        add_files(
            tmp_path / "in",
            raw_records(spark, "t", [trade_event(trade_id=1), trade_event(trade_id=extra)]),
            first=extra,
        )


def test_replayed_spike_batch_writes_nothing(spark, settings):
    rows = trades(spark, *(("2024-04-30T%02d:%02d:00" % divmod(m, 60), m, "5", str(1 + m % 11))
                           for m in range(0, 300, 5)))
    summary = windows.trade_summary(windows.window_measures(rows))
    summary.write.parquet(settings.gold(config.GOLD_SUMMARY))
    stored = spark.read.parquet(settings.gold(config.GOLD_SUMMARY))
    for _ in range(2):
        layers._write_spikes(stored, 0, settings)
    got = without_batch(spark.read.parquet(settings.gold(config.GOLD_SPIKES)))
    expected = volume_spikes(summary)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_whole_run_from_messages_to_alerts(spark, settings, tmp_path):
    texts = []
    for minute in range(0, 120):
        quantity = "50" if minute % 40 == 39 else "2"
        millis = int(at("2024-04-30T10:00:00").timestamp() * 1000) + minute * 60_000
        texts.append(trade_message(t=minute, E=millis, q=quantity, p=str(100 + minute % 3)))
    texts += ["{broken", trade_message(p="0"), texts[5]]
    routed = route(normalize(messages(spark, *texts), keep=("id",)), keep=("id",))
    routed.selectExpr(
        "topic", "id % 2 AS partition", "CAST(id AS BIGINT) AS offset", "CAST(key AS BINARY) AS key",
        "CAST(value AS BINARY) AS value", "timestamp_seconds(id) AS timestamp",
    ).write.parquet(f"{tmp_path}/bus")
    layers.run_layer(spark, settings, lambda s, c: layers.start_bronze(s, c, f"{tmp_path}/bus"))
    assert layers.read_raw(spark, settings, "market.events.invalid").count() == 2
    layers.run_layer(spark, settings, layers.start_silver)
    silver = spark.read.parquet(settings.silver(config.SILVER_TRADES))
    assert silver.count() == 120
    layers.run_layer(spark, settings, layers.start_trade_windows)
    layers.run_layer(spark, settings, layers.start_window_tables)
    layers.run_layer(spark, settings, layers.start_spikes)
    closed = windows.window_measures(silver).where("window_end <= '2024-04-30 11:49:00'")
    for table, cut in (
        (config.GOLD_SUMMARY, windows.trade_summary), (config.GOLD_VOLATILITY, windows.volatility),
        (config.GOLD_PRICE_ALERTS, windows.price_alerts), (config.GOLD_WATCHLIST, windows.watchlist),
        (config.GOLD_SPIKES, lambda m: volume_spikes(windows.trade_summary(m))),
    ):
        expected = cut(closed)
        got = tables.read_table_or_empty(spark, settings.gold(table), schemas.TABLE_SCHEMAS[table])
        got = got.select(*expected.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect())), table
    alert_bus = Bus(format="parquet", path=f"{tmp_path}/alerts")
    layers.run_layer(spark, settings, lambda s, c: layers.start_volume_alerts(s, c, alert_bus))
    strong = spark.read.parquet(settings.gold(config.GOLD_SPIKES)).where("signal_strength <> 'LOW'")
    published = read_topic(spark, alert_bus, settings.feed.alerts_topic)
    assert published.count() == strong.count() > 0
    assert json.loads(bytes(published.first().value))["alert_type"] == "VOLUME_SPIKE"


def test_repeated_alerts_can_be_dropped(spark, settings, tmp_path):
    rows = trades(spark, ("2024-04-30T10:00:00", 1, "5", "1"), ("2024-04-30T10:01:00", 2, "6", "1"))
    alert = windows.price_alerts(windows.window_measures(rows))
    folder = Path(settings.gold(config.GOLD_PRICE_ALERTS))
    add_files(folder, alert, alert)
    for name, within, expected in (("plain", None, 2), ("once", "1 day", 1)):
        own = dataclasses.replace(settings, checkpoint_path=f"{tmp_path}/{name}-checkpoints")
        target = Bus(format="parquet", path=f"{tmp_path}/{name}")
        layers.drain(layers.start_price_alerts(spark, own, target, within))
        assert read_topic(spark, target, own.feed.alerts_topic).count() == expected


def test_runner_stops_the_rest_when_one_query_ends(spark, settings, tmp_path):
    add_files(tmp_path / "in", trades(spark, FLUSH))
    live = dataclasses.replace(settings, available_now=False)
    started = []

    def start(session, _):
        source = tables.stream_table(session, f"{tmp_path}/in", trades(session, FLUSH).schema)
        for name in ("one", "two"):
            started.append(
                sinks.append_stream(
                    source, f"{tmp_path}/{name}", checkpoint=f"{tmp_path}/{name}-c", name=name
                )
            )
        threading.Timer(3, started[0].stop).start()
        return started

    spark.streams.resetTerminated()
    layers.run_layer(spark, live, start)
    assert [query.isActive for query in started] == [False, False]


def test_a_day_is_written_by_a_few_tasks_only(spark, settings):
    rows = trades(
        spark, *((f"2024-04-{day:02d}T10:{minute:02d}:00", 100 * day + minute, "1", "2")
                 for day in range(1, 6) for minute in range(60)), FLUSH
    )
    rows.write.parquet(settings.silver(config.SILVER_TRADES))
    few = dataclasses.replace(settings, files_per_day=1)
    layers.drain(layers.start_trade_windows(spark, few))
    layers.drain(layers.start_window_tables(spark, few))
    for table, per_day in ((config.GOLD_OHLC, 60), (config.GOLD_WINDOW_MEASURES, 12), (config.GOLD_SUMMARY, 12)):
        folder = Path(settings.gold(table))
        assert spark.read.parquet(str(folder)).count() == 5 * per_day
        days = [day for day in folder.glob("window_date=*") if day.name.startswith("window_date=2024-04")]
        assert len(days) == 5 and all(len(list(day.glob("*.parquet"))) == 1 for day in days)
