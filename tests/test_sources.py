from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest

from marketloom import config, schemas
from marketloom.config import Settings
from marketloom.plans import inspection, serving
from marketloom.sources import bus, sinks, tables
from tests.builders import summary

ROW = ("NEARUSDT", "2024-04-30T10:00:00", "2024-04-30T10:05:00", "3")


def test_missing_table_is_none_or_empty(spark, tmp_path):
    path = str(tmp_path / "none")
    assert tables.read_table(spark, path) is None
    assert tables.read_table(spark, path, schemas.SPIKES) is None
    empty = tables.read_table_or_empty(spark, path, schemas.SPIKES)
    assert (empty.count(), empty.schema) == (0, schemas.SPIKES)


def test_bootstrap_writes_once(spark, tmp_path):
    path = str(tmp_path / "table")
    assert tables.ensure_table(spark, path, schemas.TRADE_SUMMARY)
    assert spark.read.parquet(path).schema.names == schemas.TRADE_SUMMARY.names
    summary(spark, ROW).write.mode("append").parquet(path)
    assert not tables.ensure_table(spark, path, schemas.TRADE_SUMMARY)
    assert spark.read.parquet(path).count() == 1


def test_batch_is_appended_once(spark, tmp_path):
    path = str(tmp_path / "out")
    frame = summary(spark, ROW)
    assert sinks.append_batch_once(frame, 0, path, application="a")
    assert not sinks.append_batch_once(frame, 0, path, application="a")
    assert sinks.append_batch_once(frame, 1, path, application="a")
    assert spark.read.parquet(path).count() == 2


def test_unfinished_batch_is_invisible_and_redone(spark, tmp_path):
    path = str(tmp_path / "out")
    frame = summary(spark, ROW)
    sinks.append_batch_once(frame, 0, path, application="a")
    frame.write.parquet(f"{path}/_pending_a_1")
    assert spark.read.parquet(path).count() == 1
    assert sinks.append_batch_once(frame, 1, path, application="a")
    assert spark.read.parquet(path).count() == 2


def test_two_applications_and_checkpoints_share_a_table(spark, tmp_path):
    path = str(tmp_path / "out")
    frame = summary(spark, ROW)
    one, two = (sinks.application_id("a", folder) for folder in ("/c/1", "/c/2"))
    assert one != two
    assert all(sinks.append_batch_once(frame, 0, path, application=x) for x in ("a", "b/c", one, two))
    assert not sinks.append_batch_once(frame, 0, path, application="b/c")
    rows = spark.read.parquet(path)
    assert sorted(r.application for r in rows.collect()) == sorted(["a", "b/c", one, two])
    assert sinks.without_batch(rows).columns == frame.columns


def test_a_bus_that_is_not_there_reads_as_empty(spark, tmp_path):
    rows = bus.read_topic(spark, bus.Bus(format="parquet", path=str(tmp_path / "none")), "topic")
    assert (rows.count(), rows.schema) == (0, schemas.BUS_RECORD)


@pytest.mark.parametrize("name", ["prquet", "kafka"])
def test_a_missing_data_source_is_an_error(spark, tmp_path, name):
    with pytest.raises(Exception, match="(?i)" + name):
        bus.read_topic(spark, bus.Bus(format=name, path=str(tmp_path)), "topic")


def test_a_bounded_read_filters_in_the_scan(spark, tmp_path):
    start = datetime(2024, 1, 2, tzinfo=timezone.utc)
    times = [start - timedelta(hours=1), start, start + timedelta(hours=1)]
    rows = [("t", 0, i, b"k", b"v", at) for i, at in enumerate(times)] + [("other", 0, 9, b"k", b"v", times[2])]
    columns = "topic string, partition int, offset long, key binary, value binary, timestamp timestamp"
    spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / "bus"))
    read = bus.read_topic(spark, bus.Bus(format="parquet", path=str(tmp_path / "bus")), "t", start)
    assert sorted(r.offset for r in read.collect()) == [1, 2]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp" in plan.split("PushedFilters")[1]


def test_kafka_options():
    source = bus.Bus(options={"kafka.bootstrap.servers": "h:1"}, max_offsets_per_trigger="5")
    assert bus.stream_options(source, ["a", "b"]) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "a,b", "startingOffsets": "latest",
        "failOnDataLoss": "false", "maxOffsetsPerTrigger": "5",
    }
    assert bus.read_options(source, "a") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "a", "startingOffsets": "earliest", "endingOffsets": "latest",
    }
    bounded = bus.read_options(source, "a", datetime(1970, 1, 2))
    assert bounded["startingTimestamp"] == "86400000" and "startingOffsets" not in bounded
    files = bus.Bus(format="parquet", max_files_per_trigger="2")
    assert bus.stream_options(files, ["a"]) == {"maxFilesPerTrigger": "2"}


def test_an_interval_trigger_runs(spark, tmp_path):
    path = str(tmp_path / "in")
    summary(spark, ROW).write.parquet(path)
    rows = tables.stream_table(spark, path, schemas.TRADE_SUMMARY)
    query = sinks.append_stream(
        rows, str(tmp_path / "out"), checkpoint=str(tmp_path / "checkpoint"), name="paced", interval="1 second"
    )
    try:
        for _ in range(60):
            if query.lastProgress and query.lastProgress["batchId"] >= 0 and tables.path_exists(spark, str(tmp_path / "out")):
                query.processAllAvailable()
                break
            query.awaitTermination(1)
        assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    finally:
        query.stop()


def test_registration_skips_missing_tables(spark, tmp_path):
    summary(spark, ROW).write.parquet(str(tmp_path / "one"))
    sinks.append_batch_once(summary(spark, ROW), 3, str(tmp_path / "two"), application="a")
    paths = {name: str(tmp_path / name) for name in ("one", "two", "three")}
    database = f"db_{abs(hash(str(tmp_path)))}"
    assert tables.register_tables(spark, database, paths) == ["one", "two"]
    assert tables.register_tables(spark, database, paths) == ["one", "two"]
    assert spark.table(f"{database}.one").count() == 1
    assert [r.batch_id for r in spark.table(f"{database}.two").collect()] == [3]


def test_health_and_inventory_of_stored_tables(spark, tmp_path):
    summary(spark, ROW).write.parquet(str(tmp_path / config.GOLD_SUMMARY))
    paths = {name: str(tmp_path / name) for name in (config.GOLD_SUMMARY, config.GOLD_SPIKES)}
    stored = tables.read_tables(spark, paths, schemas.TABLE_SCHEMAS)
    health = {r.table: r for r in serving.table_health(stored, paths=paths).collect()}
    assert health[config.GOLD_SUMMARY].total_row_count == 1
    assert not health[config.GOLD_SPIKES].table_exists
    assert health[config.GOLD_SPIKES].path == paths[config.GOLD_SPIKES]
    inventory = inspection.table_inventory(stored, paths).collect()
    assert [(r.table, r.rows, r.columns) for r in inventory] == [
        (config.GOLD_SUMMARY, 1, 8), (config.GOLD_SPIKES, 0, 0),
    ]


def test_settings_from_environment():
    settings = Settings.from_env(
        {
            "GOLD_PATH": "/data/gold/", "TOPIC_TRADES_RAW": "t", "GOLD_MAX_FILES_PER_TRIGGER": "4",
            "KAFKA_BOOTSTRAP_SERVERS": "host:1", "GOLD_VOLUME_BASELINE_LOOKBACK_MINUTES": "60",
        },
        layer="gold",
    )
    assert settings.gold(config.GOLD_OHLC) == "/data/gold/gold_symbol_1min_ohlc"
    assert settings.feed.topics[0] == "t"
    assert settings.bus_options == {"kafka.bootstrap.servers": "host:1"}
    assert (settings.max_files_per_trigger, settings.baseline_lookback_minutes) == ("4", 60)
    assert Settings.from_env({}).gold_watermark == "10 minutes"


def test_kafka_stream_is_configured_but_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        bus.stream_topics(spark, bus.Bus(max_offsets_per_trigger="5"), ["a", "b"])


def test_folders_have_no_default():
    with pytest.raises(ValueError, match="GOLD_PATH"):
        Settings.from_env({}).gold(config.GOLD_OHLC)
