"""The commit log, its compaction, and the dedup that stands on it."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from marketloom import schemas
from marketloom.config import Settings
from marketloom.operators import refine
from marketloom.sources import commits
from marketloom.streaming import layers
from tests.builders import raw_records, trade_event

SCHEMA = StructType([StructField("k", StringType()), StructField("v", LongType()), StructField("day", DateType())])


def rows(spark, *values):
    frame = spark.createDataFrame(list(values), "k string, v long, day string")
    return frame.withColumn("day", F.col("day").cast("date"))


def values(spark, path):
    return sorted((r.k, r.v) for r in commits.read_committed(spark, path, SCHEMA).collect())


def append(spark, path, batch_id, frame, application="a/b"):
    return commits.append_committed(frame, batch_id, path, application=application, partition_by=("day",))


ONE, TWO, THREE = ("x", 1, "2024-01-01"), ("y", 2, "2024-01-02"), ("z", 3, "2024-01-02")


def test_a_writer_killed_before_its_commit_and_replays(spark, tmp_path):
    path = str(tmp_path)
    assert values(spark, path) == [] and commits.commits(spark, path).count() == 0
    commits.write_attempt(rows(spark, ONE, TWO), 0, path, "a/b", ("day",))  # killed here
    assert values(spark, path) == []
    assert append(spark, path, 0, rows(spark, ONE, TWO))
    assert not append(spark, path, 0, rows(spark, ONE, TWO))
    assert append(spark, path, 0, rows(spark, THREE), application="12")
    assert append(spark, path, 1, rows(spark))
    assert not append(spark, path, 1, rows(spark, THREE))
    assert values(spark, path) == [("x", 1), ("y", 2), ("z", 3)]


def test_a_commit_that_was_cut_off_does_not_count(spark, tmp_path):
    path = str(tmp_path)
    attempt = commits.write_attempt(rows(spark, ONE), 0, path, "a/b", ("day",))
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / f"{attempt}.json").write_text('{"application": "a/b", "first_ba')
    (tmp_path / "log" / "empty.json").write_text("")
    assert values(spark, path) == []
    assert append(spark, path, 0, rows(spark, ONE)) and values(spark, path) == [("x", 1)]


def test_two_commits_of_one_batch_count_once(spark, tmp_path):
    path = str(tmp_path)
    attempts = [commits.write_attempt(rows(spark, ONE), 0, path, "a", ("day",)) for _ in range(2)]
    for attempt in attempts:
        commits.commit(spark, path, "a", 0, attempt)
    assert values(spark, path) == [("x", 1)]
    assert [r.attempt for r in commits.commits(spark, path).collect()] == [min(attempts)]


def test_compaction_bounds_files_and_keeps_replays_out(spark, tmp_path):
    path = str(tmp_path)
    for i in range(12):
        append(spark, path, i, rows(spark, ("x", i, "2024-01-01"), ("y", i, "2024-01-02")))
    append(spark, path, 0, rows(spark, THREE), application="other")
    want = values(spark, path)
    commits.write_attempt(rows(spark, ONE), 11, path, "a/b", ("day",))  # a compaction killed before its commit
    assert values(spark, path) == want
    assert commits.compact(spark, path, SCHEMA, "a/b", ("day",)) == 11
    assert values(spark, path) == want and commits.commits(spark, path).count() == 2
    assert not append(spark, path, 5, rows(spark, ONE))
    assert commits.remove_replaced(spark, path, "a/b") == 13
    assert commits.remove_replaced(spark, path, "a/b") == 0
    assert values(spark, path) == want
    assert len(list(Path(path).glob("data/application=a*/**/*.parquet"))) == 2
    assert append(spark, path, 12, rows(spark, ("w", 9, "2024-01-01")))
    assert commits.compact(spark, path, SCHEMA, "a/b", ("day",)) == 12
    assert values(spark, path) == sorted([*want, ("w", 9)])
    assert not append(spark, path, 3, rows(spark, ONE))


def test_unseen_reads_only_the_days_in_reach(spark, tmp_path):
    path = str(tmp_path / "stored")
    stored = rows(spark, ("x", 1, "2024-01-01"), ("y", 2, "2024-01-05"), ("q", 4, "2024-01-04"))
    stored.write.partitionBy("day").parquet(path)
    stored = spark.read.schema(SCHEMA).parquet(path)
    batch = rows(spark, ("x", 7, "2024-01-02"), ("x", 8, "2024-01-01"), ("y", 9, "2024-01-02"), ("n", 5, "2024-01-01"), (None, 6, "2024-01-01"))
    found = refine.unseen(batch, stored, ["k"], ["v"], day="day")
    # The stored y is four days away: out of reach, so its day is not read.
    assert sorted((r.k or "", r.v) for r in found.collect()) == [("", 6), ("n", 5), ("y", 9)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "2023-12-31" in plan and "2024-01-03" in plan
    wide = refine.unseen(batch, stored, ["k"], ["v"], day="day", reach_days=4)
    assert sorted(r.k or "" for r in wide.collect()) == ["", "n"]
    assert refine.unseen(batch.limit(0), stored, ["k"], ["v"], day="day").count() == 0


@pytest.fixture
def settings(tmp_path):
    return Settings(
        bronze_path=f"{tmp_path}/bronze", silver_path=f"{tmp_path}/silver", gold_path=f"{tmp_path}/gold",
        checkpoint_path=f"{tmp_path}/checkpoints", bus_format="parquet", available_now=True,
    )


def test_late_trades_stay_and_late_copies_go(spark, tmp_path, settings, monkeypatch):
    def deliver(*trades):
        events = [trade_event(trade_id=i, event_time=at) for i, at in trades]
        raw_records(spark, "t", events).write.mode("append").parquet(f"{tmp_path}/raw")
        raw = spark.readStream.schema(schemas.RAW_RECORD).parquet(f"{tmp_path}/raw")
        monkeypatch.setattr(layers, "stream_raw", lambda *_: raw)
        layers.drain(layers.start_keyed_trades(spark, settings))
        return sorted(r.trade_id for r in layers.read_keyed_trades(spark, settings).collect())

    old, new, next_day = "2024-04-30T10:00:00Z", "2024-05-02T10:00:00Z", "2024-05-01T10:00:00Z"
    assert deliver((1, old), (2, new), (2, new)) == [1, 2]
    # Far behind any watermark: a new trade, a copy of the same day, and one a day late.
    assert deliver((3, old), (1, old), (1, next_day)) == [1, 2, 3]
    assert deliver((1, old), (4, new)) == [1, 2, 3, 4]
