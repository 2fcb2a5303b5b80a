"""The given tables as messages and deliveries: work that all cores share, deliveries that are one batch."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from checks import ingest, inputs, layers, streams

START = datetime(2024, 4, 30, 10)
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


@pytest.fixture
def sf_dir(spark, tmp_path):
    """A table of one file of one row group."""
    kinds = ("click", "view", "signup", "purchase")
    # Times run against the ids, so a delivery that is split over batches loses rows as late ones.
    rows = [
        (i, START + timedelta(minutes=400 - i), i % 7, kinds[i % 4], 5.25 + i, '{"k": %d}' % (20 + i % 30))
        for i in range(400)
    ]
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


@pytest.fixture
def kept(monkeypatch, tmp_path):
    """Folder in which a query keeps its work."""
    monkeypatch.setattr(inputs, "work_dir", lambda spark, label: f"{tmp_path}/{label}")
    return tmp_path


def trades_of(sf_dir, spark):
    return {(r.symbol, r.trade_id) for r in inputs.trades(spark, sf_dir).collect() if r.symbol in ("CLICK", "PURCHASE")}


@pytest.mark.parametrize("query", [streams.t6_dedup_late, streams.t6_dedup_stream])
def test_a_delivery_is_written_by_many_tasks_and_read_as_one_batch(spark, sf_dir, kept, query):
    found = [(r.symbol, r.trade_id) for r in query(spark, sf_dir).collect()]
    assert len(found) == len(set(found)) and set(found) == trades_of(sf_dir, spark)
    assert len(list((kept / "dedup" / "bus").glob("part-*.parquet"))) > 2
    # One captured batch per delivery.
    assert len([f for f in (kept / "dedup" / "checkpoints" / "bronze" / "all" / "offsets").iterdir() if f.name.isdigit()]) == 2


@pytest.mark.parametrize("rows", [
    inputs.bus_records, inputs.normalized, ingest.v9_faults_of_all_contracts,
    lambda spark, sf_dir: inputs.plain_events(inputs.table(spark, sf_dir, "events")),
])
def test_one_row_group_is_work_for_all_cores(spark, sf_dir, rows):
    plan = rows(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange RoundRobinPartitioning" in plan


def test_both_deliveries_come_from_one_pass(spark, sf_dir):
    rows = layers.t6_dedup_trades(spark, sf_dir)
    assert rows._jdf.queryExecution().executedPlan().toString().count("Scan parquet") == 1
    found = sorted((r.symbol, r.trade_id, r.bronze_offset) for r in rows.collect())
    assert found == sorted((symbol, n, n) for symbol, n in trades_of(sf_dir, spark))
