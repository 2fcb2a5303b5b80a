from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.llm import topk
from marketloom.llm.topk import best_of_block, top_k

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, k=5):
    whole = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    found = []
    seen = set()
    for i, v in whole:
        if i % 50 or (i, tuple(v)) in seen:
            continue
        seen.add((i, tuple(v)))
        scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in whole if j != i and len(w) == len(v)]
        found += [(i, rank, j, -s) for rank, (s, j) in enumerate(sorted(scored)[:k], 1)]
    return sorted(found)


def result(spark, rows):
    vectors = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in top_k(vectors, F.col("vec_id") % 50 == 0).collect())


def test_random_vectors_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 64)
    monkeypatch.setattr(topk, "QUERIES", 3)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 0.2, 40).tolist()) for i in range(600)]
    assert result(spark, rows) == brute(rows)


def test_nulls_ties_repeats_and_lengths(spark):
    random.seed(2)
    common = [0.5, -0.25, 0.125]
    rows = [(i, common) for i in range(120)]
    rows += [(200, None), (None, common), (250, [0.1, None, 0.2]), (300, [float("nan"), 0.0, 0.0])]
    rows += [(350, [float("inf"), 0.0, 0.0]), (400, [0.5, 0.5]), (401, [0.25, 1.0]), (450, []), (451, [])]
    rows += [(50, common), (501, [9.0, 9.0, 9.0]), (501, [9.0, 9.0, 9.0]), (-100, [-1.0, 2.0, 3.0])]
    assert result(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(50, [1.0])], [(1, [1.0]), (2, [2.0])]])
def test_few_rows(spark, rows):
    assert result(spark, rows) == brute(rows)


def test_large_components(spark):
    rows = [(i, [float(1 << 40) * (i + 1), -3.0e5]) for i in range(60)]
    got = result(spark, rows)
    for query in (0, 50):
        best = [v for q, _, v, score in got if q == query]
        assert sorted(best) == sorted([i for i in range(59, -1, -1) if i != query][:5])


def test_pruning_drops_candidates_and_stays_exact():
    rng = np.random.default_rng(3)
    vectors = (rng.normal(0, 1, (2000, 64)) * np.linspace(100, 1, 64)).astype(np.int64)
    ids = rng.permutation(2000)
    who, which, scores = best_of_block(ids[:20], vectors[:20], ids, vectors, 5)
    exact = vectors[:20] @ vectors.T
    for q in range(20):
        order = sorted((-exact[q, j], ids[j]) for j in range(2000) if ids[j] != ids[q])[:5]
        assert [(-s, v) for s, v in zip(scores[who == q], which[who == q], strict=True)] == order


def test_queries_are_not_broadcast_in_a_copy_for_each_block(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 64)
    monkeypatch.setattr(topk, "QUERIES", 2)
    monkeypatch.setattr(topk, "TOGETHER", 2)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 0.2, 8).tolist(), "x") for i in range(500)]
    best = top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "BroadcastExchange" not in plan and "Generate" not in plan
    assert sorted(tuple(r) for r in best.collect()) == brute([row[:2] for row in rows])
