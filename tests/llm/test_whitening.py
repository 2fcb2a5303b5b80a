from __future__ import annotations

import math

import numpy as np
import pytest

from marketloom.llm.queries import QUERIES
from marketloom.llm.whitening import WIDE, eigen, whiten

SCHEMA = "vec_id long, embedding array<float>, x string, n int, component string"


def run(spark, rows, components=16):
    frame = spark.createDataFrame([(*row, "a", 1, "b") for row in rows], SCHEMA)
    return whiten(frame, components).collect()


def expected(rows, components=16):
    """Whitened values by the plain solver, with exact whole numbers; signs by the largest entry."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    vectors = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in good]
    fit = sorted({tuple(x) for _, x in vectors})
    n, sums = len(fit), [sum(column) for column in zip(*fit, strict=True)]
    centred = np.array([[n * a - s for a, s in zip(x, sums, strict=True)] for x in fit], float) / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1], basis[:, ::-1]
    basis = basis * np.where(basis[np.abs(basis).argmax(axis=0), np.arange(len(values))] < 0, -1, 1)
    found = []
    for i, x in vectors:
        wide = [n * a - s for a, s in zip(x, sums, strict=True)]
        for k in range(min(components, len(values))):
            if values[k] > 1e-9 * values[0]:
                whitened = float(np.array(wide, float) / n @ basis[:, k] / math.sqrt(values[k]))
                found.append((i, k + 1, n, sum(a * a for a in wide), whitened, float(values[k] / values.sum())))
    return found


def agree(rows, found, components=16):
    want = sorted(expected(rows, components), key=str)
    got = sorted((tuple(r)[:6] for r in found), key=str)
    assert [r[:4] for r in sorted(got, key=lambda r: (str(r[0]), r[1], r[4]))] == [
        r[:4] for r in sorted(want, key=lambda r: (str(r[0]), r[1], r[4]))
    ]
    for a, b in zip(sorted(got, key=lambda r: (str(r[0]), r[1], r[4])), sorted(want, key=lambda r: (str(r[0]), r[1], r[4])), strict=True):
        assert a[4:] == pytest.approx(b[4:], rel=1e-8, abs=1e-8)
    assert all(r["identity_error"] < 1e-9 for r in found)


def random_rows(count, dims, seed=1):
    rng = np.random.default_rng(seed)
    spread = np.linspace(0.2, 3, dims)
    return [(i, [float(np.float32(c)) for c in rng.normal(0, 1, dims) * spread]) for i in range(count)]


def test_equals_the_plain_solver(spark):
    rows = random_rows(300, 6)
    agree(rows, run(spark, rows))


def test_unusable_vectors_repeated_rows_and_null_ids(spark):
    rows = random_rows(60, 4)
    rows += [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [1.0, float("nan"), 0.0, 0.0])]
    rows += [(103, [float("inf"), 0.0, 0.0, 0.0]), (104, []), (None, rows[0][1]), rows[1], rows[1]]
    rows += [(i, rows[2][1]) for i in range(200, 260)]  # half of all rows are one vector
    found = run(spark, rows)
    agree(rows, found)
    assert {r["n"] for r in found} == {60}


def test_components_are_bounded(spark):
    rows = random_rows(100, 20)
    found = run(spark, rows)
    assert {r["component"] for r in found} == set(range(1, 17))
    assert {r["component"] for r in run(spark, rows, components=3)} == {1, 2, 3}


def test_empty_single_and_deficient_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == []
    assert run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []  # no variance, no component
    line = [(i, [float(i), 2.0 * i, 5.0]) for i in range(30)]
    assert {r["component"] for r in run(spark, line)} == {1}


def test_only_the_most_frequent_length_takes_part(spark):
    rows = random_rows(40, 3)
    assert {r["vec_id"] for r in run(spark, [*rows, (77, [1.0]), (78, [1.0, 2.0])])} == set(range(40))


def test_huge_entries_do_not_make_sums_inexact(spark):
    rows = random_rows(50, 3) + [(900, [1e30, 0.0, 0.0])]
    assert 900 not in {r["vec_id"] for r in run(spark, rows)}
    wide = [(i, [v * 1e6 for v in x]) for i, x in random_rows(50, 3)]
    for row in run(spark, wide):
        assert row["identity_error"] < 1e-9


def orthonormal(size, seed):
    rng = np.random.default_rng(seed)
    basis = np.linalg.qr(rng.normal(size=(size, size)))[0].astype(WIDE)
    for _ in range(4):  # to the last digit of the extended precision
        basis = basis @ (3 * np.eye(size, dtype=WIDE) - basis.T @ basis) / 2
    return basis


@pytest.mark.parametrize("values", [
    [9, 7, 5, 3, 2, 1, 0.5, 0.1],
    [1, 1 + 1e-10, 1 - 1e-10, 1 + 3e-10, 4, 4 + 1e-9, 9, 10],
    [2, 2, 2, 2, 1, 1, 5, 5],
    [1, 1e-6, 1e-9, 1e-12, 2, 3, 3 + 1e-7, 3 - 1e-7],
    [1] * 8,
])
def test_eigenvectors_of_clustered_values(values):
    basis = orthonormal(8, 5)
    matrix = basis @ np.diag(np.array(values, WIDE)) @ basis.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = eigen(matrix)
    order = np.argsort(-np.array(values), kind="stable")
    assert np.abs(found - np.array(values, WIDE)[order]).max() < 1e-16
    assert np.abs(vectors.T @ vectors - np.eye(8)).max() < 1e-17
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-16
    true = basis[:, order]
    for k in range(8):
        gap = min((abs(values[order[k]] - v) for i, v in enumerate(values) if i != order[k]), default=1)
        if gap > 0:  # the vector of an eigenvalue of its own
            assert abs(abs(float(true[:, k] @ vectors[:, k])) - 1) < 1e-12
            assert np.abs(true[:, k] * np.sign(true[:, k] @ vectors[:, k]) - vectors[:, k]).max() < 1e-17 / gap * 50


def test_query_over_the_whole_table(spark):
    rows = QUERIES["op12_whitening"](spark, "/root/testdata/sf0.001").collect()
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()
    agree([tuple(r) for r in table], rows)
