from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest

from marketloom.llm.exact_dedup import exact_dedup, without_copies

SCHEMA = "doc_id long, text string, keep_id string, range long"


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[normal(text)].append(doc_id)
    found = []
    for text, ids in groups.items():
        known = sorted((i for i in ids if i is not None))
        keep = known[0] if known else None
        for place, doc_id in enumerate(known + [None] * (len(ids) - len(known))):
            found.append((doc_id, keep, len(ids), place == 0, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(found, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 7) for i, t in rows], SCHEMA)


def verdict(spark, rows):
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted((tuple(r) for r in exact_dedup(frame(spark, rows)).select(*columns).collect()), key=str)


CASES = {
    "empty table": [],
    "one row": [(5, "a")],
    "nulls and white space": [(1, None), (2, ""), (3, "a  b"), (4, "a\t\nb"), (5, "a\xa0b"), (6, " "), (7, "\n")],
    "null ids": [(None, "a"), (3, "a"), (None, "b"), (None, "b")],
    "repeated rows": [(1, "a"), (1, "a"), (1, "b"), (2, "a")],
    "negative and extreme ids": [(-(2**63), "a"), (2**63 - 1, "a"), (-1, "b"), (0, "b")],
    "long texts with a common beginning": [(i, "x" * 50_000 + str(i % 3)) for i in range(12)],
}


@pytest.mark.parametrize("name", CASES)
def test_groups(spark, name):
    assert verdict(spark, CASES[name]) == expected(CASES[name])


def test_a_third_of_all_rows_is_one_text_and_crosses_ranges(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        rows = [(i * 37 % 3001, f"text {i}" if i % 3 else "the same") for i in range(900)]
        assert verdict(spark, rows) == expected(rows)
        everything_equal = [(i, "the same") for i in range(500)]
        assert verdict(spark, everything_equal) == expected(everything_equal)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_kept_rows_keep_their_columns(spark):
    rows = [(1, "a b"), (2, "a\tb"), (3, "c"), (3, "c"), (None, "d"), (4, None)]
    docs = frame(spark, rows)
    kept = without_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id, r.text, r.keep_id) for r in kept.collect()) == [
        (False, 1, "a b", "x"), (False, 3, "c", "x"), (False, 4, None, "x"), (True, None, "d", "x"),
    ]


def test_only_dataframe_functions_run(spark):
    plan = exact_dedup(frame(spark, [(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
