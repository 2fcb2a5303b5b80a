"""Rows of one id with different texts are documents of their own."""

from __future__ import annotations

import random

from marketloom.llm.chaining import repeated_passages, without_repeats
from marketloom.llm.identity import keyed
from marketloom.llm.simhash import one_of_each

SCHEMA = "doc_id long, text string, _row int"


def words(seed, count):
    chosen = random.Random(seed)
    return [f"w{chosen.randrange(5000)}" for _ in range(count)]


def test_keys(spark):
    rows = [(1, "a", 0), (2, "a", 1), (2, "b", 2), (2, "b", 3), (2, None, 4), (2, "", 5), (None, "a", 6), (None, "b", 7)]
    for last in (9, 2**63 - 1):
        docs = spark.createDataFrame([*rows, (last, "z", 8)], SCHEMA)
        found, others = keyed(docs)
        keys = {r["_row"]["_row"]: r["_key"] for r in found.collect()}
        assert len(keys) == 9 and keys[0] == 1 and keys[8] == last and keys[6] is keys[7] is None
        assert keys[2] == keys[3] and keys[4] == keys[5] and len({keys[1], keys[2], keys[4]}) == 3
        assert 2 in (keys[1], keys[2], keys[4])
        assert {r["_key"]: r["_id"] for r in others.collect()} == {k: 2 for k in (keys[1], keys[2], keys[4]) if k != 2}
    found, others = keyed(spark.createDataFrame([(1, "a", 0), (1, "a", 1), (2, "b", 2)], SCHEMA))
    assert others is None and sorted(r["_key"] for r in found.collect()) == [1, 1, 2]
    assert keyed(spark.createDataFrame([], SCHEMA))[1] is None


def test_an_unrelated_text_of_a_repeated_id_stays(spark):
    a, b = " ".join(words(1, 80)), " ".join(words(2, 80))
    docs = spark.createDataFrame([(1, a, 0), (2, a, 1), (2, b, 2), (None, a, 3)], SCHEMA)
    kept = sorted((r.doc_id or 0, r.text) for r in one_of_each(docs).collect())
    assert (1, a) in kept or (2, a) in kept
    assert (2, b) in kept and (0, a) in kept and len(kept) == 3


def test_a_passage_of_a_repeated_id_is_cut_from_its_own_text(spark):
    passage = " ".join(words(3, 60))
    texts = {n: " ".join(words(n, 100)) for n in (4, 5, 6)}
    first, second = f"{texts[4]} {passage}", f"{texts[5]} {passage}"
    docs = spark.createDataFrame([(1, first, 0), (2, second, 1), (2, texts[6], 2)], SCHEMA)
    spans = [(r.doc_id, r.other_id, r.n_words) for r in repeated_passages(docs).collect()]
    assert spans == [(2, 1, 60)]
    kept = {r["_row"]: (r.doc_id, r.text) for r in without_repeats(docs).collect()}
    assert kept == {0: (1, first), 1: (2, texts[5]), 2: (2, texts[6])}
    # Both texts of the repeated id have it: one of them keeps nothing of it.
    docs = spark.createDataFrame([(2, first, 0), (2, second, 1)], SCHEMA)
    kept = sorted(r.text for r in without_repeats(docs).collect())
    assert sum(passage in t for t in kept) == 1 and sorted(len(t.split()) for t in kept) == [100, 160]
