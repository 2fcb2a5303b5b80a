from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from marketloom.llm.concat import concatenate_and_cut, windows_of
from marketloom.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
SCHEMA = "doc_id long, text string, ids string, part int, before long"


def expected_ids(text, separator):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, separator]


def check(rows, pieces, capacity, separator=2):
    """Every id in one piece, documents whole, sequences gapless, padding none."""
    documents, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4").tolist()
        assert len(ids) == p["length"] > 0
        documents[p["doc_id"]].append((p["start"], ids, p["doc_tokens"]))
        sequences[p["sequence_id"]].append((p["offset"], len(ids)))
    for doc_id, text in rows:
        want, at = expected_ids(text, separator), 0
        for start, ids, count in sorted(documents[doc_id]):
            assert (start, count) == (at, len(want)) and ids == want[at : at + len(ids)]
            at += len(ids)
        assert at == len(want)
    lengths = []
    for number in sorted(sequences):
        at = 0
        for offset, length in sorted(sequences[number]):
            assert offset == at
            at += length
        lengths.append(at)
    total = sum(len(expected_ids(text, separator)) for _, text in rows)
    assert sorted(sequences) == list(range(len(lengths)))
    full = total // capacity
    assert lengths[:full] == [capacity] * full
    rest = lengths[full:]
    assert sum(rest) == total % capacity and rest == sorted(set(rest), reverse=True)
    assert all(n & (n - 1) == 0 for n in rest)


def run(spark, rows, capacity, separator=2):
    frame = spark.createDataFrame([(*row, "x", 1, 2) for row in rows], SCHEMA)
    return concatenate_and_cut(frame.repartition(3), PATH, capacity, separator).collect()


CASES = {
    "one row": [(1, "a few words only")],
    "nulls, empty and white texts": [(1, None), (2, ""), (3, " \n\t"), (4, "word")],
    "equal texts": [(i, "the same text in many rows") for i in range(40)],
    "a very long text": [(1, "many words go on and on " * 6000), (2, "short")],
    "many texts": [(i, f"text number {i} " * (i % 17)) for i in range(200)],
}


@pytest.mark.parametrize("capacity", [1, 7, 64, 4096])
@pytest.mark.parametrize("name", CASES)
def test_pieces(spark, name, capacity):
    check(CASES[name], run(spark, CASES[name], capacity), capacity)


def test_empty_table_and_null_and_repeated_ids(spark):
    assert run(spark, [], 8) == []
    pieces = run(spark, [(None, "a b"), (None, "a b"), (3, "c"), (3, "c")], 4, separator=0)
    assert sum(p["length"] for p in pieces) == 10
    assert sorted((p["sequence_id"], p["offset"], p["length"]) for p in pieces)[-1][0] == 2


def test_windows_against_single_ids():
    rng = np.random.default_rng(3)
    for _ in range(300):
        capacity, total = int(rng.integers(1, 40)), int(rng.integers(1, 300))
        start = int(rng.integers(0, total))
        count = int(rng.integers(1, total - start + 1))
        edges = list(range(0, total // capacity * capacity + 1, capacity))
        for bit in reversed(range(10)):
            if total % capacity >> bit & 1:
                edges.append(edges[-1] + (1 << bit))
        begin, number, place = windows_of(start, count, total, capacity)
        window = [max(i for i, e in enumerate(edges) if e <= x) for x in range(start, start + count)]
        found = []
        for i, (b, n, p) in enumerate(zip(begin.tolist(), number.tolist(), place.tolist(), strict=True)):
            end = begin[i + 1] if i + 1 < len(begin) else start + count
            assert p == b - edges[n]
            found += [n] * int(end - b)
        assert found == window


def test_query_keeps_every_id(spark):
    rows = QUERIES["op11_concatenate_and_cut"](spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    pieces, places = defaultdict(list), defaultdict(int)
    for p in rows:
        pieces[p["doc_id"]].append(p)
        places[p["sequence_id"]] += p["length"]
    for doc in docs:
        ids = np.array(expected_ids(doc["text"], 2), "<u4")
        for p in pieces[doc["doc_id"]]:
            assert p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes())
        assert sum(p["length"] for p in pieces[doc["doc_id"]]) == len(ids)
    padded = [n for n in places.values() if n != 4096 and n & (n - 1)]
    assert not padded and len(rows) == len({(p["doc_id"], p["start"]) for p in rows})
