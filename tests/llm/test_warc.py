from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections import defaultdict
from pathlib import Path

import pytest

from marketloom.llm.warc import archived_pages, read_archives, records_of, write_archives

SCHEMA = "page_id long, url string, html string, refers_to string"
FIVE = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def expected(rows, least=0):
    groups = defaultdict(list)
    for page_id, _, html in rows:
        groups[html or ""].append(page_id)
    found = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        known = [i for i in groups[html or ""] if i is not None]
        newest = max(known) if known else None
        revisit = len(payload) >= least and newest is not None and page_id != newest
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        found.append((page_id, len(payload), digest, "revisit" if revisit else "response", newest if revisit else None))
    return sorted(found, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x") for row in rows], SCHEMA)


CASES = {
    "empty table": [],
    "nulls": [(None, None, None), (1, None, None), (2, "u", ""), (None, "v", "only"), (None, "w", "only")],
    "payloads that look like records": [
        (1, "http://a/", "a\r\n\r\nb"), (2, "http://a/\r\nX: y", "WARC/1.1\r\n\r\n"), (3, "u", "\r\n\r\n"), (4, "u", "\r\n\r\n"),
        (5, "é", "HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc"), (6, "", "\x00\x01"),
    ],
    "repeated rows": [(1, "a", "x"), (1, "a", "x"), (2, "a", "y"), (2, "a", "y"), (3, "a", "y")],
    "one payload has most rows": [(i, "u", "same" if i % 3 else f"own {i}") for i in range(400)],
    "long": [(1, "u", "ä" * 2_000_000), (2, "u", "ä" * 2_000_000)],
    "negative ids": [(-5, "u", "x"), (-7, "u", "x")],
}


@pytest.mark.parametrize("name", CASES)
def test_pages(spark, name):
    found = archived_pages(frame(spark, CASES[name])).select(*FIVE)
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected(CASES[name])


def test_small_payloads_are_all_responses(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]
    found = archived_pages(frame(spark, rows), least_bytes=3).select(*FIVE)
    assert sorted(tuple(r) for r in found.collect()) == expected(rows, 3)


def test_files_are_archives(spark, tmp_path):
    path = str(tmp_path / "warc")
    write_archives(frame(spark, [(1, "http://a/", "hello"), (2, "http://b/", "hello")]), path)
    records = {}
    for file in Path(path).glob("*.gz"):
        for headers, block in records_of(io.BytesIO(gzip.decompress(file.read_bytes()))):
            records[headers["warc-type"]] = headers, block
    response, revisit = records["response"], records["revisit"]
    assert response[1].endswith(b"\r\n\r\nhello") and revisit[1].endswith(b"\r\n\r\n")
    assert revisit[0]["warc-refers-to"] == response[0]["warc-record-id"]
    assert revisit[0]["warc-payload-digest"] == response[0]["warc-payload-digest"]
    assert int(response[0]["content-length"]) == len(response[1])


def test_a_changed_payload_raises(spark, tmp_path):
    path = tmp_path / "warc"
    write_archives(frame(spark, [(1, "u", "hello")]), str(path))
    file = next(x for x in path.glob("*.gz") if b"hello" in gzip.decompress(x.read_bytes()))
    changed = gzip.decompress(file.read_bytes()).replace(b"hello", b"jello")
    other = tmp_path / "changed"
    other.mkdir()
    (other / "part.gz").write_bytes(gzip.compress(changed))
    with pytest.raises(Exception, match="does not fit its digest"):
        read_archives(spark, str(other)).collect()
