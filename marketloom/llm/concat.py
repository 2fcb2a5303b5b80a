"""Packing by concatenation: all token ids in one line, cut at fixed windows.

The first pass writes every document's ids with its place in its partition and so gives the
partitions' token totals. Prefix sums of the totals are the partitions' global offsets, and the
second pass cuts each document where a window ends. A piece is a boundary record: where it lies in
its document and where in its window.

Windows have ``capacity`` tokens. What is left at the end is cut into windows of falling powers of
two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.order import sums_before
from marketloom.llm.packing import library_ids
from marketloom.llm.work import stored

CAPACITY, SEPARATOR = 4096, 2
#: Documents or pieces of a batch that a task gives out, and ids of one.
ROWS, IDS = 2000, 1 << 20

TOKENS = "doc_id long, ids binary, doc_tokens long, part long, before long"
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def tokens(docs: DataFrame, path: str, separator: int = SEPARATOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every document and the separator, as little-endian unsigned integers of 16 bits where
    the vocabulary fits, else 32; ``before`` counts the ids before them in partition ``part``."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, part, before = library_ids(path), TaskContext.get().partitionId(), 0
        narrow = width_of(path) == 2
        end = separator.to_bytes(4, "little")
        for batch in rows:
            ids, counts, places = [], [], []
            for text in batch.column("text"):
                found = work.ids(text.as_py() or "") + end
                places.append(before)
                counts.append(len(found) // 4)
                before += counts[-1]
                ids.append(np.frombuffer(found, "<u2")[::2].tobytes() if narrow else found)
            same = pa.array(np.full(len(ids), part, np.int64))
            columns = [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(counts, pa.int64()), same, pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "doc_tokens", "part", "before"])

    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    return rows.mapInArrow(batches, TOKENS)


def width_of(path: str) -> int:
    """Bytes that an id of the tokenizer file is stored in."""
    return 2 if library_ids(path).library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def windows_of(start: int, count: int, total: int, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First global id, window number and place there of each piece of the ids ``start`` to ``start + count``."""
    full = total // capacity
    # Where the windows of the rest begin: its binary digits from the highest on.
    rest, edges = total - full * capacity, [full * capacity]
    for bit in reversed(range(rest.bit_length())):
        if rest >> bit & 1:
            edges.append(edges[-1] + (1 << bit))
    edges = np.array(edges[:-1] or [total], np.int64)
    first = np.arange(start // capacity, min(full, -(-(start + count) // capacity)), dtype=np.int64)
    tail = np.flatnonzero((edges < start + count) & (np.r_[edges[1:], total] > start))
    borders = np.concatenate([first * capacity, edges[tail]])
    begin = np.maximum(borders, start)
    return begin, np.concatenate([first, full + tail]), begin - borders


def cut(rows: DataFrame, total: int, width: int, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of ``rows`` with ``doc_id, ids, doc_tokens, at``, ``at`` the first id's global place."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            columns, held = [[] for _ in range(7)], 0
            for doc_id, ids, count, at in zip(
                batch.column("doc_id").to_pylist(), batch.column("ids"), batch.column("doc_tokens").to_pylist(),
                batch.column("at").to_pylist(), strict=True,
            ):
                words = np.frombuffer(ids.as_buffer(), f"<u{width}").astype("<u4")
                begin, number, place = windows_of(at, count, total, capacity)
                edges = [*(begin - at).tolist(), count]
                for low, high, window, offset in zip(edges, edges[1:], number.tolist(), place.tolist(), strict=False):
                    piece = (doc_id, low, high - low, words[low:high].tobytes(), count, window, offset)
                    for column, value in zip(columns, piece, strict=True):
                        column.append(value)
                    held += high - low
                    if held >= IDS or len(columns[0]) >= ROWS:
                        yield _batch(columns)
                        columns, held = [[] for _ in range(7)], 0
            if columns[0]:
                yield _batch(columns)

    return rows.select("doc_id", "ids", "doc_tokens", "at").mapInArrow(batches, PIECES)


def _batch(columns: list[list]) -> pa.RecordBatch:
    kinds = [pa.binary() if i == 3 else pa.int64() for i in range(7)]
    names = [name.split()[0] for name in PIECES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def concatenate_and_cut(
    docs: DataFrame, path: str, capacity: int = CAPACITY, separator: int = SEPARATOR, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """A row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit integers. Sequences are numbered from 0 and full but
    for the last ones, whose lengths are falling powers of two. Null and empty texts are the
    separator alone. Null and repeated ids are packed like any other row, in the order of the
    table; empty input gives no rows; other columns are not read. ``capacity`` is at least 1.
    """
    found = stored(tokens(docs, path, separator, id_col, text_col), "tokens")
    totals = stored(found.groupBy("part").agg(F.sum("doc_tokens").alias("tokens")), "token-totals")
    total = totals.agg(F.sum("tokens")).first()[0] or 0
    # A row per partition of the first pass; Spark broadcasts it below its own size limit.
    offsets = stored(sums_before(totals, "part", "tokens", "earlier").select("part", "earlier"), "token-offsets")
    placed = found.join(offsets, "part").withColumn("at", F.col("earlier") + F.col("before"))
    return cut(placed, total, width_of(path), capacity)
