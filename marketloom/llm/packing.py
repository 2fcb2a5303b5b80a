"""Best-two-fit packing of tokenised documents into sequences.

A sequence is filled greedily with the longest piece that still fits. If room is left, its
smallest piece is put back and two unpacked pieces take the expanded gap when together they fit
it more tightly. Pieces are dealt evenly to groups that one task packs, so only the last
sequences of a group can be far from full; lengths are bounded by the capacity, so a group
works on counts per length and on bit masks of the lengths that are left.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marketloom.llm.bpe import KEPT_CHARS, SIMPLE, WORDS, Kept, letters_of, stretches_of
from marketloom.llm.work import stored

CAPACITY, SEPARATOR = 2048, 0
#: Pieces that one task packs.
GROUP = 50_000
#: Words and stretches whose ids a worker keeps.
ROOM = 500_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_WORDS = regex.compile(WORDS)


def _bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class LibraryIds:
    """Ids by the tokenizers library, as bytes, kept per stretch without white space.

    White space only separates for a tokenizer that drops it, so the ids of a text are those of
    its stretches one after another. Words of simple scripts are kept by their lower-case form.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.model = self.library.model
        self.words = Kept(self._word, ROOM)
        self.stretches = Kept(self._stretch, ROOM)

    def _encode(self, text: str) -> bytes:
        return _bytes(self.library.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        """Ids of a normalised pre-token: the library's model alone, without the steps before."""
        letters = word if word.isascii() and word.isprintable() else letters_of(word)
        return _bytes([token.id for token in self.model.tokenize(letters)])

    def _stretch(self, stretch: str) -> bytes:
        simple = stretch.isascii() or SIMPLE.fullmatch(stretch)
        if not simple or len(stretch) > KEPT_CHARS or any(x in stretch for x in self.special):
            return self._encode(stretch)
        return b"".join([self.words[word] for word in _WORDS.findall(stretch.lower())])

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a whole text."""
        return b"".join(map(self.stretches.__getitem__, stretches_of(text)))


@lru_cache(maxsize=2)
def library_ids(path: str) -> LibraryIds:
    """One per file and Python worker."""
    return LibraryIds(path)


def pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Each document's ids and a separator, cut only where longer than ``capacity``."""
    end = _bytes([SEPARATOR])

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = library_ids(path)
        for batch in rows:
            found = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = work.ids(text.as_py() or "") + end
                count = len(ids) // 4
                for piece, start in enumerate(range(0, count, capacity)):
                    length = min(capacity, count - start)
                    found.append((doc_id, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
            columns = list(zip(*found, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    return rows.mapInArrow(batches, PIECES)


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every piece; no length exceeds ``capacity``."""
    by_length = np.argsort(lengths, kind="stable")
    edges = np.searchsorted(lengths[by_length], np.arange(capacity + 2)).tolist()
    next_of, left = edges[:-1], [edges[n + 1] - edges[n] for n in range(capacity + 1)]
    order = by_length.tolist()
    below = [(1 << (gap + 1)) - 1 for gap in range(capacity + 1)]
    mask = sum(1 << n for n in range(capacity + 1) if left[n])
    mirror = sum(1 << (capacity - n) for n in range(capacity + 1) if left[n])
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    number = 0

    def take(n: int) -> None:
        nonlocal mask, mirror
        left[n] -= 1
        if not left[n]:
            mask &= ~(1 << n)
            mirror &= ~(1 << (capacity - n))

    def put_back(n: int) -> None:
        nonlocal mask, mirror
        left[n] += 1
        mask |= 1 << n
        mirror |= 1 << (capacity - n)

    while mask:
        gap, chosen = capacity, []
        while fitting := mask & below[gap]:
            n = fitting.bit_length() - 1
            take(n)
            chosen.append(n)
            gap -= n
        if gap and len(chosen) > 1 and mask:
            smallest = chosen[-1]
            if pair := _two_for(smallest, gap + smallest, mask, mirror, left, capacity):
                put_back(chosen.pop())
                for n in pair:
                    take(n)
                    chosen.append(n)
        at = 0
        for n in chosen:
            row = order[next_of[n]]
            next_of[n] += 1
            sequence[row], offset[row] = number, at
            at += n
        number += 1
    return sequence, offset


def _two_for(
    smallest: int, room: int, mask: int, mirror: int, left: list[int], capacity: int
) -> tuple[int, int] | None:
    """Two unpacked lengths with the largest sum up to ``room`` that is above ``smallest``."""
    for total in range(room, smallest, -1):
        # A bit n is set where both n and total - n are left.
        pairs = mask & (mirror >> (capacity - total)) & ((1 << (total // 2 + 1)) - 1)
        while pairs:
            a = pairs.bit_length() - 1
            if 2 * a != total or left[a] > 1:
                return total - a, a
            pairs &= ~(1 << a)
    return None


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``rows`` of pieces with ``sequence_id, offset``; ``rows`` must be a stored table."""
    groups = max(1, -(-rows.count() // GROUP))
    # By place in the table, not by key: no id or length can fill a group.
    dealt = rows.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def packed(part: pd.DataFrame) -> pd.DataFrame:
        sequence, offset = best_two_fit(part["length"].to_numpy(), capacity)
        number = (int(part["_group"].iat[0]) << 40) + sequence
        return part.drop(columns="_group").assign(sequence_id=number, offset=offset)

    return dealt.groupBy("_group").applyInPandas(packed, f"{PIECES}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """A row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Null texts are empty: one piece that is only the separator. Null and repeated ids are
    packed like any other row; empty input gives no rows; other columns are not read.
    """
    return pack(stored(pieces(docs, path, capacity, id_col, text_col), "pieces"), capacity)
