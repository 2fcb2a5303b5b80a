from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from marketloom.llm.bpe import Decoder, Encoder, MergeList, Transducer, encode_digests
from marketloom.llm.packing import LibraryIds, best_two_fit, pack_documents
from marketloom.llm.queries import WORD_BPE

FIXED = [
    None, "", " \n", "a", "Hello, World's  123 ÀÉß İ ı ſ K", "日本語 한국어 العربية", "é ́a Å", "Σσς ΣΑΣ",
    "<|endoftext|>", "x<|startoftext|>Y <|ENDOFTEXT|> <|endoftext|><|endoftext|>", "a\x1cb \x1d\x1e\x1f \x85\xa0 z",
    "\x00\x7f﻿​", "'s 't I'll we'd 'S", "a" * 3000, "ab" * 2000, "!?" * 900, "the " * 30_000, "word" * 20_000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_BPE)


@pytest.fixture(scope="module")
def encoder():
    return Encoder(WORD_BPE)


def samples():
    random.seed(2)
    alphabets = ["ab", "aeiounrst", "abcdefghijklmnopqrstuvwxyz", "aAéÉß İıſ ", "が日本 é x", "0123 '\"", "'stremvld ", "Σσ ́a<|"]
    for _ in range(400):
        yield "".join(random.choices(random.choice(alphabets), k=random.choice([1, 3, 10, 40, 300])))


def test_ids_and_digests_are_the_librarys(library, encoder):
    kept = LibraryIds(WORD_BPE)
    for text in [*(t or "" for t in FIXED), *samples()]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == ids
        assert np.frombuffer(kept.ids(text), "<u4").tolist() == ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert encoder.digests(text) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        )


def test_transducer_emits_early_and_keeps_a_bounded_state(library, encoder):
    random.seed(4)
    merges = encoder.merges
    for alphabet in ("a", "ab", "abcdefghijklmnopqrstuvwxyz", "theinger"):
        word = "".join(random.choices(alphabet, k=1500))
        transducer, ids, held = Transducer(merges), [], 0
        for letter in word[:-1]:
            ids += transducer.feed(letter)
            held = max(held, len(transducer.tail))
        assert ids and held <= transducer.room
        ids += transducer.finish(word[-1])
        assert ids == library.encode(word, add_special_tokens=False).ids


def test_decoder_gives_out_whole_characters(encoder):
    names = {0: "Ã", 1: "©x", 2: "Ġ"}
    decoder = Decoder(names, "ByteLevel")
    assert [decoder.push(i) for i in (0, 1, 2)] == ["", "éx", " "]
    decoder = Decoder(names, "ByteLevel")
    assert decoder.push(0) + decoder.finish() == "�"
    decoder = Decoder(names, None)
    assert [decoder.push(i) for i in (2, 0)] == ["Ġ", " Ã"]


def test_table(spark, library):
    rows = [(i, t, "x") for i, t in enumerate(FIXED)] + [(None, "a b", "y"), (3, "a", "z"), (3, "a", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    want = [(i, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows]
    found = encode_digests(docs, WORD_BPE)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(((r.doc_id, r.n_tokens) for r in found.collect()), key=str) == sorted(want, key=str)
    assert encode_digests(docs.limit(0), WORD_BPE).count() == 0


def check_packing(rows, sequences, offsets, lengths, capacity):
    by = defaultdict(list)
    for s, o, n in zip(sequences, offsets, lengths, strict=True):
        by[s].append((o, n))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("seed", range(6))
def test_packing_is_gapless_and_tight(seed):
    random.seed(seed)
    capacity = random.choice([10, 64, 2048])
    most = random.choice([capacity, capacity // 2, capacity // 3])
    lengths = np.array([random.randint(1, most) for _ in range(3000)])
    sequence, offset = best_two_fit(lengths, capacity)
    count = check_packing(None, sequence.tolist(), offset.tolist(), lengths.tolist(), capacity)
    halves = sum(2 * n > capacity for n in lengths.tolist())
    assert count <= 1.02 * max(-(-int(lengths.sum()) // capacity), halves) + 1


def test_two_pieces_take_the_place_of_the_smallest():
    # Greedily 6 + 3 leaves one free; 2 + 2 in place of the 3 fill the sequence.
    lengths = np.array([6, 3, 2, 2])
    sequence, _ = best_two_fit(lengths, 10)
    assert sequence[0] == sequence[2] == sequence[3] != sequence[1]
    assert best_two_fit(np.array([], int), 10)[0].size == 0
    assert best_two_fit(np.array([10, 10, 1]), 10)[0].tolist() == [0, 1, 2]


def test_packed_documents(spark, library):
    rows = [(i, t, "x") for i, t in enumerate(FIXED)] + [(None, "a b", "y"), (3, "a", "z"), (3, "a", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string")
    found = pack_documents(docs, WORD_BPE).collect()
    want = []
    for doc_id, text, _ in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            want.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found), key=str) == sorted(want, key=str)
    count = check_packing(None, *zip(*((r.sequence_id, r.offset, r.length) for r in found), strict=True), 2048)
    assert count <= -(-sum(r.length for r in found) // 2048) + 1
    assert pack_documents(docs.limit(0), WORD_BPE).count() == 0


def naive(word, ranks):
    """Merges of the lowest rank first, the leftmost of equal ones."""
    parts = [*word[:-1], word[-1] + "</w>"]
    while True:
        found = min(((ranks.get(pair, 10**9), i) for i, pair in enumerate(zip(parts, parts[1:], strict=False))), default=(10**9, 0))
        if found[0] == 10**9:
            return parts
        parts[found[1] : found[1] + 2] = ["".join(parts[found[1] : found[1] + 2])]


@pytest.mark.parametrize("size", [5, 26])
def test_lookahead_over_chains_of_falling_ranks(size):
    """Whether the first two letters merge is decided by the last ones."""
    letters = "abcdefghijklmnopqrstuvwxyz"[:size]
    merges = [(x, y) for x, y in zip(letters, letters[1:], strict=False)][::-1]
    names = [*letters, *(x + "</w>" for x in letters), *(x + y for x, y in merges)]
    work = MergeList({name: i for i, name in enumerate(names)}, merges)
    assert work.lookahead >= size - 1
    ranks = {pair: i for i, pair in enumerate(merges)}
    chooser = random.Random(size)
    words = [letters + letters[0] + letters[-1], letters[:-1] + "a", letters * 9]
    words += ["".join(letters[i : i + chooser.randrange(1, size)] for i in chooser.choices(range(size), k=30)) for _ in range(40)]
    for word in words:
        transducer = Transducer(work)
        found = [*transducer.feed(word[:-1]), *transducer.finish(word[-1])]
        assert [work.name[i] for i in found] == naive(word, ranks)
