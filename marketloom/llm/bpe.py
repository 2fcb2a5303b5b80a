"""BPE encoding as a bounded-lookahead streaming transducer, and incremental decoding.

A sequence of tokens is the encoding of its text exactly when every token encodes to itself
and no merge would have crossed the border of any two neighbours. So the last token of the
encoding of every prefix follows from the last tokens of shorter prefixes, one character at a
time. How far to the right a merge can depend on what comes is bounded by the merge list
(``MergeList.lookahead``): tokens that end further back than that are stable and are emitted, so
that the state never holds more than the lookahead and one longest token.

Words recur, so the results of short stretches without white space are kept in bounded caches.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: Entries of a cache before it starts anew, and characters of a stretch that is kept.
CACHE, KEPT_CHARS = 700_000, 64
#: Characters of a text that are worked on at a time.
SLICE = 1 << 16
WORD_END = "</w>"
#: Characters that Python counts as white space and Unicode does not.
NOT_WHITE = "\x1c\x1d\x1e\x1f"
_WHITE = re.compile(r"[^\S\x1c-\x1f]+")
#: The pre-tokenizer's pattern for text without white space.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{L}\p{N}]+"
_WORDS = regex.compile(WORDS)
UTF8 = codecs.getincrementaldecoder("utf-8")
#: Below this code point normal form C changes nothing and case maps one by one.
SIMPLE = re.compile("[\x00-ɏ]*")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if printable Latin-1, else from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


LETTERS = byte_letters()
BYTES = {letter: byte for byte, letter in LETTERS.items()}


def letters_of(word: str) -> str:
    """A letter for each byte of the word."""
    return word.encode("utf-8").decode("latin-1").translate(LETTERS)


class MergeList:
    """The merges of a vocabulary, their borders and their lookahead."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.vocab = vocab
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.formed: dict[str, int] = {}
        self.parts: dict[str, tuple[str, str]] = {}
        for i, (a, b) in enumerate(merges):
            if a + b in self.formed:
                continue
            if max(self.formed.get(a, -1), self.formed.get(b, -1)) >= i:
                raise ValueError("a merge comes before the merges of its parts")
            self.formed[a + b], self.parts[a + b] = i, (a, b)
        self._right: dict[str, list] = {}
        self._left: dict[str, list] = {}
        self.known_fits: dict[int, bool] = {}
        #: Tokens that encode to themselves.
        self.tokens: dict[str, int] = {s: i for s, i in vocab.items() if s not in self.parts}
        for i, (a, b) in enumerate(merges):
            if self.formed[a + b] == i and a in self.tokens and b in self.tokens:
                if a + b in vocab and self.crossing(a, b) == i:
                    self.tokens[a + b] = vocab[a + b]
        self.name = {i: s for s, i in self.tokens.items()}
        #: Every beginning of a token, with the token's id or -1 if it is none itself.
        self.begun = {s[:n]: -1 for s in self.tokens for n in range(1, len(s))} | self.tokens
        self.longest = max(map(_width, self.tokens))
        self.lookahead = self._lookahead(merges)

    def _history(self, symbol: str, side: int, known: dict[str, list]) -> list[tuple[str, float]]:
        """What stood at an edge of the symbol and the rank that replaced it, oldest first."""
        if symbol not in known:
            steps, now, until = [], symbol, math.inf
            while True:
                steps.append((now, until))
                if now not in self.parts:
                    break
                until, now = self.formed[now], self.parts[now][side]
            known[symbol] = steps[::-1]
        return known[symbol]

    def crossing(self, a: str, b: str) -> float:
        """The rank of the first merge across the border of ``a`` and ``b``, or infinity."""
        right, left = self._history(a, 1, self._right), self._history(b, 0, self._left)
        i = j = 0
        while True:
            (r, r_until), (l, l_until) = right[i], left[j]
            m = self.rank.get((r, l), math.inf)
            # Of equal merges the leftmost is first.
            if m < r_until and m <= l_until and m < math.inf:
                return m
            if r_until == l_until == math.inf:
                return math.inf
            if r_until <= l_until:
                i += 1
            else:
                j += 1

    def fits(self, a: int, b: int) -> bool:
        """Whether token ``b`` may follow token ``a`` inside a word."""
        found = self.known_fits.get(a << 32 | b)
        if found is None:
            if len(self.known_fits) >= 2 * CACHE:
                self.known_fits.clear()
            found = self.crossing(self.name[a], self.name[b]) == math.inf
            self.known_fits[a << 32 | b] = found
        return found

    def encode_short(self, word: str) -> list[int]:
        """Ids of a whole word that fits in memory: the transducer's rule, forwards from every
        position as far as some token goes on."""
        find, known, fits, size = self.begun.get, self.known_fits.get, self.fits, len(word)
        last, begin = [-1] * (size + 1), [0] * (size + 1)
        for start in range(size):
            left = last[start]
            # What ends the word is a token of its own kind.
            token = find(word[start:] + WORD_END, -1) if size - start <= self.longest else -1
            if token >= 0 and (left < 0 or self._may_follow(left, token)):
                last[size], begin[size] = token, start
            for at in range(start + 1, size):
                token = find(word[start:at])
                if token is None:
                    break
                if token >= 0 and last[at] < 0:
                    good = left < 0 or known(left << 32 | token)
                    if good or good is None and fits(left, token):
                        last[at], begin[at] = token, start
        found, at = [], size
        while at:
            if last[at] < 0:
                raise ValueError(f"{word!r} has a character without a token")
            found.append(last[at])
            at = begin[at]
        return found[::-1]

    def _may_follow(self, a: int, b: int) -> bool:
        good = self.known_fits.get(a << 32 | b)
        return self.fits(a, b) if good is None else good

    def _lookahead(self, merges: list[tuple[str, str]]) -> int:
        """Characters to the right of a token after which nothing can change it.

        A merge (a, b) needs what formed a and b, and that b is not taken first by a merge
        (b, d) of lower rank, which needs d and what formed it. One pass in rank order.
        """
        needs: dict[str, int] = {}
        taken: dict[str, int] = {}
        most = 0
        for a, b in merges:
            need = max(needs.get(a, 0) - _width(b), needs.get(b, 0), taken.get(b, 0))
            # Whether b is there to be taken depends in turn on what could take b.
            taken[a] = max(taken.get(a, 0), _width(b) + max(needs.get(b, 0), taken.get(b, 0)))
            needs[a + b] = max(needs.get(a + b, 0), need)
            most = max(most, need, taken[a])
        return most + 1


def _width(symbol: str) -> int:
    return len(symbol.removesuffix(WORD_END))


class Transducer:
    """Encodes one word, given a character at a time; ``feed`` and ``finish`` yield ids."""

    def __init__(self, merges: MergeList):
        self.merges = merges
        self.tail = ""  # characters from the last emitted border on
        self.last: list[tuple[int, int]] = [(-1, 0)]  # of each prefix of the tail: last token, its start
        self.before = -1  # the last emitted token
        self.room = 2 * (merges.lookahead + merges.longest)

    def feed(self, letters: str) -> Iterator[int]:
        """All but the word's last character."""
        for letter in letters:
            self.tail += letter
            self.last.append(self._last_token(""))
            if len(self.tail) >= self.room:
                yield from self._stable()

    def finish(self, letter: str) -> Iterator[int]:
        self.tail += letter
        self.last.append(self._last_token(WORD_END))
        yield from (token for token, _ in self._chain())
        self.tail, self.last, self.before = "", [(-1, 0)], -1

    def _last_token(self, end: str) -> tuple[int, int]:
        size, fits, tokens = len(self.tail), self.merges.fits, self.merges.tokens
        for start in range(max(0, size - self.merges.longest), size):
            token = tokens.get(self.tail[start:] + end)
            if token is not None:
                left = self.last[start][0] if start else self.before
                if left < 0 or fits(left, token):
                    return token, start
        raise ValueError(f"no token ends with {self.tail[-1]!r}")

    def _chain(self) -> list[tuple[int, int]]:
        """Tokens of the tail and where each ends."""
        found, at = [], len(self.tail)
        while at:
            token, start = self.last[at]
            found.append((token, at))
            at = start
        return found[::-1]

    def _stable(self) -> Iterator[int]:
        border = len(self.tail) - self.merges.lookahead
        stable = [(token, end) for token, end in self._chain() if end <= border]
        if stable:
            self.before, end = stable[-1]
            self.tail = self.tail[end:]
            self.last = [(-1, 0), *((token, start - end) for token, start in self.last[end + 1 :])]
            yield from (token for token, _ in stable)


class Decoder:
    """Ids to text, an id at a time, as the file's decoder does.

    Without a decoder in the file the tokens are joined by a space. With a byte-level decoder
    the letters become bytes again and a character is given out when its bytes are complete.
    """

    def __init__(self, names: dict[int, str], kind: str | None):
        self.names, self.kind, self.first = names, kind, True
        self.text = UTF8("replace")

    def push(self, number: int) -> str:
        name = self.names.get(number)
        if name is None:
            return ""
        if self.kind == "ByteLevel":
            return self.text.decode(bytes(BYTES[x] for x in name))
        gap, self.first = "" if self.first else " ", False
        return gap + name

    def finish(self) -> str:
        return self.text.decode(b"", True)


class Kept(dict):
    """Results by key; starts anew when full. Long keys are not kept."""

    def __init__(self, make, room: int = CACHE):
        super().__init__()
        self.make, self.room = make, room

    def __missing__(self, key):
        made = self.make(key)
        if len(key) <= KEPT_CHARS:
            if len(self) >= self.room:
                self.clear()
            self[key] = made
        return made


class Encoder:
    """Whole texts to ids with the merges of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != WORD_END:
            raise ValueError("a BPE file with word ends is needed")
        self.library = Tokenizer.from_file(path)
        self.added = {token["content"]: token["id"] for token in data["added_tokens"]}
        self.split_added = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        self.merges = MergeList(model["vocab"], [tuple(pair) for pair in model["merges"]])
        self.names = {i: s for s, i in (model["vocab"] | self.added).items()}
        self.kind = (data["decoder"] or {}).get("type")
        self.text_gap = b"" if self.kind == "ByteLevel" else b" "
        self.words = Kept(self._word)
        #: Per stretch: ids as text, decoded text in UTF-8, number of ids.
        self.stretches = Kept(self._stretch)

    def _word_ids(self, word: str) -> list[int]:
        """Ids of one pre-token, given in byte letters."""
        if len(word) <= KEPT_CHARS:
            return self.merges.encode_short(word)
        transducer = Transducer(self.merges)
        return [*transducer.feed(word[:-1]), *transducer.finish(word[-1])]

    def _result(self, ids: list[int]) -> tuple[bytes, bytes, int]:
        decoder = Decoder(self.names, self.kind)
        text = "".join(map(decoder.push, ids)) + decoder.finish()
        return " ".join(map(str, ids)).encode(), text.encode("utf-8"), len(ids)

    def _word(self, word: str) -> tuple[bytes, bytes, int]:
        return self._result(self._word_ids(word))

    def _parts(self, stretch: str) -> list[tuple[bytes, bytes, int]]:
        """Results of the pre-tokens of a text without white space."""
        if "<|" not in stretch or not self.added:
            return [self.words[word] for word in self._pre_tokens(stretch)]
        found = []
        for part in self.split_added.split(stretch):
            if part in self.added:
                found.append(self._result([self.added[part]]))
            elif part:
                found += [self.words[word] for word in self._pre_tokens(part)]
        return found

    def _pre_tokens(self, part: str) -> list[str]:
        if part.isascii() and part.isprintable():
            return _WORDS.findall(part.lower())
        if SIMPLE.fullmatch(part):
            return [letters_of(word) for word in _WORDS.findall(part.lower())]
        text = self.library.normalizer.normalize_str(part)
        return [word for word, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def _stretch(self, stretch: str) -> tuple[bytes, bytes, int]:
        parts = self._parts(stretch)
        if len(parts) == 1:
            return parts[0]
        ids, texts = b" ".join([x[0] for x in parts]), self.text_gap.join([x[1] for x in parts])
        return ids, texts, sum([x[2] for x in parts])

    def encode(self, text: str) -> list[int]:
        found = b" ".join([self.stretches[stretch][0] for stretch in stretches_of(text)])
        return list(map(int, found.split()))

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of ids, digest of the ids as text, digest of the decoded text."""
        ids, decoded, count, gap = hashlib.sha256(), hashlib.sha256(), 0, b""
        look_up = self.stretches.__getitem__
        for part in slices(text):
            found = list(map(look_up, stretches_of(part)))
            if found:
                ids.update(gap + b" ".join([x[0] for x in found]))
                decoded.update((self.text_gap if gap else b"") + self.text_gap.join([x[1] for x in found]))
                count += sum([x[2] for x in found])
                gap = b" "
        return count, ids.hexdigest(), decoded.hexdigest()


def stretches_of(text: str) -> list[str]:
    """The parts of a text between Unicode white space."""
    if any(x in text for x in NOT_WHITE):
        return [x for x in _WHITE.split(text) if x]
    return text.split()


def slices(text: str) -> Iterator[str]:
    """The text in parts that end before white space, or at its end."""
    low = 0
    while low < len(text):
        cut = _WHITE.search(text, low + SLICE) if len(text) > low + SLICE else None
        high = cut.start() if cut else len(text)
        yield text[low:high]
        low = high


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per file and Python worker."""
    return Encoder(path)


def encode_digests(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row, whole texts.

    ``path`` is a tokenizer file that every worker can read. Null texts are empty: no ids, and
    digests of empty texts. Special tokens written out in a text become their ids. Repeated
    rows give repeated rows; empty input gives none; other columns are not read.
    """

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = encoder(path)
        for batch in rows:
            found = [work.digests(text.as_py() or "") for text in batch.column("text")]
            columns = [pa.array([x[i] for x in found], kind) for i, kind in enumerate((pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            )

    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    return rows.mapInArrow(batches, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
