"""Language identification by segmentation-marginalised unigrams.

A language is a distribution over the pieces of a fixed public vocabulary. The probability of a
word is the sum over all ways to cut it into pieces, computed by a forward pass; a text's is the
product over its words. The piece probabilities start from how often pieces occur in the
language's words and are improved by expected counts (forward and backward passes).

The words of a batch are scored together: pieces are found by hashes of all substrings, and one
pass over character positions serves all words and languages.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from marketloom.llm.bpe import SLICE, slices
from marketloom.llm.work import stored

#: Documents per language to fit on, chosen by a hash of their id; words of a training text.
SAMPLE_DOCS = 400
ROUNDS = 2
#: Longest piece and longest part of a word that is scored as one.
LONGEST, WORD_PART = 12, 24
#: Added to every piece count, and the probability of a character no piece covers.
SMOOTHING, UNKNOWN = 0.05, 1e-9
#: Values kept per worker, a word's being one per language.
CACHE = 1_200_000
#: The answer for texts without letters.
NONE = "und"
#: Share of the best language below which a document is in none.
LEAST_SCORE = 0.5
#: Runs of letters, with letters of all scripts.
LETTERS = re.compile(r"[^\W\d_]+")
_BASE = np.uint64(0x100000001B3)
START = "▁"


def vocabulary(model_path: str) -> list[str]:
    """The usable pieces of a sentencepiece model: no control, byte or long ones."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_path)
    plain = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i)))
    pieces = {model.id_to_piece(i).lower() for i in plain}
    return sorted(p for p in pieces if len(p) <= LONGEST and (p == START or LETTERS.fullmatch(p.removeprefix(START))))


def _codes(words: list[str], size: int) -> np.ndarray:
    """Character codes of the words, a row each, zero after the end."""
    table = np.zeros((len(words), size), np.uint64)
    joined = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    table[np.arange(size) < lengths[:, None]] = joined
    return table


class Pieces:
    """Finds vocabulary pieces among the substrings of many words at once."""

    def __init__(self, pieces: list[str]):
        self.pieces = pieces
        hashes = np.zeros(len(pieces), np.uint64)
        for length in {len(p) for p in pieces}:
            at = [i for i, p in enumerate(pieces) if len(p) == length]
            hashes[at] = self._hash(_codes([pieces[i] for i in at], length))
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]
        if (np.diff(self.sorted) == 0).any():
            raise ValueError("two pieces share a hash")

    @staticmethod
    def _hash(codes: np.ndarray) -> np.ndarray:
        found = np.zeros(len(codes), np.uint64)
        for column in range(codes.shape[1]):
            found = (found ^ (codes[:, column] + np.uint64(1))) * _BASE
        return found

    def ends(self, words: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """``end, start, rows, piece`` of every piece in the words, by rising end.

        A piece number of -1 stands for a single character that no piece covers.
        """
        size = max(map(len, words))
        codes = _codes(words, size)
        at = [np.zeros(len(words), np.uint64) for _ in range(size)]
        for end in range(1, size + 1):
            used = np.flatnonzero(codes[:, end - 1])
            for start in range(max(0, end - LONGEST), end):
                at[start] = (at[start] ^ (codes[:, end - 1] + np.uint64(1))) * _BASE
                place = np.minimum(np.searchsorted(self.sorted, at[start][used]), len(self.sorted) - 1)
                known = self.sorted[place] == at[start][used]
                yield end, start, used[known], self.order[place[known]]
                if start == end - 1 and not known.all():
                    yield end, start, used[~known], np.full(int((~known).sum()), -1)


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def _cut(word: str) -> list[str]:
    """The marked word, in parts if it is long."""
    word = START + word
    return [word[i : i + WORD_PART] for i in range(0, len(word), WORD_PART)]


class Model:
    """Log probabilities of words and texts under every language."""

    def __init__(self, pieces: list[str], languages: list[str], weights: np.ndarray):
        self.finder, self.languages = Pieces(pieces), languages
        known = weights / weights.sum(axis=0, keepdims=True)
        self.chance = np.vstack([known, np.full((1, len(languages)), UNKNOWN)])  # the last row is -1
        self.room = max(SLICE, CACHE // max(1, len(languages)))
        self.place: dict[str, int] = {}
        self.logs = np.zeros((self.room, len(languages)))

    def forward(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, list]:
        """Sums over the segmentations of each prefix, word lengths, and the pieces found."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        sums = np.zeros((int(lengths.max()) + 1, len(words), len(self.languages)))
        sums[0] = 1.0
        found = list(self.finder.ends(words))
        for end, start, rows, piece in found:
            sums[end, rows] += sums[start, rows] * self.chance[piece]
        return sums, lengths, found

    def word_logs(self, words: list[str]) -> np.ndarray:
        """Of marked words or parts of words."""
        sums, lengths, _ = self.forward(words)
        return np.log(np.maximum(sums[lengths, np.arange(len(words))], 1e-300))

    def expected(self, words: list[str], counts: np.ndarray, language: int) -> np.ndarray:
        """Expected uses of each piece in words of one language, each word ``counts`` times."""
        sums, lengths, found = self.forward(words)
        everyone = np.arange(len(words))
        back = np.zeros(sums.shape[:2])
        back[lengths, everyone] = 1.0
        total = np.maximum(sums[lengths, everyone, language], 1e-300)
        uses = np.zeros(len(self.chance))
        for end, start, rows, piece in reversed(found):
            step = self.chance[piece, language] * back[end, rows]
            back[start, rows] += step
            np.add.at(uses, piece, sums[start, rows, language] * step / total[rows] * counts[rows])
        return uses[:-1]

    def text_logs(self, text: str) -> np.ndarray | None:
        """Log probability of a whole text per language; null without letters."""
        total, letters = np.zeros(len(self.languages)), False
        for part in slices(text):
            words = words_of(part)
            letters = letters or any(c.isalpha() for w in words for c in w)
            for low in range(0, len(words), self.room):
                total += self._sum(words[low : low + self.room])
        return total if letters else None

    def _sum(self, words: list[str]) -> np.ndarray:
        """Log probability of ``room`` words at most, so that all of them fit."""
        fresh = {w for w in words if w not in self.place}
        if len(self.place) + len(fresh) > self.room:
            self.place.clear()
            fresh = set(words)
        self._learn(fresh)
        return self.logs[np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))].sum(axis=0)

    def learn(self, texts: list[str | None]) -> None:
        """Score the new words of several texts together, which is faster than one by one."""
        fresh: set[str] = set()
        for text in texts:
            if text and len(text) <= SLICE:
                fresh.update(w for w in words_of(text) if w not in self.place)
            if len(fresh) > self.room // 2:
                return
        if len(self.place) + len(fresh) > self.room:
            self.place.clear()
        self._learn(fresh)

    def _learn(self, fresh: set[str]) -> None:
        if not fresh:
            return
        words = sorted(fresh)
        parts = [part for word in words for part in _cut(word)]
        ends = np.cumsum([-(-(len(word) + 1) // WORD_PART) for word in words])
        logs = np.vstack([self.word_logs(parts[i : i + 4096]) for i in range(0, len(parts), 4096)])
        at = len(self.place)
        self.logs[at : at + len(words)] = np.add.reduceat(logs, np.r_[0, ends[:-1]], axis=0)
        self.place.update(zip(words, range(at, at + len(words)), strict=True))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter[tuple[str, str]] = Counter()
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            for part in slices(text.as_py() or ""):
                counts.update((lang, piece) for word in words_of(part) for piece in _cut(word))
        columns = [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string())]
        columns.append(pa.array(counts.values(), pa.int64()))
        yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])


def fit(labelled: DataFrame, pieces: list[str], sample_docs: int = SAMPLE_DOCS, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """Languages and piece weights from rows ``doc_id, text, lang`` that have a label.

    About ``sample_docs`` documents per language decide, those with the smallest hashes of
    their id. The driver receives a weight per language and piece at most.
    """
    labelled = labelled.where(F.col("lang").isNotNull())
    sizes = {row.lang: row.n for row in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    weights = np.ones((len(pieces), len(languages)))
    if not languages:
        return languages, weights
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, sample_docs / n))])
    place = F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1_000_003)) / 1_000_003
    some = labelled.where(place <= share[F.col("lang")]).select("lang", "text")
    counted = some.mapInArrow(_count_words, "lang string, word string, n long")
    words = stored(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    for _ in range(rounds):
        now = weights

        def uses(batches: Iterator[pa.RecordBatch], now: np.ndarray = now) -> Iterator[pa.RecordBatch]:
            model = Model(pieces, languages, now)
            for batch in batches:
                langs = np.array(batch.column("lang").to_pylist(), object)
                all_words, n = np.array(batch.column("word").to_pylist(), object), batch.column("n").to_numpy()
                for number, lang in enumerate(languages):
                    at = np.flatnonzero(langs == lang)
                    found = np.zeros(len(pieces))
                    for low in range(0, len(at), 4096):
                        part = at[low : low + 4096]
                        found += model.expected(list(all_words[part]), n[part], number)
                    used = np.flatnonzero(found)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(used), number), pa.int32()), pa.array(used, pa.int32()), pa.array(found[used])],
                        ["lang", "piece", "uses"],
                    )

        # Rounded, so that the order in which parts are added does not show.
        total = words.mapInArrow(uses, "lang int, piece int, uses double").groupBy("lang", "piece")
        total = total.agg(F.sum(F.round("uses", 6).cast("decimal(28,6)")).cast("double").alias("uses"))
        weights = np.full_like(weights, SMOOTHING)
        for row in total.collect():
            weights[row.piece, row.lang] += row.uses
    return languages, weights


_MODELS: dict[str, Model] = {}


def _model(token: str, pieces: list[str], languages: list[str], weights: np.ndarray) -> Model:
    """One per fit and Python worker."""
    if token not in _MODELS:
        _MODELS.clear()
        _MODELS[token] = Model(pieces, languages, weights)
    return _MODELS[token]


def predict(
    docs: DataFrame,
    pieces: list[str],
    languages: list[str],
    weights: np.ndarray,
    row_field: str | None = None,
) -> DataFrame:
    """``docs`` with ``lang_pred, score`` instead of its column ``text``.

    The score is the language's share of the text's probability over all languages. With
    ``row_field`` the text is that field of a column ``_row``, which stays, so that a whole row
    passes through a worker once.
    """
    token = uuid.uuid4().hex
    kept = [name for name in docs.columns if row_field or name != "text"]

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(token, pieces, languages, weights) if languages else None
        for batch in rows:
            found: list[tuple[str, float]] = []
            column = batch.column("_row").field(row_field) if row_field else batch.column("text")
            for low in range(0, batch.num_rows, 256):
                texts = [text.as_py() for text in column.slice(low, 256)]
                if model is not None:
                    model.learn(texts)
                for text in texts:
                    logs = model.text_logs(text) if model is not None and text else None
                    found.append((NONE, 0.0) if logs is None else best_of(logs, languages))
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, kept), pa.array([x[0] for x in found], pa.string()),
                 pa.array([x[1] for x in found], pa.float64())],
                [*kept, "lang_pred", "score"],
            )

    kinds = [docs.schema[name] for name in kept]
    schema = StructType([*kinds, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return docs.mapInArrow(batches, schema)


def best_of(logs: np.ndarray, languages: list[str]) -> tuple[str, float]:
    raised = np.exp(logs - logs.max())
    at = int(raised.argmax())
    return languages[at], float(raised[at] / raised.sum())


def identify(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row of ``docs``, from its whole text.

    Learns from labelled rows that are not held out; held out are those whose crc32 of the id
    as text leaves 2 when divided by 4 (a null id is not). ``model_path`` is a sentencepiece
    file whose pieces are the vocabulary. A text that is null or has no letter, or any text if
    nothing is labelled, is ``und`` with score 0. Ties go to the first language in order.
    Repeated rows give repeated rows; empty input gives none; other columns are not read.
    """
    rows = _rows(docs, id_col, text_col, lang_col)
    pieces = vocabulary(model_path)
    languages, weights = fit(rows.where(~F.col("held_out")), pieces, sample_docs)
    return predict(rows.select("doc_id", "held_out", "text"), pieces, languages, weights)


def _rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
    )
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    return rows.withColumn("held_out", F.coalesce(remainder == 2, F.lit(False)))


def in_a_language(
    docs: DataFrame,
    model_path: str,
    least_score: float = LEAST_SCORE,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text is in one of the languages.

    Texts without letters go, and those whose best language has less than ``least_score``.
    """
    pieces = vocabulary(model_path)
    rows = _rows(docs, id_col, text_col, lang_col)
    languages, weights = fit(rows.where(~F.col("held_out")), pieces)
    whole = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row")
    found = predict(docs.select(whole), pieces, languages, weights, row_field=text_col)
    return found.where((F.col("lang_pred") != NONE) & (F.col("score") >= least_score)).select("_row.*")
