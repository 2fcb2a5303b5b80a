"""URL rules looked up in a cascade of Bloom filters.

The keys of a rule list are stored in alternating Bloom filters: the first holds the listed
keys, the second those other keys of the corpus that the first wrongly accepts, the third the
listed keys that the second wrongly accepts, and so on until a level accepts nothing wrongly.
Over the corpus whose keys it was built from, membership is exact. A level is a small array of
64-bit words inside the expression, so a lookup needs no join and no shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.work import stored

#: Verdict, host, path prefix.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Wrongly accepted keys that are few enough for any list.
SOME_KEYS = 1000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """After the host up to ``? #`` or the end; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(found, F.lit(""))


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``words`` of 64 bits, ``hashes`` positions per key."""

    words: tuple[int, ...]
    hashes: int
    salt: int


def _positions(key: Column, bits: int, hashes: int, salt: int) -> Column:
    return F.array(
        *[F.pmod(F.xxhash64(key, F.lit(1000 * salt + i)), F.lit(bits)) for i in range(hashes)]
    )


def _build(keys: DataFrame, count: int, error: float, salt: int) -> Level:
    """A filter of the keys with about the given rate of wrong answers."""
    hashes = max(1, round(-math.log2(error)))
    bits = 64 * max(1, math.ceil(count * hashes / math.log(2) / 64))
    at = keys.select(F.explode(_positions(F.col("key"), bits, hashes, salt)).alias("at"))
    words = at.groupBy(F.floor(F.col("at") / 64).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits")
    )
    filled = {row.word: row.bits for row in words.collect()}
    return Level(tuple(filled.get(i, 0) for i in range(bits // 64)), hashes, salt)


def _accepts(level: Level, key: Column) -> Column:
    # One text that the optimizer folds to one array, however many words there are.
    words = F.split(F.lit(",".join(map(str, level.words))), ",").cast("array<long>")
    bits = 64 * len(level.words)

    def is_set(at: Column) -> Column:
        word = F.get(words, F.floor(at / 64).cast("int"))
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))
        return word.bitwiseAND(mask) != 0

    return F.forall(_positions(key, bits, level.hashes, level.salt), is_set)


class Cascade:
    """Exact membership of a key among the listed ones, for every key of the universe."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    @staticmethod
    def build(
        listed: DataFrame, universe: DataFrame, error: float = 0.02, most_keys: int = 100_000,
        universe_size: int | None = None,
    ) -> Cascade:
        """``listed`` and ``universe`` have a column ``key`` each.

        The list is a bounded one, of ``most_keys`` keys or an error. The universe may have any size:
        the first level's rate of wrong answers is at most ``error`` and falls with
        ``universe_size`` (rows of the universe or more, counted if not given), so that about as many
        keys are wrongly accepted as are listed; if they are more than ``most_keys`` all the same,
        that level is built anew with a smaller rate.
        """
        listed = stored(listed.where(F.col("key").isNotNull()).distinct(), "listed-keys")
        count = listed.count()
        if count > most_keys:
            raise ValueError(f"a list of {count} keys, more than most_keys={most_keys}")
        if not count:
            return Cascade([])
        size = universe.count() if universe_size is None else universe_size
        rate = min(error, max(count, SOME_KEYS) / max(size, 1))
        while True:
            levels = [_build(listed, count, rate, 1)]
            accepted = universe.where(F.col("key").isNotNull() & _accepts(levels[0], F.col("key")))
            wrong = stored(accepted.distinct().join(F.broadcast(listed), "key", "left_anti"), "wrong-keys")
            if wrong.count() <= most_keys:
                break
            rate /= 16
        inside, outside = listed, wrong
        while count := outside.count():
            level = _build(outside, count, 0.5, len(levels) + 1)
            levels.append(level)
            passing = inside.where(_accepts(level, F.col("key")))
            inside, outside = outside, stored(passing, f"level-{len(levels)}")
        return Cascade(levels)

    def contains(self, key: Column) -> Column:
        """Listed when the first level that refuses the key is one of the wrong keys."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for number in range(len(self.levels) - 1, -1, -1):
            refused = F.lit(number % 2 == 1)
            answer = F.when(_accepts(self.levels[number], key), answer).otherwise(refused)
        return answer


def _keys(spark: SparkSession, keys: list[str]) -> DataFrame:
    texts = F.array(*[F.lit(key) for key in keys]).cast("array<string>")
    return spark.range(1).select(F.explode(texts).alias("key"))


def candidate_keys(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """The rule texts that would fit: host and parent domains of those label counts, path
    prefixes of those lengths, longest text first."""
    parts = F.split(host, r"\.", -1)
    keys = []
    for n in labels:
        suffix = F.array_join(F.slice(parts, F.greatest(F.size(parts) - n + 1, F.lit(1)), n), ".")
        for length in lengths:
            fits = (F.size(parts) >= n) & (F.length(path) >= length) & (host != "")
            keys.append(F.when(fits, F.concat(suffix, F.substring(path, 1, length))))
    return F.array_sort(
        F.array_compact(F.array(*keys)), lambda a, b: F.length(b) - F.length(a)
    )


def judge_urls(
    pages: DataFrame,
    rules: tuple[tuple[str, str, str], ...] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    error: float = 0.02,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row.

    A rule (verdict, host, path prefix) fits its host and all subdomains if the path starts
    with its prefix; the longest rule text wins. A url without a fitting rule is in no list
    and therefore allowed. A null url, or one without ``://``, has empty host and path and
    fits nothing. Rows are kept as they are, repeated ones too; other columns are not read.
    Rules are a bounded, given list; ``error`` is the most that the first level may answer wrongly.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(f"`{id_col}`").alias("page_id"),
        url_host(F.col(f"`{url_col}`")).alias("host"),
        url_path(F.col(f"`{url_col}`")).alias("path"),
    )
    if not rules:
        return rows.select("*", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    labels = sorted({host.count(".") + 1 for _, host, _ in rules}, reverse=True)
    lengths = sorted({len(prefix) for _, _, prefix in rules}, reverse=True)
    keyed = rows.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), labels, lengths))
    universe = keyed.select(F.explode("keys").alias("key"))
    listed = _keys(spark, [host + prefix for _, host, prefix in rules])
    blocked = _keys(spark, [host + prefix for verdict, host, prefix in rules if verdict == "block"])
    # A row has a key per pair of those at most, so the keys need not be counted.
    most = rows.count() * len(labels) * len(lengths)
    in_rules = Cascade.build(listed, universe, error, universe_size=most)
    in_blocked = Cascade.build(blocked, listed, error)
    rule = F.get(F.filter("keys", in_rules.contains), 0)
    return keyed.select("page_id", "host", "path", rule.alias("rule")).withColumn(
        "verdict",
        F.when(F.col("rule").isNotNull() & in_blocked.contains(F.col("rule")), "block").otherwise("allow"),
    )
