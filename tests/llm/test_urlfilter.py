from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from marketloom.llm.urlfilter import RULES, Cascade, judge_urls


def judged(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fitting = [
        (len(h + p), h + p, verdict) for verdict, h, p in RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    _, rule, verdict = max(fitting, default=(0, None, "allow"))
    return host, path, rule, verdict


URLS = [
    None, "", "no scheme", "http://", "http://A.NET/", "http://net", "http://net/", "http://net/x", "http://xnet/",
    "https://example.net/en/1", "https://www.EXAMPLE.net/en/1?x#y", "https://example.net/en", "https://example.net/EN/",
    "http://example.com/de/", "http://a.b.c.example.com/de/x", "http://notexample.com/de/", "http://fr.org/fr/",
    "http://a.net?x=http://b.com/c", "http://a.com?x=http://b.net/c", "ftp://x#y://z.net/", "http://a.net:80/x",
    "http://.net/", "http://net./", "x://a\nb.net/\nq", "http://ÄÖ.org/fr/é", "http://" + "a." * 500 + "net/" + "y" * 5000,
]


def test_urls(spark):
    rows = [(i, url, "rule") for i, url in enumerate(URLS)] + [(None, "http://x.net/", "z"), (1, URLS[1], "again")]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string")
    found = judge_urls(pages)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    want = sorted(((i, *judged(url)) for i, url, _ in rows), key=str)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want


def test_empty_table_and_no_rules(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(pages).count() == 0
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert [tuple(r) for r in judge_urls(pages, ()).collect()] == [(1, "a.net", "/", None, "allow")]


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(3000).select(F.concat(F.lit("key "), F.col("id").cast("string")).alias("key"))
    listed = universe.where(F.crc32(F.col("key").cast("binary")) % 7 == 0)
    cascade = Cascade.build(listed, universe, error=0.3)
    assert len(cascade.levels) > 2
    said = universe.where(cascade.contains(F.col("key")))
    assert sorted(r.key for r in said.collect()) == sorted(r.key for r in listed.collect())


def test_empty_list_contains_nothing(spark):
    keys = spark.createDataFrame([("a",)], "key string")
    cascade = Cascade.build(keys.limit(0), keys)
    assert keys.where(cascade.contains(F.col("key"))).count() == 0


def test_no_join_in_a_lookup(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    plan = judge_urls(pages)._jdf.queryExecution().toString()
    assert "Join" not in plan and "Python" not in plan


def keys_of(spark, count):
    return spark.range(count).select(F.concat(F.lit("key "), F.col("id").cast("string")).alias("key"))


def test_a_large_corpus_needs_no_other_call(spark):
    # A size that is far too small makes the first level accept nearly everything at first.
    universe = keys_of(spark, 400_000)
    listed = universe.where(F.crc32(F.col("key").cast("binary")) % 1000 == 0)
    cascade = Cascade.build(listed, universe, error=0.6, most_keys=2000, universe_size=1)
    said = universe.where(cascade.contains(F.col("key")))
    assert sorted(r.key for r in said.collect()) == sorted(r.key for r in listed.collect())


def test_two_hundred_thousand_wrongly_accepted_keys(spark):
    universe = keys_of(spark, 300_000)
    listed = universe.where(F.crc32(F.col("key").cast("binary")) % 1000 == 0)
    cascade = Cascade.build(listed, universe, error=0.75, most_keys=300_000, universe_size=1)
    first = Cascade(cascade.levels[:1])
    assert universe.where(first.contains(F.col("key"))).count() > 100_000
    said = universe.where(cascade.contains(F.col("key")))
    assert sorted(r.key for r in said.collect()) == sorted(r.key for r in listed.collect())


def test_the_first_level_follows_the_size_of_the_corpus(spark):
    universe = keys_of(spark, 1000)
    small, large = (Cascade.build(universe.limit(4), universe, universe_size=n).levels[0] for n in (1000, 10**12))
    assert small.hashes < 8 and large.hashes > 25 and len(large.words) < 10


def test_a_list_above_its_bound_is_an_error(spark):
    with pytest.raises(ValueError, match="most_keys=10"):
        Cascade.build(keys_of(spark, 11), keys_of(spark, 5), most_keys=10)
