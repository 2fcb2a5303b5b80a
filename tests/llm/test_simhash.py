from __future__ import annotations

import random
import re

import xxhash
from pyspark.sql import functions as F

from marketloom.llm.components import components
from marketloom.llm.simhash import fingerprint_of, links, near_duplicates, one_of_each


def brute_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(marks):
    parent = {i: i for i in range(len(marks))}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(marks)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= 3:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(marks))]


def signed(mark):
    return mark - 2**64 if mark >= 2**63 else mark


TEXTS = [None, "", " \t\n", "one", "Two words", "A b C", "a b c", "a b c d", "x y z " * 500, "é Éa b", "a\xa0b c d e", "q " * 90_000]


def test_fingerprints():
    for text in TEXTS:
        assert fingerprint_of(text) == brute_fingerprint(text)


def test_documents(spark):
    random.seed(3)
    vocabulary = [f"w{i}" for i in range(80)]
    rows = list(enumerate(TEXTS))
    for group in range(12):
        words = random.choices(vocabulary, k=150)
        for copy in range(6):
            changed = [w if random.random() > 0.01 * copy else random.choice(vocabulary) for w in words]
            rows.append((len(rows) * 7, " ".join(changed)))
    marks = [brute_fingerprint(t) for _, t in rows]
    roots = brute_components(marks)
    least = {}
    for (doc_id, _), root in zip(rows, roots, strict=True):
        least[root] = min(doc_id, least.get(root, doc_id))
    want = sorted((doc_id, f"{m:016x}", least[r]) for (doc_id, _), m, r in zip(rows, marks, roots, strict=True))
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, _id int")
    assert sorted(tuple(r) for r in near_duplicates(docs).collect()) == want
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))


def test_nulls_repeats_and_empty(spark):
    schema = "doc_id long, text string"
    assert near_duplicates(spark.createDataFrame([], schema)).count() == 0
    docs = spark.createDataFrame([(None, "a"), (4, ""), (4, ""), (None, None), (9, "a")], schema)
    found = sorted(((r.doc_id, r.component_id) for r in near_duplicates(docs).collect()), key=str)
    assert found == [(4, 4), (4, 4), (9, 9), (None, 4), (None, 9)]


def test_links_in_hot_keys_and_elsewhere(spark):
    random.seed(5)
    base = random.getrandbits(64)
    marks = {base}
    while len(marks) < 700:  # a dense cluster that shares most segments
        marks.add(base ^ sum(1 << random.randrange(20) for _ in range(random.randrange(4))) & (2**64 - 1))
    for _ in range(150):  # pairs at distances around the limit, in any segments
        one = random.getrandbits(64)
        marks |= {one, one ^ sum(1 << b for b in random.sample(range(64), random.choice([1, 2, 3, 4, 5])))}
    marks = sorted(marks)
    rows = spark.createDataFrame([(signed(m),) for m in marks], "mark long")
    found = links(rows)
    assert found.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > 3).count() == 0
    roots = {r.node: r.root for r in components(found).collect()}
    groups, want = {}, {}
    for mark, root in zip(marks, brute_components(marks), strict=True):
        groups.setdefault(roots.get(signed(mark), signed(mark)), set()).add(mark)
        want.setdefault(root, set()).add(mark)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_chain_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7)]
    found = components(spark.createDataFrame(pairs, "a long, b long"))
    roots = {r.node: r.root for r in found.collect()}
    assert all(roots[i] == 0 for i in range(201)) and all(roots[1000 + i] == 1000 for i in range(300))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
