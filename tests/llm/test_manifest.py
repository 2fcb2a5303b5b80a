from __future__ import annotations

import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from checks.compare import connect, normal_rows
from marketloom.llm.manifest import build, fold, prove, tamper_check
from marketloom.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, rank int, digest int, id int"
SMALL = "/root/testdata/sf0.001"


def digest(parts) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def part(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    """The root and the (left, right) siblings of every leaf, from the leaf's level up."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            low = place // 3 * 3
            paths[i].append((nodes[low:place], nodes[place + 1 : low + 3]))
            at[i] = place // 3
        nodes = [digest(nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def expected(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append((row, digest(map(part, row))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    found, trees = [], {}
    for name in names:
        groups[name].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[name] = tree([leaf for _, leaf in groups[name]])
    if not names:
        return []
    root, above = tree([trees[name][0] for name in names])
    for name, top in zip(names, above, strict=True):
        for (row, leaf), path in zip(groups[name], trees[name][1], strict=True):
            given = leaf
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                given = digest(map(part, (*row[:4], row[4].replace("\n", ""))))
            for left, right in path + top:
                given = digest([*left, given, *right])
            proof = digest(x for left, right in path + top for x in left + right)
            found.append((row[0], leaf, trees[name][0], root, proof, given, given == root))
    return sorted(found, key=str)


def checked(spark, rows):
    frame = spark.createDataFrame([(*row, "t", 1, 2, 3) for row in rows], SCHEMA)
    even = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    result = tamper_check(frame, even)
    assert result.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(row) for row in result.collect()), key=str)


CASES = {
    "empty table": [],
    "one row": [(5, "a", "en", 3, "a\nb")],
    "nulls in every column": [
        (1, None, "en", 3, "a\nb"), (2, "a", None, None, None), (3, "a", None, 0, ""), (4, None, None, None, None),
        (None, "a", "en", 1, "x\n"), (None, None, None, None, None),
    ],
    "rows of one id and repeated rows": [(7, "a", "en", 1, "x\ny")] * 5 + [(7, "a", "en", 1, t) for t in "xyz"] + [(7, "b", "en", 1, "x\ny")] * 2,
    "groups by bytes": [(i, s, "en", i, "\n") for i, s in enumerate(["b", "B", "", "é", "\U0001f600", "￿", "ab", "a"])],
    "a very long text": [(i, "a", "en", 9, "line\n" * 200_000) for i in range(4)],
}


@pytest.mark.parametrize("name", CASES)
def test_proofs(spark, name):
    assert checked(spark, CASES[name]) == expected(CASES[name])


def test_trees_of_several_pages_and_many_groups(spark):
    rows = [(i * 7 % 3001, "big" if i % 3 else f"s{i % 900:04d}", "en", i, f"text\n{i}" if i % 5 else "one line") for i in range(3001)]
    assert checked(spark, rows) == expected(rows)


def test_some_requests_only(spark):
    rows = [(i, f"s{i % 3}", "en", i, f"text {i}") for i in range(2400)]
    frame = spark.createDataFrame([(*row, "t", 1, 2, 3) for row in rows], SCHEMA)
    manifest = build(frame, keep={"id": F.col("doc_id")})
    wanted = manifest.leaves.where("id in (0, 5, 2399)").withColumn("given", F.lit(None).cast("binary"))
    proofs = {row["id"]: row for row in prove(manifest, wanted).collect()}
    assert sorted(proofs) == [0, 5, 2399]
    assert all(row["verified"] for row in proofs.values())
    other = wanted.withColumn("given", F.unhex(F.sha2(F.lit("another leaf").cast("binary"), 256)))
    assert not any(row["verified"] for row in prove(manifest, other).collect())


def test_a_path_folds_from_the_leaf_to_the_root():
    leaf, left, right = (sha256(x).digest() for x in (b"leaf", b"left", b"right"))
    inner = sha256((left.hex() + leaf.hex()).encode()).digest()
    assert fold(leaf, [(b"", right), (left, b"")]) == sha256((inner.hex() + right.hex()).encode()).digest()


def test_query_equals_its_sql(spark):
    result = QUERIES["op13_merkle_manifest"](spark, SMALL)
    relation = connect(SMALL).execute(ORACLES["op13_merkle_manifest"])
    names = [item[0] for item in relation.description]
    assert sorted(names) == sorted(result.columns)
    assert normal_rows(result.columns, [tuple(r) for r in result.collect()]) == normal_rows(names, relation.fetchall())
