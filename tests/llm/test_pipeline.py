from __future__ import annotations

import random
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import connect, normal_rows
from marketloom.llm import queries
from marketloom.llm.packing import LibraryIds
from marketloom.llm.work import stored

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_all_are_registered():
    names = entry.queries()
    assert "pipeline" in names and set(queries.QUERIES) <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "substring_dedup", "packing"]


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="given tables not found")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_its_sql(spark, name):
    result = queries.QUERIES[name](spark, SF_DIR)
    relation = connect(SF_DIR).execute(queries.ORACLES[name])
    theirs = normal_rows([item[0] for item in relation.description], relation.fetchall())
    assert normal_rows(result.columns, [tuple(r) for r in result.collect()]) == theirs != []


def planted(spark, path):
    """Documents with an empty one, copies, a near copy and a repeated passage."""
    text = duckdb.sql(f"SELECT text, lang FROM '{SF_DIR}/documents.parquet' WHERE lang = 'en' LIMIT 40").fetchall()
    words = sorted({w for t, _ in text for w in t.split()})
    random.seed(1)
    rows = [(i, " ".join(random.choices(words, k=300)), "en") for i in range(20)]
    long = random.choices(words, k=900)
    passage = " ".join(random.choices(words, k=60))
    rows += [(30, None, "en"), (31, "123 ---", "en"), (32, rows[3][1].replace(" ", "\n  "), "en"), (33, rows[3][1], None)]
    rows += [(40, " ".join(long), "en"), (41, " ".join([*long[:450], "another", *long[451:]]), "en")]
    rows += [(50, rows[5][1] + " x " + passage, "en"), (51, passage + " " + " ".join(random.choices(words, k=100)), "en")]
    rows = [(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in rows]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    return {i: t for i, t, *_ in rows}, passage


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="given tables not found")
def test_decisions_of_every_stage_take_effect(spark, tmp_path):
    texts, passage = planted(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = [set(texts)]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        left.append({r.doc_id for r in docs.collect()})
    assert left[0] - left[1] == {30, 31}
    assert left[1] - left[2] == {32, 33}
    assert left[2] - left[3] == {41}
    assert left[3] == left[4]
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert kept[50] == " x " + passage and passage not in kept[51] and len(kept[51].split()) == 100
    assert all(kept[i] == texts[i] for i in left[4] - {50, 51})

    library = LibraryIds(queries.WORD_BPE)
    want = []
    for doc_id, text in kept.items():
        ids = np.frombuffer(library.ids(text), "<u4").tolist() + [0]
        for piece in range(-(-len(ids) // 2048)):
            part = ids[2048 * piece : 2048 * piece + 2048]
            want.append((doc_id, piece, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in found) == sorted(want)
