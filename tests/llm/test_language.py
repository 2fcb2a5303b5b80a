from __future__ import annotations

import math
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.llm.language import LEAST_SCORE, Model, fit, identify, in_a_language, predict
from marketloom.llm.queries import PIECE_BPE

SCHEMA = "doc_id long, text string, lang string, score string"
WORDS = {"aa": "la le les une des pour avec dans est".split(), "bb": "der die das und nicht mit ein von zu".split()}


def docs(spark, more=()):
    rows = [(i, " ".join(WORDS[lang][(i + k) % 9] for k in range(12)), lang, "x") for i, lang in enumerate(["aa", "bb"] * 60)]
    return spark.createDataFrame(rows + list(more), SCHEMA)


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_forward_sums_all_segmentations():
    pieces = ["▁a", "b", "ab", "▁", "a", "c"]
    weights = np.array([[4.0, 1.0], [2.0, 1.0], [1.0, 5.0], [1.0, 1.0], [1.0, 1.0], [1.0, 1.0]])
    model = Model(pieces, ["x", "y"], weights)
    chance = {p: weights[i] / weights.sum(axis=0) for i, p in enumerate(pieces)}

    def total(rest):
        if not rest:
            return np.ones(2)
        found = sum((chance[rest[:n]] * total(rest[n:]) for n in range(1, len(rest) + 1) if rest[:n] in chance), np.zeros(2))
        return found if rest[:1] in chance else found + model.chance[-1] * total(rest[1:])

    for word in ("▁ab", "▁abab", "▁zab", "▁cabbac"):
        assert np.allclose(model.word_logs([word]), np.log(total(word)))
    whole = model.text_logs("ab AB 12 zab")
    assert np.allclose(whole, 2 * np.log(total("▁ab")) + np.log(total("▁zab")))
    assert model.text_logs("12 _ ² !") is None


def test_expected_counts_are_the_mean_over_segmentations():
    pieces = ["▁", "a", "aa"]
    model = Model(pieces, ["x"], np.array([[1.0], [1.0], [2.0]]))
    # ▁ a a: 1/4*1/4*1/4; ▁ aa: 1/4*1/2.
    one, two = 1 / 64, 1 / 8
    uses = model.expected(["▁aa"], np.array([3]), 0)
    assert np.allclose(uses, 3 * np.array([one + two, 2 * one, two]) / (one + two))


def test_predictions(spark):
    more = [(500, None, "aa", "x"), (501, "", None, "x"), (502, "123 -- !", "bb", "x"), (None, "der die das", None, "x"),
            (503, "la les une", None, "x"), (503, "la les une", None, "x"), (504, "les " * 60_000, None, "x"),
            (505, "x" * 30_000, None, "x")]
    found = identify(docs(spark, more), PIECE_BPE)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = found.collect()
    assert len(rows) == 128 and all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[i].lang_pred == ["aa", "bb"][i % 2] for i in range(120))
    assert [(by_id[i].lang_pred, by_id[i].score) for i in (500, 501, 502)] == [("und", 0.0)] * 3
    assert (by_id[None].lang_pred, by_id[503].lang_pred, by_id[504].lang_pred) == ("bb", "aa", "aa")
    assert by_id[505].lang_pred in ("aa", "bb") and not math.isnan(by_id[505].score)


def test_held_out_labels_are_not_used(spark):
    changed = docs(spark).withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, "zz").otherwise(F.col("lang")))
    assert {r.lang_pred for r in identify(changed, PIECE_BPE).collect()} == {"aa", "bb"}


def test_nothing_learned_and_empty(spark):
    unlabelled = docs(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in identify(unlabelled, PIECE_BPE).collect()} == {("und", 0.0)}
    assert identify(docs(spark).limit(0), PIECE_BPE).count() == 0


def test_stage_keeps_rows_in_a_language(spark):
    more = [(500, None, "aa", "x"), (502, "123 -- !", "bb", "y")]
    rows = docs(spark, more)
    kept = in_a_language(rows, PIECE_BPE)
    assert kept.schema.simpleString() == rows.schema.simpleString() and LEAST_SCORE < 1
    assert sorted(r.doc_id for r in kept.collect()) == list(range(120))


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="given tables not found")
def test_held_out_accuracy_on_the_given_documents(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = identify(given, PIECE_BPE).where("held_out").join(given.select("doc_id", "lang"), "doc_id")
    right, count = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert count > 100 and right >= 0.98 * count


def test_fit_and_predict_are_usable_alone(spark):
    pieces = ["▁", *"abcdefghijklmnopqrstuvwxyz", "und", "les"]
    languages, weights = fit(docs(spark).select("doc_id", "text", "lang"), pieces, sample_docs=20, rounds=1)
    assert languages == ["aa", "bb"] and weights.shape == (len(pieces), 2)
    found = predict(docs(spark).select("score", "text").toDF("mark", "text"), pieces, languages, weights)
    assert found.columns == ["mark", "lang_pred", "score"] and found.count() == 120


def test_a_text_without_white_space_and_more_words_than_the_table_holds():
    pieces = [chr(9601), *"abcdefghij"]
    languages = [f"l{i:02}" for i in range(20)]
    weights = np.random.default_rng(1).random((len(pieces), len(languages))) + 0.1
    model = Model(pieces, languages, weights)
    words = ["".join("abcdefghij"[int(d)] for d in f"{i:06}") for i in range(model.room + 5000)]
    whole = model.text_logs(",".join(words))
    assert np.allclose(whole, Model(pieces, languages, weights).text_logs(" ".join(words)))
