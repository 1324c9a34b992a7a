from __future__ import annotations

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from prepframe.llm import lang_id
from prepframe.llm.lang_id import SCRIPTS, SWITCH, LanguageModel, words_of
from prepframe.llm.queries import QUERIES


def model(n=3):
    prior = np.log(np.arange(1, n + 1) / sum(range(1, n + 1)))
    return LanguageModel([f"l{i}" for i in range(n)], np.zeros((2 * lang_id.BUCKETS, n)), np.ones((SCRIPTS, n), bool), prior)


def worth(m, score, path):
    return m.prior[path[0]] + sum(score[i][p] for i, p in enumerate(path)) - SWITCH * sum(a != b for a, b in zip(path, path[1:], strict=False))


@pytest.mark.parametrize("spread", [1.0, 6.0, 15.0])
def test_path_is_the_best_of_all(spread):
    draw, m = np.random.default_rng(3), model()
    for _ in range(60):
        score = draw.normal(0, spread, (5, 3))
        best = max(worth(m, score, p) for p in product(range(3), repeat=5))
        assert worth(m, score, m.path(score).tolist()) == pytest.approx(best)


def test_words_and_scripts():
    w = words_of("A b1c été éx Ж")
    assert list(zip(w.starts, w.ends, strict=True)) == [(0, 1), (2, 3), (4, 5), (6, 9), (10, 13), (14, 15)]
    assert w.scripts.tolist() == [1, 1, 1, 1, 1, 3]
    assert words_of("12 !") is None and words_of(None) is None and words_of("") is None


def test_held_out_accuracy(spark, sf_dir):
    found = QUERIES["op1_language_id"](spark, sf_dir)
    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    row = found.where("held_out").join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.min("score").alias("low"), F.max("score").alias("high")).first()
    assert row["right"] >= 0.98 and 0 <= row["low"] <= row["high"] <= 1


def test_mixed_text_has_spans(docs):
    by = {r["lang"]: r["text"] for r in docs.where("length(text) > 1500 AND text NOT LIKE '%$%' AND text NOT LIKE '%|%'").groupBy("lang").agg(F.min("text").alias("text")).collect()}
    m = lang_id.fit_language_model(docs)
    both = by["en"][:900] + "\n" + by["de"][:500]
    lang, score, spans = m.label(both)
    assert lang == "en" and 0.5 < score < 0.8
    assert [s["lang"] for s in spans] == ["en", "de"] and abs(spans[1]["start"] - 901) < 60


def test_cases(odd, nothing):
    m = lang_id.fit_language_model(odd)
    assert m.languages == ["de", "en", "fr"]
    rows = lang_id.label_languages(odd, m).collect()
    assert len(rows) == odd.count() and "a.b" in rows[0].asDict()
    by = {r["doc_id"]: r for r in rows}
    assert [by[i]["lang_pred"] for i in (3, 4, 5, 8)] == ["und"] * 4 and by[4]["score"] == 0 and by[3]["lang_spans"] == []
    assert by[1]["lang_pred"] == by[2]["lang_pred"] and by[6]["lang_pred"] in m.languages
    assert lang_id.label_languages(nothing, m).count() == 0
    empty = lang_id.fit_language_model(nothing)
    assert {r["lang_pred"] for r in lang_id.label_languages(odd, empty).collect()} == {"und"}


def test_copies_of_a_text_leave_the_others_in_the_sample(spark):
    rows = [("Schöne Grüße aus der Stadt", "de")] * 5000 + [(f"Das Wetter ist heute {k} Grad wärmer geworden", "de") for k in range(10)] + [(f"The weather is {k} degrees warmer today", "en") for k in range(20)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    m = lang_id.fit_language_model(df, per_language=5)
    assert m.languages == ["de", "en"] and m.allowed[1].all() and m.prior[0] > m.prior[1]
    assert m.label("Das Wetter ist wärmer geworden")[0] == "de" and m.label("The weather is warmer")[0] == "en"
    few, many = lang_id.fit_language_model(df.distinct()), lang_id.fit_language_model(df)
    assert np.allclose(few.grams, many.grams)  # copies count once


def test_unknown_script_goes_by_shares():
    m = model()
    m.allowed[3] = False
    assert m.label("ЖЖ Ж")[0] == "l2"
