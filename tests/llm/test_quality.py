from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from prepframe.llm import quality
from prepframe.llm.quality import CUT, FEATURES, features, fit_pairs, fit_ranking, score_quality
from prepframe.llm.queries import QUERIES


def test_pairs_reach_the_minimum():
    draw = np.random.default_rng(1)
    good, bad = draw.normal(0.5, 1, (200, 4)), draw.normal(0, 1, (200, 4))
    w = fit_pairs(good, bad, 5000)
    again = np.random.default_rng(0)
    x = good[again.integers(200, size=5000)] - bad[again.integers(200, size=5000)]
    p = 1 / (1 + np.exp(x @ w))
    assert np.abs(quality.RIDGE * w - x.T @ p / len(x)).max() < 1e-6


def test_held_out(spark, sf_dir):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = QUERIES["op8_quality"](spark, "/root/testdata/sf0.01")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    good, bad = [r["score"] for r in rows if r["quality"] == 1], [r["score"] for r in rows if r["quality"] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert sum((r["predicted"] == 1) == (r["quality"] == 1) for r in rows) / len(rows) > 0.93
    assert all((r["predicted"] == 1) == (r["score"] >= CUT) and 0 <= r["score"] <= 1 for r in found.collect())


def test_cut_is_the_quantile_of_all_labelled_rows(spark, docs, monkeypatch):
    """However small the sample that the weights come from, and on both sides of the broadcast's bound."""
    marks = docs.select("doc_id", (F.length("text") % 3 > 0).cast("int").alias("quality"))
    marks = marks.union(marks.where("doc_id < 40"))  # repeated labels weigh twice
    for bound in (quality.BROADCAST_LABELS, 3):
        monkeypatch.setattr(quality, "BROADCAST_LABELS", bound)
        ranking = fit_ranking(docs, marks, per_class=15)
        rows = docs.join(marks, "doc_id").select("text", "quality").collect()
        z = sorted(ranking.place(r["text"]) for r in rows)
        share = sum(r["quality"] == 0 for r in rows)
        above = [v for v in z if v > z[share - 1]]
        assert abs(ranking.cut - (z[share - 1] + above[0]) / 2) < 1e-6 * (z[-1] - z[0] + 1)


def test_features():
    for t in (None, "", " ", "a", "A!! B!!", "x" * 100_000, "é|é\n" * 50, "\U0001f642"):
        own = features(t)
        assert own.shape == (FEATURES,) and np.isfinite(own).all()
    assert (features(None) == features("")).all()


def test_cases(odd, nothing, docs, spark):
    labels = spark.createDataFrame([(1, 1), (2, 1), (8, 0), (8, 0), (77, 0), (None, 1), (4, None), (9, 2)], "doc_id long, quality int")
    ranking = fit_ranking(odd, labels)
    rows = score_quality(odd, ranking).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    by = {r["doc_id"]: r["score"] for r in rows}
    assert by[1] == by[2] > by[8] and by[3] == by[4]
    assert score_quality(nothing, ranking).count() == 0
    for none in (labels.limit(0), labels.where("quality = 1"), labels.where("doc_id = 77 OR quality = 1")):
        assert {(r["score"], r["predicted"]) for r in score_quality(odd, fit_ranking(odd, none)).collect()} == {(1.0, 1)}
    assert fit_ranking(nothing, labels).slope == 0
    # The order of rows doesn't matter.
    marks = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    a, b = fit_ranking(docs, marks), fit_ranking(docs.orderBy(F.desc("doc_id")).repartition(5), marks)
    assert np.allclose(a.weights, b.weights) and abs(a.cut - b.cut) < 1e-9
