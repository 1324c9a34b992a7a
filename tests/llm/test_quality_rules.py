from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from prepframe.llm.queries import QUERIES
from prepframe.llm.quality_rules import KEEP, MONOTONE, STATISTICS, TREE_DEPTH, apply_rules, fit_rules, grow, measure


def counts(text):
    """The five counts and the base rules, window by window."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), failed


def walk(forest, x):
    """A row's score, node by node."""
    total = forest.start
    for node in forest.roots:
        for _ in range(TREE_DEPTH):
            node = forest.left[node] if x[forest.feature[node]] <= forest.threshold[node] else forest.right[node]
        total += forest.value[node]
    return 1 / (1 + np.exp(-total))


@pytest.fixture(scope="module")
def larger(spark):
    return "/root/testdata/sf0.01"


def test_query(spark, larger):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{larger}/documents.parquet").collect()}
    rows = QUERIES["op12_quality_rules"](spark, larger).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r)[1:7] == counts(texts[r["doc_id"]])
        assert r["kept"] == (not r["base_failed"] and r["score"] >= KEEP)


def test_held_out(spark, larger):
    labels = spark.read.parquet(f"{larger}/labels.parquet").withColumnRenamed("doc_id", "id")
    found = QUERIES["op12_quality_rules"](spark, larger)
    rows = found.join(labels, found["doc_id"] == labels["id"]).where("crc32(CAST(doc_id AS STRING)) % 5 = 0 AND NOT base_failed").collect()
    assert sum(r["kept"] == (r["quality"] == 1) for r in rows) / len(rows) > 0.93
    assert sum(r["kept"] for r in rows if r["quality"] == 1) / sum(r["quality"] for r in rows) > 0.95


def test_trees():
    draw = np.random.default_rng(3)
    x = draw.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float) * (x[:, 2] < 1)
    signs = np.array([0, 0, -1, 1])
    forest = grow(x, y, signs, 40)
    scores = forest.score(x)
    assert np.allclose(scores, [walk(forest, r) for r in x])
    assert ((scores > 0.5) == (y == 1)).mean() > 0.95
    # a stump's split is the best of all
    stump = grow(x[:, :1], (x[:, 0] > 0.3).astype(float), np.zeros(1), 1)
    assert abs(stump.threshold[stump.roots[0]] - 0.3) < 0.1
    # along a constrained column no score moves the wrong way
    for f, sign in ((2, -1), (3, 1)):
        rows = np.repeat(x[:200], 41, axis=0)
        rows[:, f] = np.tile(np.linspace(-4, 4, 41), 200)
        steps = np.diff(forest.score(rows).reshape(200, 41), axis=1)
        assert (sign * steps >= 0).all()


def test_query_is_monotone(spark, sf_dir, docs):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    forest = fit_rules(docs, labels)
    x = measure([r["text"] for r in docs.limit(50).collect()]).statistics
    for name in MONOTONE:
        rows = np.repeat(x, 21, axis=0)
        rows[:, STATISTICS.index(name)] = np.tile(np.linspace(0, 1, 21), len(x))
        assert (np.diff(forest.score(rows).reshape(-1, 21), axis=1) <= 0).all()


def test_measure():
    texts = [None, "", " \n ", "a", "x y " * 40, "one\none\n two\n\n\none", "\x1c a\x85b c", "é" * 70_000, "w " * 50_000, "a b c d e f g h i a b c d e f g h"]
    found = measure(texts)
    for k, t in enumerate(texts):
        want = counts(t)
        got = (found.n_words[k], found.word_chars[k], found.n_symbols[k], found.n_dup_lines[k], found.n_repeat_words[k], found.failed()[k])
        assert tuple(map(int, got)) == tuple(map(int, want))
        assert (measure([t]).statistics[0] == found.statistics[k]).all() and np.isfinite(found.statistics[k]).all()


def test_cases(spark, odd, nothing, docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (8, 0), (77, 0), (None, 1), (4, None), (9, 2)], "doc_id long, quality int")
    forest = fit_rules(odd, labels)
    rows = apply_rules(odd, forest).collect()
    assert len(rows) == odd.count()
    assert all(r["base_failed"] and not r["kept"] for r in rows if not r["text"])
    assert apply_rules(nothing, forest).count() == 0
    for none in (labels.limit(0), labels.where("quality = 1")):
        assert all(r["kept"] != r["base_failed"] and r["score"] == 1 for r in apply_rules(odd, fit_rules(odd, none)).collect())
    marks = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS quality")
    a, b = fit_rules(docs, marks), fit_rules(docs.orderBy("text").repartition(5), marks.union(marks))
    assert (a.threshold == b.threshold).all() and (a.value == b.value).all()
