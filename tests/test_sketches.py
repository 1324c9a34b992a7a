"""Mergeable states, bounded samples and single-byte encodings."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from prepframe.operators import chartdata, sketches
from prepframe.sources import csv, encodings


@pytest.fixture()
def skewed(spark):
    draw = random.Random(1)
    rows = [(i, draw.choice("abcdefg"), "hot" if i % 3 == 0 else str(draw.randrange(5000)), None if i % 11 == 0 else float(draw.randrange(40)) ** 2) for i in range(6000)]
    return spark.createDataFrame(rows, "id long, day string, code string, x double").repartition(7)


def test_heavy_values(skewed):
    rows = skewed.collect()
    for share in (0.3, 0.05, 0.01, 0.001):
        want = {}
        for c in ("code", "x", "day"):
            present = [r[c] for r in rows if r[c] is not None]
            want |= {(c, str(v)): n for v, n in Counter(present).items() if n > share * len(present)}
        got = {(r["column"], r["value"]): r["n"] for r in sketches.heavy_values(skewed, ["code", "x", "day"], share).collect()}
        by_day = sketches.frequency_states(skewed, ["code", "x", "day"], ["day"])
        merged = {(r["column"], r["value"]): r["n"] for r in sketches.heavy_values(skewed, ["code", "x", "day"], share, by_day).collect()}
        assert got == merged == want
    assert sketches.heavy_values(skewed.limit(0), ["code"], 0.1).count() == 0
    for share in (0, 1.5, 1e-6):
        with pytest.raises(ValueError):
            sketches.heavy_values(skewed, ["code"], share)


def test_quantile_states(skewed):
    values = sorted(r["x"] for r in skewed.collect() if r["x"] is not None)
    by_day = sketches.quantile_states(skewed, ["x"], ["day"])
    assert by_day.count() == 7 and by_day.agg(F.sum("n")).first()[0] == len(values)
    for states in (sketches.merge_quantile_states(by_day), sketches.quantile_states(skewed, ["x"])):
        for r in sketches.state_quantiles(states, [0.0, 0.1, 0.5, 1.0]).collect():
            below, upto = sum(v < r["value"] for v in values), sum(v <= r["value"] for v in values)
            assert below / len(values) - 0.01 <= r["share"] <= upto / len(values) + 0.01 and r["n"] == len(values)
    with pytest.raises(ValueError):
        sketches.state_quantiles(by_day, [2])


def test_distinct_states(skewed):
    merged = sketches.merge_distinct_states(sketches.distinct_states(skewed, ["code", "x"], ["day"]))
    exact = skewed.agg(F.count_distinct("code").alias("code"), F.count_distinct("x").alias("x")).first()
    found = {r["column"]: r["distinct"] for r in sketches.distinct_counts(merged).collect()}
    assert all(abs(found[c] - exact[c]) <= 0.05 * exact[c] for c in ("code", "x"))


def test_scatter_sample(skewed):
    some = chartdata.scatter_sample(skewed, "id", "x", "id", 50, hue="day")
    again = chartdata.scatter_sample(skewed.repartition(3).orderBy(F.desc("x")), "id", "x", "id", 50, hue="day")
    assert some.collect() == again.collect() and some.count() == 50 and some.columns == ["x", "y", "hue"]
    assert some.where("y IS NULL").count() == 0
    more = {r["x"] for r in chartdata.scatter_sample(skewed, "id", "x", "id", 80).collect()}
    assert {r["x"] for r in some.collect()} <= more
    assert chartdata.scatter_sample(skewed, "id", "x", "id", 10**6).count() == skewed.where("x IS NOT NULL").count()


TEXTS = {
    "polish": "Zażółć gęślą jaźń. Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
    "czech": "Všichni lidé rodí se svobodní a sobě rovní co do důstojnosti a práv. Příliš žluťoučký kůň.",
    "french": "Tous les êtres humains naissent libres et égaux en dignité et en droits, où ça ? À l'école.",
    "german": "Alle Menschen sind frei und gleich an Würde geboren; größer, schöner, Öl, Äpfel.",
    "spanish": "Todos los seres humanos nacen libres e iguales en dignidad; el niño soñó mañana, ¿qué?",
}


@pytest.mark.parametrize("language, encoding", [("polish", "windows-1250"), ("polish", "ISO-8859-2"), ("czech", "windows-1250"), ("czech", "ISO-8859-2"), ("french", "ISO-8859-1"), ("german", "ISO-8859-1"), ("spanish", "ISO-8859-1"), ("polish", "UTF-8"), ("french", "UTF-8")])
def test_encodings(spark, tmp_path, language, encoding):
    text = TEXTS[language]
    body = "\n".join(["nazwa;słowo" if encoding != "ISO-8859-1" else "nom;élève", *[f"{w};{i}" for i, w in enumerate(text.replace(";", "").split())]])
    (tmp_path / "t.csv").write_bytes(body.encode(encoding))
    path = str(tmp_path / "t.csv")
    assert csv.dialects(spark, path).first()["encoding"] == encoding
    df = csv.read_csv(spark, path)
    assert df.columns == body.split("\n")[0].split(";")
    assert sorted(r[0] for r in df.collect()) == sorted(text.replace(";", "").split())
    assert csv.dialects(spark, path, "ISO-8859-1").first()["encoding"] in ("UTF-8", "ISO-8859-1")


def test_characters():
    assert encodings.characters("ISO-8859-1")[0x69] == "é" and encodings.characters("windows-1250")[0x39] == "ą"
    assert all(len(encodings._scores(e)) == encodings.KINDS * 128 for e in encodings.CANDIDATES)
    assert encodings.decoded_name("za¿ó³æ", "windows-1250") == "zażółć" and encodings.decoded_name("é", "UTF-8") == "é"


def test_bootstrap_band(spark):
    draw = random.Random(7)
    rows = [(i, "ab"[i % 2], draw.gauss(10 * (i % 2), 3)) for i in range(1200)] + [(5000, "one", 4.0), (5001, None, 1.0), (5002, "a", None)]
    df = spark.createDataFrame(rows, "id long, k string, v double")
    closed = {r["k"]: r for r in chartdata.line_series(df, "k", "v").collect()}
    found = {r["k"]: r for r in chartdata.line_band(df, "k", "v", "id", replicates=4000).collect()}
    assert set(found) == set(closed) == {"a", "b", "one"}
    for k in "ab":
        want, got = closed[k], found[k]
        assert got["n"] == want["n"] and got["mean_y"] == pytest.approx(want["mean_y"])
        assert got["high"] - got["low"] == pytest.approx(want["high"] - want["low"], rel=0.03)
    assert (found["one"]["low"], found["one"]["high"], found["one"]["n"]) == (4.0, 4.0, 1)
    some = chartdata.line_band(df, "k", "v", "id", replicates=40).collect()
    again = chartdata.line_band(df.repartition(5).orderBy(F.desc("v")), "k", "v", "id", replicates=40).collect()
    for a, b in zip(some, again, strict=True):
        assert a["k"] == b["k"] and (a["low"], a["high"]) == pytest.approx((b["low"], b["high"]), rel=1e-12)
    assert chartdata.line_band(df.limit(0), "k", "v", "id").count() == 0
    for bad in ({"replicates": 6}, {"level": 1}, {"keys": []}):
        with pytest.raises(ValueError):
            chartdata.line_band(df, "k", "v", **{"keys": "id", **bad})
