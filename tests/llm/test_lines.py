from __future__ import annotations

import random
import time

import pytest

from check import compare, connect
from prepframe.llm import line_dedup
from prepframe.llm.line_dedup import Cutter, remove_repeated_passages
from prepframe.llm.queries import ORACLES, QUERIES


def prose(seed, words):
    """Sentences of words that occur nowhere else."""
    draw = random.Random(seed)
    out = []
    for i in range(words):
        out.append("".join(draw.choices("abcdefghijklmnop", k=draw.randint(2, 9))) + ("." if i % 9 == 8 else ""))
    return " ".join(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_query(spark, sf_dir):
    assert compare(QUERIES["op3_line_dedup"](spark, sf_dir), connect(sf_dir), ORACLES["op3_line_dedup"]) is None


def test_offsets_give_back_the_text(docs):
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = remove_repeated_passages(docs).collect()
    assert any(r["n_removed"] for r in rows)
    for r in rows:
        text, left, at = before[r["doc_id"]], [], 0
        for s in r["removed"]:
            left.append(text[at : s["start"]])
            at = s["end"]
        assert r["text"] == "".join([*left, text[at:]]) and bool(r["removed"]) == bool(r["n_removed"])


def test_units():
    for text in ("", " \n ", "a", " a b.c. D\n\n e ", "Ein Satz. Noch einer!\nZeile", "中文。中文 a.。b", "a\x1cb\x85c d", prose(1, 500)):
        raw = text.encode()
        units = list(Cutter().units(raw))
        assert b"".join(u for *_, u in units).replace(b" ", b"") == b"".join(raw.lower().split())
        assert [raw[s : s + 1].lower() for s, _, _ in units] == [u[:1] for *_, u in units]
        assert all(n >= len(u.split()) for _, n, u in units)
    # cut alike wherever it stands
    inside, alone = [[u for *_, u in Cutter().units(t.encode())] for t in ("x y " + prose(2, 200) + " z", prose(2, 200))]
    assert set(alone[1:-1]) <= set(inside)


@pytest.mark.parametrize("bound", [line_dedup.BROADCAST_DIGESTS, 0])
def test_passages(spark, monkeypatch, bound):
    """Passages inside lines and over line breaks go from all but the earliest document; short repeats stay."""
    monkeypatch.setattr(line_dedup, "BROADCAST_DIGESTS", bound)
    passage, short = prose(7, 70), prose(8, 20)
    rows = [(i, f"{prose(100 + i, 30)} {passage} {prose(200 + i, 30)}\n{short}\n{prose(300 + i, 20)}") for i in range(12)]
    rows += [(20, prose(400, 100).upper()), (21, prose(401, 40) + " " + prose(400, 100)), (None, passage.replace(" ", "\t "))]
    rows += [(30, "\n".join([prose(500, 15)] * 3)), (31, prose(500, 15))]
    found = {r["doc_id"]: r for r in remove_repeated_passages(frame(spark, rows)).collect()}
    texts = dict(rows)
    kept = {0, 20, 30, 31}
    assert {i for i, r in found.items() if not r["n_removed"]} == kept and all(found[i]["text"] == texts[i] for i in kept)
    for i in range(1, 12):
        assert short in found[i]["text"] and prose(300 + i, 20) in found[i]["text"] and len(found[i]["removed"]) == 1
        words = len(texts[i].split()) - len(found[i]["text"].split())
        assert 40 <= words <= 70
    assert len(found[21]["text"].split()) < 60 and len(found[None]["text"].split()) < 30


def test_chance_units_inside_a_passage(spark):
    """A unit whose earliest copy stands elsewhere doesn't break the stretch."""
    passage = f"{prose(1, 27)} It is so. {prose(2, 27)}"
    rows = [(0, "It is so."), (1, passage), (2, passage + " " + prose(3, 30))]
    found = {r["doc_id"]: r for r in remove_repeated_passages(frame(spark, rows)).collect()}
    assert found[1]["n_removed"] == 0 and found[2]["text"].split() == prose(3, 30).split() and len(found[2]["removed"]) == 1


def test_scripts_without_spaces(spark):
    passage = "。".join("这是一个在语料库中重复出现的很长的段落" + chr(0x4E00 + k) for k in range(6)) + "。"
    rows = [(1, passage), (2, "开头不同。" + passage), (3, "这是一个。")]
    found = {r["doc_id"]: r["n_removed"] for r in remove_repeated_passages(frame(spark, rows)).collect()}
    assert found[1] == found[3] == 0 and found[2] > 0


def test_long_text(spark):
    """A hundred thousand lines in one text, and a copy of it."""
    lines = [f"line {i} of many" for i in range(20_000)] + ["the same line"] * 80_000
    rows = [(1, "\n".join(lines)), (2, "\n".join(lines)), (3, "the same line")]
    start = time.time()
    found = {r["doc_id"]: r for r in remove_repeated_passages(frame(spark, rows)).collect()}
    assert time.time() - start < 60
    assert found[1]["n_removed"] == 0 and found[2]["n_removed"] >= 20_000


def test_cases(spark, odd, nothing):
    rows = remove_repeated_passages(odd, min_words=14).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_removed"] == 0 and by[2]["text"] == "" and by[2]["removed"][0]["start"] == 0
    assert [r["text"] for r in rows if r["doc_id"] == 2] == ["", ""]
    assert by[10]["text"] == "" and by[3]["text"] is None and by[4]["text"] == "" and by[9]["text"] == "one"
    assert remove_repeated_passages(nothing).count() == 0
