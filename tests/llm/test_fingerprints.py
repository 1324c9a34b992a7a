from __future__ import annotations

import hashlib

import numpy as np
import pytest

from prepframe.llm import fingerprints
from prepframe.llm.fingerprints import GRAM, WINDOW, compare_with_next, fingerprint, likeness, winnow
from prepframe.llm.queries import QUERIES

MASK = (1 << 64) - 1


def slow(text, gram=GRAM, window=WINDOW):
    """The definition, gram by gram and window by window."""
    if not text:
        return [], []
    codes = [ord(c) + 1 for c in text]
    gram = min(gram, len(codes), GRAM if len(codes) >= fingerprints.SHORT else fingerprints.SHORT_GRAM)
    base = int(fingerprints._BASE[0])
    hashes = []
    for i in range(len(codes) - gram + 1):
        total = 0
        for c in codes[i : i + gram]:
            total = (total * base + c) & MASK
        total ^= total >> 29
        total = (total * 0xBF58476D1CE4E5B9) & MASK
        total ^= total >> 32
        hashes.append(total >> 24)
    part = max(1, len(hashes) // fingerprints.SHARE)
    window = min(window, max(fingerprints.LEAST, 1 << (part.bit_length() - 1)))
    spots = set()
    for i in range(max(1, len(hashes) - window + 1)):
        own = hashes[i : i + window]
        spots.add(i + max(k for k, h in enumerate(own) if h == min(own)))
    spots = sorted(spots)
    return [hashes[s] for s in spots], spots


@pytest.mark.parametrize("stretch", [1 << 20, 100])
def test_like_the_definition(plain, monkeypatch, stretch):
    monkeypatch.setattr(fingerprints, "STRETCH", stretch)
    texts = [t[:900] for _, t in plain[:25]] + ["a" * 500, "ab" * 300, "", "x", "abcdefg", "abcdefghijklmnop" * 9, "\U0001f642" * 90]
    for t in texts:
        hashes, spots = winnow(t)
        assert (hashes.tolist(), spots.tolist()) == slow(t)


def test_shared_passage_shares_a_hash(plain):
    long = [t for _, t in plain if len(t) > 1500][:6]
    for a, b in zip(long, long[1:], strict=False):
        passage = a[200 : 200 + WINDOW + GRAM - 1]
        assert np.intersect1d(winnow(a)[0], winnow(b[:700] + passage + b[700:])[0]).size


def alike(a, b):
    """Shared hashes as a part of all, both texts at the smaller gram and window."""
    sizes = [fingerprints.measures(len(x)) for x in (a, b) if x] or [(1, 1)]
    gram, window = (min(x) for x in zip(*sizes, strict=True))
    x, y = set(slow(a, gram, window)[0]), set(slow(b, gram, window)[0])
    return len(x & y) / len(x | y) if x | y else 1.0


def brute(rows, longest):
    """Rows by falling id with what the query should say, where both texts are short."""
    rows = sorted(rows, key=lambda r: -r[0])
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        text, after = text or "", after or ""
        if max(len(text), len(after)) > longest:
            continue
        n = len(text) // 3
        other = text[: len(text) - n] + after[:n]
        yield i, len(text), hashlib.sha256(other.encode()).hexdigest(), alike(text, other), alike(text, after)


@pytest.mark.parametrize("parts", ["8", "1", "37"])
def test_query(spark, sf_dir, plain, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = QUERIES["op4_fingerprints"](spark, sf_dir).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    found = {r["doc_id"]: (r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in rows}
    assert len(rows) == len(plain)
    wanted = [*brute(plain, 1000)]
    assert len(wanted) > 5
    for want in wanted:
        assert found[want[0]] == pytest.approx(want)
    # All edited texts, the last one's included.
    order = sorted(plain, key=lambda r: -r[0])
    for (i, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        assert found[i][2] == hashlib.sha256((text[: len(text) - len(text) // 3] + after[: len(text) // 3]).encode()).hexdigest()


def test_cases(odd, nothing, spark):
    rows = compare_with_next(odd).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[3]["n_chars"] == 0 and by[3]["fingerprint"] == "" and by[4]["near_next"] == 1.0 and by[4]["near_edited"] == 1.0
    assert by[2]["fingerprint"] == by[1]["fingerprint"] and sorted(r["near_next"] for r in rows if r["doc_id"] == 2) == [1.0, 1.0]
    assert by[None]["n_chars"] == 49
    assert compare_with_next(nothing).count() == 0
    one = compare_with_next(spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")).collect()
    assert one[0]["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and one[0]["near_next"] == 1.0
    assert fingerprint(odd).columns == [*odd.columns, "fingerprint"] and fingerprint(odd).count() == odd.count()


@pytest.mark.parametrize("left", [70, 63, 60])
def test_one_gram_for_two_texts(spark, left):
    """A text of 90 code points keeps its likeness to its edited text on either side of the short texts' limit."""
    text = "".join(chr(97 + k * k * 7 % 26) + chr(97 + k * 5 % 23) for k in range(45))
    rows = [(2, text), (1, "Z" * (left - 60))]
    found = {r["doc_id"]: r for r in compare_with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(text) == 90 and found[2]["near_edited"] > 0.3


def test_likeness():
    a, none = np.array([1, 2, 3, 3], np.uint64), np.zeros(0, np.uint64)
    assert likeness(a, a) == 1 and likeness(none, none) == 1 and likeness(a, none) == 0
    assert likeness(a, np.array([3, 4], np.uint64)) == 0.25
