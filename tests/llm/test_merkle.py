from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from check import compare, connect
from prepframe.llm import merkle
from prepframe.llm.merkle import FAN, SPAN, folded, height, manifest, rounds, sweep_down, sweep_up
from prepframe.llm.queries import ORACLES, QUERIES

FIELDS = ["doc_id", "source", "text"]


def h(parts):
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def leaf(row):
    return h(b"-" if v is None else b"%d:%s" % (len(str(v).encode()), str(v).encode()) for v in row)


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(out[-1][i : i + FAN]) for i in range(0, len(out[-1]), FAN)])
    return out


def siblings(tree, i):
    out = []
    for level in tree[:-1]:
        a = i // FAN * FAN
        out += [b"".join(level[a:i]), b"".join(level[i + 1 : a + FAN])]
        i //= FAN
    return out


def brute(rows):
    """(doc_id, leaf, subroot, root, proof_sha256) of rows (doc_id, source, text), trees built whole."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0] is not None, r[0], leaf(r)))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = [levels([x for _, _, x in sorted(by[s], key=lambda t: (t[0], t[1] or 0, t[2]))]) for s in names]
    top = levels([t[-1][0] for t in trees])
    out = []
    for k, (s, tree) in enumerate(zip(names, trees, strict=True)):
        for i, (_, doc, own) in enumerate(sorted(by[s], key=lambda t: (t[0], t[1] or 0, t[2]))):
            proof = h([*siblings(tree, i), *siblings(top, k)])
            out.append((doc, *[x.decode() for x in (own, tree[-1][0], top[-1][0], proof)]))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: [(x is not None, x) for x in r])


def test_query(spark, sf_dir):
    assert compare(QUERIES["op11_merkle"](spark, sf_dir), connect(sf_dir), ORACLES["op11_merkle"]) is None


def test_sweeps():
    """Block by block, whatever the number of nodes: the same tops and proofs as the whole tree."""
    for size in (1, 2, FAN, FAN + 1, SPAN - 1, SPAN, SPAN + 1, 3 * SPAN + FAN + 1):
        nodes = [h([b"%d" % i]) for i in range(size)]
        whole = levels(nodes)
        assert height(size) == len(whole) - 1 and rounds(size) == max(1, -(-height(size) // 2))
        for first in range(0, size, SPAN):
            own = nodes[first : first + SPAN]
            top, children = sweep_up(first, own, size)
            up = min(merkle.DEPTH, height(size))
            assert top == whole[up][first // FAN**up]
            assert all(whole[level - 1][i * FAN : i * FAN + len(run)] == run for (level, i), run in children.items())
            for k, proof in sweep_down(first, own, size, []):
                assert proof == siblings(whole[: up + 1], first + k)
                assert folded(own[k], proof) == top


@pytest.mark.parametrize("broadcast", [merkle.BROADCAST_SOURCES, 0])
def test_by_brute_force(spark, monkeypatch, broadcast):
    """One source with several blocks, many small ones, ties, nulls and equal rows."""
    monkeypatch.setattr(merkle, "BROADCAST_SOURCES", broadcast)
    draw = random.Random(5)
    rows = [(i, "big", f"text {i}") for i in range(2 * SPAN + 37)] + [(7, "big", "another"), (7, "big", "another")]
    rows += [(1000 + i, f"s{i % 300}", draw.choice(["", "é", None, "x" * 5000])) for i in range(700)]
    rows += [(None, None, "a"), (None, "big", None), (None, "big", "b"), (3, None, "c"), (-5, "big", "d"), (9, "", "e")]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(7)
    found = manifest(df, FIELDS, proofs=True).collect()
    assert ordered(tuple(r)[:5] for r in found) == ordered(brute(rows))
    assert all(r["verified"] and r["folded_root"] == r["root"] for r in found)
    for r in found[:50]:
        assert hashlib.sha256("".join(r["proof"]).encode()).hexdigest() == r["proof_sha256"]
        assert folded(r["leaf"].encode(), [x.encode() for x in r["proof"]]).decode() == r["root"]


def test_tampered(spark):
    df = spark.createDataFrame([(i, "s", f"T{i}") for i in range(40)], "doc_id long, source string, text string")
    other = F.when(F.col("doc_id") % 4 == 0, merkle.leaf_digest([F.col("doc_id"), F.col("source"), F.lower("text")]))
    rows = manifest(df, FIELDS, other=other).collect()
    assert {r["doc_id"] for r in rows if not r["verified"]} == set(range(0, 40, 4))
    same = manifest(df, FIELDS, other=merkle.leaf_digest([F.col(f) for f in FIELDS])).collect()
    assert all(r["verified"] for r in same)


def test_cases(odd, nothing):
    names = ["doc_id", "source", "lang", "n_chars", "text", "a.b", "k0"]
    rows = manifest(odd, names).collect()
    assert len(rows) == odd.count() and len({r["root"] for r in rows}) == 1 and all(r["verified"] for r in rows)
    twice = [r for r in rows if r["doc_id"] == 2]
    assert len(twice) == 2 and twice[0]["leaf"] == twice[1]["leaf"]
    # one row is a tree without levels
    one = manifest(odd.where("doc_id = 9"), names).first()
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof_sha256"] == hashlib.sha256(b"").hexdigest()
    assert manifest(nothing, names).count() == 0


def test_no_rows(spark):
    """A table without rows has no tree, and so no block to hand a root to."""
    df = spark.createDataFrame([], "doc_id long, source string, text string")
    for other in (None, merkle.leaf_digest([F.col("doc_id"), F.lower("text")])):
        found = manifest(df, FIELDS, other=other, proofs=True)
        assert found.columns[0] == "doc_id" and found.columns[-1] == "proof" and found.collect() == []
