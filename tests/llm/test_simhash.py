from __future__ import annotations

import random

import pytest
import xxhash

from prepframe.llm import simhash as module
from prepframe.llm.components import components
from prepframe.llm.queries import QUERIES
from prepframe.llm.simhash import BKTree, links, near_duplicates, simhash


def slow(text):
    """The definition, word by word and bit by bit."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in low).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints):
    """The smallest id reachable, comparing all pairs: [(id, fingerprint)] to {id: smallest}."""
    top = {i: i for i, _ in prints}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for n, (i, a) in enumerate(prints):
        for j, b in prints[:n]:
            if (a ^ b).bit_count() <= 2:
                a_, b_ = root(i), root(j)
                top[max(a_, b_)] = min(a_, b_)
    return {i: root(i) for i, _ in prints}


def test_like_the_definition(plain):
    for t in [t for _, t in plain[:60]] + [None, "", " \n", "A", "a b", "x\x1cy\x85z  q", "Été ÉTÉ É a"]:
        assert simhash(t) == slow(t)


def test_tree_finds_all_within_the_radius():
    draw = random.Random(2)
    values = [draw.getrandbits(10) for _ in range(300)]
    tree = BKTree()
    for v in values:
        tree.add(v)
    for v in values[:50]:
        assert sorted(tree.near(v, 2)) == [i for i, w in enumerate(values) if (v ^ w).bit_count() <= 2]


@pytest.mark.parametrize("shard", [1024, 3, 1])
@pytest.mark.parametrize("bound", [100_000, 0])
def test_links_hold_together_what_is_near(spark, monkeypatch, shard, bound):
    monkeypatch.setattr(module, "SHARD_SIZE", shard)
    monkeypatch.setattr(module, "BROADCAST_SHARDS", bound)
    draw = random.Random(shard)
    centres = [draw.getrandbits(64) for _ in range(12)] + [0, (1 << 64) - 1]
    values = {c ^ sum({1 << draw.randrange(64) for _ in range(draw.randrange(5))}) for c in centres for _ in range(12)}
    prints = list(enumerate(sorted(values)))
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v, i) for i, v in prints], "fp long, node long")
    found = {r["node"]: r["component"] for r in components(links(df)).collect()}
    assert {i: found.get(i, i) for i, _ in prints} == groups(prints)


def test_components_of_random_graphs(spark):
    draw = random.Random(5)
    for edges in ([], [(1, 1)], [(i, i + 1) for i in range(60)], [(draw.randrange(80), draw.randrange(80)) for _ in range(60)], [(0, i) for i in range(1, 50)] + [(99, 98)]):
        df = spark.createDataFrame(edges, "a long, b long")
        found = {r["node"]: r["component"] for r in components(df).collect()}
        top = {x: x for e in edges for x in e}
        for _ in top:
            for a, b in edges:
                top[a] = top[b] = min(top[a], top[b])
        assert found == {k: v for k, v in top.items() if any(a != b and k in (a, b) for a, b in edges)}


def test_query(spark, sf_dir, plain):
    rows = {r["doc_id"]: r for r in QUERIES["op6_simhash"](spark, sf_dir).collect()}
    prints = [(i, simhash(t)) for i, t in plain]
    assert {i: r["fingerprint"] for i, r in rows.items()} == {i: f"{p:016x}" for i, p in prints}
    assert {i: r["component_id"] for i, r in rows.items()} == groups(prints)


def test_cases(odd, nothing, spark):
    rows = near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["component_id"] == by[2]["component_id"] == 1
    assert by[3]["fp"] == by[4]["fp"] == 0 and by[4]["component_id"] == by[3]["component_id"] == 3
    assert by[None]["component_id"] is None
    assert near_duplicates(nothing).count() == 0
    # One id with two texts: both texts' copies hold together.
    twice = spark.createDataFrame([(5, "a b c d"), (5, "x y z w"), (7, "a b c d"), (9, "x y z w"), (None, "x y z w")], "doc_id long, text string")
    assert [r["component_id"] for r in near_duplicates(twice).collect()] == [5] * 5
