"""Near-duplicates by SimHash fingerprints and BK-trees.

A text's fingerprint has a bit for each bit set in more than half of the hashes of its word shingles. Fingerprints that
differ in at most two bits are linked; documents reachable over links form a group.

Links are searched in BK-trees, whose children are keyed by their Hamming distance to the parent, following only edges
within the radius. The trees are sharded so that a fingerprint meets only trees that can hold a partner: of four blocks
of 16 bits, two fingerprints within two bits agree in at least two, so each of the six pairs of blocks gives a shard key
and every link lies in a common shard. A shard of more than `SHARD_SIZE` fingerprints gets no tree (its search grows
with the square of its size): its fingerprints are linked through the keys one bit away from them, since two
fingerprints share such a key, or are one, if and only if they differ in at most two bits. Both ways are exact.

Cases: a text without words (null, empty, white space) has fingerprint zero, which links like any other. Fewer words
than a shingle make one shingle of all. Rows of equal id are one document for reachability. A row without an id gets
the component of its fingerprint, or null if no row with an id is reachable over its fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepframe.llm.components import components
from prepframe.llm.frames import column, longs, map_columns
from prepframe.scratch import stored

SHINGLE = 3
SEED = 42
RADIUS = 2
#: Fingerprints of a shard up to which it gets a tree.
SHARD_SIZE = 1024
#: Keys of large shards up to which their table is broadcast (12 bytes each); a join by shuffle beyond.
BROADCAST_SHARDS = 100_000

#: A-Z in lower case, all other bytes as they are.
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def shingle_hashes(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The hash of each word shingle, in order of place."""
    # Bytes split at exactly space, tab, line feed, vertical tab, form feed and carriage return.
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    line, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[: n - 1].tolist()]
    stops = (ends[-n:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], seed) for a, b in zip(starts, stops, strict=True)], "<u8")


def simhash(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint, unsigned."""
    hashes = shingle_hashes(text, shingle, seed)
    n = len(hashes)
    if not n:
        return 0
    counts = np.zeros(64, np.int64)
    for first in range(0, n, 1 << 14):
        some = hashes[first : first + (1 << 14)]
        counts += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return sum(1 << i for i in np.flatnonzero(counts * 2 > n).tolist())


def fingerprints(df: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Kept columns (all, if not said) with `fp`, the fingerprint as a signed long."""

    def start():
        def apply(texts):
            return [longs(np.array([simhash(t) for t in texts], np.uint64).astype(np.int64))]

        return apply

    return map_columns(df, df.columns if keep is None else keep, [text_col], [T.StructField("fp", T.LongType())], start)


class BKTree:
    """Fingerprints by distance to their parents."""

    def __init__(self) -> None:
        self.prints: list[int] = []
        self.children: list[dict[int, int]] = []

    def near(self, value: int, radius: int) -> list[int]:
        """The numbers of all fingerprints within the radius."""
        found, todo = [], [0] if self.prints else []
        while todo:
            node = todo.pop()
            distance = (self.prints[node] ^ value).bit_count()
            if distance <= radius:
                found.append(node)
            own = self.children[node]
            if own:
                todo.extend([own[d] for d in range(distance - radius, distance + radius + 1) if d in own])
        return found

    def add(self, value: int) -> None:
        node, new = 0, len(self.prints)
        self.prints.append(value)
        self.children.append({})
        while new:
            distance = (self.prints[node] ^ value).bit_count()
            after = self.children[node].setdefault(distance, new)
            if after == new:
                return
            node = after


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, fp, node) in order of shard: edges that hold together what the shard's tree links."""
    shard, tree, nodes, group = None, BKTree(), [], []

    def root(i: int) -> int:
        while group[i] != i:
            group[i] = i = group[group[i]]
        return i

    for batch in batches:
        out_a, out_b = [], []
        for key, fp, node in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
            if key != shard:
                shard, tree, nodes, group = key, BKTree(), [], []
            value = fp & 0xFFFFFFFFFFFFFFFF
            new = len(nodes)
            nodes.append(node)
            group.append(new)
            for other in tree.near(value, RADIUS):
                if (top := root(other)) != root(new):
                    group[top] = root(new)
                    out_a.append(node)
                    out_b.append(nodes[other])
            tree.add(value)
        yield pa.RecordBatch.from_arrays([longs(out_a), longs(out_b)], names=["a", "b"])


def _shards(fp: str) -> Column:
    """Six keys: a pair of blocks (3 bits) above the blocks' 32 bits."""
    block = [F.shiftrightunsigned(F.col(fp), 16 * k).bitwiseAND(F.lit(0xFFFF)) for k in range(4)]
    pairs = [(i, j) for i in range(4) for j in range(i + 1, 4)]
    return F.array(*[F.lit(n << 32).bitwiseOR(F.shiftleft(block[i], 16)).bitwiseOR(block[j]) for n, (i, j) in enumerate(pairs)])


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) between the nodes of distinct fingerprints (fp, node) that connect whatever lies within two bits."""
    shards = stored(prints.select(F.explode(_shards("fp")).alias("shard"), "fp", "node"), "shards")
    sizes = shards.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1")
    sizes = stored(sizes, "sizes")
    large = sizes.where(F.col("n") > SHARD_SIZE).select("shard")
    if (many := large.limit(BROADCAST_SHARDS + 1).count()) == 0:
        crowd = None
    else:
        crowd = shards.join(F.broadcast(large) if many <= BROADCAST_SHARDS else large, "shard").select("fp", "node").distinct()
    small = shards.join(sizes.where(F.col("n") <= SHARD_SIZE).select("shard"), "shard")
    edges = small.select("shard", "fp", "node").repartition("shard").sortWithinPartitions("shard").mapInArrow(_links, "a long, b long")
    return edges if crowd is None else edges.union(_ball_links(crowd))


def _ball_links(prints: DataFrame) -> DataFrame:
    """The same for fingerprints of large shards: 65 keys each, and the smallest node of each key."""
    ball = F.concat(F.array("fp"), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))
    keys = stored(prints.select(F.explode(ball).alias("key"), "node"), "balls")
    least = keys.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most").drop("most")
    return keys.join(least, "key").where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (signed long) and component_id, the smallest id reachable."""
    source = df.select(column(id_col).cast("long").alias("doc_id"), column(text_col).alias("text"))
    docs = stored(fingerprints(source, "text", ["doc_id"]), "prints")
    prints = stored(docs.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("node"), F.max("doc_id").alias("most")), "distinct")
    # Rows that share an id hold together, too.
    same = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("fp").alias("fp_a"), F.max("fp").alias("fp_b")).where("fp_a <> fp_b")
    found = links(prints.select("fp", "node"))
    if same.limit(1).count():
        repeated = docs.join(same.select("doc_id"), "doc_id").join(prints, "fp").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
        found = found.union(repeated)
    groups = components(found)
    # Only fingerprints whose rows don't stand for themselves alone need looking up.
    whole = prints.join(groups, prints["node"] == groups["node"], "left").select("fp", prints["node"], "most", "component")
    shared = whole.where("most > node OR component IS NOT NULL").select("fp", F.coalesce("component", "node").alias("component"))
    return docs.join(shared, "fp", "left").select("doc_id", "fp", F.coalesce("component", "doc_id").alias("component_id"))
