"""A Merkle manifest of a table: every row a leaf, one tree for each source, one tree over the sources' roots.

A leaf hashes the row's fields, a node the hex digests of up to `FAN` children in order. Rows are numbered in order of
(source, id), and time-forward processing sends digests up the trees: nodes are labelled by the place of their last
leaf, then by level, so that children come before parents; a node's digest goes into a priority queue under the label
of its parent, and a parent is computed once the sweep reaches its label. A second sweep in reversed label order hands
each child its siblings and all that its parent was handed, which is the leaf's proof: for each level the digests left
and right of the path. The queue is external: a tree is swept in blocks of `SPAN` nodes, what a block sends to
or receives from the level above is written to the shared folder, and Spark's sorted shuffle brings it to the block it
is meant for, ahead of the block's nodes. A task holds one block and the queue of one path, whatever the tree's size.

Cases: null fields hash as `-`. Rows without an id come first in their source, rows without a source form the first
source. Rows of equal source and id are leaves of their own, in order of their digests; those that agree in everything
have equal leaves, and which of them has which place is open. Empty and very long texts are hashed whole. A table
without rows gives no rows. Columns not named are left alone.
"""

from __future__ import annotations

from binascii import hexlify
from collections.abc import Iterator
from hashlib import sha256
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from prepframe.llm.frames import column, steps
from prepframe.operators.rowid import ROW_ID, number_rows
from prepframe.scratch import stored

FAN = 16
#: Levels that one round climbs, and nodes of a block.
DEPTH = 2
SPAN = FAN**DEPTH
#: Sources up to which their table is broadcast (48 bytes each). Beyond, only those with more than 1/HOT_SHARE of the
#: rows are, of which there are fewer than HOT_SHARE; the rest is joined by shuffle.
BROADCAST_SOURCES, HOT_SHARE = 100_000, 1_000


def field_text(c: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value as text."""
    text = c.cast("string")
    return F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(fields: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field_text(c) for c in fields]).cast("binary"), 256))


def height(size: int) -> int:
    """Levels above `size` nodes."""
    levels = 0
    while size > 1:
        size, levels = -(-size // FAN), levels + 1
    return levels


def rounds(size: int) -> int:
    return max(1, -(-height(size) // DEPTH))


def _label(level: int, index: int, size: int) -> tuple[int, int, int]:
    """When a node's turn comes: after its last leaf, lower levels first."""
    return min((index + 1) * FAN**level, size) - 1, level, index


def sweep_up(first: int, digests: list[bytes], size: int) -> tuple[bytes, dict[tuple[int, int], list[bytes]]]:
    """A block's top, and the children of each of its nodes. `digests` (hex) stand from `first` in a level of `size` nodes."""
    top, queue, children = min(DEPTH, height(size)), [], {}
    done = digests[0]
    for place, leaf in enumerate(digests, first):
        if top:
            heappush(queue, (_label(1, place // FAN, size), place, leaf))
        while queue and queue[0][0][0] == place:
            label, run = queue[0][0], []
            while queue and queue[0][0] == label:
                run.append(heappop(queue)[2])
            _, level, index = label
            children[level, index] = run
            done = hexlify(sha256(b"".join(run)).digest())
            if level < top:
                heappush(queue, (_label(level + 1, index // FAN, size), index, done))
    return done, children


def sweep_down(first: int, digests: list[bytes], size: int, proof: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """(number in the block, proof) of each node, last one first. `proof` is that of the block's top: for each level,
    from below, the joined digests left and right of the path."""
    _, children = sweep_up(first, digests, size)
    top = min(DEPTH, height(size))

    def message(level: int, index: int, own: list[bytes]) -> tuple:
        return tuple(-x for x in _label(level, index, size)), level, index, own

    queue = [message(top, first // FAN**top, proof)]
    while queue:
        _, level, index, own = heappop(queue)
        if level == 0:
            yield index - first, own
            continue
        run = children[level, index]
        for k in range(len(run)):
            beside = [b"".join(run[:k]), b"".join(run[k + 1 :])]
            heappush(queue, message(level - 1, index * FAN + k, beside + own))


def folded(digest: bytes, proof: list[bytes]) -> bytes:
    """The root that a leaf (hex) and its proof give."""
    for left, right in zip(proof[::2], proof[1::2], strict=True):
        digest = hexlify(sha256(left + digest + right).digest())
    return digest


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows that agree in their first two columns; they come sorted."""
    now, rows = None, []
    for batch in steps(batches):
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if row[:2] != now:
                if rows:
                    yield rows
                now, rows = row[:2], []
            rows.append(row)
    if rows:
        yield rows


def _climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (tree, block, index, size, digest) to the top of each block."""
    names = ["tree", "index", "size", "digest"]
    out: list[tuple] = []
    for rows in _blocks(batches):
        tree, block, first, size, _ = rows[0]
        top, _ = sweep_up(first, [hexlify(r[4]) for r in rows], size)
        out.append((tree, block, -(-size // SPAN), bytes.fromhex(top.decode())))
        if len(out) >= 4096:
            yield _batch(out, names, _TOP)
            out = []
    yield _batch(out, names, _TOP)


_TOP = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def climb(nodes: DataFrame, size: int) -> list[DataFrame]:
    """The tops of blocks, round by round, from nodes (tree, index, size, digest); `size` is that of the largest tree.
    A tree's root is the row with size 1 of the first round that has one."""
    out = []
    for _ in range(rounds(size)):
        placed = nodes.select("tree", F.floor(F.col("index") / SPAN).cast("long").alias("block"), "index", "size", "digest")
        dealt = placed.repartition("tree", "block").sortWithinPartitions("tree", "block", "index")
        out.append(stored(dealt.mapInArrow(_climb, "tree long, index long, size long, digest binary"), "tops"))
        nodes = out[-1].where("size > 1")
    return out


def _with_heads(nodes: DataFrame, heads: DataFrame) -> DataFrame:
    """Nodes (tree, index, size, digest, carried) of blocks, each block led by what its top was handed (tree, index, root,
    proof): rows tree, block, leads, index, size, digest, carried, root, proof, sorted."""
    block = F.floor(F.col("index") / SPAN).cast("long").alias("block")
    carried = nodes.schema["carried"].dataType
    lead = heads.select(
        "tree",
        F.col("index").alias("block"),
        F.lit(0).alias("leads"),
        F.lit(-1).cast("long").alias("index"),
        F.lit(0).cast("long").alias("size"),
        F.lit(None).cast("binary").alias("digest"),
        F.lit(None).cast(carried).alias("carried"),
        "root",
        "proof",
    )
    own = nodes.select(
        "tree", block, F.lit(1).alias("leads"), "index", "size", "digest", "carried",
        F.lit(None).cast("binary").alias("root"), F.lit(None).cast("array<binary>").alias("proof"),
    )
    return own.unionByName(lead).repartition("tree", "block").sortWithinPartitions("tree", "block", "leads", "index")


def _hand_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node of a block with its tree's root and its own proof."""
    names, types = ["tree", "index", "root", "proof"], [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.binary())]
    for head, *rows in _blocks(batches):
        tree, _, _, first, size, _, _, _, _ = rows[0]
        found = sweep_down(first, [hexlify(r[5]) for r in rows], size, head[8])
        yield _batch([(tree, first + k, head[7], proof) for k, proof in found], names, types)


def hand_down(tops: list[DataFrame], roots: DataFrame) -> DataFrame:
    """(tree, index, root, proof) of the first round's tops, from what the roots of trees were handed (tree, round, root,
    proof), `round` being the one that reached the root."""
    heads = None
    for n in range(len(tops), 0, -1):
        done = roots.where(F.col("round") == n).select("tree", F.lit(0).cast("long").alias("index"), "root", "proof")
        if heads is not None:
            inner = tops[n - 1].where("size > 1").withColumn("carried", F.lit(None).cast("int"))
            below = _with_heads(inner, heads).mapInArrow(_hand_down, "tree long, index long, root binary, proof array<binary>")
            done = done.unionByName(below)
        heads = stored(done, "handed")
    return heads


def _rounds(size: Column) -> Column:
    """`rounds` as an expression."""
    out, reach = F.lit(1), SPAN
    while reach < 1 << 62:
        out, reach = out + (size > reach).cast("int"), reach * SPAN
    return out


def manifest(
    df: DataFrame,
    fields: list[str],
    id_col: str = "doc_id",
    source_col: str = "source",
    other: Column | None = None,
    proofs: bool = False,
) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row; with `proofs` also proof, an array
    of hex texts: for each level, from below, the digests left and right of the path.

    `other` is a digest to be folded in place of a row's leaf (null: the leaf itself), as one would check a copy.
    """
    digest = F.lit(None).cast("binary") if other is None else other
    hashed = df.select(
        column(source_col).alias("source"), column(id_col).alias("doc_id"), leaf_digest([column(f) for f in fields]).alias("leaf"), digest.alias("other")
    )
    leaves = stored(hashed, "leaves")  # numbering reads its table twice
    numbered = number_rows(leaves, [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf").asc()])
    rows = numbered.rows()
    found = rows.groupBy("source").agg(F.min(ROW_ID).alias("tree"), F.count(F.lit(1)).alias("size"))
    sources = number_rows(found, [F.col("source").asc_nulls_first()])
    many, total = sources.count, numbered.count
    ranked = sources.rows(name="place")
    biggest = ranked.agg(F.max("size")).first()[0] or 1
    nodes = stored(_placed(rows, ranked, many, total), "nodes")
    tops = climb(nodes.select("tree", "index", "size", F.col("leaf").alias("digest")), biggest)
    roots = tops[0].where("size = 1")
    for t in tops[1:]:
        roots = roots.union(t.where("size = 1"))
    # the trees' roots are the leaves of one more tree
    joined = ranked.select("tree", "place", F.col("size").alias("rows")).join(roots.select("tree", "digest"), "tree")
    upper = stored(
        joined.select(
            F.lit(0).cast("long").alias("tree"), F.col("place").alias("index"), F.lit(many).cast("long").alias("size"), "digest",
            F.struct(F.col("tree").alias("of"), "rows").alias("carried"),
        ),
        "subroots",
    )
    higher = climb(upper.drop("carried"), max(1, many))
    root = [r["digest"] for r in higher[-1].collect()]  # one row, or none without rows
    root = bytes(root[0]) if root else b""
    top = [(0, len(higher), root, [])] if root else []
    start = df.sparkSession.createDataFrame(top, "tree long, round int, root binary, proof array<binary>")
    schema = "tree long, rows long, root binary, proof array<binary>"
    handed = _with_heads(upper, hand_down(higher, start)).mapInArrow(_hand_to_trees, schema)
    heads = hand_down(tops, stored(handed.withColumn("round", _rounds(F.col("rows"))), "roots"))
    own = nodes.select("tree", "index", "size", F.col("leaf").alias("digest"), F.struct("doc_id", "other").alias("carried"))
    id_type = leaves.schema["doc_id"].dataType
    texts = [T.StructField(n, T.StringType()) for n in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
    schema = [T.StructField("doc_id", id_type), *texts, T.StructField("verified", T.BooleanType())]
    if proofs:
        schema.append(T.StructField("proof", T.ArrayType(T.StringType())))
    return _with_heads(own, heads).mapInArrow(_leaf_rows(root.hex(), proofs, to_arrow_type(id_type)), T.StructType(schema))


def _placed(rows: DataFrame, ranked: DataFrame, many: int, total: int) -> DataFrame:
    """Each row with its tree (the place of its source's first row), its place in it and the tree's size."""
    key = F.unhex(F.sha2(F.col("source").cast("binary"), 256))
    rows = rows.withColumn("_key", key)
    sources = ranked.select(key.alias("_source"), "tree", "size")
    same = F.col("_key").eqNullSafe(F.col("_source"))

    def joined(some: DataFrame, names: DataFrame) -> DataFrame:
        return some.join(names, same).select("tree", (F.col(ROW_ID) - F.col("tree")).alias("index"), "size", "leaf", "doc_id", "other")

    if many <= BROADCAST_SOURCES:
        return joined(rows, F.broadcast(sources))
    hot = F.broadcast(sources.where(F.col("size") * HOT_SHARE > total))
    rest = rows.join(hot, same, "left_anti")
    return joined(rows, hot).union(joined(rest, sources.where(F.col("size") * HOT_SHARE <= total)))


def _hand_to_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each leaf of the tree over all sources: the tree it is the root of, that tree's size, its digest and proof."""
    names, types = ["tree", "rows", "root", "proof"], [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.binary())]
    for head, *rows in _blocks(batches):
        found = sweep_down(rows[0][3], [hexlify(r[5]) for r in rows], rows[0][4], head[8])
        yield _batch([(rows[k][6]["of"], rows[k][6]["rows"], rows[k][5], proof) for k, proof in found], names, types)


def _leaf_rows(root: str, proofs: bool, id_type: pa.DataType):
    """The result's rows from blocks of leaves."""
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"] + ["proof"] * proofs
    types = [id_type, *[pa.string()] * 5, pa.bool_()] + [pa.list_(pa.string())] * proofs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for head, *rows in _blocks(batches):
            out, digests = [], [hexlify(r[5]) for r in rows]
            for k, proof in sweep_down(rows[0][3], digests, rows[0][4], head[8]):
                carried = rows[k][6]
                other = digests[k] if carried["other"] is None else hexlify(carried["other"])
                again = folded(other, proof).decode()
                row = (carried["doc_id"], digests[k].decode(), head[7].hex(), root, sha256(b"".join(proof)).hexdigest(), again, again == root)
                out.append((*row, [x.decode() for x in proof]) if proofs else row)
            yield _batch(out, names, types)

    return run
