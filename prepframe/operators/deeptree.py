"""Decision trees of any depth with exact thresholds.

Leaves with many rows are split by Spark. One pass counts the classes of every such leaf in ranges of each feature's
values, which gives the worth of the thresholds between ranges and a bound for those inside; a common value is a range of
its own. Only of ranges whose bound reaches the best worth all distinct values are counted: running counts are taken
part by part of a range-partitioned table, and parts are shifted by what stands before them, so that a feature with very
many values is no single task's. Equal rows count as one with a weight. Leaves of at most LEAF_ROWS different rows are
grouped, a leaf to a task at a time, and finished there whatever their depth.

A threshold lies half-way between neighbouring values. Of equally good splits the first feature's smallest is taken. A
leaf is final when it is pure or no feature varies in it; splits without gain are taken too, as some targets need them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepframe.scratch import stored

#: Different rows of a leaf up to which one task finishes it.
LEAF_ROWS = 200_000
#: Nodes of a tree up to which it is broadcast whole (28 bytes each); beyond, rows go to their leaf's own tree by shuffle.
BROADCAST_NODES = 500_000
#: Tasks that the rows of one leaf are dealt to then.
SALTS = 8
#: Ranges that a feature's values are first counted in, and those of all features together.
RANGES, ALL_RANGES = 1_024, 262_144
#: Values of rows that a task counts at a time.
COUNTED = 2_000_000
#: Classes up to which the bound of a range takes every way to part its classes; a wider bound beyond.
CORNERS = 4

_SUBTREE = "leaf long, feature array<int>, threshold array<double>, left array<int>, right array<int>, label array<int>"
_PARTS = ["feature", "threshold", "left", "right", "label"]


@dataclass
class Nodes:
    """A tree as arrays; a final leaf leads to itself and has feature -1."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    label: np.ndarray

    @classmethod
    def of(cls, rows: list[list]) -> Nodes:
        kinds = [np.int32, np.float64, np.int64, np.int64, np.int32]
        return cls(*[np.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)])

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The final leaf of each row."""
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(rows):
            rows = rows[self.feature[at[rows]] >= 0]
            node = at[rows]
            goes_left = x[rows, self.feature[node]] <= self.threshold[node]
            at[rows] = np.where(goes_left, self.left[node], self.right[node])
        return at

    def depth(self) -> int:
        deep = np.zeros(len(self.feature), np.int64)
        for i in np.flatnonzero(self.feature >= 0):  # children are numbered after their parents
            deep[self.left[i]] = deep[self.right[i]] = deep[i] + 1
        return int(deep.max())


def _matrix(arrays: pa.Array) -> np.ndarray:
    return arrays.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(arrays), -1)


def _half_way(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Between two neighbours, never the upper one."""
    middle = low / 2 + high / 2
    return np.where(middle < high, middle, low)


def _worth(left: np.ndarray, total: np.ndarray, gini: bool) -> np.ndarray:
    """What a split leaves of purity, larger is better; counts of classes along the last axis."""
    return _purity(left, gini) + _purity(total - left, gini)


def _purity(counts: np.ndarray, gini: bool) -> np.ndarray:
    n = counts.sum(axis=-1)
    if gini:
        return (counts.astype(np.float64) ** 2).sum(axis=-1) / np.maximum(n, 1)
    logs = counts * np.log(np.maximum(counts, 1))
    return logs.sum(axis=-1) - n * np.log(np.maximum(n, 1))


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray, classes: int, gini: bool) -> list[list]:
    """The exact tree over weighted rows: feature, threshold, left, right, label of each node, parents first."""
    nodes: list[list] = [[-1, 0.0, 0, 0, 0]]
    todo = [(0, np.arange(len(y)))]
    while todo:
        at, rows = todo.pop()
        counts = np.bincount(y[rows], weight[rows], classes)
        nodes[at] = [-1, 0.0, at, at, int(counts.argmax())]
        if np.count_nonzero(counts) < 2:
            continue
        best, found = -np.inf, None
        present = np.flatnonzero(counts)
        for f in range(x.shape[1]):
            order = np.argsort(x[rows, f], kind="stable")
            v = x[rows[order], f]
            edges = np.flatnonzero(v[1:] > v[:-1])
            if not len(edges):
                continue
            one = (y[rows[order]][:, None] == present) * weight[rows[order]][:, None]
            worth = _worth(np.cumsum(one, axis=0)[edges], counts[present], gini)
            k = int(np.argmax(worth))
            if worth[k] > best:
                best, found = worth[k], (f, float(_half_way(v[edges[k]], v[edges[k] + 1])))
        if found is None:
            continue
        f, cut = found
        goes_left = x[rows, f] <= cut
        nodes[at][:4] = [f, cut, len(nodes), len(nodes) + 1]
        todo += [(len(nodes), rows[goes_left]), (len(nodes) + 1, rows[~goes_left])]
        nodes += [[-1, 0.0, 0, 0, 0], [-1, 0.0, 0, 0, 0]]
    return nodes


def _route(rows: DataFrame, nodes: Nodes, only: list[int]) -> DataFrame:
    """(leaf, x, y, weight) of the rows that fall into some leaves."""
    shared = rows.sparkSession.sparkContext.broadcast((nodes, np.array(sorted(only), np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, wanted = shared.value
        for batch in batches:
            leaf = tree.leaves(_matrix(batch.column(0)))
            chosen = pa.array(np.isin(leaf, wanted))
            yield pa.RecordBatch.from_arrays([pa.array(leaf), *batch.columns], names=["leaf", "x", "y", "weight"]).filter(chosen)

    return rows.select("x", "y", "weight").mapInArrow(run, "leaf long, x array<double>, y int, weight long")


def _worth_column(counts: list[Column], gini: bool) -> Column:
    n = sum(counts[1:], counts[0])
    if gini:
        return sum((c * c for c in counts[1:]), counts[0] * counts[0]) / F.greatest(n, F.lit(1.0))

    def log(c: Column) -> Column:
        return c * F.log(F.greatest(c, F.lit(1.0)))

    return sum((log(c) for c in counts[1:]), log(counts[0])) - log(n)


def _edges(rows: DataFrame) -> list[np.ndarray]:
    """Of each feature, the last values of ranges of about as many rows; any values do, these bound best."""
    width = rows.select(F.size("x")).first()[0]
    ranges = max(2, min(RANGES, ALL_RANGES // max(width, 1)))
    shares = [i / ranges for i in range(1, ranges)]
    found = rows.select(F.posexplode("x").alias("f", "v")).groupBy("f").agg(F.percentile_approx("v", shares, 4 * ranges).alias("edges"))
    return [np.unique(r["edges"]) for r in found.orderBy("f").collect()]


def _cells(rows: DataFrame, nodes: Nodes, only: list[int], edges: list[np.ndarray], classes: int) -> DataFrame:
    """(leaf, f, cell, low, high, c0, c1, …) of the ranges that some leaves' rows fall into: their least and greatest value,
    the classes' counts and, last, the number of different rows."""
    shared = rows.sparkSession.sparkContext.broadcast((nodes, np.array(sorted(only), np.int64), edges))
    names = ["leaf", "f", "cell", "low", "high", *[f"c{k}" for k in range(classes + 1)]]

    def counted(x: np.ndarray, leaf: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Iterator[pa.RecordBatch]:
        _, wanted, edges = shared.value
        for f, own in enumerate(edges):
            cell = np.searchsorted(wanted, leaf) * (len(own) + 1) + np.searchsorted(own, x[:, f])
            order = np.argsort(cell, kind="stable")
            cell, v, kinds, weights = cell[order], x[order, f], y[order], weight[order]
            starts = np.concatenate([[0], np.flatnonzero(cell[1:] > cell[:-1]) + 1])
            place, inside = np.divmod(cell[starts], len(own) + 1)
            sums = [np.add.reduceat(np.where(kinds == k, weights, 0.0), starts) for k in range(classes)]
            rows_in = np.diff(np.append(starts, len(cell))).astype(np.float64)
            columns = [wanted[place], np.full(len(starts), f, np.int32), inside.astype(np.int32), np.minimum.reduceat(v, starts), np.maximum.reduceat(v, starts), *sums, rows_in]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, wanted, _ = shared.value
        held, size = [], 0
        for batch in batches:
            x = _matrix(batch.column(0))
            leaf = tree.leaves(x)
            chosen = np.isin(leaf, wanted)
            if chosen.any():
                held.append((x[chosen], leaf[chosen], batch.column(1).to_numpy()[chosen], batch.column(2).to_numpy()[chosen]))
                size += held[-1][0].size
            if size >= COUNTED:
                yield from counted(*[np.concatenate(c) for c in zip(*held, strict=True)])
                held, size = [], 0
        if held:
            yield from counted(*[np.concatenate(c) for c in zip(*held, strict=True)])

    kinds = "leaf long, f int, cell int, low double, high double, " + ", ".join(f"c{k} double" for k in range(classes + 1))
    parts = rows.select("x", "y", "weight").mapInArrow(run, kinds)
    return parts.groupBy("leaf", "f", "cell").agg(F.min("low").alias("low"), F.max("high").alias("high"), *[F.sum(n).alias(n) for n in names[5:]])


def _bound(before: np.ndarray, upto: np.ndarray, total: np.ndarray, gini: bool) -> np.ndarray:
    """No split inside a range is worth more: rows on the left are `before` and some of those up to `upto`.

    The worth is convex in the classes' counts, so the best is at a corner. And of two sides apart neither is worth
    less than both together, a range's own rows at most their number (entropy: 0).
    """
    inside = upto - before
    wide = _purity(before, gini) + _purity(total - upto, gini) + (inside.sum(axis=-1) if gini else 0.0)
    if before.shape[1] > CORNERS:
        return wide
    corners = [_worth(before + inside * np.array(c), total, gini) for c in product((0, 1), repeat=before.shape[1])]
    return np.minimum(wide, np.max(corners, axis=0))


_FOUND = "leaf long, f int, cell int, worth double, v double, next double, left array<double>, total array<double>, open long"


def _between(classes: int, gini: bool):
    """Of one leaf's ranges: its best split between two of them (cell -1), and the ranges that may hold a better one."""

    def search(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        best, out, bounds = [key[0], -1, -1, -np.inf, 0.0, 0.0, [], [], 0], [], []
        names = [f"c{k}" for k in range(classes + 1)]
        for f, cells in own.sort_values(["f", "cell"]).groupby("f"):
            counts, low, high = cells[names].to_numpy(), cells["low"].to_numpy(), cells["high"].to_numpy()
            upto = np.cumsum(counts, axis=0)
            before, total = upto - counts, upto[-1]
            if len(cells) > 1:
                worth = _worth(upto[:-1, :classes], total[:classes], gini)
                k = int(np.argmax(worth))
                if worth[k] > best[3]:
                    best[1:8] = [f, -1, worth[k], high[k], low[k + 1], upto[k].tolist(), total.tolist()]
            bound = _bound(before[:, :classes], upto[:, :classes], total[:classes], gini)
            bounds += [(bound[k], f, c, before[k], total) for k, c in enumerate(cells["cell"]) if low[k] < high[k]]
        reach = best[3] - 1e-9 * abs(best[3]) if best[3] > -np.inf else -np.inf
        for bound, f, cell, left, total in bounds:
            if bound >= reach:
                out.append([key[0], f, cell, None, None, None, left.tolist(), total.tolist(), 0])
        best[-1] = len(out)
        return pd.DataFrame([best, *out], columns=["leaf", "f", "cell", "worth", "v", "next", "left", "total", "open"])

    return search


def _best_splits(rows: DataFrame, nodes: Nodes, only: list[int], edges: list[np.ndarray], classes: int, gini: bool) -> list[tuple]:
    """For some leaves: leaf, worth, -feature, -value, the value that follows, and on the left of its best split the class
    counts and, last, the number of different rows."""
    cells = _cells(rows, nodes, only, edges, classes)
    found = stored(cells.groupBy("leaf").applyInPandas(_between(classes, gini), _FOUND), "ranges")
    between = found.where("cell = -1").collect()
    best = {r["leaf"]: (r["worth"], -r["f"], -r["v"], r["next"], r["left"]) for r in between if r["f"] >= 0}
    open_in = [r["leaf"] for r in between if r["open"]]
    if open_in:
        for r in _inside(_route(rows, nodes, open_in), found.where("cell >= 0"), edges, classes, gini):
            one = (r["worth"], r["f"], r["v"], r["next"], r["left"])
            best[r["leaf"]] = max(best.get(r["leaf"], one), one, key=lambda b: b[:3])
    return sorted((leaf, *b) for leaf, b in best.items())


def _inside(rows: DataFrame, ranges: DataFrame, edges: list[np.ndarray], classes: int, gini: bool) -> list:
    """The best split of each leaf of (leaf, x, y, weight) among the thresholds inside some ranges of its values."""
    shared = rows.sparkSession.sparkContext.broadcast(edges)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1)) + 0.0  # one zero, as in a grouping
            for f, own in enumerate(shared.value):
                columns = [np.full(len(x), f, np.int32), np.searchsorted(own, x[:, f]).astype(np.int32), x[:, f]]
                yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in columns], *batch.columns[2:]], names=["leaf", "f", "cell", "v", "y", "weight"])

    ks, cell = range(classes + 1), ["leaf", "f", "cell"]
    long = rows.mapInArrow(split, "leaf long, f int, cell int, v double, y int, weight long").join(ranges.select(*cell), cell, "left_semi")
    sums = [F.sum(F.when(F.col("y") == k, F.col("weight")).otherwise(0)) for k in range(classes)] + [F.count(F.lit(1))]
    counts = long.groupBy(*cell, "v").agg(*[c.cast("double").alias(f"c{k}") for k, c in enumerate(sums)])
    parts = counts.repartitionByRange(*cell, "v").sortWithinPartitions(*cell, "v")
    parts = stored(parts.withColumn("part", F.spark_partition_id()), "values")
    along = Window.partitionBy(*cell).orderBy("part")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    pieces = parts.groupBy(*cell, "part").agg(F.min("v").alias("first"), *[F.sum(f"c{k}").alias(f"s{k}") for k in ks])
    shifts = pieces.select(
        *cell, "part", F.lead("first").over(along).alias("after"),
        *[F.coalesce(F.sum(f"s{k}").over(before), F.lit(0.0)).alias(f"b{k}") for k in ks],
    )
    known = ranges.select(*cell, *[F.col("left")[k].alias(f"a{k}") for k in ks], *[F.col("total")[k].alias(f"t{k}") for k in ks])
    within = Window.partitionBy(*cell, "part").orderBy("v")
    at = parts.join(shifts.join(known, cell), [*cell, "part"]).select(
        *cell, "v", F.coalesce(F.lead("v").over(within), F.col("after")).alias("next"),
        *[(F.col(f"a{k}") + F.col(f"b{k}") + F.sum(f"c{k}").over(within)).alias(f"l{k}") for k in ks], *[f"t{k}" for k in ks],
    ).where("next IS NOT NULL")
    left = [F.col(f"l{k}") for k in ks]
    right = [F.col(f"t{k}") - left[k] for k in range(classes)]
    worth = _worth_column(left[:classes], gini) + _worth_column(right, gini)
    one = F.struct(worth.alias("worth"), (-F.col("f")).alias("f"), (-F.col("v")).alias("v"), "next", F.array(*left).alias("left"))
    return at.groupBy("leaf").agg(F.max(one).alias("best")).select("leaf", "best.*").collect()


@dataclass
class DeepTree:
    """The nodes split by Spark, and a table of the trees that go on from their leaves."""

    shared: Nodes
    subtrees: DataFrame
    n_nodes: int
    whole: Nodes | None

    def transform(self, df: DataFrame, features: str, prediction: str) -> DataFrame:
        """`df` with the predicted class as a double; `features` is a vector column."""
        raw = F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns]).alias("raw")
        rows = df.select(raw, vector_to_array(F.col(features)).alias("x"))
        kind = T.StructType([rows.schema["raw"], T.StructField("_p", T.DoubleType())])
        found = _predict_broadcast(rows, self.whole, kind) if self.whole else _predict_by_leaf(rows, self, kind)
        return found.select("raw.*", F.col("_p").alias(prediction))


def _predict_broadcast(rows: DataFrame, nodes: Nodes, kind: T.StructType) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(nodes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        for batch in batches:
            labels = tree.label[tree.leaves(_matrix(batch.column(1)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(labels.astype(np.float64))], names=["raw", "_p"])

    return rows.mapInArrow(run, kind)


def _predict_by_leaf(rows: DataFrame, model: DeepTree, kind: T.StructType) -> DataFrame:
    """Rows meet their leaf's own tree, which leads each of its tasks' rows."""
    shared = rows.sparkSession.sparkContext.broadcast(model.shared)
    placed = T.StructType([rows.schema["raw"], rows.schema["x"], T.StructField("leaf", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = pa.array(shared.value.leaves(_matrix(batch.column(1))))
            yield pa.RecordBatch.from_arrays([*batch.columns, leaf], names=["raw", "x", "leaf"])

    own = rows.mapInArrow(place, placed)
    own = own.select("leaf", F.pmod(F.xxhash64("x", F.monotonically_increasing_id()), F.lit(SALTS)).alias("salt"), F.lit(1).alias("leads"), "raw", "x",
                     F.lit(None).cast(model.subtrees.drop("leaf").select(F.struct("*")).schema[0].dataType).alias("tree"))
    trees = model.subtrees.select("leaf", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")).alias("salt"), F.lit(0).alias("leads"),
                                  F.lit(None).cast(rows.schema["raw"].dataType).alias("raw"), F.lit(None).cast("array<double>").alias("x"),
                                  F.struct(*_PARTS).alias("tree"))
    met = own.unionByName(trees).repartition("leaf", "salt").sortWithinPartitions("leaf", "salt", "leads").select("leaf", "leads", "x", "tree", "raw")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, holder = None, None
        for batch in batches:
            leaf, leads = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            starts = [0, *(np.flatnonzero((leads[1:] == 0) | (leaf[1:] != leaf[:-1])) + 1).tolist(), batch.num_rows]
            for a, b in zip(starts, starts[1:], strict=False):
                if a < b and leads[a] == 0:
                    own = batch.column(3)[a].as_py()
                    tree, holder, a = Nodes.of(list(zip(*[own[p] for p in _PARTS], strict=True))), leaf[a], a + 1
                if a == b:
                    continue
                if holder != leaf[a]:
                    tree = None  # a leaf that Spark left final
                labels = np.full(b - a, shared.value.label[leaf[a]]) if tree is None else tree.label[tree.leaves(_matrix(batch.column(2).slice(a, b - a)))]
                yield pa.RecordBatch.from_arrays([batch.column(4).slice(a, b - a), pa.array(labels.astype(np.float64))], names=["raw", "_p"])

    return met.mapInArrow(run, kind)


def fit_deep_tree(df: DataFrame, features: str, label: str, classes: int, impurity: str = "gini") -> DeepTree:
    """Learn from a vector column and the places of classes, 0 to classes - 1."""
    if impurity not in ("gini", "entropy"):
        raise ValueError("impurity must be gini or entropy")
    gini = impurity == "gini"
    plain = df.select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("int").alias("y"))
    rows = stored(plain.groupBy("x", "y").agg(F.count(F.lit(1)).alias("weight")), "tree_rows")
    counts = np.zeros(classes + 1)  # the last one is that of different rows
    for r in rows.groupBy("y").agg(F.sum("weight").alias("n"), F.count(F.lit(1)).alias("rows")).collect():
        counts[r["y"]] = r["n"]
        counts[-1] += r["rows"]
    if not counts.any():
        raise ValueError("no rows to learn from")
    nodes: list[list] = [[-1, 0.0, 0, 0, int(counts[:-1].argmax())]]
    open_leaves, small, edges = {0: counts}, [], None
    while open_leaves:
        large = {}
        for leaf, own in open_leaves.items():
            if np.count_nonzero(own[:-1]) > 1:
                if own[-1] > LEAF_ROWS:
                    large[leaf] = own
                else:
                    small.append(leaf)
        open_leaves = {}
        if not large:
            break
        edges = _edges(rows) if edges is None else edges
        for leaf, _, f, v, after, counted in _best_splits(rows, Nodes.of(nodes), list(large), edges, classes, gini):
            left, cut = np.array(counted), float(_half_way(np.float64(-v), np.float64(after)))
            at = len(nodes)
            nodes[leaf][:4] = [-f, cut, at, at + 1]
            for k, own in enumerate((left, large[leaf] - left)):
                nodes.append([-1, 0.0, at + k, at + k, int(own[:-1].argmax())])
                open_leaves[at + k] = own
    shared = Nodes.of(nodes)

    def finish(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        tree = grow(np.stack(own["x"].to_numpy()), own["y"].to_numpy().astype(np.int64), own["weight"].to_numpy(), classes, gini)
        return pd.DataFrame([[key[0], *[list(c) for c in zip(*tree, strict=True)]]], columns=["leaf", *_PARTS])

    subtrees = stored(_route(rows, shared, small).groupBy("leaf").applyInPandas(finish, _SUBTREE), "subtrees")
    inside = subtrees.agg(F.coalesce(F.sum(F.size("feature") - 1), F.lit(0)).alias("n")).first()["n"]
    total = len(nodes) + inside
    return DeepTree(shared, subtrees, total, _joined(nodes, subtrees) if total <= BROADCAST_NODES else None)


def _joined(nodes: list[list], subtrees: DataFrame) -> Nodes:
    """One tree of all nodes; a subtree's first node takes its leaf's place."""
    out = [list(n) for n in nodes]
    for r in subtrees.orderBy("leaf").collect():
        shift = len(out) - 1

        def place(i: int, leaf: int = r["leaf"], shift: int = shift) -> int:
            return i + shift if i else leaf

        own = [[f, t, place(a), place(b), k] for f, t, a, b, k in zip(*[r[p] for p in _PARTS], strict=True)]
        out[r["leaf"]] = own[0]
        out += own[1:]
    return Nodes.of(out)
