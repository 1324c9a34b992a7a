"""Moments of all pairs of columns of a wide table, on a grid of column blocks.

Columns are cut into blocks of BLOCK_WIDTH. Every pair of blocks is a cell of the grid, and rows are dealt to the cells
once: a task of a cell adds up, with numpy, what its two blocks' columns have in common, and keeps only that cell's sums.
Rows are also dealt to stripes, so that a cell's rows are split over several tasks whatever their number; a stripe's
sums meet again in one aggregation. Two scans and one shuffle of the rows, however many columns there are; the pairs
stay a table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns of a block: a cell's six sums of this width squared are what a task holds (12 MB).
BLOCK_WIDTH = 512
#: Numbers of a piece of rows that travels as one record (2 MB).
PIECE = 1 << 18
#: Tasks that the rows of one cell are dealt to.
STRIPES = 16

MOMENTS = ["n", "sa", "sb", "qa", "qb", "sab"]


def _rows(arrays: pa.Array, width: int) -> np.ndarray:
    """Arrays of doubles as a matrix, missing values as NaN."""
    flat = arrays.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(-1, width)


def column_survey(df: DataFrame, vector: str, width: int) -> DataFrame:
    """(place, n, total, low, high) of every column of an array that has values, one row a column."""
    names = ["place", "n", "total", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(width, np.int64), np.zeros(width)
        low, high = np.full(width, np.inf), np.full(width, -np.inf)
        for batch in batches:
            x = _rows(batch.column(0), width)
            there = ~np.isnan(x)
            n += there.sum(axis=0)
            total += np.where(there, x, 0.0).sum(axis=0)
            low = np.fmin(low, np.where(there, x, np.inf).min(axis=0, initial=np.inf))
            high = np.fmax(high, np.where(there, x, -np.inf).max(axis=0, initial=-np.inf))
        if n.any():
            some = np.flatnonzero(n)
            columns = [pa.array(some.astype(np.int32)), *[pa.array(v[some]) for v in (n, total, low, high)]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    found = df.select(vector).mapInArrow(run, "place int, n long, total double, low double, high double")
    return found.groupBy("place").agg(*[F.sum(c).alias(c) for c in names[1:3]], F.min("low").alias("low"), F.max("high").alias("high"))


def _deal(width: int, block: int, mean: np.ndarray, scale: np.ndarray, stripes: int):
    """Rows to records (cell, stripe, left, right): standardised values of the cell's two blocks, NaN where missing."""
    edges = [(a, min(a + block, width)) for a in range(0, width, block)]
    names = ["left", "right", "stripe", "rows", "x", "y"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0  # each piece of rows is one stripe's, in turn
        for batch in batches:
            for first in range(0, batch.num_rows, max(1, PIECE // block)):
                z = (_rows(batch.column(0).slice(first, max(1, PIECE // block)), width) - mean) / scale
                parts = [np.ascontiguousarray(z[:, a:b]).tobytes() for a, b in edges]
                turn = (turn + 1) % stripes
                for i, own in enumerate(parts):
                    for j in range(i, len(parts)):
                        row = [[i], [j], [turn], [len(z)], [own], [parts[j] if j > i else None]]
                        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
                        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names=names)

    return run


def _add_up(block: int):
    """Records of cells in order to a row for each pair of columns of a cell and stripe."""
    names = ["a", "b", *MOMENTS]

    def sums(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        px, py = ~np.isnan(x), ~np.isnan(y)
        x, y, px, py = np.where(px, x, 0.0), np.where(py, y, 0.0), px.astype(float), py.astype(float)
        return [px.T @ py, x.T @ py, px.T @ y, (x * x).T @ py, px.T @ (y * y), x.T @ y]

    def rows(cell: tuple[int, int], found: list[np.ndarray]) -> pa.RecordBatch:
        a, b = np.indices(found[0].shape)
        keep = np.ones(a.shape, bool) if cell[0] != cell[1] else a <= b
        places = [pa.array((k[keep] + c * block).astype(np.int32)) for k, c in zip((a, b), cell, strict=True)]
        return pa.RecordBatch.from_arrays([*places, *[pa.array(f[keep]) for f in found]], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, []
        for batch in batches:
            for i, j, stripe, n, x, y in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (i, j, stripe) != now:
                    if now is not None:
                        yield rows(now[:2], total)
                    now, total = (i, j, stripe), []
                left = np.frombuffer(x).reshape(n, -1)
                own = sums(left, left if y is None else np.frombuffer(y).reshape(n, -1))
                total = [t + o for t, o in zip(total, own, strict=True)] if total else own
        if now is not None:
            yield rows(now[:2], total)

    return run


def pair_moments(df: DataFrame, vector: str, mean: np.ndarray, scale: np.ndarray, block: int | None = None) -> DataFrame:
    """(a, b, n, sa, sb, qa, qb, sab) for every pair of places a <= b of an array column: over the rows that have both
    values, standardised by `mean` and `scale`, their number, sums, sums of squares and sum of products."""
    width, block = len(mean), block or BLOCK_WIDTH
    schema = "left int, right int, stripe int, rows int, x binary, y binary"
    dealt = df.select(vector).mapInArrow(_deal(width, block, mean, scale, STRIPES), schema)
    dealt = dealt.repartition("left", "right", "stripe").sortWithinPartitions("left", "right", "stripe")
    kinds = ", ".join(f"{m} double" for m in MOMENTS)
    return dealt.mapInArrow(_add_up(block), f"a int, b int, {kinds}").groupBy("a", "b").agg(*[F.sum(m).alias(m) for m in MOMENTS])
