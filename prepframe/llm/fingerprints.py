"""Document fingerprints by winnowing, and their likeness.

A text's k-grams of code points are hashed with a rolling polynomial; of each window of w neighbouring hashes the
smallest is chosen, of equal ones the rightmost. Any passage of at least w + k - 1 code points that two texts share
gives both a common hash, and the positions say where. The fingerprint string lists the chosen hashes in order of
position, each as 10 hex digits, `@` and the distance in hex from the one before, joined by spaces; likeness is the share of hashes in common
(Jaccard) of two texts, both winnowed with the smaller gram and window of the two.

Cases: white space and case count as they stand. Texts of few grams have smaller windows (what a larger window chooses, a
smaller one does, too, so the guarantee holds for the larger of two texts' windows), and texts below `SHORT` code points
smaller grams. A text shorter than a gram has one hash, of the whole; a null or empty one has none: its fingerprint is
empty, and two empty ones are alike 1. Equal texts have equal fingerprints. Null ids rank
below all others; rows of equal id keep together in the order of their texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepframe.llm.frames import column, map_columns, steps, strings

#: Code points of a gram, and grams of a window.
GRAM, WINDOW = 16, 64
#: Texts of fewer code points have grams of SHORT_GRAM; a window is at most a part of SHARE of a text's grams, LEAST at least.
SHORT, SHORT_GRAM, SHARE, LEAST = 64, 6, 8, 4
#: Bytes of text of one part of the ordering, about; there are at least as many parts as shuffle partitions.
PART_BYTES = 256 << 20
#: Code points taken at once from a very long text.
STRETCH = 1 << 20

_BASE = np.array([0x9E3779B97F4A7C15], np.uint64)  # an array wraps around without a warning


def measures(length: int, gram: int = GRAM, window: int = WINDOW) -> tuple[int, int]:
    """The gram and window of a text of so many code points, no larger than those given."""
    gram = min(gram, length, GRAM if length >= SHORT else SHORT_GRAM)
    return gram, min(window, max(LEAST, 1 << (max(1, (length - gram + 1) // SHARE).bit_length() - 1)))


def winnow(text: str | None, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """The chosen hashes (40 bits) and their positions, in order."""
    if not text:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    gram, window = measures(len(codes), gram, window)
    hashes = _rolling(codes, gram)
    if len(hashes) <= window:
        spot = len(hashes) - 1 - int(hashes[::-1].argmin())
        return hashes[[spot]], np.array([spot])
    found = []
    for first in range(0, len(hashes) - window + 1, STRETCH):
        found.append(first + _minima(hashes[first : first + STRETCH + window - 1], window))
    spots = np.unique(np.concatenate(found))
    return hashes[spots], spots


def _rolling(codes: np.ndarray, gram: int) -> np.ndarray:
    """Polynomial hashes of all grams, doubling the length hashed, then mixed and cut to 40 bits."""
    power, done, total, base, length = codes, 0, np.zeros(len(codes) - gram + 1, np.uint64), _BASE, 1
    count = len(total)
    while True:
        if gram & length:
            total = total * base + power[done : done + count]
            done += length
        if length * 2 > gram:
            break
        power = power[: len(power) - length] * base + power[length:]
        base, length = np.multiply(base, base), length * 2
    total ^= total >> np.uint64(29)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    total ^= total >> np.uint64(32)
    return total >> np.uint64(64 - 40)


def _minima(hashes: np.ndarray, window: int) -> np.ndarray:
    """The places of the smallest hash of each window, the rightmost of equal ones."""
    n = len(hashes)
    # One number for each: the hash, then the place counted from the right.
    least = (hashes << np.uint64(64 - 40)) | (np.uint64(n - 1) - np.arange(n, dtype=np.uint64))
    length = 1
    while length * 2 <= window:
        least = np.minimum(least[: len(least) - length], least[length:])
        length *= 2
    rest = window - length
    if rest:
        least = np.minimum(least[: len(least) - rest], least[rest:])
    return np.int64(n - 1) - np.unique((least & np.uint64((1 << 24) - 1)).astype(np.int64))[::-1]


def shown(hashes: np.ndarray, spots: np.ndarray) -> str:
    return " ".join([f"{h:010x}@{p:x}" for h, p in zip(hashes.tolist(), np.diff(spots, prepend=0).tolist(), strict=True)])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared hashes as a part of all hashes of either."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def nearness(a: str, own: tuple, b: str, other: tuple) -> float:
    """The likeness of two texts, given their fingerprints. Texts whose measures differ are compared at the smaller ones."""
    if not a or not b:
        return likeness(own[0], other[0])
    mine, its = measures(len(a)), measures(len(b))
    gram, window = min(mine[0], its[0]), min(mine[1], its[1])
    return likeness(*[found[0] if m == (gram, window) else winnow(t, gram, window)[0] for t, found, m in ((a, own, mine), (b, other, its))])


def fingerprint(df: DataFrame, text_col: str = "text", keep: list[str] | None = None, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Kept columns (all, if not said) with `fingerprint`."""

    def start():
        return lambda texts: [strings([shown(*winnow(t, gram, window)) for t in texts])]

    return map_columns(df, df.columns if keep is None else keep, [text_col], [T.StructField("fingerprint", T.StringType())], start)


def edited(text: str, following: str) -> str:
    """The last third of the code points (rounded down) replaced by the first as many of the following text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
)


def compare_with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text, its edited form and the next text by falling id (after the last: the first), compared.

    The ids alone are cut into parts of about equal size; each part gets its own rows and a copy of the row that comes
    next, so that texts are shuffled once and no part depends on another.
    """
    spark = df.sparkSession
    low = -(1 << 63)
    docs = df.select(F.coalesce(column(id_col).cast("long"), F.lit(low)).alias("rank"), column(id_col).cast("long").alias("doc_id"), F.coalesce(column(text_col), F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    steps_ = [k / parts for k in range(1, parts)]
    cuts = docs.select(F.col("rank").cast("double").alias("rank")).approxQuantile("rank", steps_, 0.2 / parts) if steps_ else []
    bounds = np.unique(np.array(cuts, np.float64))

    def part_of(rank: pa.Array) -> np.ndarray:
        return np.searchsorted(bounds, rank.to_numpy().astype(np.float64), "left").astype(np.int32)

    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, rank = part_of(batch.column(0)), batch.column(0).to_numpy()
            own = np.unique(part)
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array([int(rank[part == k].max()) for k in own], pa.int64())], names=["part", "rank"])

    heads = docs.select("rank").mapInArrow(head, "part int, rank long").groupBy("part").agg(F.max("rank").alias("rank")).orderBy(F.desc("part")).collect()
    # The first row of each part is copied into the part before it; the first of all into the last.
    wanted = sorted((following["rank"], here["part"]) for here, following in zip(heads, [*heads[1:], *heads[:1]], strict=True))
    ranks, goals = np.array([r for r, _ in wanted], np.int64), np.array([p for _, p in wanted], np.int32)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column(0).to_numpy()
            yield _placed(part_of(batch.column(0)), False, batch)
            at = np.minimum(np.searchsorted(ranks, rank), max(0, len(ranks) - 1))
            if (first := ranks[at] == rank).any():
                yield _placed(goals[at[first]], True, batch.filter(pa.array(first)))

    placed = docs.mapInArrow(place, "part int, copy boolean, rank long, doc_id long, text string")
    sent = placed.repartitionById(max(1, len(bounds) + 1), F.col("part"))
    rows = sent.sortWithinPartitions("part", "copy", F.desc("rank"), "text")
    return rows.mapInArrow(_follow, RESULT)


def _placed(part: np.ndarray, copy: bool, batch: pa.RecordBatch) -> pa.RecordBatch:
    columns = [pa.array(part, pa.int32()), pa.array(np.full(len(part), copy)), *batch.columns]
    return pa.RecordBatch.from_arrays(columns, names=["part", "copy", *batch.schema.names])


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, each part's last one a copy: every row but the copies is finished when the next one comes."""
    before = None
    for batch in steps(batches):
        out: list[tuple] = []
        for part, copy, _, doc_id, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            own = winnow(text)
            if before is not None and before[0] == part:
                out.append(_finished(before, text, own))
            before = None if copy else (part, doc_id, text, own)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), ARROW, strict=True)], schema=ARROW)


def _finished(row: tuple, following: str, next_print: tuple) -> tuple:
    _, doc_id, text, own = row
    other = edited(text, following)
    print_ = winnow(other)
    return (
        doc_id,
        len(text),
        hashlib.sha256(other.encode()).hexdigest(),
        shown(*own),
        shown(*print_),
        nearness(text, own, other, print_),
        nearness(text, own, following, next_print),
    )


ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)
