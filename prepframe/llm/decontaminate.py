"""Benchmark decontamination: a hash set of normalised n-grams against every window of every document.

Benchmark items give windows of 13 words (an item of fewer words, but not none, is one window). Words of items get
numbers, windows get hashes of their numbers; a block of items is a few flat arrays, some 20 bytes a word, beside the
table of its words. Blocks are broadcast, at most `BLOCK_BYTES` of text each, and the documents pass through one block after
another. Where a document's window has a known hash its words are compared, and the words inside occurrences are hit.
A document is contaminated if at least one word in twenty is hit.

Cases: null and empty texts have no words, no hits and no items. Repeated items count once by id; items of null id are
left out, those without words have no window. Equal rows of documents give equal results. Ids of items compare as
strings. An empty benchmark hits nothing.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepframe.llm.frames import column, longs, map_columns
from prepframe.llm.words import words_of

WINDOW = 13
#: Bytes of benchmark text of one broadcast block.
BLOCK_BYTES = 32 << 20
#: A document is contaminated if hits times this are at least its words.
SHARE = 20

_BASE = np.uint64(0x9E3779B97F4A7C15)


class Table:
    """The different windows of one length: sorted hashes, a place in the block's words, and the items of each."""

    def __init__(self, sequence: np.ndarray, starts: np.ndarray, items: np.ndarray, size: int) -> None:
        self.size = size
        hashes = _hashes(sequence, starts, size)
        order = np.lexsort((items, hashes))
        hashes, starts, items = hashes[order], starts[order], items[order]
        # Neighbours of equal words are one window. Should windows of one hash alternate, each of their stretches is an
        # entry of its own, and all entries of a hash are compared.
        again = np.zeros(len(hashes), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & _equal(sequence, starts[1:], sequence, starts[:-1], size)
        first = np.flatnonzero(~again)
        self.hashes, self.starts = hashes[first], starts[first].astype(np.uint32)
        entry = np.cumsum(~again) - 1
        kept = ~again
        kept[1:] |= items[1:] != items[:-1]
        self.items = items[kept]
        self.bounds = np.searchsorted(entry[kept], np.arange(len(first) + 1)).astype(np.uint32)
        self._sieve: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_sieve": None}  # made again by each worker that needs it

    def sieve(self) -> np.ndarray:
        """Which low bits occur among the hashes: a power of two, some eight bits or more a hash up to 2^26."""
        if self._sieve is None:
            self._sieve = np.zeros(1 << min(26, max(16, (8 * len(self.hashes)).bit_length())), bool)
            self._sieve[self.hashes & np.uint64(len(self._sieve) - 1)] = True
        return self._sieve

    def find(self, sequence: np.ndarray, own: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of the places `at` whose windows are known, and the entries found (each once)."""
        sieve = self.sieve()
        hashes = _hashes(own, at, self.size)
        may = sieve[hashes & np.uint64(len(sieve) - 1)]
        at, hashes = at[may], hashes[may]
        low, high = np.searchsorted(self.hashes, hashes, "left"), np.searchsorted(self.hashes, hashes, "right")
        hit, entries = np.zeros(len(at), bool), []
        for k in range(int((high - low).max(initial=0))):
            some = np.flatnonzero(low + k < high)
            some = some[_equal(own, at[some], sequence, self.starts[low[some] + k].astype(np.int64), self.size)]
            hit[some] = True
            entries.append(low[some] + k)
        return at[hit], np.unique(np.concatenate(entries)) if entries else np.zeros(0, np.int64)

    def items_of(self, entries: np.ndarray) -> np.ndarray:
        return np.concatenate([self.items[self.bounds[e] : self.bounds[e + 1]] for e in entries.tolist()])


class Windows:
    """All windows of a block of items, by length and hash. Repeated items count once by id."""

    def __init__(self, items: list[tuple[str, str | None]], size: int) -> None:
        self.numbers: dict[bytes, int] = {}
        self.names = sorted({item for item, _ in items})
        number_of = {item: k for k, item in enumerate(self.names)}
        parts, starts, owners, done = [], {}, {}, 0
        for item, text in items:
            own = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text)]
            if own:
                n = min(len(own), size)
                parts.append(np.array(own, np.uint32))
                starts.setdefault(n, []).append(np.arange(done, done + len(own) - n + 1))
                owners.setdefault(n, []).append(np.full(len(own) - n + 1, number_of[item], np.uint32))
                done += len(own)
        self.sequence = np.concatenate([np.zeros(0, np.uint32), *parts])
        self.tables = [Table(self.sequence, np.concatenate(at), np.concatenate(owners[n]), n) for n, at in starts.items()]

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Places of occurrences (first word, length) and the items they are of."""
        number = self.numbers.get
        own = np.array([number(w, 0) for w in words], np.uint32)
        run = np.cumsum(np.concatenate([[0], own > 0]))
        places, items = [], set()
        for table in self.tables:
            n = table.size
            if len(own) < n:
                continue
            at = np.flatnonzero(run[n:] - run[:-n] == n)
            if not len(at):
                continue
            at, entries = table.find(self.sequence, own, at)
            if len(at):
                places += [(i, n) for i in at.tolist()]
                items |= {self.names[k] for k in np.unique(table.items_of(entries)).tolist()}
        return places, items


def _equal(a: np.ndarray, at: np.ndarray, b: np.ndarray, bt: np.ndarray, size: int) -> np.ndarray:
    """Whether the words from each place of one sequence are those from a place of the other."""
    same = np.ones(len(at), bool)
    for k in range(size):
        same &= a[at + k] == b[bt + k]
    return same


def _hashes(sequence: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """The hash of the `size` numbers from each place."""
    total = np.zeros(len(at), np.uint64)
    for k in range(size):
        total = total * _BASE + sequence[at + k].astype(np.uint64)
    total ^= total >> np.uint64(31)
    return total * _BASE ^ (total >> np.uint64(27))


FOUND = [
    T.StructField("n_words", T.LongType()),
    T.StructField("starts", T.ArrayType(T.LongType())),
    T.StructField("ends", T.ArrayType(T.LongType())),
    T.StructField("items", T.ArrayType(T.StringType())),
]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """Items in blocks whose texts hold block_bytes at most (a longer item is a block of its own), one at a time."""
    items = benchmark.select(column(id_col).cast("string").alias("item"), column(text_col).alias("text")).where("item IS NOT NULL AND text IS NOT NULL")
    block, held = [], 0
    for row in items.toLocalIterator():
        size = len(row["text"].encode())
        if block and held + size > block_bytes:
            yield block
            block, held = [], 0
        block.append((row["item"], row["text"]))
        held += size
    if block:
        yield block


def find_windows(
    df: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """All columns with n_words, hit stretches of words (starts, ends: exclusive, merged, in order) and items (sorted)."""
    spark = df.sparkSession
    keep = df.columns
    names = [f"found {i} {f.name}" for i, f in enumerate(FOUND)]
    found = None
    for block in chain(_blocks(benchmark, item_id_col, item_text_col, block_bytes), [[]]):
        if not block and found is not None:
            break
        shared = spark.sparkContext.broadcast(Windows(block, window))

        def start(shared=shared):
            windows = shared.value

            def apply(texts, *before):
                counts, starts, ends, items = [], [], [], []
                for row, text in enumerate(texts):
                    words = words_of(text)
                    places, of = windows.find(words)
                    spans = [(a, a + n) for a, n in places]
                    if before:
                        spans += zip(before[0][row], before[1][row], strict=True)
                        of |= set(before[2][row])
                    merged: list[list[int]] = []
                    for a, b in sorted(spans):
                        if merged and a <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], b)
                        else:
                            merged.append([a, b])
                    counts.append(len(words))
                    starts.append([a for a, _ in merged])
                    ends.append([b for _, b in merged])
                    items.append(sorted(of))
                lists = pa.list_(pa.int64())
                return [longs(counts), pa.array(starts, lists), pa.array(ends, lists), pa.array(items, pa.list_(pa.string()))]

            return apply

        fields = [T.StructField(n, f.dataType) for n, f in zip(names, FOUND, strict=True)]
        if found is None:
            found = map_columns(df.toDF(*[f"c{i}" for i in range(len(keep))]), [f"c{i}" for i in range(len(keep))], [f"c{keep.index(text_col)}"], fields, start)
        else:
            cols = [f"c{i}" for i in range(len(keep))]
            found = map_columns(found, cols, [f"c{keep.index(text_col)}", *names[1:]], fields, start)
    return found.toDF(*keep, *[f.name for f in FOUND])


def decontaminate(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, starts, ends: one row for each document."""
    source = df.select(column(id_col).alias("doc_id"), column(text_col).alias("text"))
    return summary(find_windows(source, benchmark, "text", item_id_col, item_text_col)).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "starts", "ends"
    )


def summary(found: DataFrame) -> DataFrame:
    """The columns of find_windows with n_hit, n_items, items_sha256 and contaminated."""
    hit = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda n, x: n + x)
    out = found.withColumn("n_hit", hit).withColumn("n_items", F.size("items").cast("long"))
    out = out.withColumn("items_sha256", F.sha2(F.array_join("items", ",").cast("binary"), 256))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * SHARE >= F.col("n_words")))


def drop_contaminated(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of df that are not contaminated, with the same columns."""
    names = [f"c{i}" for i in range(len(df.columns))]
    renamed = df.toDF(*names)
    found = summary(find_windows(renamed, benchmark, names[df.columns.index(text_col)], item_id_col, item_text_col))
    return found.where("NOT contaminated").select(*names).toDF(*df.columns)
