"""Quality rules: counts of each document, two fixed rules, and boosted trees over document statistics.

The trees are grown on histograms of the labelled texts' statistics with the logistic loss. Along the statistics of
`MONOTONE` the score may only fall: a split whose children would rise is not taken, and what lies below a split keeps
to its side of the children's middle. The grown trees are flattened into arrays of nodes, and a batch of documents goes
down all trees at once.

Cases: null and empty texts have no words and fail the base rules. Without labels of both classes the trees reject
nothing. Labels that are null, or whose id is null or not among the documents, are left out; of repeated label rows and
repeated documents of one id, one counts for each label. Ties at a threshold go left. Very long texts are read whole; a
table without rows gives no rows. Only the text is an input of a verdict.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepframe.llm.frames import column, longs, map_columns

MIN_WORDS, MAX_REPEATED, WINDOW = 20, 30, 8
#: Labelled documents of each class that the trees learn from at most, by the smallest hashes of their ids.
SAMPLE_PER_CLASS = 4000
TREES, TREE_DEPTH, RATE, BINS, MIN_LEAF, RIDGE = 80, 4, 0.15, 64, 20, 1.0
#: Score from which a document is kept.
KEEP = 0.3

_SPACE = " \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_UPPER, _DIGIT, _MARK, _CLOSE = (bytes(b) for b in (range(0x41, 0x5B), range(0x30, 0x3A), b".,;:?!'\"()-", b".?!\"'"))

STATISTICS = [
    "log_words", "mean_word", "word_spread", "symbols", "repeated_lines", "repeated_words", "distinct_words", "top_word",
    "upper", "digits", "marks", "words_a_line", "closed_lines", "non_ascii", "capital_words", "longest_word",
]
#: Statistics along which the score may only fall.
MONOTONE = ["symbols", "repeated_lines", "repeated_words", "top_word", "digits"]


def repeated_words(words: np.ndarray, document: np.ndarray, rows: int, window: int = WINDOW) -> np.ndarray:
    """For each document, the words inside windows that it holds twice or more. `words` numbers equal words alike.

    Windows are numbered exactly, from numbers of their halves.
    """
    out = np.zeros(rows, np.int64)
    if len(words) <= window:
        return out
    code, width = words.astype(np.int64), 1
    while width < window:
        code = np.unique(code[:-width] * (int(code.max()) + 1) + code[width:], return_inverse=True)[1]
        width *= 2
    starts = np.flatnonzero(document[: len(code)] == document[window - 1 :])
    _, which, many = np.unique(document[starts] * (int(code.max()) + 1) + code[starts], return_inverse=True, return_counts=True)
    again = starts[many[which] > 1]
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, again, 1)
    np.add.at(edges, again + window, -1)
    return np.bincount(document[np.cumsum(edges[:-1]) > 0], minlength=rows)


@dataclass
class Measured:
    """Counts of some texts, and their statistics as rows."""

    n_words: np.ndarray
    word_chars: list[int]
    n_symbols: list[int]
    n_dup_lines: list[int]
    n_repeat_words: np.ndarray
    statistics: np.ndarray

    def failed(self) -> np.ndarray:
        return (self.n_words < MIN_WORDS) | (100 * self.n_repeat_words > MAX_REPEATED * self.n_words)


def measure(texts: list[str | None]) -> Measured:
    words, sizes, chars, symbols, dup, rest = [], [], [], [], [], []
    for text in texts:
        text = text or ""
        raw = text.encode()
        own = raw.split()  # at exactly space, tab, line feed, vertical tab, form feed and carriage return
        words += own
        sizes.append(len(own))
        chars.append(len(text) - sum(map(text.count, _SPACE)))
        symbols.append(len(raw) - len(raw.translate(None, _SYMBOLS)))
        lines = [x for x in raw.split(b"\n") if x.strip()]
        dup.append(len(lines) - len(set(lines)))
        rest.append(_statistics(raw, own, lines, symbols[-1], dup[-1]))
    numbers = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    counts = np.array(sizes, np.int64)
    repeats = repeated_words(numbers, np.repeat(np.arange(len(texts)), counts), len(texts))
    statistics = np.array(rest).reshape(len(texts), len(STATISTICS))
    statistics[:, STATISTICS.index("repeated_words")] = repeats / np.maximum(1, counts)
    return Measured(counts, chars, symbols, dup, repeats, statistics)


def _statistics(raw: bytes, words: list[bytes], lines: list[bytes], symbols: int, dup: int) -> list[float]:
    n, many, size = max(1, len(raw)), max(1, len(words)), max(1, len(lines))
    lengths = np.fromiter(map(len, words), np.float64, len(words))
    seen = Counter(words)

    def share(kind: bytes) -> float:
        return (len(raw) - len(raw.translate(None, kind))) / n

    return [
        math.log1p(len(words)),
        float(lengths.mean()) if len(words) else 0.0,
        float(lengths.std()) if len(words) else 0.0,
        symbols / many,
        dup / size,
        0.0,  # filled in for all texts at once
        len(seen) / many,
        max(seen.values(), default=0) / many,
        share(_UPPER),
        share(_DIGIT),
        share(_MARK),
        math.log1p(many / size),
        sum(x.rstrip()[-1] in _CLOSE for x in lines) / size,
        sum(map((0x7F).__lt__, raw)) / n if not raw.isascii() else 0.0,
        sum(0x41 <= w[0] <= 0x5A for w in words) / many,
        math.log1p(float(lengths.max())) if len(words) else 0.0,
    ]


@dataclass
class Forest:
    """All trees' nodes in one set of arrays; a leaf leads to itself."""

    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    threshold: np.ndarray = field(default_factory=lambda: np.zeros(0))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    right: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    roots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    start: float = math.inf  # without trees everything scores 1

    def score(self, x: np.ndarray) -> np.ndarray:
        """Scores of the rows of x, between 0 and 1."""
        total = np.full(len(x), self.start)
        if len(self.roots):
            rows = np.arange(len(x))[:, None]
            at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
            for _ in range(TREE_DEPTH):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            total = total + self.value[at].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def grow(x: np.ndarray, y: np.ndarray, signs: np.ndarray, trees: int = TREES) -> Forest:
    """Boosted trees for labels y (0 or 1). `signs`: 1 where the score may only rise along a column, -1 where it may only
    fall, 0 where it is free."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for c in x.T]
    binned = np.column_stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)])
    rate = min(max(y.mean(), 1e-6), 1 - 1e-6)
    start = math.log(rate / (1 - rate))
    total = np.full(len(y), start)
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, curve = y - p, p * (1 - p)
        roots.append(_branch(nodes, binned, cuts, signs, gradient, curve, np.arange(len(y)), -math.inf, math.inf, TREE_DEPTH, total))
    columns = list(zip(*nodes, strict=True))
    kinds = [np.int32, np.float64, np.int32, np.int32, np.float64]
    return Forest(*[np.array(c, k) for c, k in zip(columns, kinds, strict=True)], np.array(roots, np.int32), start)


def _branch(nodes, binned, cuts, signs, gradient, curve, rows, low, high, depth, total) -> int:
    """Append the node over `rows`, whose weights must lie between low and high, and those below it; add its part of the
    score to `total`; return its number."""
    number = len(nodes)
    g, h = gradient[rows].sum(), curve[rows].sum()
    weight = float(np.clip(g / (h + RIDGE), low, high))
    nodes.append([0, 0.0, number, number, RATE * weight])
    best = _best_split(binned[rows], cuts, signs, gradient[rows], curve[rows], low, high) if depth else None
    if best is None:
        total[rows] += RATE * weight
        return number
    f, cut, wl, wr = best
    middle = (wl + wr) / 2
    bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[int(signs[f])]
    goes_left = binned[rows, f] <= cut
    nodes[number][:2] = [f, float(cuts[f][cut])]
    for side, (some, (a, b)) in enumerate(zip((rows[goes_left], rows[~goes_left]), bounds, strict=True)):
        nodes[number][2 + side] = _branch(nodes, binned, cuts, signs, gradient, curve, some, a, b, depth - 1, total)
    return number


def _best_split(binned, cuts, signs, gradient, curve, low, high):
    """(column, last bin on the left, left weight, right weight) of the largest gain, or None."""
    best, found = 1e-9, None
    g, h = gradient.sum(), curve.sum()

    def worth(a, b):
        w = np.clip(a / (b + RIDGE), low, high)
        return w, a * w - 0.5 * (b + RIDGE) * w * w

    base = worth(g, h)[1]
    for f, own in enumerate(cuts):
        size = len(own) + 1
        if size < 2:
            continue
        gl, hl = (np.cumsum(np.bincount(binned[:, f], v, size))[:-1] for v in (gradient, curve))
        nl = np.cumsum(np.bincount(binned[:, f], minlength=size))[:-1]
        (wl, left), (wr, right) = worth(gl, hl), worth(g - gl, h - hl)
        gain = left + right - base
        gain[(nl < MIN_LEAF) | (len(binned) - nl < MIN_LEAF) | (signs[f] * (wr - wl) < 0)] = -math.inf
        at = int(np.argmax(gain))
        if gain[at] > best:
            best, found = float(gain[at]), (f, at, float(wl[at]), float(wr[at]))
    return found


def fit_rules(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_class: int = SAMPLE_PER_CLASS
) -> Forest:
    """Learn from at most `per_class` labelled documents of each class; their statistics reach the driver."""
    marked = labels.select(column(id_col).alias("id"), column(label_col).cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)")
    draw = F.xxhash64("id")
    drawn = [marked.where(F.col("label") == k).distinct().orderBy(draw, "id").limit(per_class) for k in (0, 1)]
    sample = F.broadcast(drawn[0].union(drawn[1]))  # at most 2 x per_class rows
    texts = df.select(column(id_col).alias("id"), column(text_col).alias("text")).join(sample, "id")

    def start():
        return lambda rows: [pa.array(measure(rows).statistics.tolist(), pa.list_(pa.float64()))]

    found = map_columns(texts, ["id", "label"], ["text"], [T.StructField("x", T.ArrayType(T.DoubleType()))], start)
    rows = found.groupBy("id", "label").agg(F.min("x").alias("x")).select("label", "x").collect()
    rows = sorted((r["label"], r["x"]) for r in rows)  # the same trees whatever order the rows came in
    y = np.array([k for k, _ in rows], np.float64)
    if not (y == 1).any() or not (y == 0).any():
        return Forest()
    signs = np.array([-1 if s in MONOTONE else 0 for s in STATISTICS])
    return grow(np.array([x for _, x in rows]), y, signs)


def apply_rules(df: DataFrame, forest: Forest, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Kept columns (all, if not said) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept
    and score, that of the trees."""
    shared = df.sparkSession.sparkContext.broadcast(forest)

    def start():
        own = shared.value

        def apply(texts):
            found = measure(texts)
            scores, failed = own.score(found.statistics), found.failed()
            counts = [found.n_words, found.word_chars, found.n_symbols, found.n_dup_lines, found.n_repeat_words]
            return [*map(longs, counts), pa.array(failed), pa.array(~failed & (scores >= KEEP)), pa.array(scores)]

        return apply

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    fields = [T.StructField(n, T.LongType()) for n in names] + [T.StructField(n, T.BooleanType()) for n in ("base_failed", "kept")]
    fields.append(T.StructField("score", T.DoubleType()))
    return map_columns(df, df.columns if keep is None else keep, [text_col], fields, start)
