"""A quality classifier by Bradley-Terry ranking: scores are learned from preference pairs, then cut at a quantile.

Each pair is a good and a bad labelled text; the logistic loss on the difference of their features gives one weight for
each feature. The cut is the score quantile that leaves below it the share of bad texts among all labelled ones, over
the scores of all of them; scores are mapped to 0..1 so that the cut lies at `CUT`.

Cases: null and empty texts have the features of a text without words and get a score like any other. Without labels of
both classes every text scores 1. Labelled ids that are not among the documents, null labels and null ids are left out;
repeated label rows weigh as often as they occur. Only the text is an input of a score.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepframe.llm.frames import column, doubles, map_columns
from prepframe.scratch import stored

#: Labelled texts taken of each class to learn from (a bounded sample, by a hash of the id).
SAMPLE_PER_CLASS = 4000
#: Preference pairs drawn from the sample.
PAIRS = 60_000
RIDGE = 1e-3
CUT = 0.3
#: Cells of a grid that scores are counted on.
CELLS = 1 << 14
#: Labelled ids up to which only their texts are scored for the cut (8 bytes each, broadcast).
BROADCAST_LABELS = 1_000_000

_KIND = np.zeros(256, np.uint8)  # 0 other, 1 a-z and non-ASCII, 2 A-Z, 3 digit, 4 white space, 5 sentence marks, 6 quotes and dashes
_KIND[0x61:0x7B] = 1
_KIND[0x80:] = 1
_KIND[0x41:0x5B] = 2
_KIND[0x30:0x3A] = 3
for _b in b" \t\n\x0b\x0c\r":
    _KIND[_b] = 4
for _b in b".,;:?":
    _KIND[_b] = 5
for _b in b"'\"-()":
    _KIND[_b] = 6
FEATURES = 18


def features(text: str | None) -> np.ndarray:
    """What a text looks like: kinds of characters, lengths, repetition of words and lines."""
    text = text or ""
    raw = np.frombuffer(text.encode(), np.uint8)
    n = max(1, len(raw))
    kinds = np.bincount(_KIND[raw], minlength=7) / n
    words = text.split()
    count = max(1, len(words))
    seen = Counter(words)
    top = max(seen.values(), default=0)
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    lines = [x for x in text.split("\n") if x]
    n_lines = max(1, len(lines))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    mean = float(lengths.mean()) if len(words) else 0.0
    spread = float(lengths.std()) if len(words) else 0.0
    return np.array(
        [
            math.sqrt(kinds[0]),
            kinds[1],
            math.sqrt(kinds[2]),
            math.sqrt(kinds[3]),
            kinds[4],
            kinds[5],
            math.sqrt(kinds[6]),
            math.log1p(count),
            mean,
            spread,
            len(seen) / count,
            math.sqrt(top / count),
            math.sqrt(again / count),
            len(set(lines)) / n_lines,
            math.log1p(count / n_lines),
            math.sqrt(text.count("!") / n),
            math.sqrt(text.count("|") / n),
            math.sqrt(sum(map(str.isupper, seen)) / max(1, len(seen))),
        ]
    )


@dataclass
class Ranking:
    """Standardised features, weights, and where the cut lies."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float

    def score(self, text: str | None) -> float:
        if not self.slope:
            return 1.0
        z = self.place(text)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.slope * (z - self.cut) + math.log(CUT / (1 - CUT))))))

    def place(self, text: str | None) -> float:
        return float(np.clip((features(text) - self.mean) / self.scale, -8, 8) @ self.weights)


def fit_pairs(good: np.ndarray, bad: np.ndarray, pairs: int = PAIRS) -> np.ndarray:
    """Weights by Newton's method on the logistic loss of differences, good minus bad."""
    draw = np.random.default_rng(0)
    x = good[draw.integers(len(good), size=pairs)] - bad[draw.integers(len(bad), size=pairs)]
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(np.clip(x @ w, -30, 30)))
        gradient = RIDGE * w - x.T @ p / len(x)
        curve = (x * (p * (1 - p))[:, None]).T @ x / len(x) + RIDGE * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _cut(scores: DataFrame, reach: float) -> float:
    """The value of z below which as much weight lies as label 0 has, over all rows of (z, label, n).

    Weights are counted on a grid over [-reach, reach], then on one inside the cell that holds the value, so two
    groupings of at most `CELLS` rows reach the driver whatever the number of scores; the cut lies half way between the
    values on its two sides.
    """
    low, width = -reach, 2 * reach
    below = 0
    sums = scores.agg(F.sum("n"), F.sum(F.when(F.col("label") == 0, F.col("n")))).first()
    share = sums[1] or 0
    for _ in range(2):
        cell = F.least(F.lit(CELLS - 1), F.floor((F.col("z") - low) / width * CELLS)).cast("int")
        inside = scores.where((F.col("z") >= low) & (F.col("z") < low + width)).groupBy(cell.alias("cell")).agg(F.sum("n").alias("n"))
        last = 0
        for k, n in sorted((r["cell"], r["n"]) for r in inside.collect()):
            last = k
            if below + n >= share:
                break
            below += n
        low, width = low + last * width / CELLS, width / CELLS
    top = low + width
    side = scores.agg(F.max(F.when(F.col("z") < top, F.col("z"))).alias("a"), F.min(F.when(F.col("z") >= top, F.col("z"))).alias("b")).first()
    a = top if side["a"] is None else side["a"]
    return (a + (a if side["b"] is None else side["b"])) / 2


def fit_ranking(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_class: int = SAMPLE_PER_CLASS
) -> Ranking:
    """Learn from about `per_class` labelled ids of each class (all, if fewer); their features reach the driver.

    The weights come from that sample, the cut from the scores of all labelled rows. An id with several equal labels is
    one of the sample and counts as often as it is labelled in the cut.
    """
    marked = labels.select(column(id_col).alias("id"), column(label_col).cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)")
    marked = stored(marked.groupBy("id", "label").agg(F.count("*").alias("n")), "marked")
    sizes, ids = {}, {}
    for r in marked.groupBy("label").agg(F.sum("n").alias("n"), F.count("*").alias("ids")).collect():
        sizes[r["label"]], ids[r["label"]] = r["n"], r["ids"]
    nothing = Ranking(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), 0.0, 0.0)
    if len(sizes) < 2:
        return nothing
    part = F.when(F.col("label") == 1, per_class * 1_000_000 // ids[1]).otherwise(per_class * 1_000_000 // ids[0])
    sample = marked.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < part)  # about 2 x per_class rows, one for each id and label
    source = df.select(column(id_col).alias("id"), column(text_col).alias("text"))
    texts = source.join(F.broadcast(sample), "id").select("label", "text")

    def measure(batches):
        for batch in batches:
            own = [features(t).tolist() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.list_(pa.float64()))], names=["label", "x"])

    found = texts.mapInArrow(measure, "label int, x array<double>").toArrow()
    y = found.column("label").to_numpy()
    if not (y == 1).any() or not (y == 0).any():
        return nothing
    x = np.array(found.column("x").to_pylist())
    order = np.lexsort(np.column_stack([x, y]).T)  # the same whatever order the rows came in
    x, y = x[order], y[order]
    weight = np.where(y == 1, sizes[1] / (y == 1).sum(), sizes[0] / (y == 0).sum())
    mean = np.average(x, axis=0, weights=weight)
    scale = np.sqrt(np.average((x - mean) ** 2, axis=0, weights=weight))
    scale[scale < 1e-9] = 1.0
    z = np.clip((x - mean) / scale, -8, 8)
    w = fit_pairs(z[y == 1], z[y == 0])
    s = z @ w
    slope = 1.0 / max(1e-6, float(np.sqrt(np.average((s - s.mean()) ** 2))) / 4)
    ranking = Ranking(mean, scale, w, 0.0, slope)
    scored = source
    if marked.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:  # else texts without label are scored, too
        scored = source.join(F.broadcast(marked.select("id").distinct()), "id", "left_semi")

    def place(batches):
        for batch in batches:
            own = [ranking.place(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), doubles(own)], names=["id", "z"])

    kind = source.schema["id"].dataType.simpleString()
    places = scored.where("id IS NOT NULL").mapInArrow(place, f"id {kind}, z double").join(marked, "id").select("z", "label", "n")
    return replace(ranking, cut=_cut(stored(places, "places"), 8 * float(np.abs(w).sum()) + 1e-9))


def score_quality(df: DataFrame, ranking: Ranking, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Kept columns (all, if not said) with score and predicted (1 from `CUT` on)."""
    shared = df.sparkSession.sparkContext.broadcast(ranking)

    def start():
        own = shared.value

        def apply(texts):
            scores = [own.score(t) for t in texts]
            return [doubles(scores), pa.array([int(s >= CUT) for s in scores], pa.int32())]

        return apply

    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return map_columns(df, df.columns if keep is None else keep, [text_col], fields, start)
