"""Language identification of whole, possibly mixed texts.

Script ranges narrow the candidate languages of a word, character n-grams score the word for each candidate, and a
Viterbi pass with a penalty for switching labels spans of words. The language of a text is the one whose spans hold
most letters.

Cases: a text that is null or has no letter is `und` with score 0 and no span. Ties go to the language that is first in
the alphabet. Letters of a script that no learned language uses say nothing, so that only the shares of the languages
in training decide. Without any training row every text is `und`. Repeated rows are labelled alike; columns other than
the text play no part in a prediction.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepframe.llm.frames import column, doubles, map_columns, steps, strings

#: Buckets of each hashed n-gram order.
BUCKETS = 1 << 17
ORDERS = 2
#: Training texts taken of each language (a bounded sample, by a hash of the text).
SAMPLE_PER_LANGUAGE = 2000
#: Parts that hashes of texts are dealt to when texts are drawn.
PARTS = 1 << 40
#: What a change of language costs, in units of log likelihood.
SWITCH = 12.0
SMOOTHING = 0.1
UNKNOWN = "und"

# First code points of script blocks, in order, and the script that begins there (0: none or shared).
SCRIPT_STARTS = [
    (0x0000, 0), (0x0041, 1), (0x0250, 0), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0700, 0),
    (0x0750, 6), (0x0780, 0), (0x0900, 7), (0x0980, 8), (0x0A00, 0), (0x0E00, 9), (0x0E80, 0), (0x10A0, 10), (0x1100, 11),
    (0x1200, 12), (0x13A0, 0), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x3040, 13), (0x3100, 0), (0x3400, 14), (0xA000, 0),
    (0xAC00, 11), (0xD7B0, 0), (0xF900, 14), (0xFB00, 0), (0xFB50, 6), (0xFE00, 0), (0xFE70, 6), (0xFF00, 0),
    (0x20000, 14), (0x30000, 0),
]
SCRIPTS = 15


@lru_cache(1)
def _letters() -> np.ndarray:
    """For each code point: 1 a letter, 2 a mark (which goes on a word), 0 anything else."""
    table = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind == "L":
            table[code] = 1
        elif kind == "M":
            table[code] = 2
    return table


@dataclass
class Words:
    """The words of a text: where they begin and end, their letters, scripts, and n-grams in order."""

    starts: np.ndarray
    ends: np.ndarray
    scripts: np.ndarray
    grams: np.ndarray
    first: np.ndarray


def words_of(text: str | None) -> Words | None:
    """None if there is no letter. Positions are code points of the text itself."""
    if not text:
        return None
    low = text.lower()
    if len(low) != len(text):
        low = "".join(x if len(x := c.lower()) == 1 else c for c in text)
    codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    kinds = _letters()[codes]
    inside = kinds > 0
    if not (kinds == 1).any():
        return None
    padded = np.zeros(len(codes) + 3, np.int64)
    padded[2:-1] = np.where(inside, codes, 0)
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    at = np.flatnonzero(inside)
    a, b, c, d = padded[at], padded[at + 1], padded[at + 2], padded[at + 3]
    a = np.where(b == 0, 0, a)  # nothing reaches over a word's edge
    three = (b * 0x9E3779B1 + c * 0x85EBCA6B + d * 0xC2B2AE35) >> 7
    four = (three + a * 0x27D4EB2F) ^ (three >> 11)
    grams = np.stack([three % BUCKETS, four % BUCKETS + BUCKETS], axis=1)
    bounds = np.array([x for x, _ in SCRIPT_STARTS])
    names = np.array([x for _, x in SCRIPT_STARTS])
    scripts = names[np.searchsorted(bounds, codes[starts], "right") - 1]
    return Words(starts, ends, scripts, grams, np.concatenate([[0], np.cumsum(ends - starts)[:-1]]))


@dataclass
class LanguageModel:
    """Log likelihoods of hashed n-grams by language, languages by script, and shares of the languages."""

    languages: list[str]
    grams: np.ndarray
    allowed: np.ndarray
    prior: np.ndarray

    def scores(self, words: Words) -> np.ndarray:
        """A row for each word, a column for each language; what its script rules out is far below."""
        letters = self.grams[words.grams[:, 0]] + self.grams[words.grams[:, 1]]
        score = np.add.reduceat(letters, words.first, axis=0).astype(np.float64) / ORDERS
        allowed = self.allowed[words.scripts]
        known = allowed.any(axis=1)
        score[~known] = 0.0
        score[known] = np.where(allowed[known], score[known], -1e4)
        return score

    def path(self, score: np.ndarray) -> np.ndarray:
        """The language of each word on the best path."""
        total = score.sum(axis=0) + self.prior
        best = int(total.argmax())
        gain = score - score[:, [best]]
        run = np.cumsum(gain, axis=0)
        low = np.minimum(np.minimum.accumulate(np.vstack([np.zeros(len(total)), run[:-1]]), axis=0), 0)
        # What a beginning in another language can gain (with its share in training), and any stretch. On a path through
        # several languages each stretch in another one has a switch of its own to pay, but for the beginning on a path
        # that never comes to the best language: so below one switch in all no path beats the one without.
        first = max(0.0, float((run + self.prior - self.prior[best]).max()))
        if first + float((run - low).max()) <= SWITCH:
            return np.full(len(score), best)
        return self._viterbi(score)

    def _viterbi(self, score: np.ndarray) -> np.ndarray:
        rows = score.tolist()
        n = len(rows[0])
        value = [p + s for p, s in zip(self.prior.tolist(), rows[0], strict=True)]
        back = []
        for row in rows[1:]:
            top = max(value)
            origin = value.index(top)
            came = [origin if top - SWITCH > v else k for k, v in enumerate(value)]
            back.append(came)
            value = [value[came[k]] - (SWITCH if came[k] != k else 0.0) + row[k] for k in range(n)]
        at = value.index(max(value))
        out = [at]
        for came in reversed(back):
            at = came[at]
            out.append(at)
        return np.array(out[::-1])

    def label(self, text: str | None) -> tuple[str, float, list[dict]]:
        """The language, the share of letters in its spans, and the spans."""
        words = words_of(text) if self.languages else None
        if words is None:
            return UNKNOWN, 0.0, []
        path = self.path(self.scores(words))
        weights = np.bincount(path, words.ends - words.starts, len(self.languages))
        best = int(weights.argmax())
        cut = np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1]]))
        last = np.concatenate([cut[1:] - 1, [len(path) - 1]])
        spans = [
            {"start": int(words.starts[i]), "end": int(words.ends[j]), "lang": self.languages[path[i]]}
            for i, j in zip(cut, last, strict=True)
        ]
        return self.languages[best], float(weights[best] / weights.sum()), spans


def fit_language_model(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE
) -> LanguageModel:
    """Count n-grams of about `per_language` different texts of each language, chosen by a hash of the text (all, if fewer).

    Copies of a text count once, however many there are; languages are as likely beforehand as they have rows. Only
    counts reach the driver: at most one for each language and bucket.
    """
    rows = df.select(column(text_col).alias("text"), column(lang_col).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    rows = rows.withColumn("own", F.xxhash64("text"))
    different = rows.groupBy("lang", "own").agg(F.count("*").alias("n")).groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("texts")).collect()
    sizes = {r["lang"]: r["n"] for r in different}
    names = sorted(sizes)
    if not names:
        return LanguageModel([], np.zeros((0, 0)), np.zeros((SCRIPTS, 0), bool), np.zeros(0))
    part = F.create_map(*[F.lit(x) for r in different for x in (r["lang"], min(PARTS, max(1, per_language * PARTS // r["texts"])))])
    drawn = rows.where(F.pmod("own", F.lit(PARTS)) < part[F.col("lang")])
    sample = drawn.groupBy("lang", "own").agg(F.min("text").alias("text")).select("text", "lang")

    def count(batches):
        found: dict[str, np.ndarray] = {}
        width = ORDERS * BUCKETS + SCRIPTS
        for batch in steps(batches):
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if (words := words_of(text)) is not None:
                    own = found.setdefault(lang, np.zeros(width, np.int64))
                    own += np.bincount(words.grams.ravel(), minlength=width)
                    own += np.bincount(words.scripts + ORDERS * BUCKETS, minlength=width)
        for lang, own in found.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(own[at], pa.int64())], names=["lang", "at", "n"]
            )

    counted = sample.mapInArrow(count, "lang string, at long, n long").groupBy("lang", "at").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((len(names), ORDERS * BUCKETS + SCRIPTS))
    row = np.searchsorted(names, counted.column("lang").to_pylist()) if counted.num_rows else np.zeros(0, np.int64)
    counts[row, counted.column("at").to_numpy()] = counted.column("n").to_numpy()
    grams = np.zeros((ORDERS * BUCKETS, len(names)), np.float32)
    for k in range(ORDERS):
        own = counts[:, k * BUCKETS : (k + 1) * BUCKETS] + SMOOTHING
        grams[k * BUCKETS : (k + 1) * BUCKETS] = np.log(own / own.sum(axis=1, keepdims=True)).T
    scripts = counts[:, ORDERS * BUCKETS :]
    # A language uses a script if one word in a hundred is in it.
    allowed = (scripts > 0.01 * np.maximum(scripts.sum(axis=1, keepdims=True), 1)).T
    prior = np.log(np.array([sizes[k] for k in names]) / sum(sizes.values()))
    return LanguageModel(names, grams, allowed, prior)


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("lang", T.StringType())]))


def label_languages(df: DataFrame, model: LanguageModel, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Kept columns (all, if not said) with lang_pred, score and lang_spans; spans are in code points, end exclusive."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # languages x buckets numbers

    def start():
        own = shared.value

        def apply(texts):
            found = [own.label(t) for t in texts]
            spans = pa.array([f[2] for f in found], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])))
            return [strings([f[0] for f in found]), doubles([f[1] for f in found]), spans]

        return apply

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("lang_spans", SPANS)]
    return map_columns(df, df.columns if keep is None else keep, [text_col], fields, start)
