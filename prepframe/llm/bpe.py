"""Byte-pair encoding and decoding with a given vocabulary whose words end in a mark.

The most frequent words of the corpus are compiled, with their ids, into a minimal acyclic transducer that every task
maps into memory; all other words are merged exactly, many at a time. A word here is a run without white space, which
no token crosses. The strings of special tokens in a text become those tokens, as the vocabulary's library has it.

Cases: a null or empty text, or one of white space alone, has no ids and decodes to the empty string. The lexicon
changes speed only: ties at its end, or no lexicon at all, give the same ids. Words and texts may be of any length.
"""

from __future__ import annotations

import hashlib
import heapq
import io
import json
import unicodedata
import uuid
from collections import Counter, defaultdict
from itertools import chain, islice
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepframe.llm.automaton import Transducer, compile_words
from prepframe.llm.frames import column, longs, map_columns, steps, strings
from prepframe.scratch import scratch_path, stored

#: Words compiled into the lexicon at most: the most frequent ones of the corpus.
LEXICON_WORDS = 50_000
#: Longest word of the lexicon, in bytes.
LEXICON_BYTES = 48
#: Words that a task keeps with their ids before it forgets them all.
KEPT_WORDS = 500_000
#: Distinct words that a task counts before it hands its counts on.
COUNTED_WORDS = 400_000
#: Symbols of a piece up to which pieces are merged side by side.
WIDE = 48

# The library's pattern for pieces of a word, with white space as Unicode has it.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
RUNS = regex.compile(r"[^\p{White_Space}]+")
#: Characters at which str.split() cuts although they are not white space in Unicode.
NOT_SPACE = regex.compile(r"[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class Vocabulary:
    """Merges and tokens as arrays."""

    def __init__(self, path: str) -> None:
        said = json.loads(Path(path).read_text(encoding="utf-8"))
        model, suffix = said["model"], said["model"]["end_of_word_suffix"]
        ids = model["vocab"]
        self.special = {x["content"]: x["id"] for x in said["added_tokens"]}
        self.tokens = [""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in [*ids.items(), *self.special.items()]:
            self.tokens[i] = token
        letters = byte_letters()
        self.inner = np.array([ids[x] for x in letters], np.int64)
        self.last = np.array([ids[x + suffix] for x in letters], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        made: dict[int, int] = {}
        keys, news = [], []
        for rank, (a, b) in enumerate(pairs):
            new = ids[a + b]
            if made.setdefault(new, rank) != rank or max(made.get(ids[a], -1), made.get(ids[b], -1)) >= rank:
                raise ValueError("merges out of order: a token is made after it is used, or twice")
            keys.append(ids[a] << 32 | ids[b])
            news.append(new)
        order = np.argsort(np.array(keys))
        self.keys, self.ranks = np.array(keys, np.int64)[order], order.astype(np.int64)
        self.new = np.array(news, np.int64)
        self.none = len(pairs)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank at which each pair merges; `none` if it doesn't."""
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.none)

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each piece (each has a byte at least): lowest rank first, leftmost first."""
        out: list[list[int]] = [[]] * len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        low = 0
        for high in (1, 2, 4, 6, 8, 12, 16, 24, WIDE):
            rows = np.flatnonzero((lengths > low) & (lengths <= high))
            low = high
            for some in np.array_split(rows, max(1, len(rows) // 20_000)):
                if len(some):
                    self._side_by_side(pieces, some, lengths[some], high, out)
        for i in np.flatnonzero(lengths > WIDE):
            out[i] = self._one(pieces[i])
        return out

    def _side_by_side(self, pieces, rows, lengths, width, out) -> None:
        cols = np.arange(width)
        inside = cols < lengths[:, None]
        codes = np.zeros((len(rows), width), np.int64)
        codes[inside] = np.frombuffer(b"".join([pieces[i] for i in rows]), np.uint8)
        symbols = np.where(inside, np.where(cols == lengths[:, None] - 1, self.last[codes], self.inner[codes]), -1)
        ranks = np.full((len(rows), width), self.none)
        ranks[:, :-1] = np.where(inside[:, 1:], self.rank(symbols[:, :-1], symbols[:, 1:]), self.none)
        while True:
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), at]
            live = best < self.none
            if not live.all():
                for i, own in zip(rows[~live].tolist(), symbols[~live].tolist(), strict=True):
                    out[i] = own[: own.index(-1)] if own[-1] == -1 else own
                rows, symbols, ranks, at, best = rows[live], symbols[live], ranks[live], at[live], best[live]
            if not len(rows):
                return
            each = np.arange(len(rows))
            after = cols > at[:, None]
            symbols = np.where(after, np.concatenate([symbols[:, 1:], np.full((len(rows), 1), -1)], axis=1), symbols)
            ranks = np.where(after, np.concatenate([ranks[:, 1:], np.full((len(rows), 1), self.none)], axis=1), ranks)
            symbols[each, at] = self.new[best]
            right = np.where(at + 1 < width, symbols[each, np.minimum(at + 1, width - 1)], -1)
            ranks[each, at] = np.where(right >= 0, self.rank(symbols[each, at], right), self.none)
            has = at > 0
            ranks[each[has], at[has] - 1] = self.rank(symbols[each[has], at[has] - 1], symbols[each[has], at[has]])

    def _one(self, piece: bytes) -> list[int]:
        """A long piece: a heap of pairs over a linked list."""
        codes = np.frombuffer(piece, np.uint8)
        symbols = self.inner[codes]
        symbols[-1] = self.last[codes[-1]]
        n = len(symbols)
        heap = [(int(r), i) for i, r in enumerate(self.rank(symbols[:-1], symbols[1:])) if r < self.none]
        heapq.heapify(heap)
        symbols = symbols.tolist()
        after, before, pair = list(range(1, n + 1)), list(range(-1, n - 1)), {i: r for r, i in heap}

        def look(i: int) -> None:
            pair.pop(i, None)
            if i >= 0 and after[i] < n:
                r = int(self.rank(np.array([symbols[i]]), np.array([symbols[after[i]]]))[0])
                if r < self.none:
                    pair[i] = r
                    heapq.heappush(heap, (r, i))

        while heap:
            r, i = heapq.heappop(heap)
            if pair.get(i) != r:
                continue
            j = after[i]
            symbols[i], after[i] = int(self.new[r]), after[j]
            if after[j] < n:
                before[after[j]] = i
            symbols[j] = -1
            pair.pop(j, None)
            look(i)
            look(before[i])
        return [x for x in symbols if x >= 0]


def pieces_of(word: str) -> list[bytes]:
    """The pieces of a word after the library's normalising: composed, and each character in lower case."""
    if not word.isascii():
        word = unicodedata.normalize("NFC", word)
        if "Σ" in word:  # its form at a word's end is not asked for
            word = word.replace("Σ", "σ")
    word = word.lower()
    if word.isalpha():
        return [word.encode()]
    if word[:-1].isalpha():  # the rest is one character, a piece of its own
        return [word[:-1].encode(), word[-1].encode()]
    return [x.encode() for x in PIECES.findall(word)]


class Encoder:
    """Encodes texts in a task. Words looked up or merged are kept for the next texts, up to a bound."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Transducer | None) -> None:
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.parts = regex.compile("(" + "|".join(regex.escape(x) for x in sorted(vocabulary.special, key=len, reverse=True)) + ")") if vocabulary.special else None
        self._forget()

    def _forget(self) -> None:
        self.number: defaultdict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.known = 0
        self.lengths = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int64)

    def words(self, text: str | None) -> list[str]:
        if not text:
            return []
        if self.parts is not None and any(x in text for x in self.vocabulary.special):
            cut = self.parts.split(text)
            return [w for x in cut for w in ([x] if x in self.vocabulary.special else self._runs(x))]
        return self._runs(text)

    @staticmethod
    def _runs(text: str) -> list[str]:
        return RUNS.findall(text) if NOT_SPACE.search(text) else text.split()

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each text has."""
        if len(self.number) > KEPT_WORDS:
            self._forget()
        number = self.number.__getitem__
        each = [list(map(number, self.words(t))) for t in texts]
        self._learn()
        at = np.fromiter(chain.from_iterable(each), np.int64, sum(map(len, each)))
        lengths, starts = self.lengths[at], (np.cumsum(self.lengths) - self.lengths)[at]
        ids = self.flat[_ragged(starts, lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum([0, *map(len, each)])]
        return ids, np.diff(ends)

    def _learn(self) -> None:
        """Find the ids of the words that are new."""
        new = list(islice(self.number, self.known, None))
        self.known = len(self.number)
        if not new:
            return
        lengths = np.zeros(len(new), np.int64)
        rank = self.lexicon.ranks([w.encode() for w in new]) if self.lexicon else np.full(len(new), -1)
        for word, i in self.vocabulary.special.items():
            if (at := self.number.get(word, -1) - (self.known - len(new))) >= 0:
                rank[at] = -2 - i
        known = np.flatnonzero(rank >= 0)
        if len(known):
            lengths[known] = self.lexicon.lengths[rank[known]]
        lengths[rank < -1] = 1
        rest = np.flatnonzero(rank == -1).tolist()
        index: dict[bytes, int] = {}
        own = [[index.setdefault(p, len(index)) for p in pieces_of(new[i])] for i in rest]
        merged = self.vocabulary.merge(list(index))
        found = [merged[pieces[0]] if len(pieces) == 1 else [x for p in pieces for x in merged[p]] for pieces in own]
        lengths[rest] = np.fromiter(map(len, found), np.int64, len(found))
        starts = np.cumsum(lengths) - lengths
        flat = np.zeros(int(lengths.sum()), np.int64)
        if len(known):
            first = self.lexicon.starts[rank[known]]
            flat[_ragged(starts[known], lengths[known])] = self.lexicon.ids[_ragged(first, lengths[known])]
        flat[starts[rank < -1]] = -2 - rank[rank < -1]
        flat[_ragged(starts[rest], lengths[rest])] = np.fromiter(chain.from_iterable(found), np.int64, int(lengths[rest].sum()))
        self.lengths = np.concatenate([self.lengths, lengths])
        self.flat = np.concatenate([self.flat, flat])


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of all members of runs that begin at starts."""
    total = np.cumsum(lengths)
    return np.arange(int(total[-1]) if len(total) else 0) + np.repeat(starts - (total - lengths), lengths)


def frequent_words(df: DataFrame, text_col: str, most: int) -> list[str]:
    """The words that occur most often, and twice at least, counted over every text; at most `most` reach the driver.

    Words that occur equally often are all taken or all left.
    """

    def count(batches):
        found: Counter[str] = Counter()

        def told():
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

        for batch in steps(batches):
            for text in batch.column(0).to_pylist():
                if text:
                    found.update(text.split())
            if len(found) > COUNTED_WORDS:
                yield told()
                found.clear()
        yield told()

    counted = df.select(column(text_col).alias("text")).mapInArrow(count, "word string, n long").where(F.octet_length("word") <= LEXICON_BYTES)
    often = stored(counted.groupBy("word").agg(F.sum("n").alias("n")).where("n > 1"), "words")
    # How many words have which count (above 1000 in steps of a hundredth): whole steps are taken while they fit.
    step = F.when(F.col("n") <= 1000, F.col("n")).otherwise(1000 + F.floor(100 * F.log(F.col("n") / 1000)))
    least, total = None, 0
    for row in often.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("n")).orderBy(F.desc("step")).collect():
        total += row["words"]
        if total > most:
            break
        least = row["n"]
    return [] if least is None else sorted(often.where(F.col("n") >= least).select("word").toArrow().column("word").to_pylist())


def compile_lexicon(vocabulary: Vocabulary, words: list[str]) -> np.ndarray:
    """The table of a transducer from words to their ids; words that the encoder would never look up don't harm."""
    ids = Encoder(vocabulary, None)
    plain = sorted({w.encode(): w for w in words if w and w not in vocabulary.special and not NOT_SPACE.search(w)}.items())
    encoded, counts = ids.encode([w for _, w in plain])
    return compile_words([b for b, _ in plain], [x.tolist() for x in np.split(encoded, np.cumsum(counts)[:-1])] if plain else [])


def ship(spark: SparkSession, table: np.ndarray) -> str:
    """Write the table to the shared folder and have every executor, present and future, fetch it; its file's name."""
    name = f"lexicon-{uuid.uuid4().hex}.npy"
    path = f"{scratch_path(spark, 'lexicon')}/{name}"
    raw = io.BytesIO()
    np.save(raw, table)
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = file.getFileSystem(spark._jsc.hadoopConfiguration()).create(file)
    out.write(raw.getvalue())
    out.close()
    spark.sparkContext.addFile(path)
    return name


def decoded(ids: list[int], tokens: list[str]) -> str:
    """The tokens of the ids with a space between, as a vocabulary without a decoder has it."""
    return " ".join(map(tokens.__getitem__, ids))


def encode(
    df: DataFrame, vocabulary_path: str, text_col: str = "text", keep: list[str] | None = None, lexicon_words: int = LEXICON_WORDS, ids: bool = True
) -> DataFrame:
    """Kept columns (all, if not said) with n_tokens, ids (if asked for), ids_sha256 and decoded_sha256.

    The digests are of the ids as little-endian unsigned 32-bit numbers and of the decoded text in UTF-8.
    """
    spark = df.sparkSession
    vocabulary = Vocabulary(vocabulary_path)
    name = ship(spark, compile_lexicon(vocabulary, frequent_words(df, text_col, lexicon_words))) if lexicon_words else None
    shared = spark.sparkContext.broadcast(vocabulary)  # as large as the vocabulary

    def start():
        lexicon = Transducer(np.load(SparkFiles.get(name), mmap_mode="r")) if name else None
        encoder, tokens = Encoder(shared.value, lexicon), shared.value.tokens

        def apply(texts):
            found, counts = encoder.encode(texts)
            cut = np.concatenate([[0], np.cumsum(counts)])
            raw, listed = found.astype("<u4").tobytes(), found.tolist()
            digests, shown = [], []
            for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                digests.append(hashlib.sha256(raw[4 * a : 4 * b]).hexdigest())
                shown.append(hashlib.sha256(decoded(listed[a:b], tokens).encode()).hexdigest())
            lists = [pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(found, pa.int32()))] if ids else []
            return [longs(counts), *lists, strings(digests), strings(shown)]

        return apply

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if ids:
        fields.insert(1, T.StructField("ids", T.ArrayType(T.IntegerType())))
    return map_columns(df, df.columns if keep is None else keep, [text_col], fields, start)


def decode(df: DataFrame, vocabulary_path: str, ids_col: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """Kept columns with `decoded`: the tokens of the ids, specials too, with a space between; null ids give null."""
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary_path).tokens)

    def start():
        tokens = shared.value

        def apply(lists):
            return [strings([None if x is None else decoded(x, tokens) for x in lists])]

        return apply

    return map_columns(df, df.columns if keep is None else keep, [ids_col], [T.StructField("decoded", T.StringType())], start)
