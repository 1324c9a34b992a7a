"""Substring deduplication by hashed units: of all copies of a passage in the corpus, the earliest ranked one stays.

A text is cut into units after each line, each sentence and each word whose digest is below `MARK`, which depends on
the word alone, so that copies of a passage are cut alike wherever they stand. Units are normalised (A-Z in lower case,
white space runs as one space) and grouped by a 128-bit digest over the whole corpus. The earliest copy of a unit always
stays. Units common by chance are no passages: from runs of consecutive repeated units, what goes are stretches of at
least `min_words` words of which half or more stands in one document in the same order, at the place where the earliest
copies are. Copies rank by document id (null last), then by
the digest of the document's text, then by place. Every
document comes back once, with what stays of its text and the offsets (code points, end exclusive, up to the next word)
of what was removed.

`min_words` lies below the length of the passages looked for, since the units at both ends of a passage may hold words
of the text around it. In scripts without spaces two letters count as a word.

Cases: null and empty texts, and texts of white space, come back as they are. Rows that agree in id and text count as one
document with one result for each of them. A line that one document repeats back to back stays, its copies being no
stretch of the first one. Very long texts are cut in one pass, their units travel as rows. Tables without rows give no
rows; columns other than id and text are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepframe.llm.frames import column, longs, map_columns, steps, strings
from prepframe.scratch import stored

#: Words of a stretch that is removed: those of a passage of over 50 words without the parts of units at its ends.
MIN_WORDS = 40
#: Words whose digest in hex is smaller end a unit: one in 64.
MARK = "04"
SENTENCE_ENDS = ".!?。！？"
#: Digests of repeated units up to which their table is broadcast (40 bytes each). Beyond, those of more than
#: 1/HOT_SHARE of all units are (fewer than HOT_SHARE), and others are joined by shuffle.
BROADCAST_DIGESTS, HOT_SHARE = 200_000, 1_000
#: Words whose marks a task remembers.
REMEMBERED = 1_000_000
#: Bits of a unit's place in its text; the bits above are its text's digest.
PLACE_BITS = 25
#: Rows without an id rank from here on, by a digest of their text.
NO_ID = (1 << 63) - (1 << 30)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_SPACE = b" \t\n\x0b\x0c\r"
_ENDS = re.compile("[.!?](?=[ \t\n\x0b\x0c\r]|\\Z)|。|！|？|\n".encode())
_WORDS = re.compile(rb"[^ \t\n\x0b\x0c\r]+")
_UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]")


class Cutter:
    """Cuts texts; remembers which words are marks."""

    def __init__(self) -> None:
        self.known: set[bytes] = set()
        self.marks: set[bytes] = set()

    def _unmarked(self, words: list[bytes]) -> bool:
        if not self.known.issuperset(words):
            if len(self.known) >= REMEMBERED:
                self.known.clear()
                self.marks.clear()
            new = set(words) - self.known
            self.known |= new
            self.marks.update(w for w in new if md5(w).hexdigest()[: len(MARK)] < MARK)
        return self.marks.isdisjoint(words)

    def units(self, raw: bytes) -> Iterator[tuple[int, int, bytes]]:
        """(start, words, normalised) of each unit of a text in UTF-8; the next one's start ends it."""
        low, at = raw.translate(_LOWER), 0
        unspaced = bool(raw) and max(raw) >= 0xE0  # the scripts without spaces lie beyond U+0800
        for end in [*[m.end() for m in _ENDS.finditer(low)], len(low)]:
            piece = low[at:end]
            words = piece.split()
            if words:
                start = at + len(piece) - len(piece.lstrip(_SPACE))
                if self._unmarked(words):
                    yield start, _size(words, unspaced), b" ".join(words)
                else:
                    own: list[bytes] = []
                    for m in _WORDS.finditer(piece):
                        if not own:
                            start = at + m.start()
                        own.append(m.group())
                        if own[-1] in self.marks:
                            yield start, _size(own, unspaced), b" ".join(own)
                            own = []
                    if own:
                        yield start, _size(own, unspaced), b" ".join(own)
            at = end


def _size(words: list[bytes], unspaced: bool) -> int:
    return max(len(words), len(_UNSPACED.findall(b" ".join(words).decode())) // 2) if unspaced else len(words)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, document, text) to their units, `unit` being the document's digest and the place."""
    cutter = Cutter()
    for batch in steps(batches, 1 << 20):
        rows, places, words, digests = [], [], [], []
        for row, text in enumerate(batch.column(2).to_pylist()):
            units = [(n, md5(unit).digest()) for _, n, unit in cutter.units(text.encode())]
            rows += [row] * len(units)
            places += range(len(units))
            words += [n for n, _ in units]
            digests += [d for _, d in units]
        at = pa.array(np.array(rows, np.int64))
        unit = batch.column(1).take(at).to_numpy(zero_copy_only=False) + np.array(places, np.int64)
        halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        columns = [batch.column(0).take(at), pa.array(unit), pa.array(words, pa.int32()), *[pa.array(np.ascontiguousarray(halves[:, k])) for k in (0, 1)]]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "unit", "words", "d0", "d1"])


def _with_kept(units: DataFrame, repeated: DataFrame) -> DataFrame:
    """Units that occur again elsewhere, with the copy that stays; that copy itself is left out."""
    digest = ["d0", "d1"]
    if repeated.limit(BROADCAST_DIGESTS + 1).count() <= BROADCAST_DIGESTS:
        met = [units.join(F.broadcast(repeated), digest)]
    else:
        hot = F.col("copies") * HOT_SHARE > units.count()
        common = F.broadcast(repeated.where(hot))
        met = [units.join(common, digest), units.join(common, digest, "left_anti").join(repeated.where(~hot), digest)]
    # rows of one document are the same units: where units met by shuffle, they lie together already
    gone = [m.where("id <> k.id OR unit <> k.unit").dropDuplicates([*digest, "id", "unit"]) for m in met]
    out = gone[0] if len(gone) == 1 else gone[0].union(gone[1])
    document, place = _document(F.col("unit")), _place(F.col("unit"))
    shift = _place(F.col("k.unit")) - place
    return out.select("id", document.alias("document"), place.alias("place"), "words", F.col("k.id").alias("k_id"), _document(F.col("k.unit")).alias("k_document"), shift.alias("shift"))


def _place(unit):
    return unit.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))


def _document(unit):
    return unit.bitwiseAND(F.lit(-(1 << PLACE_BITS)))


def _stretches(gone: DataFrame, min_words: int) -> DataFrame:
    """(id, document, spans) of documents that lose something: spans of first and last place."""
    document = ["id", "document"]
    along = Window.partitionBy(*document).orderBy("place")
    runs = gone.select(
        "*",
        (F.col("place") - F.row_number().over(along)).alias("run"),
        F.sum("words").over(along).alias("upto"),
    )
    found = runs.groupBy(*document, "run", "k_id", "k_document", "shift").agg(
        F.sum("words").alias("own"),
        (F.max("upto") - F.min(F.col("upto") - F.col("words"))).alias("all"),
        F.struct(F.min("place").alias("a"), F.max("place").alias("b")).alias("span"),
    )
    found = found.where((F.col("all") >= min_words) & (F.col("own") * 2 >= F.col("all")))
    return found.groupBy(*document).agg(F.sort_array(F.collect_list("span")).alias("spans"))


def _merged(spans: list[dict]) -> list[list[int]]:
    """First and last places in order, spans that touch or overlap as one."""
    out: list[list[int]] = []
    for s in spans:
        if out and s["a"] <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], s["b"])
        else:
            out.append([s["a"], s["b"]])
    return out


def _start():
    cutter = Cutter()

    def without(text: str, spans: list[list[int]]) -> tuple[str, list[dict]]:
        raw = text.encode()
        starts = [0, *[s for s, _, _ in cutter.units(raw)][1:], len(raw)]
        pieces, removed, at, chars = [], [], 0, 0
        for a, b in spans:
            stays, goes = raw[at : starts[a]].decode(), raw[starts[a] : starts[b + 1]].decode()
            pieces.append(stays)
            start = chars + len(stays)
            at, chars = starts[b + 1], start + len(goes)
            removed.append({"start": start, "end": chars})
        return "".join([*pieces, raw[at:].decode()]), removed

    def apply(texts, found):
        spans = [_merged(s or []) for s in found]
        cut = [without(t, s) if s else (t, []) for t, s in zip(texts, spans, strict=True)]
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        return [strings([t for t, _ in cut]), longs([sum(b - a + 1 for a, b in s) for s in spans]), pa.array([r for _, r in cut], pa.list_(span))]

    return apply


def remove_repeated_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text (what stays), n_removed (units), removed (array of start and end in the original text)."""
    text = column(text_col)
    by_text = F.lit(NO_ID) + F.xxhash64(text, F.lit(1)).bitwiseAND(F.lit((1 << 30) - 1))
    rank = F.coalesce(column(id_col).cast("long"), by_text)
    docs = df.select(column(id_col).alias("doc_id"), rank.alias("id"), _document(F.xxhash64(text)).alias("document"), text.alias("text"))
    units = docs.where("text IS NOT NULL").select("id", "document", "text").mapInArrow(_cut, "id long, unit long, words int, d0 long, d1 long")
    units = stored(units, "units")
    kept = F.min(F.struct("id", "unit")).alias("k")
    repeated = units.groupBy("d0", "d1").agg(kept, F.count(F.lit(1)).alias("copies")).where("copies > 1")
    spans = _stretches(_with_kept(units, stored(repeated, "repeated")), min_words)
    found = docs.join(spans, ["id", "document"], "left")
    offsets = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    fields = [T.StructField("text", T.StringType()), T.StructField("n_removed", T.LongType()), T.StructField("removed", offsets)]
    return map_columns(found.select("doc_id", "text", "spans"), ["doc_id"], ["text", "spans"], fields, _start)
