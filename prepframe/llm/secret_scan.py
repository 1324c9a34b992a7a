"""Secret scans: patterns verified on the texts that a trigram index leaves over.

From each pattern a Boolean query of trigrams is derived that every match must satisfy. The texts of a task are indexed
batch by batch, in one pass over their bytes: every trigram that some query names has a posting, the sorted numbers of
the texts that hold it. Postings are intersected and united as the query says, and only the texts left are searched with
the pattern. A pattern without mandatory trigrams (such as long hex numbers) searches every text. The index holds no
more than a batch and needs no shuffle.

Cases: null and empty texts have no spans. Spans are code points, end exclusive, leftmost and not overlapping within a
kind; kinds may overlap each other. Very long texts are searched whole. Equal rows give equal results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as sre
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepframe.llm.frames import column, longs, map_columns, strings

#: Strings followed at once while a query is derived.
MOST_STRINGS = 64
#: Bytes of a batch that are looked up at once.
STRETCH = 1 << 20


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and how long a match or one of its groups must be."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    either_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | re.IGNORECASE if self.either_case else re.ASCII)


# The kinds every scan looks for, in the order in which spans of equal start are listed.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
#: Further kinds with a well-known shape.
MORE = (
    Rule("key_block", r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("url_login", r"://[^\s/:@]{1,256}:[^\s/@]{1,256}@"),
)
RULES = BASE + MORE

#: A query: a trigram, ("and", ...), ("or", ...), or None, which every text satisfies.
Query = str | tuple | None


def _all_of(parts: list[Query]) -> Query:
    parts = list(dict.fromkeys(p for p in parts if p is not None))
    return None if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def _any_of(parts: list[Query]) -> Query:
    if not parts or any(p is None for p in parts):
        return None
    parts = list(dict.fromkeys(parts))
    return parts[0] if len(parts) == 1 else ("or", *parts)


def _of_strings(texts: set[str]) -> Query:
    texts = {t.encode().decode("latin-1") for t in texts}  # a character for each byte
    return _any_of([_all_of([t[i : i + 3] for i in range(len(t) - 2)]) for t in sorted(texts)])


def _low(code: int) -> str:
    """A-Z in lower case, as the texts are indexed."""
    return chr(code).lower() if code < 128 else chr(code)


def _strings_of(node) -> set[str] | None:
    """All strings a part of a pattern can match, if they are few; in lower case."""
    kind, value = node
    if kind is sre.LITERAL:
        return {_low(value)}
    if kind is sre.IN:
        found: set[str] = set()
        for what, own in value:
            if what is sre.LITERAL:
                found.add(_low(own))
            elif what is sre.RANGE and own[1] - own[0] < 8:
                found |= {_low(c) for c in range(own[0], own[1] + 1)}
            else:
                return None
        return found if len(found) <= 8 else None
    if kind is sre.SUBPATTERN:
        return _strings_of_all(value[3])
    if kind is sre.BRANCH:
        parts = [_strings_of_all(x) for x in value[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if kind is sre.MAX_REPEAT and value[1] <= 1 and (own := _strings_of_all(value[2])) is not None:
        return own if value[0] else own | {""}
    return None


def _strings_of_all(nodes) -> set[str] | None:
    texts = {""}
    for node in nodes:
        own = _strings_of(node)
        if own is None or len(texts) * len(own) > MOST_STRINGS:
            return None
        texts = {a + b for a, b in product(texts, own)}
    return texts


def _required(nodes) -> Query:
    """What any match of the nodes in order must hold."""
    parts: list[Query] = []
    run = {""}
    for node in nodes:
        own = _strings_of(node)
        if own is not None and len(run) * len(own) <= MOST_STRINGS:
            run = {a + b for a, b in product(run, own)}
            continue
        parts.append(_of_strings(run))
        run = own if own is not None else {""}
        kind, value = node
        if own is None and kind is sre.SUBPATTERN:
            parts.append(_required(value[3]))
        elif own is None and kind is sre.BRANCH:
            parts.append(_any_of([_required(x) for x in value[1]]))
        elif own is None and kind is sre.MAX_REPEAT and value[0]:
            # At least this often: the repeated part itself, and if it is a string, its copies in a row.
            once = _strings_of_all(value[2])
            parts.append(_required(value[2]) if once is None else _of_strings({x * min(value[0], 8) for x in once}))
    parts.append(_of_strings(run))
    return _all_of(parts)


def trigram_query(pattern: str) -> Query:
    """A query over trigrams in lower case that any text with a match satisfies; None if there is none."""
    return _required(_parser.parse(pattern, re.ASCII))


def _named(query: Query) -> set[str]:
    """The trigrams of a query."""
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*[_named(part) for part in query[1:]])


class Trigrams:
    """The trigrams that queries name, numbered from 1, and the number of every possible trigram (0: not named)."""

    def __init__(self, queries: list[Query]) -> None:
        self.names = sorted(set().union(*[_named(q) for q in queries]))
        self.number = np.zeros(1 << 24, np.uint16 if len(self.names) < 1 << 16 else np.uint32)
        for k, gram in enumerate(self.names):
            self.number[int.from_bytes(gram.encode("latin-1"), "big")] = k + 1


class BatchIndex:
    """Postings of a batch: for each named trigram the sorted numbers of the texts that hold it."""

    def __init__(self, texts: list[bytes], grams: Trigrams) -> None:
        self.count = n = len(texts)
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        data = np.frombuffer(b"".join(texts), np.uint8)
        pairs = [np.zeros(0, np.int64)]
        for first in range(0, len(data) - 2, STRETCH):
            part = data[first : first + STRETCH + 2].astype(np.uint32)
            number = grams.number[part[:-2] << 16 | part[1:-1] << 8 | part[2:]]
            at = np.flatnonzero(number)
            text = np.searchsorted(ends, first + at, "right")
            inside = first + at + 3 <= ends[text]  # not across the end of a text
            pairs.append(np.unique(number[at[inside]].astype(np.int64) * n + text[inside]))
        found = np.unique(np.concatenate(pairs))
        cuts = np.searchsorted(found, np.arange(1, len(grams.names) + 2) * n)
        self.postings = {g: found[cuts[k] : cuts[k + 1]] - (k + 1) * n for k, g in enumerate(grams.names)}

    def candidates(self, query: Query) -> np.ndarray:
        """The sorted numbers of the texts that satisfy the query."""
        if query is None:
            return np.arange(self.count)
        if isinstance(query, str):
            return self.postings[query]
        parts = [self.candidates(part) for part in query[1:]]
        if query[0] == "and":
            return reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True), sorted(parts, key=len))
        return np.unique(np.concatenate(parts))


class Scanner:
    """Rules with their queries; finds the spans of many texts."""

    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules = [(r, r.compiled(), trigram_query(r.pattern)) for r in rules]
        self.grams = Trigrams([query for _, _, query in self.rules])
        # A run counts only from its least length on, so shorter ones need not be matched one by one.
        self.runs = {r.kind: re.compile(f"{r.pattern[:-1]}{{{r.least},}}") for r in rules if re.fullmatch(r"\[[^\]]+\]\+", r.pattern) and r.least}

    def spans(self, texts: list[str | None]) -> list[list[tuple[int, int, int]]]:
        """For each text (start, number of the rule, end), in this order."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        index = BatchIndex([(t or "").encode().lower() for t in texts], self.grams)
        for number, (rule, pattern, query) in enumerate(self.rules):
            pattern = self.runs.get(rule.kind, pattern)
            for i in index.candidates(query).tolist():
                for m in pattern.finditer(texts[i] or ""):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        found[i].append((m.start(), number, m.end()))
        for own in found:
            own.sort()
        return found


def _mapped(df: DataFrame, keep: list[str], text_col: str, rules: tuple[Rule, ...], fields: list[T.StructField], make: Callable) -> DataFrame:
    def start():
        scanner = Scanner(rules)
        return lambda texts: make(texts, scanner.spans(texts))

    return map_columns(df, keep, [text_col], fields, start)


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def find_secrets(df: DataFrame, text_col: str = "text", keep: list[str] | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Kept columns (all, if not said) with secrets: kind, start and end of each span."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def make(texts, found):
        return [pa.array([[{"kind": rules[n].kind, "start": a, "end": b} for a, n, b in own] for own in found], kind)]

    return _mapped(df, df.columns if keep is None else keep, text_col, rules, [T.StructField("secrets", SPANS)], make)


def summarise_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts of the base kinds, the digest of their spans, and all spans as text."""

    def listed(own):
        return ",".join([f"{RULES[n].kind}:{a}:{b}" for a, n, b in own])

    def make(texts, found):
        counts = [longs([sum(n == k for _, n, _ in own) for own in found]) for k in range(len(BASE))]
        base = [listed([x for x in own if x[1] < len(BASE)]) for own in found]
        return [*counts, strings([hashlib.sha256(x.encode()).hexdigest() for x in base]), strings([listed(own) for own in found])]

    fields = [T.StructField(f"n_{r.kind}", T.LongType()) for r in BASE]
    fields += [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
    return _mapped(df.select(column(id_col).alias("doc_id"), column(text_col).alias("text")), ["doc_id"], "text", RULES, fields, make)


def mask_secrets(df: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """The same columns and rows, with every span (overlapping ones as one) replaced by the mark."""

    def masked(text, own):
        if not own:
            return text
        out, at = [], 0
        for a, _, b in own:
            if a >= at:
                out += [text[at:a], mark]
            at = max(at, b)
        return "".join([*out, text[at:]])

    def make(texts, found):
        return [strings([masked(t, own) for t, own in zip(texts, found, strict=True)])]

    names = [f"c{i}" for i in range(len(df.columns))]
    new = _mapped(df.toDF(*names), names, names[df.columns.index(text_col)], rules, [T.StructField("masked", T.StringType())], make)
    return new.select(*[F.col("masked").alias(n) if k == text_col else F.col(n) for n, k in zip(names, df.columns, strict=True)]).toDF(*df.columns)
