"""License scans: phrases, and an exact set-similarity join of text blocks with license templates.

A block is a line, or in a paragraph of several lines (without a line that has no word) any run of words as long as the
template's, give or take `THRESHOLD`; so a notice is found however its lines are broken and whatever comment signs stand
before them. A block meets a template if it holds at least `THRESHOLD` of the template's distinct words. Words of
templates are ordered by how often they occur in the whole corpus, rarest first. Of a template with t words, o of which
must be met, only the first t - o + 1 can be the first common one (prefix filter); a block needs o of the templates'
words (length filter); where the first common word stands bounds what can still follow (positional filter). Blocks that
pass are compared word by word, so the join is exact. The templates are a fixed, small table in every task.

Phrases are found wherever their words stand consecutively, across lines too.

Cases: null and empty texts have no words, no label and score 0. Labels are distinct and sorted. Ties in frequency go
by the word. Equal rows give equal results; other columns play no part.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepframe.llm.frames import column, doubles, longs, map_columns, steps, strings
from prepframe.llm.words import words_of

THRESHOLD = 0.9

# Phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Templates and their labels: notices as they are commonly put.
TEMPLATES = (
    ("Released under the MIT License", "mit"),
    ("Licensed under the MIT License", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("Licensed under the Apache License, Version 2.0", "apache-2.0"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl-3.0"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License", "gpl"),
    ("GNU Lesser General Public License", "lgpl"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License", "mpl"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc"),
    ("Licensed under CC BY-SA 4.0", "cc-by-sa"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("This is free and unencumbered software released into the public domain", "unlicense"),
)


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]  # distinct, the rarest in the corpus first
    needed: int
    window: int  # words of a block in a paragraph


def templates_of(texts: tuple[tuple[str, str], ...], counts: dict[bytes, int], threshold: float = THRESHOLD) -> list[Template]:
    out = []
    for text, label in texts:
        words = sorted(set(words_of(text)), key=lambda w: (counts.get(w, 0), w))
        out.append(Template(label, tuple(words), max(1, math.ceil(threshold * len(words) - 1e-9)), window_of(text, threshold)))
    return out


def window_of(text: str, threshold: float = THRESHOLD) -> int:
    """Words that a template may spread over."""
    return math.floor(len(words_of(text)) / threshold + 1e-9)


def corpus_counts(df: DataFrame, text_col: str, vocabulary: set[bytes]) -> dict[bytes, int]:
    """How often each of the words occurs in all texts."""

    def count(batches):
        found: Counter[bytes] = Counter()
        for batch in steps(batches):
            for text in batch.column(0).to_pylist():
                found.update(filter(vocabulary.__contains__, words_of(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

    rows = df.select(column(text_col).alias("text")).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in rows.collect()}  # one row for each word of the templates


class Join:
    """The templates with an index from the words of their prefixes, asked block by block."""

    def __init__(self, templates: list[Template], counts: dict[bytes, int]) -> None:
        self.templates = templates
        self.vocabulary = frozenset(w for t in templates for w in t.words)
        self.order = {w: k for k, w in enumerate(sorted(self.vocabulary, key=lambda w: (counts.get(w, 0), w)))}
        self.least = min((t.needed for t in templates), default=0)
        self.prefixes: dict[bytes, list[tuple[int, int]]] = {}
        for number, t in enumerate(templates):
            for place, word in enumerate(t.words[: len(t.words) - t.needed + 1]):
                self.prefixes.setdefault(word, []).append((number, place))

    def may_meet(self, words: list[bytes]) -> bool:
        """False if no block of these words can meet a template: too few words, or none of a prefix."""
        common = self.vocabulary.intersection(words)
        return len(common) >= self.least and not common.isdisjoint(self.prefixes)

    def meets(self, words: list[bytes]) -> dict[int, float]:
        """The templates that a block meets, and the part of their words it holds."""
        block = sorted(self.vocabulary.intersection(words), key=self.order.__getitem__)
        tried: set[int] = set()
        found = {}
        for at, word in enumerate(block):
            if len(block) - at < self.least:
                break
            for number, place in self.prefixes.get(word, ()):
                t = self.templates[number]
                if number in tried:
                    continue
                tried.add(number)  # its first common word: none of those before it is in both
                if min(len(block) - at, len(t.words) - place) >= t.needed:
                    both = len(set(t.words).intersection(block))
                    if both >= t.needed:
                        found[number] = both / len(t.words)
        return found


def best_window(words: list[bytes], template: Template) -> tuple[int, int]:
    """The most distinct words of the template in any of its windows, and where the first such window's first one is."""
    sought = set(template.words)
    spots = [k for k, w in enumerate(words) if w in sought]
    held: Counter[bytes] = Counter()
    most, at, first = 0, 0, 0
    for k in spots:
        held[words[k]] += 1
        # Words too far back go, and those at the start that come again.
        while spots[first] <= k - template.window or held[words[spots[first]]] > 1:
            left = words[spots[first]]
            held[left] -= 1
            if not held[left]:
                del held[left]
            first += 1
        if len(held) > most:
            most, at = len(held), spots[first]
    return most, at


def paragraphs(lines: list[list[bytes]]) -> list[tuple[int, int]]:
    """First line and end of each run of two or more lines with words."""
    out, start = [], 0
    for k in range(len(lines) + 1):
        if k == len(lines) or not lines[k]:
            if k - start > 1:
                out.append((start, k))
            start = k + 1
    return out


def places_of(words: list[bytes], phrases: tuple[tuple[str, str], ...] = PHRASES) -> list[tuple[int, str]]:
    """First word and label of each place where a phrase stands."""
    line = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in phrases:
        sought = b" " + phrase.encode() + b" "
        at = line.find(sought)
        while at >= 0:
            found.append((line.count(b" ", 0, at), label))
            at = line.find(sought, at + 1)
    return found


MATCHES = T.ArrayType(T.StructType([T.StructField("line", T.IntegerType()), T.StructField("label", T.StringType()), T.StructField("containment", T.DoubleType())]))


def scan_licences(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and the blocks that meet templates.

    The score is 1 for a text with a phrase, else the largest containment of a template, else 0.
    """
    source = df.select(column(id_col).alias("doc_id"), column(text_col).alias("text"))
    vocabulary = {w for text, _ in templates for w in words_of(text)}
    counts = corpus_counts(source, "text", vocabulary)
    join = Join(templates_of(templates, counts, threshold), counts)

    def start():
        kind = pa.list_(pa.struct([("line", pa.int32()), ("label", pa.string()), ("containment", pa.float64())]))

        def apply(texts):
            rows = [_scan(t, join) for t in texts]
            n_words, places, matches = zip(*rows, strict=True)
            base = [sorted({x for _, x in own}) for own in places]
            every = [sorted({*b, *[m["label"] for m in own]}) for b, own in zip(base, matches, strict=True)]
            return [
                longs(n_words),
                longs([len(own) for own in places]),
                longs([min((i for i, _ in own), default=None) for own in places]),
                longs([max((i for i, _ in own), default=None) for own in places]),
                strings([",".join(b) for b in base]),
                strings([",".join(x) for x in every]),
                doubles([1.0 if b else max((m["containment"] for m in own), default=0.0) for b, own in zip(base, matches, strict=True)]),
                pa.array(matches, kind),
            ]

        return apply

    fields = [
        *[T.StructField(n, T.LongType()) for n in ("n_words", "n_base", "first_word", "last_word")],
        *[T.StructField(n, T.StringType()) for n in ("base_labels", "labels")],
        T.StructField("score", T.DoubleType()),
        T.StructField("matches", MATCHES),
    ]
    return map_columns(source, ["doc_id"], ["text"], fields, start)


def _scan(text: str | None, join: Join) -> tuple[int, list[tuple[int, str]], list[dict]]:
    words = words_of(text)
    matches = []
    if join.may_meet(words):
        lines = [words_of(line) for line in text.split("\n")]
        met: list[dict[int, float]] = []
        for number, line in enumerate(lines):
            met.append(join.meets(line) if line else {})
            for k, part in sorted(met[-1].items()):
                matches.append({"line": number, "label": join.templates[k].label, "containment": part})
        for start, end in paragraphs(lines):
            whole = [w for line in lines[start:end] for w in line]
            if not join.may_meet(whole):
                continue
            for k in sorted(join.meets(whole)):  # what the paragraph doesn't hold, none of its windows does
                t = join.templates[k]
                most, at = best_window(whole, t)
                if most >= t.needed and most / len(t.words) > max(found.get(k, 0.0) for found in met[start:end]):
                    number = start
                    while at >= len(lines[number]):
                        at -= len(lines[number])
                        number += 1
                    matches.append({"line": number, "label": t.label, "containment": most / len(t.words)})
    return len(words), places_of(words), matches
