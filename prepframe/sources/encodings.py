"""Telling single-byte encodings apart by the likelihood of their byte pairs, and reading them.

Under each candidate encoding a byte from 0x80 on is a letter or a sign, more or less common in the languages written
with it; after a lower-case letter, signs and capitals are unlikely. The scores of all such bytes of a file, with the
byte before them, are summed in the aggregation that checks its lines for UTF-8.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Candidates, on equal scores the earlier one wins; letters of their languages by how common they are,
# each group a third as common as the one before.
CANDIDATES = ["ISO-8859-1", "windows-1250", "ISO-8859-2"]
WESTERN = ["éäöüáíóñ", "èàêçúßåøæãï", "âîôùëûõìòÿðþý"]
CENTRAL = ["łąęóżśíáéčš", "ćěřžýůńúäöüő", "źďťňľĺŕôßűâăîşţđ"]
LETTERS = {"ISO-8859-1": WESTERN, "windows-1250": CENTRAL, "ISO-8859-2": CENTRAL}
#: What a byte may stand behind: a lower-case letter, a capital, another high byte, anything else.
KINDS = 4
CAPITAL, SIGN, UNLISTED, IMPOSSIBLE = 0.05, 0.01, 0.002, 1e-6
INSIDE_WORD = 0.02


def characters(encoding: str) -> str:
    """What the bytes 0x80 to 0xFF mean, U+FFFD where they mean nothing."""
    return bytes(range(0x80, 0x100)).decode(encoding, "replace")


def _scores(encoding: str) -> list[float]:
    """Logarithms by kind of the byte before, then byte."""
    common = {c: 3.0**-i for i, group in enumerate(LETTERS[encoding]) for c in group}
    total = sum(common.values())
    out = []
    for kind in range(KINDS):
        for c in characters(encoding):
            lower = c.lower()
            if c == "�" or c < "\xa0":
                p = IMPOSSIBLE
            elif c.isalpha():
                p = common.get(lower, UNLISTED) / total
                if c != lower:
                    p *= INSIDE_WORD if kind == 0 else CAPITAL
            else:
                p = SIGN * (INSIDE_WORD if kind < 2 else 1.0)
            out.append(math.log(p))
    return out


def _pairs(line: Column) -> Column:
    """Places in the table of scores, one for each byte from 0x80 on."""
    spaced = F.regexp_replace(F.concat(F.lit("20"), F.hex(line.cast("binary"))), "(..)", "$1 ")
    found = F.regexp_extract_all(spaced, F.lit("(?=([0-9A-F]{2} [89A-F][0-9A-F]) )"), 1)

    def place(pair: Column) -> Column:
        before = F.substring(pair, 1, 2)
        kind = F.when(before.between("61", "7A"), 0).when(before.between("41", "5A"), 1).when(before >= "80", 2).otherwise(3)
        return kind * 128 + F.conv(F.substring(pair, 4, 2), 16, 10).cast("int") - 127

    return F.transform(found, place)


def line_scores(line: Column) -> list[Column]:
    """A line's score under each candidate; 0 for lines in UTF-8, which say nothing."""
    places = F.when(~F.is_valid_utf8(line), _pairs(line))

    def total(encoding: str) -> Column:
        table = F.array(*[F.lit(s) for s in _scores(encoding)])
        return F.coalesce(F.aggregate(places, F.lit(0.0), lambda s, i: s + F.element_at(table, i)), F.lit(0.0))

    return [total(e) for e in CANDIDATES]


def best(totals: list[Column]) -> Column:
    """The candidate with the highest total, the first one on ties."""
    top = F.greatest(*totals)
    return F.coalesce(*[F.when(t == top, F.lit(e)) for t, e in zip(totals, CANDIDATES, strict=True)])


def read_as(encoding: str) -> str:
    """The encoding to read a file by: bytes of a candidate keep their numbers as ISO-8859-1."""
    return "ISO-8859-1" if encoding in CANDIDATES else encoding


def decoded(text: Column, encoding: str) -> Column:
    """Text read by `read_as` as it stands in the file's encoding."""
    if encoding not in CANDIDATES or encoding == "ISO-8859-1":
        return text
    return F.translate(text, characters("ISO-8859-1"), characters(encoding))


def decoded_name(name: str, encoding: str) -> str:
    if encoding not in CANDIDATES:
        return name
    return name.translate({0x80 + i: c for i, c in enumerate(characters(encoding))})


def encoded(text: Column, encoding: str) -> Column:
    """The reverse: text that written as ISO-8859-1 gives the file's bytes."""
    pairs = [(c, chr(0x80 + i)) for i, c in enumerate(characters(encoding)) if c != "�"]
    return F.translate(text, "".join(c for c, _ in pairs), "".join(b for _, b in pairs))
