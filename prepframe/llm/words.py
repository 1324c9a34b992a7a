"""Words of a text as several operators take them: runs of digits, letters a-z and all characters from U+0080 on, with
A-Z in lower case. In UTF-8 these are runs of bytes, so that texts are cut as bytes."""

from __future__ import annotations

#: Each byte as it stands in a word; a space for what separates words.
WORD_BYTES = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split() if text else []
