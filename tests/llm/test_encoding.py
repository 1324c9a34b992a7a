from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from prepframe.llm import bpe
from prepframe.llm.automaton import Transducer, compile_words
from prepframe.llm.bpe import Encoder, Vocabulary, compile_lexicon
from prepframe.llm.queries import QUERIES, VOCABULARY


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(VOCABULARY)


def test_transducer_is_minimal_and_exact():
    draw = random.Random(4)
    words = sorted({bytes(draw.choices(b"abc", k=draw.randint(1, 7))) for _ in range(300)})
    ids = [[draw.randrange(99) for _ in range(draw.randint(0, 3))] for _ in words]
    t = Transducer(compile_words(words, ids))
    asked = [*words, b"", b"zz", b"abcabcabc", words[0] + b"z"]
    known = {w: i for i, w in enumerate(words)}
    assert t.ranks(asked).tolist() == [known.get(w, -1) for w in asked]
    assert [t.ids[s : s + n].tolist() for s, n in zip(t.starts, t.lengths, strict=True)] == ids
    prefixes = {w[:k] for w in words for k in range(len(w) + 1)}
    rests = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for p in prefixes}
    assert len(t.final) == len(rests)


def test_transducer_without_words():
    assert Transducer(compile_words([], [])).ranks([b"a", b""]).tolist() == [-1, -1]


def test_like_the_library(library, vocabulary, plain):
    draw = random.Random(1)
    letters = [*"abcdeé ñΣσςİıßǅﬁ́ͅ \t\n\x0b\x0c\r\x1c\x1d\x85   ​᠎　'stredvml019²½Ⅻ中文\U0001f642.,-_=|<>"]
    letters += ["<|endoftext|>", "<|startoftext|>", "'s", "'LL", "the ", "and", "K", "Å", "`"]
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 40))) for _ in range(3000)]
    texts += ["".join(draw.choices("abcdeiou", k=300)) for _ in range(20)] + ["a" * 5000, "ab" * 900 + "é" * 200, None, "", " "]
    texts += [t for _, t in plain]
    frequent = sorted({w for t in texts[-200:] if t for w in t.split()})[::2]
    for encoder in (Encoder(vocabulary, None), Encoder(vocabulary, Transducer(compile_lexicon(vocabulary, frequent)))):
        ids, counts = encoder.encode(texts)
        for text, own in zip(texts, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
            want = library.encode(text or "", add_special_tokens=False).ids
            assert own.tolist() == want, text
            assert bpe.decoded(want, vocabulary.tokens) == library.decode(want, skip_special_tokens=False)


def test_query_and_round_trip(spark, sf_dir, docs, library):
    rows = {r["doc_id"]: r for r in QUERIES["op2_bpe"](spark, sf_dir).collect()}
    assert len(rows) == docs.count()
    for r in docs.collect():
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        own = rows[r["doc_id"]]
        assert own["n_tokens"] == len(want)
        assert own["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert own["decoded_sha256"] == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()


def test_cases(odd, nothing, library):
    for lexicon in (0, 1000):
        found = bpe.decode(bpe.encode(odd, VOCABULARY, lexicon_words=lexicon), VOCABULARY)
        rows = found.collect()
        assert len(rows) == odd.count()
        for r in rows:
            want = library.encode(r["text"] or "", add_special_tokens=False).ids
            assert r["ids"] == want and r["decoded"] == library.decode(want, skip_special_tokens=False)
    assert bpe.encode(nothing, VOCABULARY).count() == 0


def test_frequent_words(spark):
    df = spark.createDataFrame([("b a b",), ("a c",), (None,), ("",)], "text string")
    assert bpe.frequent_words(df, "text", 2) == ["a", "b"]
    assert bpe.frequent_words(df, "text", 1) == []
    many = spark.createDataFrame([("x " * 1700 + "y " * 1200 + "z z",)], "text string")
    assert [bpe.frequent_words(many, "text", n) for n in (1, 2, 3)] == [["x"], ["x", "y"], ["x", "y", "z"]]


def test_kept_words_are_bounded(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    e, whole = Encoder(vocabulary, None), Encoder(vocabulary, None)
    texts = ["one two three four", "five one", "two two six"]
    each = [e.encode([t])[0].tolist() for t in texts]
    assert sum(each, []) == whole.encode(texts)[0].tolist() and len(e.number) <= 5
