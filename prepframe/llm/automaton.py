"""A minimal acyclic transducer: sorted words in, the rank of each word out, suffixes shared.

Every state is stored once. An arc adds to the output the number of words that sort before those going through it, so
the outputs along a word add up to its rank among all words. The table is one array that tasks map into memory.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def compile_words(words: Sequence[bytes], ids: Sequence[Sequence[int]]) -> np.ndarray:
    """One array with everything: words are distinct and in ascending order, ids are their outputs."""
    register: dict[tuple, int] = {}
    size: list[int] = []  # words below a state
    arcs: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

    def settled(final: bool, out: list[tuple[int, int]]) -> int:
        key = (final, tuple(out))
        state = register.get(key)
        if state is None:
            state = register[key] = len(arcs)
            arcs.append(key)
            size.append(final + sum(size[to] for _, to in out))
        return state

    # The states of the last word that may still get arcs: whether a word ends there, and its arcs so far.
    final, out, last = [False], [[]], b""
    for word in words:
        same = 0
        while same < len(last) and same < len(word) and last[same] == word[same]:
            same += 1
        for k in range(len(last), same, -1):
            out[k - 1].append((last[k - 1], settled(final.pop(), out.pop())))
        for _ in word[same:]:
            final.append(False)
            out.append([])
        final[-1] = True
        last = word
    for k in range(len(last), 0, -1):
        out[k - 1].append((last[k - 1], settled(final.pop(), out.pop())))
    root = settled(final[0], out[0])

    keys, targets, adds = [], [], []
    for state, (end, own) in enumerate(arcs):
        before = int(end)
        for label, to in own:
            keys.append(state * 256 + label)
            targets.append(to)
            adds.append(before)
            before += size[to]
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    lengths = np.array([len(x) for x in ids], np.int64)
    flat = np.array([x for own in ids for x in own], np.int64)
    head = np.array([len(keys), len(arcs), len(lengths), len(flat), root, max(map(len, words), default=0)], np.int64)
    parts = [head, *[np.array(x, np.int64)[order] for x in (keys, targets, adds)], np.array([f for f, _ in arcs], np.int64), lengths, flat]
    return np.concatenate(parts)


class Transducer:
    """Looks words up in a compiled table, many at a time."""

    def __init__(self, table: np.ndarray) -> None:
        n_arcs, n_states, n_words, n_ids, self.root, self.longest = (int(x) for x in table[:6])
        at, parts = 6, []
        for n in (n_arcs, n_arcs, n_arcs, n_states, n_words, n_ids):
            parts.append(table[at : at + n])
            at += n
        self.keys, self.targets, self.adds, self.final, self.lengths, self.ids = parts
        self.starts = np.cumsum(self.lengths) - self.lengths

    def ranks(self, words: Sequence[bytes]) -> np.ndarray:
        """The rank of each word, -1 where it is not in the lexicon."""
        rank = np.full(len(words), -1, np.int64)
        if not len(self.keys):
            return rank
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        text = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        live = np.flatnonzero((lengths <= self.longest) & (lengths > 0))
        state, total = np.full(len(live), self.root), np.zeros(len(live), np.int64)
        for step in range(self.longest):
            ended = lengths[live] == step
            done = ended & (self.final[state] == 1)
            rank[live[done]] = total[done]
            go = ~ended
            live, state, total = live[go], state[go], total[go]
            if not len(live):
                return rank
            key = state * 256 + text[starts[live] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[arc] == key
            live, total = live[hit], total[hit] + self.adds[arc[hit]]
            state = self.targets[arc[hit]]
        done = self.final[state] == 1
        rank[live[done]] = total[done]
        return rank
