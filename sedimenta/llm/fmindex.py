"""Bidirectional FM-index over numbers, with all intervals of one depth extended at once.

A text is an array of word numbers from 1, with 0 before, between and behind its pieces. Each
direction sorts the places of the text by the next few symbols and keeps the symbol before each
place (the transform) with the row that this symbol leads to. A phrase is an interval of rows in
either direction. Reading the symbols of its interval gives all its extensions to one side, with
their counts and their own intervals; the symbols that sort before one tell where the extension
lies in the other direction's interval.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np


def _order(text: np.ndarray, depth: int) -> np.ndarray:
    """Places in order of their next ``depth`` symbols or more, by doubling; the text is a ring."""
    rank, known = text.astype(np.int64), 1
    while known < depth:
        pairs = rank * (rank.max() + 1) + np.roll(rank, -known)
        rank, known = np.unique(pairs, return_inverse=True)[1], 2 * known
    return np.argsort(rank, kind="stable")


@dataclass(frozen=True)
class Direction:
    """``before``: the symbol before each sorted place; ``leads``: the row where it stands itself."""

    before: np.ndarray
    leads: np.ndarray

    @classmethod
    def of(cls, text: np.ndarray, depth: int) -> Direction:
        before = text[_order(text, depth) - 1]
        leads = np.empty(len(text), np.int64)
        leads[np.argsort(before, kind="stable")] = np.arange(len(text))
        return cls(before, leads)

    def extensions(
        self, near: np.ndarray, far: np.ndarray, size: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Parent, symbol, near and far start, and count of every extension by a word.

        ``near`` and ``far`` are where the intervals start in this and in the other direction.
        """
        ends = np.cumsum(size)
        parent = np.repeat(np.arange(len(size)), size)
        rows = np.arange(len(parent)) + np.repeat(near - (ends - size), size)
        symbol = self.before[rows]
        key = parent * (int(self.before.max()) + 1) + symbol
        ordered = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.diff(key[ordered], prepend=-1))
        count = np.diff(first, append=len(ordered))
        head = ordered[first]
        parent, symbol = parent[head], symbol[head]
        smaller = first - (ends - size)[parent]
        word = symbol != 0
        found = (parent, symbol, self.leads[rows[head]], far[parent] + smaller, count)
        return tuple(values[word] for values in found)


def phrases(text: np.ndarray, longest: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """For 2 to ``longest`` words: the words of every phrase as columns, and its counts.

    ``text`` starts with 0. Phrases of even length grow to the right, those of odd length to the left.
    """
    size = np.bincount(text)
    start = np.cumsum(size) - size
    word = np.flatnonzero(size)[1:]
    columns, forward, backward, count = [word], start[word], start[word], size[word]
    to_right = Direction.of(text[::-1], longest - 1)
    to_left = Direction.of(text, longest - 1) if longest > 2 else None
    for length in range(2, longest + 1):
        if not len(count):
            return
        if length % 2 == 0:
            parent, new, backward, forward, count = to_right.extensions(backward, forward, count)
            columns = [*(c[parent] for c in columns), new]
        else:
            parent, new, forward, backward, count = to_left.extensions(forward, backward, count)
            columns = [new, *(c[parent] for c in columns)]
        yield columns, count
