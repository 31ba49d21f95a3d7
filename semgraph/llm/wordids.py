"""Token ids of texts by way of their distinct words.

A tokenizer that treats words on their own has to see each distinct word once.
Texts become arrays of word numbers; new words are encoded together; ids are
then gathered from one flat array.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np


def gather(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The ranges [start, start + length) of a flat array, one after another."""
    ends = np.cumsum(length)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    shift = np.repeat(start - (ends - length), length)
    return flat[shift + np.arange(ends[-1])]


class WordIds:
    """Numbers words, and encodes the new ones when ids are asked for.

    encode: from a list of new words to (flat ids, ids of each word).  Past
    ``limit`` words or ``limit_bytes`` of their letters and ids the numbering
    starts afresh; results don't depend on it.
    """

    class _Numbers(dict):
        def __init__(self):
            self.new: list = []

        def __missing__(self, word):
            n = self[word] = len(self)
            self.new.append(word)
            return n

    def __init__(self, encode: Callable[[list], tuple[np.ndarray, np.ndarray]], limit: int = 200_000, limit_bytes: int = 32 << 20):
        self.encode, self.limit, self.limit_bytes = encode, limit, limit_bytes
        self.clear()

    def clear(self) -> None:
        self.numbers, self.letters = self._Numbers(), 0
        self.flat, self.start, self.length = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def number(self, words: Iterable) -> np.ndarray:
        return np.fromiter(map(self.numbers.__getitem__, words), np.int32)

    def settle(self) -> None:
        """Encodes the words numbered since the last call."""
        new = self.numbers.new
        if new:
            self.numbers.new = []
            self.letters += sum(map(len, new))
            flat, length = self.encode(new)
            start = len(self.flat) + np.cumsum(length) - length
            self.flat = np.concatenate([self.flat, flat.astype(np.uint32)])
            self.start, self.length = np.concatenate([self.start, start]), np.concatenate([self.length, length])

    def ids(self, numbers: np.ndarray) -> np.ndarray:
        return gather(self.flat, self.start[numbers], self.length[numbers])

    def rest(self) -> None:
        """To be called between batches, when no numbers are held."""
        if len(self.numbers) > self.limit or self.letters + self.flat.nbytes > self.limit_bytes:
            self.clear()
