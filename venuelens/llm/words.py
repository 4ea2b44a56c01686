"""Words of flat UTF-8 text and hashes of runs of them, in numpy.

Separators are ASCII bytes, which never lie inside a UTF-8 character, so bytes decide.
"""

from __future__ import annotations

import numpy as np

from venuelens.llm.common import BASE, BASE_INVERSE, PrefixHash, mix, powers

#: Kinds of bytes: of a word, between words, between pieces of text.
WORD, SPACE, BREAK = 0, 1, 2


def kinds(spaces: bytes, breaks: bytes = b"") -> np.ndarray:
    """The kind of each byte."""
    out = np.zeros(256, np.uint8)
    out[list(spaces)] = SPACE
    out[list(breaks)] = BREAK
    return out


class Words:
    """Places of the words of flat documents, in order: start, end (bytes) and the row each lies in."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray, table: np.ndarray):
        kind = table[data]
        inside = kind == WORD
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True  # a document's end ends its last word
        before = np.r_[False, inside[:-1]] & ~edge[:-1] if len(data) else inside
        after = np.r_[inside[1:], False] & ~edge[1:] if len(data) else inside
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.row = np.searchsorted(offsets, self.start, side="right") - 1
        #: where each row's words begin, and the number of all
        self.edges = np.searchsorted(self.start, offsets)
        self._breaks = kind

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, data: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        return mix(PrefixHash(data).of(self.start, self.end))

    def piece(self) -> np.ndarray:
        """A number that rises where a row or a piece between BREAK bytes begins."""
        breaks = np.cumsum(self._breaks == BREAK)
        at = breaks[self.start] if len(self.start) else np.zeros(0, np.int64)
        new = (np.diff(at, prepend=at[:1]) != 0) | (np.diff(self.row, prepend=self.row[:1]) != 0)
        return np.cumsum(new)


class RunHash:
    """Polynomial hash (mod 2**64) of any run of words, from one prefix sum over the words' hashes."""

    def __init__(self, values: np.ndarray):
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * powers(BASE, len(values)), out=self.sums[1:])
        self.shift = powers(BASE_INVERSE, len(values) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.shift[start])

    def windows(self, k: int) -> np.ndarray:
        """Hash of every run of k words."""
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[k:] - self.sums[:-k]) * self.shift[:n])
