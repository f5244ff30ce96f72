"""Pre-tokens of the byte-level vocabularies, found with array operations.

The splitting rule is the published one of byte-level BPE::

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

A text is classed character by character (letter, number, space, other); borders follow
from neighbouring classes, so there is no per-match work.  Empty texts have no pieces.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

from tidemark.llm.text import _BYTE_VALUES, Text, span_hashes

LETTER, NUMBER, SPACE, OTHER, UNKNOWN = 0, 1, 2, 3, 255

#: Endings split off after an apostrophe; fixed values of the rule.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


#: Characters with the Unicode property White_Space; fixed values.
WHITE_SPACE = frozenset(
    [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)


class Classes:
    """The class of each character, looked up when it first occurs."""

    def __init__(self):
        self.of = np.full(0x110000, UNKNOWN, np.uint8)

    @staticmethod
    def _class(point: int) -> int:
        if point in WHITE_SPACE:
            return SPACE
        return {"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(point))[0], OTHER)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        classes = self.of[points]
        new = classes == UNKNOWN
        if new.any():
            for point in np.unique(points[new]).tolist():
                self.of[point] = self._class(point)
            classes = self.of[points]
        return classes


@lru_cache(maxsize=1)
def classes() -> Classes:
    return Classes()


def characters(t: Text) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points, the byte at which each starts (one more at the end), first of each document."""
    points = np.frombuffer(t.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    at = np.append(np.flatnonzero((t.data & 0xC0) != 0x80), len(t.data))
    return points, at, np.searchsorted(at, t.offsets)


def _apostrophes(points: np.ndarray, start: np.ndarray, edge: np.ndarray) -> None:
    """Cut the endings: the apostrophe keeps its letters, what follows starts anew."""
    n = len(points)
    for at in np.flatnonzero(start & (points == 39)).tolist():
        for ending in ENDINGS:
            stop = at + 1 + len(ending)
            inside = stop <= n and not edge[at + 1 : stop].any()
            if inside and all(points[at + 1 + k] == ord(c) for k, c in enumerate(ending)):
                start[at + 1] = False
                if stop < n:
                    start[stop] = True
                break


class Pieces:
    """Byte spans of the pieces of a few documents, and how many each document has."""

    def __init__(self, t: Text):
        self.data = t.data
        points, at, first = characters(t)
        n = len(points)
        edge = np.zeros(n + 1, bool)
        edge[first] = True
        kind = classes()(points)
        start = edge[:n].copy()
        start[1:] |= kind[1:] != kind[:-1]
        space = kind == SPACE
        # The last character of a space run before a word leaves the run ...
        last = np.zeros(n, bool)
        last[:-1] = space[:-1] & ~space[1:] & ~edge[1:n]
        start |= last
        # ... and a blank joins the word.
        after = np.zeros(n, bool)
        after[1:] = last[:-1] & (points[:-1] == 32)
        start &= ~after
        _apostrophes(points, start, edge[:n])
        begins = np.flatnonzero(start)
        self.start = at[begins]
        self.end = at[np.append(begins[1:], n)] if len(begins) else self.start
        self.first = np.searchsorted(self.start, t.offsets)

    def hashes(self) -> np.ndarray:
        return span_hashes(_BYTE_VALUES[self.data], self.start, self.end)

    def piece(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()

    def per_doc(self) -> np.ndarray:
        return np.diff(self.first)


def gather(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The slices ``values[start:start + length]`` one after the other."""
    total = int(length.sum())
    out_start = np.cumsum(length) - length
    return values[np.repeat(start - out_start, length) + np.arange(total)]
