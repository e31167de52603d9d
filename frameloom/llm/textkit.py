"""Words, lines and shingles of many texts at once, as numpy arrays over their UTF-8 bytes.

White space is ASCII only (0x20, 0x09 to 0x0D), so that bytes can be judged one by one. Equality of words, lines and
shingles is equality of 64-bit hashes, sums of one mixed number for each byte at its place: different texts are taken for equal
with a chance of 2^-64 a pair, whatever their structure.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of h (the finaliser of splitmix64)."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def range_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of each range of values (below 2**24)."""
    size = end - start
    ends = np.cumsum(size)
    place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)
    each = values[np.repeat(start, size) + place].astype(U)
    sums = np.zeros(len(place) + 1, U)
    np.cumsum(mix(each + (place.astype(U) << U(24)) + U(0x9E3779B97F4A7C15)), out=sums[1:])
    return mix(sums[ends] - sums[ends - size] + size.astype(U))


class Words:
    """The words of a run of texts: start, end (bytes), hash, and text (the index of its text)."""

    def __init__(self, raw: np.ndarray, off: np.ndarray, lower: bool = False):
        self.raw, self.off, n = raw, off, len(raw)
        b = LOWER[raw] if lower else raw
        space = SPACE[raw]
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        before, after = np.ones(n, bool), np.ones(n, bool)
        if n:
            before[1:], after[:-1] = space[:-1], space[1:]
        self.start = np.flatnonzero(~space & (before | edge[:-1]))
        self.end = np.flatnonzero(~space & (after | edge[1:])) + 1
        self.text = np.searchsorted(off, self.start, "right") - 1
        self.bytes = b
        self.hash = range_hash(b, self.start, self.end)
        self.space = space

    def per_text(self, mark: np.ndarray) -> np.ndarray:
        """How many bytes of each text are marked."""
        sums = np.zeros(len(mark) + 1, np.int64)
        np.cumsum(mark, out=sums[1:])
        return sums[self.off[1:]] - sums[self.off[:-1]]

    def count(self) -> np.ndarray:
        return np.bincount(self.text, minlength=len(self.off) - 1)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each run of `width` words within one text."""
        n = len(self.hash) - width + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, U)
        h = np.zeros(n, U)
        for k in range(width):
            h = h * U(0xD6E8FEB86659FD93) + self.hash[k : n + k]
        at = np.flatnonzero(self.text[:n] == self.text[width - 1 :])
        return at, mix(h[at])

    def shingle_sets(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Text and hash of the distinct shingles, by text then hash; shorter texts give their whole sequence as one."""
        at, h = self.windows(width)
        text, n = self.text[at], self.count()
        short = np.flatnonzero((n > 0) & (n < width))
        if len(short):
            first = np.concatenate([[0], np.cumsum(n)])[short]
            whole = np.zeros(len(short), U)
            for k in range(width - 1):
                has = n[short] > k
                whole[has] = whole[has] * U(0xA0761D6478BD642F) + self.hash[first[has] + k]
            text, h = np.concatenate([text, short]), np.concatenate([h, mix(whole + n[short].astype(U))])
        order = np.lexsort((h, text))
        text, h = text[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
        return text[new], h[new]

    def repeated_words(self, width: int) -> np.ndarray:
        """Per text, how many words stand in windows of `width` words that its text has at least twice."""
        at, h = self.windows(width)
        key = mix(h + self.text[at].astype(U) * U(0x9FB21C651E98DF25))
        order = np.argsort(key, kind="stable")
        same = np.zeros(len(key) + 1, bool)
        same[1:-1] = key[order][1:] == key[order][:-1]
        hit = at[order[same[:-1] | same[1:]]]
        depth = np.zeros(len(self.hash) + 1, np.int64)
        depth[hit] += 1
        depth[hit + width] -= 1
        return np.bincount(self.text[np.cumsum(depth[:-1]) > 0], minlength=len(self.off) - 1)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """start, end, text and hash of the \\n-split lines that hold a word."""
        if not len(self.raw):
            return (*(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, U))
        cut = np.flatnonzero(self.raw == 10)
        start = np.union1d(self.off[:-1], cut + 1)
        start = start[start < len(self.raw)]
        end = np.append(start[1:], len(self.raw))
        text = np.searchsorted(self.off, start, "right") - 1
        end = np.where((end > start) & (self.raw[np.maximum(end - 1, 0)] == 10), end - 1, end)
        ink = np.zeros(len(self.raw) + 1, np.int64)
        np.cumsum(~self.space, out=ink[1:])
        full = ink[end] > ink[start]
        return start[full], end[full], text[full], range_hash(self.bytes, start[full], end[full])

    def repeated_lines(self) -> np.ndarray:
        """Per text, how many lines with a word equal an earlier line."""
        _, _, text, h = self.lines()
        total = np.bincount(text, minlength=len(self.off) - 1)
        order = np.lexsort((h, text))
        new = np.ones(len(h), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (text[order][1:] != text[order][:-1])
        return total - np.bincount(text[order][new], minlength=len(self.off) - 1)
