"""Cut many texts into pre-tokens at once, as numpy arrays over their code points.

Both public vocabularies cut by classes of characters (letters, digits, white space, the rest) and a few contractions.
A text is cut here only if all its characters are in ranges whose classes are the same in every Unicode version; the
others are left to the caller (`plain` is false for them).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import numpy as np

from .textkit import range_hash

LETTER, DIGIT, SPACE, OTHER, UNKNOWN = range(5)
LIMIT = 0x2800
#: Second letters of contractions that are a pre-token of their own, and the pairs of letters.
ONE, TWO = "stmd", ("re", "ve", "ll")


def _classes() -> np.ndarray:
    out = np.full(LIMIT + 1, UNKNOWN, np.uint8)
    for c in [*range(0x250), *range(0x2010, 0x2028), *range(0x20A0, 0x20AD), *range(0x2190, 0x2200)]:
        kind = unicodedata.category(chr(c))[0]
        out[c] = {"L": LETTER, "N": DIGIT}.get(kind, OTHER)
    out[[*range(0x09, 0x0E), 0x20, 0x85, 0xA0]] = SPACE
    return out


CLASS = _classes()


def code_points(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of the texts, and their offsets in them."""
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le", "surrogatepass"), np.uint32)
    lead = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=lead[1:])
    return points, lead[off]


def _per_text(mark: np.ndarray, off: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(mark) + 1, np.int64)
    np.cumsum(mark, out=sums[1:])
    return sums[off[1:]] - sums[off[:-1]]


def cut(points: np.ndarray, off: np.ndarray, spaces: bool, lower: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """start, end, text and hash of the pre-tokens, and which texts are plain.

    spaces: white space belongs to pre-tokens (a blank goes with what follows it, other white space stands alone);
    else it is left out, every digit stands alone, and `lower` maps the code points first.
    """
    small = np.minimum(points, LIMIT)
    kind = CLASS[small]
    n = len(points)
    bad = kind == UNKNOWN
    if lower is not None:
        small = lower[small]
        bad = bad | (small == LIMIT)
    plain = _per_text(bad, off) == 0
    first = np.zeros(n + 1, bool)
    first[off] = True
    before = np.concatenate([[UNKNOWN], kind[:-1]]).astype(np.uint8) if n else kind
    start = first[:n] | (kind != before)
    blank = points == 0x20
    if spaces:
        # of a run of white space before something else, the last character goes its own way; a blank joins what follows
        ends_run = np.zeros(n, bool)
        if n:
            ends_run[:-1] = (kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~first[1:n]
        start |= ends_run
        joined = np.zeros(n, bool)
        if n:
            joined[1:] = ends_run[:-1] & blank[:-1]
        start &= ~joined
    else:
        start |= kind == DIGIT
    # contractions: an apostrophe that begins a pre-token, then the letters
    for i in np.flatnonzero((points == 0x27) & start) if n else []:
        tail = small[i + 1 : i + 3]
        stop = int(off[np.searchsorted(off, i, "right")])
        a = chr(tail[0]) if len(tail) and i + 1 < stop else ""
        b = a + chr(tail[1]) if a and len(tail) > 1 and i + 2 < stop else ""
        size = 2 if a and a in ONE else 3 if b in TWO else 0
        if size:
            start[i + 1 : i + size] = False
            if i + size < stop and kind[i + size] != SPACE:
                start[i + size] = True
    at = np.flatnonzero(start)
    end = np.append(at[1:], n)
    text = np.searchsorted(off, at, "right") - 1
    if not spaces:
        ink = kind[at] != SPACE
        at, end, text = at[ink], end[ink], text[ink]
    ok = plain[text]
    at, end, text = at[ok], end[ok], text[ok]
    return at, end, text, range_hash(small, at, end), plain


class Codebook:
    """What is known of each pre-token so far, by hash; cleared when it holds `most` of them, so memory is bounded."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], most: int = 500_000):
        self.encode, self.most = encode, most
        self.clear()

    def __len__(self) -> int:
        return self.n

    def clear(self) -> None:
        self.place: dict[int, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.begin = np.zeros(1 << 14, np.int64)
        self.n = 0

    def look_up(self, points: np.ndarray, at: np.ndarray, end: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """The place of each pre-token in the book, and which places are new."""
        found, first, back = np.unique(h, return_index=True, return_inverse=True)
        if self.n + len(found) > self.most:
            self.clear()
        keys = found.tolist()
        place = np.fromiter((self.place.get(k, -1) for k in keys), np.int64, len(keys))
        new = np.flatnonzero(place < 0)
        if len(new):
            b = points.astype("<u4").tobytes()
            words = [b[4 * at[i] : 4 * end[i]].decode("utf-32-le") for i in first[new]]
            coded = self.encode(words)
            sizes = np.fromiter(map(len, coded), np.int64, len(coded))
            flat = np.fromiter((x for c in coded for x in c), np.uint32, int(sizes.sum()))
            place[new] = self.n + np.arange(len(new))
            used = int(self.begin[self.n])
            while len(self.begin) < self.n + len(new) + 2:
                self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
            while len(self.ids) < used + len(flat):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[used : used + len(flat)] = flat
            self.begin[self.n + 1 : self.n + len(new) + 1] = used + np.cumsum(sizes)
            self.place.update(zip((keys[i] for i in new), place[new].tolist(), strict=True))
            self.n += len(new)
        return place[back], place[new].tolist()

    def expand(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pre-tokens one after another, and how many each has."""
        size = self.begin[place + 1] - self.begin[place]
        ends = np.cumsum(size)
        take = np.repeat(self.begin[place] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)
        return self.ids[take], size
