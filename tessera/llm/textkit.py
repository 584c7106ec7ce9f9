"""Vectorised word hashing shared by the corpus operators.

Texts are cut into words by ASCII white space (the complement of
``[^\\x20\\x09-\\x0D]``).  Each word gets a 64-bit hash computed with numpy over
the UTF-8 bytes of many texts at once; nothing here loops over words in Python.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

U = np.uint64
_NEAR_LETTERS = 64  # places of a word whose letter codes are looked up
_LEFT, _RIGHT = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93)

#: Texts are handled in chunks of about this many bytes, which bounds the arrays
#: of a worker; a longer text forms a chunk of its own.
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ASCII_LOWER = np.arange(256, dtype=np.uint8)
_ASCII_LOWER[ord("A") : ord("Z") + 1] += 32
_PUNCT = np.zeros(256, bool)
_PUNCT[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser; the result is a fresh array."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_CODES = mix((np.arange(1, (_NEAR_LETTERS << 8) + 1, dtype=U)) * _LEFT)


class Words:
    """The words of a list of texts.

    hash: one uint64 per word; first: index of each text's first word, with the
    total at the end; start, end: byte range of each word in ``data``.
    """

    __slots__ = ("data", "end", "first", "hash", "letters", "start")

    def __init__(self, first, start, end, data, letters):
        self.first, self.start, self.end, self.data, self.letters = first, start, end, data, letters
        self.hash = self.beginnings()

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def beginnings(self, most: int | None = None) -> np.ndarray:
        """A hash of the first ``most`` bytes of each word, of the whole word without a limit."""
        sizes = self.end - self.start
        at = np.cumsum(sizes) - sizes
        taken = sizes if most is None else np.minimum(sizes, most)
        if not len(sizes):
            return np.zeros(0, U)
        if most is None:
            out = np.add.reduceat(self.letters, at)
        else:
            out = self.letters[at].copy()
            for k in range(1, most):
                longer = np.flatnonzero(taken > k)
                out[longer] += self.letters[at[longer] + k]
        out += taken.astype(U) * _RIGHT
        return mix(out)


def words_of(texts: list[str], ascii_lower: bool = False, full_lower: bool = False, strip_punctuation: bool = False) -> Words:
    """Cut and hash the words of the texts (None counts as empty).

    A word's hash is the mixed sum of one random code per byte and its place in
    the word, so words that differ in regular ways do not cancel out.  full_lower
    lowers all of Unicode, ascii_lower only A-Z; strip_punctuation removes ASCII
    punctuation bytes, so a word of punctuation alone vanishes.
    """
    raw = [(t.lower() if full_lower else t).encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    ends = np.cumsum(np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw))) if raw else np.zeros(0, np.int64)
    if ascii_lower:
        data = _ASCII_LOWER[data]
    if strip_punctuation:
        keep = ~_PUNCT[data]
        kept = np.zeros(len(data) + 1, np.int64)
        np.cumsum(keep, out=kept[1:])
        data, ends = data[keep], kept[ends]
    solid = ~_SPACE[data]
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = solid
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    first = np.zeros(len(raw) + 1, np.int64)
    first[1:] = np.searchsorted(start, ends)
    return Words(first, start, end, data, _letter_codes(data[solid], end - start))


def _letter_codes(solid: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The code of each byte of the words at its place in its word."""
    ends = np.cumsum(sizes)
    code = np.arange(len(solid))
    code -= np.repeat(ends - sizes, sizes)
    code <<= 8
    code |= solid
    if not len(sizes) or int(sizes.max()) <= _NEAR_LETTERS:
        return _CODES[code]
    far = np.flatnonzero(code >= len(_CODES))
    beyond = mix((code[far].astype(U) + U(1)) * _LEFT)
    code[far] = 0
    out = _CODES[code]
    out[far] = beyond
    return out


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` consecutive words, borders of texts ignored.

    Runs double in length until two, overlapping if need be, make the width.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, U)
    out, have = mix(hashes + U(width)), 1
    while have < width:
        step = min(have, width - have)
        left = out[: len(out) - step] * _LEFT
        left += out[step:] * _RIGHT
        out = mix(left)
        have += step
    return out


def inner(first: np.ndarray, width: int) -> np.ndarray:
    """Which windows of that width lie within one text, as a mask over their starts."""
    total = int(first[-1])
    n = max(0, total - width + 1)
    fits = np.zeros(total + 1, np.int32)
    counts = np.diff(first)
    ok = counts >= width
    np.add.at(fits, first[:-1][ok], 1)
    np.add.at(fits, (first[1:] - width + 1)[ok], -1)
    return np.cumsum(fits)[:n] > 0


def chunks(frames: Iterable, column: str = "text", most: int = CHUNK_BYTES) -> Iterator:
    """Cut incoming pandas frames into row slices of about ``most`` characters of text."""
    for frame in frames:
        if not len(frame):
            continue
        sizes = np.cumsum([len(t) if isinstance(t, str) else 0 for t in frame[column]])
        at = 0
        while at < len(frame):
            base = sizes[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(sizes, base + most, "right")))
            yield frame.iloc[at:stop].reset_index(drop=True)
            at = stop


def texts_of(column) -> list:
    """Values of a pandas column, with None for nulls."""
    return [t if isinstance(t, str) else None for t in column]
