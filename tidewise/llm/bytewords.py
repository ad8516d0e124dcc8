"""Vectorised words of many texts at once (numpy, inside tasks).

A batch of texts is one byte buffer. Words are runs outside the ASCII white space (0x20, 0x09-0x0D) after
lower-casing A-Z; each gets a 64-bit hash: its 8-byte pieces go through a bit mixer, each with its place, before they
are summed, so that no regular pattern of bytes cancels out (as in a polynomial modulo 2**64). Word identity is
this hash: two given words clash with a chance near 2**-64.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: ASCII other than letters and digits
IS_PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def release_memory() -> None:
    """Hands what a block has freed back to the system. Python workers live on from task to task, so memory that one
    stage has freed but kept would stand beside the next stage's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finisher on uint64 (splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words low[start:end] (none of them empty)."""
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    padded = np.concatenate((low, np.zeros(8, dtype=np.uint8)))
    eight = np.ndarray((len(low),), dtype="<u8", buffer=padded.data, strides=(1,))  # the 8 bytes from every place on
    pieces = (end - start + 7) // 8
    first = np.cumsum(pieces) - pieces
    number = np.arange(int(pieces.sum())) - np.repeat(first, pieces)
    at = np.repeat(start, pieces) + 8 * number
    inside = np.minimum(np.repeat(end, pieces) - at, 8).astype(np.uint64)
    piece = eight[at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * inside))
    summed = np.add.reduceat(mix(piece ^ mix(number.astype(np.uint64))), first)
    return mix(summed + (end - start).astype(np.uint64))


def slices(texts: pa.Array, most: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes of text; a longer text is a range of its own."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    ends = np.cumsum(lengths)
    lo, n = 0, len(lengths)
    while lo < n:
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield lo, hi
        lo = hi


def buffer(texts: pa.Array, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of rows lo..hi; a null text is empty."""
    part = pc.fill_null(texts.slice(lo, hi - lo).cast(pa.large_binary()), b"")
    offsets = np.frombuffer(part.buffers()[1], dtype=np.int64)[part.offset:part.offset + len(part) + 1]
    data = part.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


class Words:
    """Words of rows lo..hi: ``low`` lower-cased bytes, ``doc_at`` byte offsets of the texts,
    ``start``/``end`` bytes of each word, ``first`` the number of the first word of each text (one more
    entry than texts), ``hash`` 64-bit word hashes."""

    def __init__(self, texts: pa.Array, lo: int, hi: int, separators: np.ndarray = IS_SPACE):
        raw, self.doc_at = buffer(texts, lo, hi)
        self.low = LOWER[raw]
        n = len(raw)
        space = separators[raw]
        opens = ~space
        closes = ~space
        if n:
            heads = np.zeros(n + 1, dtype=bool)  # a text begins here: no word reaches across
            heads[self.doc_at] = True
            opens = opens & (np.concatenate(([True], space[:-1])) | heads[:-1])
            closes = closes & (np.concatenate((space[1:], [True])) | heads[1:])
        self.start = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.start, self.doc_at)
        self.hash = word_hashes(self.low, self.start, self.end)

    def _windows(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, words from there to the end of the text) of all n-word windows that lie in one text, and the number of the
        first window of each text. A text of 1 to n - 1 words has one window, its whole sequence."""
        count = np.diff(self.first)
        windows = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
        first = np.concatenate(([0], np.cumsum(windows)))
        doc = np.repeat(np.arange(len(count)), windows)
        at = self.first[:-1][doc] + (np.arange(first[-1]) - first[doc])
        return at, self.first[1:][doc] - at, first

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows (see ``_windows``), and the number of the first window of each text."""
        at, left, first = self._windows(n)
        acc = np.minimum(left, n).astype(np.uint64)
        padded = np.concatenate((self.hash, np.zeros(n, dtype=np.uint64)))
        for j in range(n):
            h = padded[at + j] * np.uint64(pow(0xD6E8FEB86659FD93, j + 1, 1 << 64))
            acc += h if j == 0 else np.where(left > j, h, np.uint64(0))
        return mix(acc), first

    def least(self, n: int, values: np.ndarray) -> np.ndarray:
        """The smallest of the words' ``values`` in each window."""
        at, left, _ = self._windows(n)
        top = np.iinfo(values.dtype).max
        padded = np.concatenate((values, np.full(n, top, dtype=values.dtype)))
        out = np.full(len(at), top, dtype=values.dtype)
        for j in range(n):
            out = np.minimum(out, np.where(left > j, padded[at + j], top))
        return out
