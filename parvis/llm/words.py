"""Words of Arrow text columns as 64-bit hashes, found in the UTF-8 bytes of whole batches.

All word classes used in this package treat every non-ASCII byte alike, so words can be cut
from the bytes without decoding. Only A-Z are lower-cased. The hash of a word is the sum of its
bytes, each scrambled with its place in the word, and then mixed with the length. (A polynomial
modulo 2^64 would not do: whatever its base, it takes some pairs of words for one.)
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15
SLICE_BYTES = 1 << 19  # bytes of text hashed at once; a longer text is taken alone

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

SPACED = np.ones(256, bool)  # [^\x20\x09-\x0D]
SPACED[[0x20, *range(0x09, 0x0E)]] = False
LETTERS = np.zeros(256, bool)  # [^\x00-\x2F\x3A-\x60\x7B-\x7F]
LETTERS[0x30:0x3A] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True

VALUES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """The words of some texts: byte ranges and hashes, and where each text's words begin."""

    data: np.ndarray  # lower-cased bytes of all texts
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # index of each text's first word; one more entry than texts

    @cached_property
    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct hashes, a word of each, and which of them each word has.

        ``np.unique`` does the same, but finds the first word of each by a slower, stable sort.
        """
        order = np.argsort(self.hash)
        ordered = self.hash[order]
        begins = np.ones(len(order), bool)
        begins[1:] = ordered[1:] != ordered[:-1]
        index = np.empty(len(order), np.int64)
        index[order] = np.cumsum(begins) - 1
        return ordered[begins], order[begins], index

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hashes of byte ranges of ``data``."""
    size = (end - start).astype(np.int64)
    stop = np.cumsum(size)
    first = stop - size
    every = np.arange(stop[-1] if len(stop) else 0)
    value = VALUES[data[every + np.repeat(start - first, size)]]
    every -= np.repeat(first, size)  # the places in their words
    place = every.view(np.uint64)
    place *= np.uint64(BASE)
    value ^= place
    sums = np.zeros(len(every) + 1, np.uint64)
    np.cumsum(mix(value), out=sums[1:])
    return mix(sums[stop] - sums[first] + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def cut_words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = SPACED) -> Words:
    """All words of class ``kind`` in texts that lie at ``offsets`` of ``data``."""
    data = LOWER[data]
    inside = kind[data]
    n = len(data)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[offsets < n]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    tails = offsets[(offsets > 0) & (offsets <= n)] - 1
    ends[tails] = inside[tails]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    hashes = range_hashes(data, start, end)
    return Words(data, start, end, hashes, np.searchsorted(start, offsets))


def slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``SLICE_BYTES`` together."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + SLICE_BYTES, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def word_slices(column: pa.Array, kind: np.ndarray = SPACED) -> Iterator[tuple[int, int, Words]]:
    """``(i, j, words of the texts i to j)`` over a whole column."""
    data, offsets = text_bytes(column)
    for i, j in slices(offsets):
        part = data[offsets[i]:offsets[j]]
        yield i, j, cut_words(part, offsets[i:j + 1] - offsets[i], kind)


def word_hash(word: str | bytes) -> int:
    """The hash that :func:`cut_words` gives to one word."""
    raw = np.frombuffer(word.encode() if isinstance(word, str) else word, np.uint8)
    found = cut_words(raw, np.array([0, len(raw)]), np.ones(256, bool))
    return int(found.hash[0])
