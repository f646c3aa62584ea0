"""Words and their hashes, by numpy over the UTF-8 bytes of whole Arrow columns.

A word's hash is the sum of a mixed value per byte and place, so that no two texts differ by a pattern that sums cancel. Hashes of
spans of words are polynomials in 64-bit arithmetic with a mixing step, from two prefix sums. All are the same in every
process; two seeds together make a 128-bit name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are taken into arrays at once; a longer document is taken alone.
SLICE_BYTES = 1 << 20
BLOCK_BYTES = 1 << 19

# Places in a word whose values are looked up; those further on are worked out.
PLACES = 64

MULTIPLIERS = (0x9E3779B97F4A7C15 | 1, 0xD1342543DE82EF95)


def byte_table(*members: int) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


#: Everything but 0x20 and 0x09 to 0x0D.
NON_BLANK = ~byte_table(0x20, *range(0x09, 0x0E))
#: ASCII letters and digits, the apostrophe, and all bytes of other characters.
WORD_BYTES = byte_table(
    *range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), ord("'"),
    *range(0x80, 0x100),
)
#: ASCII capitals as small letters.
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[ord("A") : ord("Z") + 1] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    """UTF-8 with the capitals of ASCII and Latin-1 as small letters, byte for byte."""
    found = _LOWERED[data]
    # U+00C0 to U+00DE, without the multiplication sign, are C3 80 to C3 9E.
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    capital = second[(data[second] >= 0x80) & (data[second] <= 0x9E) & (data[second] != 0x97)]
    found[capital] += 0x20
    return found


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _placed(byte: np.ndarray, place: np.ndarray, seed: int) -> np.ndarray:
    """A value per byte and its place in the word."""
    return mix((place.astype(np.uint64) << np.uint64(8)) + byte.astype(np.uint64) + np.uint64((seed + 1) << 56))


@cache
def _first_places(seed: int) -> np.ndarray:
    place, byte = np.divmod(np.arange(PLACES * 256), 256)
    return _placed(byte, place, seed)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**n, modulo 2**64."""
    known = _POWERS.get(base)
    if known is None or len(known) <= n:
        factors = np.full(max(n + 1, 1 << 16), base, np.uint64)
        factors[0] = 1
        known = _POWERS[base] = np.cumprod(factors)
    return known[: n + 1]


class Prefix:
    """Prefix sums of a sequence of 64-bit values; the hash of any span of it."""

    def __init__(self, values: np.ndarray, seed: int = 0):
        base = MULTIPLIERS[seed]
        n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers(base, n)[:n], out=self.sums[1:])
        self.inverse = powers(pow(base, -1, 1 << 64), n)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix(raw + (end - start).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))


@dataclass(frozen=True)
class Words:
    """The words of some documents: byte places, the number of words before each document and in all, and the
    places where the documents' texts start."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    text_start: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def document(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, seed: int = 0, length: int | None = None) -> np.ndarray:
        """A hash of each word, or of its first ``length`` bytes (of shorter ones, of all of it)."""
        found = np.empty(len(self.start), np.uint64)
        edges = np.searchsorted(self.start, np.arange(0, len(self.data), BLOCK_BYTES))
        for lo, hi in zip(edges, [*edges[1:], len(self.start)]):
            if lo < hi:
                base = self.start[lo]
                start, end = self.start[lo:hi] - base, self.end[lo:hi] - base
                data = self.data[base : self.end[hi - 1]]
                place = np.arange(len(data)) - np.repeat(start, np.diff(np.r_[start, len(data)]))
                # Blanks have a value too; it is in no word's span.
                far = np.flatnonzero(place >= PLACES)
                values = _first_places(seed)[(np.minimum(place, PLACES - 1) << 8) | data]
                values[far] = _placed(data[far], place[far], seed)
                sums = np.zeros(len(data) + 1, np.uint64)
                np.cumsum(values, out=sums[1:])
                if length is not None:
                    end = np.minimum(end, start + length)
                found[lo:hi] = mix(sums[end] - sums[start] + (end - start).astype(np.uint64) * np.uint64(MULTIPLIERS[seed]))
        return found


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each text starts and the last ends. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most ``limit`` bytes together, or of one document."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray, member: np.ndarray = NON_BLANK) -> Words:
    """Maximal runs of member bytes; none goes over the end of a document."""
    inside = member[data]
    begin, last = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    begin[heads] = inside[heads]
    last[tails] = inside[tails]
    start = np.flatnonzero(begin)
    return Words(data, start, np.flatnonzero(last) + 1, np.searchsorted(start, offsets), offsets)


def sliced_words(
    column: pa.Array | pa.ChunkedArray, member: np.ndarray = NON_BLANK, lower: bool = False, limit: int = SLICE_BYTES
) -> Iterator[tuple[int, int, Words]]:
    """Ranges of documents and their words, a slice at a time."""
    data, offsets = buffers(column)
    for lo, hi in slices(offsets, limit):
        part = data[offsets[lo] : offsets[hi]]
        yield lo, hi, words(lowered(part) if lower else part, offsets[lo : hi + 1] - offsets[lo], member)
