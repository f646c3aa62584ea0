"""Counts of three-word paths as weighted acyclic automata.

A path is three labels, whole numbers from 1 on; label 0 is the end of a shorter path. An automaton holds sorted paths with weights
as arrays: the arcs of the first state, those of the states behind them, and so on, so that equal beginnings are stored once.
It is built in one pass over sorted paths: a new state where a label differs from the path before. The weight of a beginning is
the sum of the weights of its paths. The union of automata adds the weights of equal paths.

Every first arc knows the prefix ranges of its paths: usually one; a frequent label has several, and its paths are dealt to
them by their other labels.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

from tidemark.llm.words import mix


@dataclass(frozen=True)
class Paths:
    """Sorted, distinct paths: three labels, weight, and the first and the number of the ranges of the first label."""

    a: np.ndarray
    b: np.ndarray
    c: np.ndarray
    weight: np.ndarray
    first: np.ndarray
    ranges: np.ndarray

    def __len__(self) -> int:
        return len(self.a)

    def pick(self, chosen) -> "Paths":
        return Paths(*(column[chosen] for column in self.columns()))

    def columns(self) -> tuple[np.ndarray, ...]:
        return self.a, self.b, self.c, self.weight, self.first, self.ranges

    def range(self) -> np.ndarray:
        """The prefix range of each path."""
        tail = mix((self.b.astype(np.uint64) << np.uint64(32)) | self.c.astype(np.uint64))
        return self.first + (tail % self.ranges.astype(np.uint64)).astype(np.int64)

    def split(self, width: int) -> Iterator[tuple[int, "Paths"]]:
        """The paths by range, ``width`` ranges together. They stay sorted."""
        key = self.range() // width
        order = np.argsort(key, kind="stable")
        key = key[order]
        heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else []
        for lo, hi in zip(heads, [*heads[1:], len(key)]):
            yield int(key[lo]), self.pick(order[lo:hi])

    def beginnings(self) -> tuple[np.ndarray, np.ndarray]:
        """Where a new pair of first labels begins, and the weight of each pair."""
        heads = np.flatnonzero(np.r_[True, (self.a[1:] != self.a[:-1]) | (self.b[1:] != self.b[:-1])]) if len(self) else []
        heads = np.asarray(heads, np.int64)
        return heads, np.add.reduceat(self.weight, heads) if len(heads) else np.zeros(0, np.int64)


NONE = Paths(*(np.zeros(0, np.int64) for _ in range(6)))


def union(automata: Sequence[Paths]) -> Paths:
    """All paths, the weights of equal ones added."""
    if not automata:
        return NONE
    joined = Paths(*map(np.concatenate, zip(*(p.columns() for p in automata))))
    if not len(joined):
        return NONE
    low = joined.a.min()
    bits = [int(top).bit_length() for top in (joined.a.max() - low, joined.b.max(), joined.c.max())]
    if sum(bits) < 64:
        code = ((joined.a - low) << (bits[1] + bits[2])) | (joined.b << bits[2]) | joined.c
        # Each automaton is sorted: the stable sort merges runs.
        joined = joined.pick(np.argsort(code, kind="stable"))
    else:
        joined = joined.pick(np.lexsort((joined.c, joined.b, joined.a)))
    a, b, c = joined.a, joined.b, joined.c
    heads = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])])
    kept = joined.pick(heads)
    return Paths(kept.a, kept.b, kept.c, np.add.reduceat(joined.weight, heads), kept.first, kept.ranges)


def dump(paths: Paths) -> bytes:
    """The automaton as bytes: labels and numbers of arcs state by state."""
    import zstandard

    a, b, c = paths.a, paths.b, paths.c
    state = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.zeros(0, np.int64)
    pair, _ = paths.beginnings()
    arcs = np.diff(np.r_[np.searchsorted(pair, state), len(pair)])
    fields = [a[state], paths.first[state], paths.ranges[state], arcs, b[pair], np.diff(np.r_[pair, len(a)]), c, paths.weight]
    # Byte by byte, so that the high bytes, mostly zero, take no room.
    planes = b"".join(np.ascontiguousarray(f, "<u8").view("u1").reshape(-1, 8).T.tobytes() for f in fields)
    sizes = np.array([len(state), len(pair), len(a)], "<u8").tobytes()
    return sizes + zstandard.ZstdCompressor(level=1).compress(planes)


def load(data: bytes) -> Paths:
    import zstandard

    states, pairs, total = np.frombuffer(data[:24], "<u8").astype(np.int64)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[24:]), "u1")
    fields, at = [], 0
    for n in (states, states, states, states, pairs, pairs, total, total):
        own = np.ascontiguousarray(planes[at : at + 8 * n].reshape(8, n).T).view("<u8").ravel()
        fields.append(own.astype(np.int64))
        at += 8 * n
    a, first, ranges, arcs, b, ends, c, weight = fields
    per_state = np.add.reduceat(ends, np.cumsum(arcs) - arcs) if states else ends[:0]
    a, first, ranges = (np.repeat(column, per_state) for column in (a, first, ranges))
    return Paths(a, np.repeat(b, ends), c, weight, first, ranges)
