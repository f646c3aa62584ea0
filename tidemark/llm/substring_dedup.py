"""Exact removal of long repeated passages, found by recompression.

**Naming.** Rounds of recompression parse every document: a round names maximal runs of one symbol, then splits the
symbols by a hash bit in left and right ones and names each pair of a left and a right neighbour. A name is a hash
of what it stands for, so all tasks give one name to one content without a shuffle. A decision looks only at direct
neighbours; the *span* of a symbol is the stretch of words that its existence depends on. Equal spans give equal
symbols, wherever they stand: a symbol whose span lies in a window of words is fixed by the window.

**Anchors.** Of the symbols of the last round that a window fixes, the one with the least hash is its anchor, named
by the content of its span. Equal windows have equal anchors. A window that fixes none (long runs, or edges of a
document) stands for itself.

**Rounds over the corpus.** Documents are dealt to chunks of bounded size. Each chunk sends the distinct anchors of
its windows with the smallest and largest document; an anchor of one document only is dropped, and with it all its
windows. For the others each chunk sends the 128-bit names of their windows; a window's smallest document comes back
to the chunks that have it in a later one, and the words it covers go. A passage that very many documents share is
one row of each chunk, never one of each document, so no task gets more rows of a key than there are chunks.

Null and empty texts have no words and stay as they are. Repeated rows with one id do not remove each other's words.
A null id counts as later than all others.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.words import Prefix, Words, buffers, mix, sliced_words

WINDOW = 50
ROUNDS = 4
# Symbols of more words are not joined further.
LONGEST = 16
CHUNK_BYTES = 2 << 20

FAR = np.int64(1) << 40
LAST = np.iinfo(np.int64).max

_C = np.uint64(0xA24BAED4963EE407)
_D = np.uint64(0x9FB21C651E98DF25)


class Symbols:
    """A parse: of each symbol its name, words [start, end), span [left, right) and document."""

    def __init__(self, names: np.ndarray, document: np.ndarray):
        n = len(names)
        self.name = names
        self.start = np.arange(n, dtype=np.int64)
        self.end = self.start + 1
        self.left, self.right = self.start, self.end
        self.document = document

    def _take(self, keep: np.ndarray) -> None:
        for field in ("name", "start", "end", "left", "right", "document"):
            setattr(self, field, getattr(self, field)[keep])

    def _neighbours(self):
        """Spans to the left and right of each symbol; beyond a document's edge they have no end."""
        left, right = np.full(len(self.left), -FAR), np.full(len(self.right), FAR)
        if len(left) > 1:
            within = self.document[1:] == self.document[:-1]
            left[1:][within] = self.left[:-1][within]
            right[:-1][within] = self.right[1:][within]
        return left, right

    def runs(self) -> None:
        active = self.end - self.start <= LONGEST
        left, right = self._neighbours()
        new_left = np.where(active, np.minimum(self.left, left), self.left)
        new_right = np.where(active, np.maximum(self.right, right), self.right)
        goes_on = np.zeros(len(self.name), bool)
        goes_on[1:] = (
            (self.name[1:] == self.name[:-1]) & (self.document[1:] == self.document[:-1]) & active[1:] & active[:-1]
        )
        heads = np.flatnonzero(~goes_on)
        tails = np.append(heads[1:], len(self.name)) - 1
        length = (tails - heads + 1).astype(np.uint64)
        end, right_of = self.end[tails], new_right[tails]
        self.left = new_left
        self._take(heads)
        self.end, self.right = end, right_of
        self.name = np.where(length > 1, mix(self.name * _C + length * _D), self.name)

    def pairs(self, round_: int) -> None:
        active = self.end - self.start <= LONGEST
        is_left = (mix(self.name + np.uint64((round_ + 1) * int(_D) % (1 << 64))) & np.uint64(1)).astype(bool)
        left, right = self._neighbours()
        # A left symbol looks at the next one, a right symbol at the one before.
        new_left = np.where(active & ~is_left, np.minimum(self.left, left), self.left)
        new_right = np.where(active & is_left, np.maximum(self.right, right), self.right)
        joins = np.zeros(len(self.name), bool)
        joins[:-1] = (
            is_left[:-1] & ~is_left[1:] & active[:-1] & active[1:] & (self.document[1:] == self.document[:-1])
        )
        first = np.flatnonzero(joins)
        name, end = self.name.copy(), self.end.copy()
        name[first] = mix(self.name[first] * _C + mix(self.name[first + 1] + _D))
        end[first] = self.end[first + 1]
        # A joined pair depends on its two symbols only.
        new_left[first] = self.left[first]
        new_right[first] = self.right[first + 1]
        keep = np.ones(len(name), bool)
        keep[first + 1] = False
        self.name, self.end, self.left, self.right = name, end, new_left, new_right
        self._take(keep)


def parse(names: np.ndarray, document: np.ndarray, rounds: int = ROUNDS) -> Symbols:
    symbols = Symbols(names, document)
    for round_ in range(rounds):
        symbols.runs()
        symbols.pairs(round_)
    return symbols


class Windows:
    """The windows of a slice of documents: place of the first word, document, and by need names and anchors."""

    def __init__(self, found: Words, size: int):
        counts = np.maximum(found.counts - size + 1, 0)
        self.document = np.repeat(np.arange(len(counts)), counts)
        ahead = np.cumsum(counts) - counts
        self.start = np.arange(len(self.document)) - np.repeat(ahead, counts) + np.repeat(found.first[:-1], counts)
        self.size, self.words = size, found

    @cached_property
    def _hashes(self) -> np.ndarray:
        return self.words.hashes(0)

    @cached_property
    def _first(self) -> Prefix:
        return Prefix(self._hashes, 0)

    @cached_property
    def _second(self) -> Prefix:
        return Prefix(self.words.hashes(1), 1)

    def names(self, of: np.ndarray | slice = slice(None)) -> np.ndarray:
        start = self.start[of]
        return self._first.spans(start, start + self.size)

    def second_names(self, of: np.ndarray) -> np.ndarray:
        start = self.start[of]
        return self._second.spans(start, start + self.size)

    def anchors(self, rounds: int = ROUNDS) -> np.ndarray:
        """The name of each window's anchor; of a window that fixes no symbol, its own."""
        anchor = self.names()
        if not len(anchor):
            return anchor
        symbols = parse(self._hashes, self.words.document, rounds)
        fits = (symbols.right - symbols.left <= self.size) & (symbols.left >= 0)
        left, right = symbols.left[fits], symbols.right[fits]
        lo = np.searchsorted(left, self.start)
        hi = np.searchsorted(right, self.start + self.size, "right")
        some = np.flatnonzero(lo < hi)
        if len(some):
            anchor[some] = _least(self._first.spans(left, right), lo[some], hi[some])
        return anchor


def _least(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The least of keys[lo:hi] for each range, from minima over ranges of powers of two."""
    found = np.empty(len(lo), np.uint64)
    width, level, step = hi - lo, keys, 1
    while True:
        here = np.flatnonzero((width >= step) & (width < 2 * step))
        found[here] = np.minimum(level[lo[here]], level[hi[here] - step])
        if not (width >= 2 * step).any():
            return found
        level = np.minimum(level[:-step], level[step:]) if len(level) > step else level
        step *= 2


def _ids(table: pa.Table) -> np.ndarray:
    return pc.fill_null(table.column("doc_id").cast(pa.int64()), LAST).to_numpy()


def _signed(keys: np.ndarray) -> np.ndarray:
    return keys.view(np.int64)


def _grouped(keys: tuple[np.ndarray, ...], ids: np.ndarray):
    """Distinct keys with the smallest and largest id."""
    if not len(ids):
        return keys, ids, ids
    order = np.lexsort((ids, *reversed(keys)))
    keys, ids = tuple(k[order] for k in keys), ids[order]
    new = np.ones(len(ids), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(ids)) - 1
    return tuple(k[heads] for k in keys), ids[heads], ids[tails]


def _slices(table: pa.Table, size: int):
    ids = _ids(table)
    for lo, hi, found in sliced_words(table.column("text")):
        windows = Windows(found, size)
        yield lo, hi, found, windows, ids[lo:hi]


def _anchor_rows(size: int):
    def of_chunk(table: pa.Table) -> pa.Table:
        keys, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for _lo, _hi, _found, windows, own in _slices(table, size):
            anchor, document = windows.anchors(), windows.document
            # Neighbouring windows mostly have one anchor.
            new = np.ones(len(anchor), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (document[1:] != document[:-1])
            keys.append(anchor[new])
            ids.append(own[document[new]])
        (key,), low, high = _grouped((np.concatenate(keys),), np.concatenate(ids))
        chunk = table.column("chunk")[0].as_py()
        return pa.table(
            {"chunk": np.full(len(key), chunk, np.int64), "anchor": _signed(key), "low": low, "high": high}
        )

    return of_chunk


def _member(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(keys), bool)
    place = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return sorted_keys[place] == keys


def _window_rows(size: int):
    def of_chunk(table: pa.Table, shared: pa.Table) -> pa.Table:
        anchors = np.sort(shared.column("anchor").to_numpy().view(np.uint64))
        a, b, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for _lo, _hi, _found, windows, own in _slices(table, size) if table.num_rows and len(anchors) else ():
            of = np.flatnonzero(_member(anchors, windows.anchors()))
            if len(of):
                a.append(windows.names(of))
                b.append(windows.second_names(of))
                ids.append(own[windows.document[of]])
        (a, b), low, high = _grouped((np.concatenate(a), np.concatenate(b)), np.concatenate(ids))
        chunk = table.column("chunk")[0].as_py() if table.num_rows else 0
        return pa.table(
            {
                "chunk": np.full(len(a), chunk, np.int64),
                "a": _signed(a),
                "b": _signed(b),
                "low": low,
                "high": high,
            }
        )

    return of_chunk


def _covered(place: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n words the windows at these places cover."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, place, 1)
    np.add.at(edges, place + size, -1)
    return np.cumsum(edges[:-1]) > 0


class _Repeated:
    """Window names and the smallest document of each, for lookups."""

    def __init__(self, table: pa.Table):
        a = table.column("a").to_numpy().view(np.uint64)
        order = np.argsort(a, kind="stable")
        self.a = a[order]
        self.b = table.column("b").to_numpy().view(np.uint64)[order]
        self.first = table.column("first").to_numpy()[order]
        # Names that agree in their first half only.
        self.same = int(np.unique(self.a, return_counts=True)[1].max()) if len(a) else 0

    def earlier(self, windows: Windows, own: np.ndarray) -> np.ndarray:
        """The windows that an earlier document has too."""
        of = np.flatnonzero(_member(self.a, windows.names()))
        if not len(of):
            return of
        a, b, ids = windows.names(of), windows.second_names(of), own[windows.document[of]]
        place, hit = np.searchsorted(self.a, a), np.zeros(len(of), bool)
        for k in range(self.same):
            at = np.minimum(place + k, len(self.a) - 1)
            hit |= (self.a[at] == a) & (self.b[at] == b) & (self.first[at] < ids)
        return of[hit]


def _kept_rows(size: int, names: list[str]):
    def of_chunk(table: pa.Table, repeated: pa.Table) -> pa.Table:
        known = _Repeated(repeated)
        kept: list[str] = []
        n_words, n_removed = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        data, offsets = buffers(table.column("text"))
        for lo, hi, found, windows, own in _slices(table, size):
            gone = np.zeros(len(found), bool)
            if len(known.a):
                gone = _covered(windows.start[known.earlier(windows, own)], size, len(found))
            removed = np.bincount(found.document[gone], minlength=hi - lo)
            for d in range(hi - lo):
                own_words = bytes(data[offsets[lo + d] : offsets[lo + d + 1]]).split()
                if removed[d]:
                    mask = gone[found.first[d] : found.first[d + 1]].tolist()
                    own_words = [w for w, out in zip(own_words, mask) if not out]
                kept.append(b" ".join(own_words).decode())
            n_words.append(found.counts)
            n_removed.append(removed)
        made = {
            "kept_text": pa.array(kept, pa.string()),
            "n_words": pa.array(np.concatenate(n_words), pa.int64()),
            "n_removed": pa.array(np.concatenate(n_removed), pa.int64()),
        }
        return pa.table([made.get(n) if n in made else table.column(n) for n in names], names=names)

    return of_chunk


def dedup(docs: DataFrame, size: int = WINDOW, carry: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, text, kept_text, n_words, n_removed and ``carried``.

    A word goes if a window of ``size`` words covers it that an earlier document has too. ``kept_text`` is the words
    left, joined by one space. ``carry`` names columns that come along in the struct ``carried``.
    """
    carried = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(None).cast("struct<none:int>")
    rows = docs.select("doc_id", "text", carried.alias("carried"))
    amount = rows.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    chunks = 1 + (amount[0] or 0) // CHUNK_BYTES + amount[1] // 50_000
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(chunks)))
    grouped = dealt.groupBy("chunk")

    anchors = grouped.applyInArrow(_anchor_rows(size), "chunk long, anchor long, low long, high long")
    every = Window.partitionBy("anchor")
    shared = (
        anchors.withColumn("shared", F.min("low").over(every) < F.max("high").over(every))
        .where("shared")
        .select("chunk", "anchor")
    )
    windows = grouped.cogroup(shared.groupBy("chunk")).applyInArrow(
        _window_rows(size), "chunk long, a long, b long, low long, high long"
    )
    repeated = (
        windows.withColumn("first", F.min("low").over(Window.partitionBy("a", "b")))
        .where("first < high")
        .select("chunk", "a", "b", "first")
    )
    result = "doc_id, text, carried".split(", ")
    names = [*result, "kept_text", "n_words", "n_removed"]
    made = [("kept_text", T.StringType()), ("n_words", T.LongType()), ("n_removed", T.LongType())]
    kinds = [(c, dealt.schema[c].dataType) for c in result] + made
    schema = T.StructType([T.StructField(name, kind) for name, kind in kinds])
    return grouped.cogroup(repeated.groupBy("chunk")).applyInArrow(_kept_rows(size, names), schema)
