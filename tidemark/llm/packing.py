"""Packing of token sequences: shortest-pack-first over the histogram of lengths.

Tokenising is per document, in Python batches. Every document's tokens are cut into full pieces of the sequence length
and a rest. Only the histogram of piece lengths, one row per length, goes to the driver. There the lengths
are placed longest first: each goes into the pack with the least in it, if it fits there, and else opens new packs;
packs of one pattern are counted together, so the work depends on the number of lengths and not on documents.

Every piece then finds its place by its rank among the pieces of its length: pattern counts give each length
ranges of ranks. Ranks are numbered in buckets, so a length that a third of all pieces have is no task's burden.

A null or empty text is its end token alone. Repeated rows are packed once each.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.spread import numbered, written
from tidemark.llm.words import Words, byte_table, lowered, sliced_words

SEQUENCE = 4096
END = 2
# Text that is taken into arrays at once, and what a task remembers of parts of words and their ids.
SLICE_BYTES = 2 << 20
MEMO_BYTES = 48 << 20

# ---------------------------------------------------------------- tokens

# The steps that the splitting here stands for. Texts for any other tokenizer go to it whole.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}

_BLANKS = byte_table(0x20, *range(0x09, 0x0E))
_DIGITS = byte_table(*b"0123456789")
_LETTERS = byte_table(*range(ord("a"), ord("z") + 1), *range(0x80, 0x100))
# Bytes that no word split here has, besides those of characters above U+00FF.
_CONTROLS = byte_table(*range(0x00, 0x09), *range(0x0E, 0x20), 0x7F)
_APOSTROPHE, _LEAD = ord("'"), 0xC3
# What makes a word a part as it is: a control, a character that is neither ASCII nor U+00C0 to U+00FF, a special token.
_STRANGE = re.compile(rb"[\x00-\x08\x0e-\x1f\x7f]|<\||[\x80-\xc2\xc4-\xff](?<!\xc3.)", re.DOTALL)
PARTS_AT_ONCE = 200


def _next(data: np.ndarray, n: int) -> np.ndarray:
    """The byte n places on; 0 behind the end."""
    return np.r_[data[n:], np.zeros(min(n, len(data)), data.dtype)]


def parts(found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words without blanks as bytes, where each part starts in them, and the first part of each document and the end.

    A word of ASCII and of the letters from U+00C0 to U+00FF is lower-cased and split as the tokenizer splits it: runs of
    letters, single digits, runs of anything else, and a few endings after an apostrophe. Any other word is one part, as it
    is; so is one that may hold a special token.
    """
    length = found.end - found.start
    places = np.cumsum(length) - length
    raw = found.data[~_BLANKS[found.data]]
    first = np.zeros(len(raw), bool)
    first[places] = True

    lead = raw == _LEAD
    strange = (raw >= 0x80) & ~lead
    strange[1:] &= ~lead[:-1]
    strange |= _CONTROLS[raw] | ((raw == ord("<")) & (_next(raw, 1) == ord("|")) & ~_next(first, 1))
    word = np.add.reduceat(strange, places) > 0 if len(places) else np.zeros(0, bool)
    whole = np.repeat(word, length)
    data = np.where(whole, raw, lowered(raw))

    kind = np.where(_LETTERS[data], 0, np.where(_DIGITS[data], 1, 2))
    # The signs for multiplication and division are no letters.
    sign = np.flatnonzero(lead[:-1] & ((data[1:] == 0x97) | (data[1:] == 0xB7)))
    kind[sign] = kind[sign + 1] = 2
    starts = kind == 1
    starts[1:] |= kind[1:] != kind[:-1]
    starts |= first

    one, two = _next(data, 1), _next(data, 2)
    ending = (data == _APOSTROPHE) & starts & ~_next(first, 1)
    short = ending & np.isin(one, list(b"stmd"))
    long = ending & ~_next(first, 2) & (
        ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    )
    starts[np.flatnonzero(short | long) + 1] = False
    behind = np.r_[np.flatnonzero(short) + 2, np.flatnonzero(long) + 3]
    starts[behind[behind < len(starts)]] = True

    at = np.flatnonzero(np.where(whole, first, starts))
    edges = np.r_[places, len(raw)][found.first]
    return data, at, np.searchsorted(at, edges)


class WordEncoder:
    """Token ids of texts, by the ids of their distinct parts.

    The tokenizer lower-cases, drops white space and never joins tokens over it or over the ends of parts, so a text's ids are
    its parts' ids. The parts of a slice of texts are told apart once, and those met before in the task are not encoded again;
    what is remembered is bounded, and forgotten when it is full.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        steps = json.loads(self.tokenizer.to_str())
        self.splits = steps["normalizer"] == NORMALIZER and steps["pre_tokenizer"] == PRE_TOKENIZER
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_binary())
        self.ids, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _text_ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _new_ids(self, new: list[bytes]) -> list[list[int]]:
        """The ids of each part. Parts as split here go to the tokenizer some hundred at a time, apart by blanks."""
        found: list[list[int]] = [[]] * len(new)
        plain = []
        for i, part in enumerate(new):
            if _STRANGE.search(part):
                found[i] = self._text_ids(part.decode())
            else:
                plain.append(i)
        groups = [plain[i : i + PARTS_AT_ONCE] for i in range(0, len(plain), PARTS_AT_ONCE)]
        joined = [b" ".join([new[i] for i in own]).decode() for own in groups]
        for own, encoding in zip(groups, self.tokenizer.encode_batch(joined, add_special_tokens=False)):
            ids, edges = encoding.ids, np.searchsorted(encoding.word_ids, np.arange(len(own) + 1)).tolist()
            for i, lo, hi in zip(own, edges, edges[1:]):
                found[i] = ids[lo:hi]
        return found

    def _look_up(self, distinct: pa.Array) -> np.ndarray:
        """The numbers of parts among those remembered, the new ones added."""
        if self.known.nbytes + self.ids.nbytes + self.ends.nbytes > MEMO_BYTES:
            self._forget()
        new = distinct.filter(pc.is_null(pc.index_in(distinct, value_set=self.known)))
        if len(new):
            found = self._new_ids(new.to_pylist())
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            self.known = pa.concat_arrays([self.known, new])
            self.ids = np.r_[self.ids, np.fromiter(chain.from_iterable(found), np.uint32, sizes.sum())]
            self.ends = np.r_[self.ends, self.ends[-1] + np.cumsum(sizes)]
        return pc.index_in(distinct, value_set=self.known).to_numpy()

    def texts(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text; null is empty."""
        if not self.splits:
            for text in column:
                yield np.array(self._text_ids(text.as_py() or ""), np.uint32)
            return
        for _, _, found in sliced_words(column, ~_BLANKS, limit=SLICE_BYTES):
            data, at, documents = parts(found)
            edges = pa.py_buffer(np.r_[at, len(data)].astype("<i8"))
            array = pa.Array.from_buffers(pa.large_binary(), len(at), [None, edges, pa.py_buffer(np.ascontiguousarray(data))])
            encoded = array.dictionary_encode()
            number = self._look_up(encoded.dictionary)[encoded.indices.to_numpy()]
            start, size = self.ends[number], self.ends[number + 1] - self.ends[number]
            end = np.cumsum(size)
            ids = self.ids[np.repeat(start - (end - size), size) + np.arange(end[-1] if len(end) else 0)]
            bounds = np.r_[0, end][documents]
            del data, array, encoded, number, start, size
            yield from (ids[a:b] for a, b in zip(bounds[:-1], bounds[1:]))

    def encode(self, text: str) -> bytes:
        return next(self.texts(pa.array([text], pa.large_string()))).astype("<u4").tobytes()


@cache
def _tokenizer(path: str):
    """One tokenizer per worker and file. Parts are remembered by task, so that workers give the memory back."""
    # Its own threads would take the cores of other tasks.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, vocabulary: str, sequence: int = SEQUENCE, end: int = END, with_ids: bool = False):
    """Cuts each document's tokens (and the end token) into pieces of at most ``sequence`` tokens."""
    tail = np.array([end], "<u4").tobytes()

    def cut(batches):
        encoder = WordEncoder(vocabulary)
        for batch in batches:
            rows = defaultdict(list)
            for doc_id, own_ids in zip(batch.column("doc_id").to_pylist(), encoder.texts(batch.column("text"))):
                ids = own_ids.astype("<u4").tobytes() + tail
                total = len(ids) // 4
                for start in range(0, total, sequence):
                    own = ids[4 * start : 4 * (start + sequence)]
                    rows["doc_id"].append(doc_id)
                    rows["start"].append(start)
                    rows["length"].append(len(own) // 4)
                    rows["ids_crc32"].append(zlib.crc32(own))
                    rows["doc_tokens"].append(total)
                    if with_ids:
                        rows["ids"].append(own)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, pa.binary() if k == "ids" else pa.int64()) for k, v in rows.items()], list(rows)
                )
        # The worker goes on to other stages; what this one took is given back.
        del encoder
        pa.default_memory_pool().release_unused()

    schema = PIECES + (", ids binary" if with_ids else "")
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


# ---------------------------------------------------------------- patterns


def shortest_pack_first(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[int, tuple]]:
    """Packing patterns as (count, ((length, times), ...)). ``histogram`` maps a length to its number of pieces."""
    # By tokens in the pack: patterns and their counts.
    packs: dict[int, dict[tuple, int]] = defaultdict(lambda: defaultdict(int))
    used: list[int] = []  # totals of packs, ascending
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            total = used[0] if used else sequence + 1
            if total + length > sequence:
                packs[length][((length, 1),)] += left
                _insert(used, length)
                break
            pattern, count = packs[total].popitem()
            taken = min(count, left)
            if count > taken:
                packs[total][pattern] = count - taken
            if not packs[total]:
                used.pop(0)
            if pattern[-1][0] == length:
                longer = (*pattern[:-1], (length, pattern[-1][1] + 1))
            else:
                longer = (*pattern, (length, 1))
            packs[total + length][longer] += taken
            _insert(used, total + length)
            left -= taken
    return sorted(((n, p) for own in packs.values() for p, n in own.items()), key=lambda x: x[1], reverse=True)


def _insert(values: list[int], value: int) -> None:
    place = bisect_right(values, value)
    if not place or values[place - 1] != value:
        values.insert(place, value)


class Places:
    """Where the piece of a given length and rank goes: its sequence and offset there."""

    def __init__(self, patterns: list[tuple[int, tuple]]):
        rows, first = [], 0
        for count, pattern in patterns:
            offset = 0
            for length, times in pattern:
                rows.append((length, count * times, times, first, offset))
                offset += length * times
            first += count
        rows.sort(key=lambda r: r[0])
        table = np.array(rows, np.int64).reshape(-1, 5)
        self.length, amount, self.times, self.sequence, self.offset = table.T
        # Ranks within a length start from 0.
        before = np.cumsum(amount) - amount
        heads = np.searchsorted(self.length, self.length)
        self.rank = before - before[heads] if len(rows) else before

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = np.int64(1) << 44
        at = np.searchsorted(self.length * key + self.rank, length * key + rank, "right") - 1
        within = rank - self.rank[at]
        return self.sequence[at] + within // self.times[at], self.offset[at] + within % self.times[at] * length


def pack(docs: DataFrame, vocabulary: str, sequence: int = SEQUENCE, end: int = END) -> DataFrame:
    """Every piece and its place: the columns of ``PIECES``, sequence_id and offset.

    ``vocabulary`` is a tokenizer file that the workers can read.
    """
    table = written(pieces(docs, vocabulary, sequence, end), "pieces")
    histogram = {r["length"]: r["n"] for r in table.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = Places(shortest_pack_first(histogram, sequence))

    names = table.columns

    def place(batches):
        for batch in batches:
            of = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence_id, offset = places.of(*of)
            columns = [batch.column(n) for n in names] + [pa.array(sequence_id), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "offset"])

    order = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    ranked = numbered(table, ["length"], order, order, "rank")
    return ranked.select(*names, "rank").mapInArrow(place, PIECES + ", sequence_id long, offset long")
