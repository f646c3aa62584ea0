"""Benchmark decontamination: BM25 search of every training passage in an index of test items, then verification.

**Index.** Terms are lower-cased words. The inverted index holds, by term, the items and their BM25 parts; parts
are divided by the score an item has against itself, so one threshold holds for all items. Items stand in blocks of
``BLOCK``; of each term the index also holds its greatest part in any item and in each block. An index takes at most
``INDEX_POSTINGS`` postings and is broadcast; more items make more indexes, which are asked one after the other.
Document frequencies and lengths are those of all items. Items of one index are of one length class: up to ``STRIDE``
words, up to twice as many, and so on. Small indexes of several classes are broadcast together and share one reading.

**Queries.** A document is cut into passages of two strides, one stride apart. The stride is the greatest length of the
class, whichever items there are; so an item that stands in a document stands whole in a passage, and what is found of
one item has the span of some four items at most (or of two times ``STRIDE`` words). As in WAND, a passage goes on only if the greatest
parts of its terms could reach the threshold together; then, as in block-max WAND, only into blocks whose own
greatest parts could; only there postings are read and summed. The tests run on all passages of a slice
of documents at once.

**Verification.** The first part of an item is taken as its question, the last ``ANSWER_SHARE`` as its answer: word
three-grams of both must stand in the passage, each to the share ``OVERLAP``. An item of fewer than ``SHORT`` words has no
such parts: it is hit by a document of just its words, and not by others that hold them.

Null and empty texts hit nothing; items without words are never hit. Repeated items and rows are reported
once each. Of passages of one document that hit an item equally, the last is reported. Very long texts are read whole, in
slices of words. Empty tables give an empty result. Columns besides id and text are not read; ``clean`` keeps them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.spread import written
from tidemark.llm.words import WORD_BYTES, Prefix, Words, sliced_words

K1, B = 1.2, 0.75
THRESHOLD = 0.5
OVERLAP = 0.6
ANSWER_SHARE = 1 / 3
NGRAM = 3
STRIDE = 64
SHORT = 2 * NGRAM
BLOCK = 16
INDEX_POSTINGS = 1_000_000


# ---------------------------------------------------------------- index


@dataclass(frozen=True)
class Item:
    item_id: int
    words: np.ndarray  # hashes, in order

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Names of the n-grams of question and answer; a part shorter than that is one gram."""
        answer = max(1, round(len(self.words) * ANSWER_SHARE))
        return _grams(self.words[:-answer]), _grams(self.words[-answer:])


def _grams(words: np.ndarray) -> np.ndarray:
    n = min(NGRAM, len(words))
    start = np.arange(len(words) - n + 1 if n else 0)
    return np.unique(Prefix(words).spans(start, start + n))


def length_class(n: int) -> int:
    """The least of ``STRIDE`` and its doubles that is no less than a number of words."""
    return STRIDE << max(0, (n - 1) // STRIDE).bit_length()


class Index:
    """Postings of some items, of one length class.

    ``rows_with`` maps a term to the number of items that have it, of all ``n_items``. Short items have no postings; they are
    looked up by all their words.
    """

    def __init__(self, items: list[Item], rows_with: dict[int, int], n_items: int, mean_length: float):
        self.items = items
        self.stride = max([STRIDE, *(length_class(len(i.words)) for i in items)])
        self.short: dict[tuple, list[int]] = {}
        for k, one in enumerate(items):
            if len(one.words) < SHORT:
                self.short.setdefault(tuple(one.words.tolist()), []).append(k)
        term, item, part = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for k, one in enumerate(items):
            if len(one.words) < SHORT:
                continue
            terms, times = np.unique(one.words, return_counts=True)
            df = np.array([rows_with[t] for t in terms.tolist()], float)
            idf = np.log1p((n_items - df + 0.5) / (df + 0.5))
            own = idf * times * (K1 + 1) / (times + K1 * (1 - B + B * len(one.words) / mean_length))
            term.append(terms)
            item.append(np.full(len(terms), k))
            part.append(own / own.sum())
        term, item, part = map(np.concatenate, (term, item, part))
        order = np.lexsort((item, term))
        term, self.item, self.part = term[order], item[order], part[order]
        self.terms, self.first = np.unique(term, return_index=True)
        self.first = np.append(self.first, len(term))
        self.greatest = np.maximum.reduceat(self.part, self.first[:-1]) if len(term) else np.zeros(0)
        # The greatest part by term and block.
        key = np.repeat(np.arange(len(self.terms)), np.diff(self.first)) * (len(items) // BLOCK + 1) + self.item // BLOCK
        _, heads = np.unique(key, return_index=True)
        self.block = self.item[heads] // BLOCK
        self.block_part = np.maximum.reduceat(self.part, heads) if len(term) else np.zeros(0)
        self.block_first = np.searchsorted(heads, self.first)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """Term numbers of words; -1 for other words."""
        if not len(self.terms):
            return np.full(len(hashes), -1)
        place = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[place] == hashes, place, -1)


def _expanded(first: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all entries of the given terms, and which term each is for."""
    counts = first[terms + 1] - first[terms]
    which = np.repeat(np.arange(len(terms)), counts)
    ahead = np.cumsum(counts) - counts
    return first[terms][which] + np.arange(len(which)) - ahead[which], which


def search(index: Index, found: Words, hashes: np.ndarray, threshold: float):
    """Passage, item and score of all hits in a slice; and each passage's document and words [start, end)."""
    stride = index.stride
    counts = found.counts
    strides = -(-counts // stride)
    first_stride = np.concatenate([[0], np.cumsum(strides)])
    document = found.document
    at = np.arange(len(hashes)) - found.first[:-1][document]
    own_stride = first_stride[:-1][document] + at // stride

    # A passage is a stride and the next one of its document; the last stride is a passage only if it is the first too.
    head = np.arange(first_stride[-1])
    stride_document = np.repeat(np.arange(len(counts)), strides)
    within = head - first_stride[:-1][stride_document]
    is_passage = (within == 0) | (within < strides[stride_document] - 1)
    start = found.first[:-1][stride_document] + within * stride
    end = np.minimum(start + 2 * stride, found.first[1:][stride_document])

    term = index.of(hashes)
    some = term >= 0
    n_terms = len(index.terms)
    pairs = np.unique(own_stride[some] * n_terms + term[some])
    of_stride, of_term = pairs // max(n_terms, 1), pairs % max(n_terms, 1)

    # Pivot test by strides: a term that stands in both counts twice, so this is an upper bound.
    most = np.bincount(of_stride, index.greatest[of_term], len(head))
    follower = np.append(stride_document[1:] == stride_document[:-1], False)
    reach = most + np.where(follower, np.append(most[1:], 0), 0)
    alive = is_passage & (reach >= threshold)
    keep = alive[of_stride]
    before = (of_stride > 0) & follower[of_stride - 1] & alive[of_stride - 1]
    pairs = np.unique(np.concatenate([pairs[keep], pairs[before] - n_terms]))
    passage, of_term = pairs // max(n_terms, 1), pairs % max(n_terms, 1)
    alive = np.bincount(passage, index.greatest[of_term], len(head)) >= threshold
    passage, of_term = passage[alive[passage]], of_term[alive[passage]]

    # Block-max test.
    entry, which = _expanded(index.block_first, of_term)
    n_blocks = len(index.items) // BLOCK + 1
    key = passage[which] * n_blocks + index.block[entry]
    keys, inverse = np.unique(key, return_inverse=True)
    good_blocks = keys[np.bincount(inverse, index.block_part[entry], len(keys)) >= threshold]

    # Postings of the blocks left.
    live = np.zeros(len(head), bool)
    live[good_blocks // n_blocks] = True
    passage, of_term = passage[live[passage]], of_term[live[passage]]
    entry, which = _expanded(index.first, of_term)
    inside = np.isin(passage[which] * n_blocks + index.item[entry] // BLOCK, good_blocks)
    entry, which = entry[inside], which[inside]
    key = passage[which] * len(index.items) + index.item[entry]
    keys, inverse = np.unique(key, return_inverse=True)
    score = np.bincount(inverse, index.part[entry], len(keys))
    hit = score >= threshold
    passage, item = keys[hit] // max(len(index.items), 1), keys[hit] % max(len(index.items), 1)
    return passage, item, score[hit], stride_document, start, end


def hits(group: list[Index], column, threshold: float = THRESHOLD, overlap: float = OVERLAP):
    """Verified hits in a text column: (row, item id, score, question overlap, answer overlap, word start, end),
    the best passage of each row and item."""
    best: dict[tuple[int, int, int], tuple] = {}
    grams: dict[tuple[int, int], tuple] = {}
    for lo, _hi, found in sliced_words(pc.utf8_lower(column), WORD_BYTES):
        hashes = found.hashes(0)
        for g, index in enumerate(group):
            for key, row in _hits(index, found, hashes, threshold, overlap, g, grams):
                key = (lo + key[0], g, key[1])
                best[key] = max(best.get(key, row), row)
    return [(r, group[g].items[k].item_id, *row[1:]) for (r, g, k), row in sorted(best.items())]


def _hits(index: Index, found: Words, hashes: np.ndarray, threshold: float, overlap: float, g: int, grams: dict):
    passage, item, score, document, start, end = search(index, found, hashes, threshold)
    for p, k, s in zip(passage.tolist(), item.tolist(), score.tolist()):
        if (g, k) not in grams:
            grams[g, k] = index.items[k].grams()
        words = hashes[start[p] : end[p]]
        own = _grams(words)
        shares = [_share(part, words, own) for part in grams[g, k]]
        if min(shares) >= overlap:
            d = int(document[p])
            first = found.first[d]
            yield (d, k), (min(shares), s, *shares, int(start[p] - first), int(end[p] - first))
    if index.short:
        for d in np.flatnonzero((found.counts > 0) & (found.counts < SHORT)).tolist():
            words = hashes[found.first[d] : found.first[d + 1]]
            for k in index.short.get(tuple(words.tolist()), ()):
                yield (d, k), (1.0, 1.0, 1.0, 1.0, 0, len(words))


def _share(part: np.ndarray, words: np.ndarray, grams: np.ndarray) -> float:
    """The share of an item part's n-grams in a passage. An empty part is there."""
    if not len(part):
        return 1.0
    own = float(np.isin(part, grams).mean())
    if len(part) == 1 and not own:
        # The part may be shorter than an n-gram.
        for n in range(1, NGRAM):
            start = np.arange(max(len(words) - n + 1, 0))
            if np.isin(part, Prefix(words).spans(start, start + n)).any():
                return 1.0
    return own


# ---------------------------------------------------------------- Spark


def indexes(items: DataFrame) -> list[Index]:
    """Indexes over all items (item_id, text)."""

    def run(batches):
        for batch in batches:
            words = []
            for _lo, hi, found in sliced_words(pc.utf8_lower(batch.column("text")), WORD_BYTES):
                hashes = found.hashes(0).view(np.int64)
                words += [hashes[a:b] for a, b in zip(found.first[:-1], found.first[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array(words, pa.list_(pa.int64()))], ["item_id", "words"]
            )

    kind = items.schema["item_id"].dataType.simpleString()
    table = written(
        items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, words array<long>").where("size(words) > 0"),
        "items",
    )
    n, mean = table.agg(F.count(F.lit(1)), F.avg(F.size("words"))).first()
    if not n:
        return []
    terms = table.select("item_id", F.explode(F.array_distinct("words")).alias("term"))
    rows_with = written(terms.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "terms")
    last = F.floor((F.size("words") - 1) / STRIDE)
    sized = table.withColumn("class", F.when(last < 1, 0).otherwise(F.length(F.bin(last))))
    classes = sized.groupBy("class").agg(F.sum(F.size("words")).alias("postings")).orderBy("class").collect()
    parts = [(c["class"], 1 + c["postings"] // INDEX_POSTINGS, k) for c in classes for k in range(1 + c["postings"] // INDEX_POSTINGS)]
    made = []
    for of, shards, shard in parts:
        here = F.pmod(F.xxhash64("item_id", "words"), F.lit(shards)) == shard
        own = sized.where((F.col("class") == of) & here).drop("class")
        used = own.select(F.explode("words").alias("term")).distinct()
        known = {r["term"] % (1 << 64): r["n"] for r in rows_with.join(used, "term", "left_semi").collect()}
        rows = sorted(own.collect(), key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["words"]))
        made.append(Index([Item(r["item_id"], np.array(r["words"], np.int64).view(np.uint64)) for r in rows], known, n, mean))
    return made


def groups(made: list[Index]) -> list[list[Index]]:
    """Indexes to be broadcast together, of at most ``INDEX_POSTINGS`` postings or one index."""
    found: list[list[Index]] = []
    held = 0
    for index in made:
        if not found or held + len(index.item) > INDEX_POSTINGS:
            found.append([])
            held = 0
        found[-1].append(index)
        held += len(index.item)
    return found


HITS = (
    "score double, question_overlap double, answer_overlap double, passage_start long, passage_end long"
)


def leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """Verified hits: doc_id, item_id and the columns of ``HITS``; the passage is in words. A row per document and item."""
    doc_kind = docs.schema["doc_id"].dataType.simpleString()
    item_kind = items.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {doc_kind}, item_id {item_kind}, {HITS}"
    names = [part.split()[0] for part in HITS.split(", ")]
    rows = docs.select("doc_id", "text")
    result = docs.sparkSession.createDataFrame([], schema)
    for group in groups(indexes(items)):
        shared = docs.sparkSession.sparkContext.broadcast(group)

        def run(batches, shared=shared):
            for batch in batches:
                found = hits(shared.value, batch.column("text"), threshold, overlap)
                if found:
                    row, ids, *rest = zip(*found)
                    columns = [batch.column("doc_id").take(pa.array(row)), pa.array(ids)]
                    yield pa.RecordBatch.from_arrays(columns + [pa.array(c) for c in rest], ["doc_id", "item_id", *names])

        result = result.unionAll(rows.mapInArrow(run, schema))
    return result


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item."""
    for group in groups(indexes(items)):
        shared = docs.sparkSession.sparkContext.broadcast(group)

        def run(batches, shared=shared):
            for batch in batches:
                kept = np.ones(batch.num_rows, bool)
                kept[[h[0] for h in hits(shared.value, batch.column("text"), threshold, overlap)]] = False
                yield batch.filter(pa.array(kept))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
