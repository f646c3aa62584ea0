"""Cross-entropy difference: how much closer each document is to a target language model than to a background one.

The background is the whole corpus, the target its documents labelled good. Both are bigram models of one form: one
vocabulary, one set of bigrams, one smoothing, each with its own counts. The vocabulary is all words that occur at least
``LEAST`` times in the corpus, and likewise the bigrams, at every size: the model grows with the corpus and is never
gathered. All other words are one unknown word.

Documents stand in chunks of bounded size. A chunk tells its distinct words, with their counts, to buckets of words; a
bucket adds them up and answers each chunk in the order in which it asked, so answers need no names. The same is done
with bigrams of the numbers that the words got, and with what follows each word in all. A word or bigram of any number
of documents is one entry per chunk. Then every chunk has the figures of its own words and bigrams, and scores alone.

The probability of a word after another one is its share among what follows there, in part, and its overall share for the
rest; the rest is what makes the sum over the vocabulary one. A document's first word has its overall share only.

The score is the mean over a document's words of target loss minus background loss, in nats: the lower, the closer to
the target. A null or empty text has no words, null losses and score 0. Repeated rows are counted and scored each.
Without labelled documents the target model is uniform. A text longer than a chunk is a chunk of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.spread import written
from tidemark.llm.words import WORD_BYTES, mix, sliced_words
from tidemark.session import settings

# Occurrences in the corpus that make a word or bigram known.
LEAST = 2
# Weight of what follows a word, against the overall shares.
FOLLOWING = 0.7
ADDED = 0.5
# Text of a chunk, and text of the corpus per bucket.
CHUNK_BYTES = 16 << 20
BUCKET_BYTES = 16 << 20
# What a row counts in a chunk besides its text.
ROW_BYTES = 64
# Buckets of a small corpus.
BUCKETS = 256
# The chunk or bucket of what is said to the driver.
DRIVER = -1

SAID = "chunk long, bucket int, said binary"
SAID_NAMES = ["chunk", "bucket", "said"]


def _packed(table: np.ndarray) -> bytes:
    """Rows of integers in few bytes: by the bytes' place in the integers; of ascending keys in the first row, the steps."""
    table = np.array(table, np.int64, order="C")
    keys = table[0].view(np.uint64)
    ascending = bool((keys[1:] > keys[:-1]).all())
    if ascending:
        table[0] = np.diff(table[0], prepend=0)
    planes = np.ascontiguousarray(table.reshape(-1).view(np.uint8).reshape(-1, 8).T)
    return bytes([ascending]) + table.size.to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _unpacked(said: bytes, rows: int) -> np.ndarray:
    size = int.from_bytes(said[1:9], "little")
    planes = np.frombuffer(pa.decompress(said[9:], 8 * size, "zstd", asbytes=True), np.uint8).reshape(8, size)
    table = np.array(planes.T, order="C").view(np.int64).reshape(rows, -1)
    if said[0]:
        table[0] = np.cumsum(table[0])
    return table


def _rows(said: list[tuple[int, int, np.ndarray]]) -> pa.Table:
    columns = list(zip(*said)) or [(), (), ()]
    kinds = (pa.int64(), pa.int32(), pa.binary())
    blobs = [_packed(told) for told in columns[2]]
    arrays = [pa.array(c, kind) for c, kind in zip((columns[0], columns[1], blobs), kinds)]
    return pa.Table.from_arrays(arrays, SAID_NAMES)


def _heard(column: pa.ChunkedArray, rows: int) -> list[np.ndarray]:
    return [_unpacked(said, rows) for said in column.to_pylist()]


def _summed(place: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(place, own, n) for own in counts]).astype(np.int64)


def _asked(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys by bucket and key, the number of keys before each bucket and in all, and the place of each key."""
    distinct, inverse = np.unique(keys, return_inverse=True)
    bucket = (mix(distinct) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return distinct[order], np.searchsorted(bucket[order], np.arange(buckets + 1)), place[inverse]


def _questions(keys: np.ndarray, counts: np.ndarray, chunk: int, buckets: int):
    """What a chunk tells each bucket: distinct keys and their two counts."""
    distinct, first, place = _asked(keys, buckets)
    told = np.concatenate([distinct.view(np.int64)[None], _summed(place, counts, len(distinct))])
    return [(chunk, int(b), told[:, first[b] : first[b + 1]]) for b in np.flatnonzero(np.diff(first))]


def _both(good: np.ndarray) -> np.ndarray:
    """Counts of single occurrences: in the background, and in the target if good."""
    return np.stack([np.ones(len(good), np.int64), good.astype(np.int64)])


def _tokens(texts) -> tuple[np.ndarray, np.ndarray]:
    """The hash and the document of each word."""
    hashes, document = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for lo, _hi, found in sliced_words(texts, WORD_BYTES, True):
        hashes.append(found.hashes(0))
        document.append(found.document + lo)
    return np.concatenate(hashes), np.concatenate(document)


def _step(table: DataFrame, label: str) -> DataFrame:
    """The frame as a written table. The shuffles on the way to it go at once, so that steps do not add up on disk."""
    with settings(table.sparkSession, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        return written(table, label)


def _dealt(rows: DataFrame, buckets: int, chunk_bytes: int) -> DataFrame:
    """The rows with their chunk, and what the chunks tell the buckets of words."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        chunk, size, held = TaskContext.get().partitionId() << 32, 0, []
        types = None

        def closed():
            keys, counts = np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held], 1)
            told = _rows(_questions(keys, counts, chunk, buckets))
            nothing = [pa.nulls(len(told), t) for t in types]
            own = [told[c].chunk(0) for c in SAID_NAMES]
            return pa.RecordBatch.from_arrays([own[0], *nothing, *own[1:]], names)

        names = ["chunk", "doc_id", "text", "good", "bucket", "said"]
        for batch in batches:
            own = [batch.column(c) for c in ("doc_id", "text", "good")]
            types = [c.type for c in own]
            good = own[2].to_numpy(zero_copy_only=False).astype(bool)
            for lo, hi, found in sliced_words(own[1], WORD_BYTES, True):
                n = hi - lo
                chunks = pa.array(np.full(n, chunk), pa.int64())
                parts = [c.slice(lo, n) for c in own]
                yield pa.RecordBatch.from_arrays(
                    [chunks, *parts, pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names
                )
                distinct, inverse = np.unique(found.hashes(0), return_inverse=True)
                held.append((distinct, _summed(inverse, _both(good[lo:hi][found.document]), len(distinct))))
                size += len(found.data) + ROW_BYTES * n
                if size >= chunk_bytes:
                    yield closed()
                    chunk, size, held = chunk + 1, 0, []
        if held:
            yield closed()

    return rows.mapInArrow(run, f"chunk long, doc_id {kind}, text string, good boolean, bucket int, said binary")


class _Bucket:
    """The keys that chunks told one bucket, added up."""

    def __init__(self, table: pa.Table):
        self.chunks = table["chunk"].to_pylist()
        told = _heard(table["said"], 3)
        self.ends = np.cumsum([t.shape[1] for t in told])
        keys, *counts = np.concatenate(told, 1)
        self.keys, self.inverse = np.unique(keys.view(np.uint64), return_inverse=True)
        self.counts = _summed(self.inverse, counts, len(self.keys))
        self.known = self.counts[0] >= LEAST

    def answers(self, bucket: int, found: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
        """For each chunk, ``found`` of its keys in its own order; 0 of unknown ones."""
        parts = np.split((found * self.known)[:, self.inverse], self.ends[:-1], 1)
        return [(chunk, bucket, part) for chunk, part in zip(self.chunks, parts)]


def _word_numbers(told: DataFrame, buckets: int) -> DataFrame:
    """To chunks: the numbers of known words, from 1. To the driver: known words, all counts, known ones' counts."""

    def run(table):
        own, bucket = _Bucket(table), table["bucket"][0].as_py()
        numbers = 1 + bucket + buckets * (np.cumsum(own.known) - 1)
        if len(numbers) and numbers.max() >= 1 << 32:
            raise ValueError("more than 2**32 words")
        figures = [own.known.sum(), *own.counts.sum(1), *own.counts[:, own.known].sum(1)]
        return _rows([*own.answers(bucket, numbers[None]), (DRIVER, bucket, np.array(figures)[:, None])])

    return told.groupBy("bucket").applyInArrow(run, SAID)


def _answers(table: pa.Table, kind: int, rows: int) -> np.ndarray:
    own = table.filter(pc.equal(table["kind"], kind)).sort_by("bucket")
    return np.concatenate([np.zeros((rows, 0), np.int64), *_heard(own["said"], rows)], 1)


def _pairs(numbers: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a word follows another one, and the key of both."""
    follows = np.flatnonzero(document[1:] == document[:-1]) + 1
    numbers = numbers.astype(np.uint64)
    return follows, numbers[follows - 1] << np.uint64(32) | numbers[follows]


def _pair_counts(rows: DataFrame, numbers: DataFrame, buckets: int) -> DataFrame:
    """To chunks: counts of known bigrams. To buckets of words and, for the unknown word, to the driver: what follows."""

    def tell(docs, answers):
        chunk = docs["chunk"][0].as_py()
        hashes, document = _tokens(docs["text"])
        _, _, place = _asked(hashes, buckets)
        follows, keys = _pairs(_answers(answers, 0, 1)[0][place], document)
        good = docs["good"].to_numpy().astype(bool)[document[follows]]
        return _rows(_questions(keys, _both(good), chunk, buckets))

    def run(table):
        own, bucket = _Bucket(table), table["bucket"][0].as_py()
        before, inverse = np.unique(own.keys[own.known] >> np.uint64(32), return_inverse=True)
        before = before.astype(np.int64)
        sums = np.concatenate([before[None], _summed(inverse, own.counts[:, own.known], len(before))])
        home = np.where(before > 0, (before - 1) % buckets, DRIVER)
        order = np.argsort(home, kind="stable")
        homes, first = np.unique(home[order], return_index=True)
        said = [(DRIVER, int(b), part) for b, part in zip(homes, np.split(sums[:, order], first[1:], 1))]
        return _rows([*own.answers(bucket, own.counts), *said])

    told = rows.groupBy("chunk").cogroup(numbers.groupBy("chunk")).applyInArrow(tell, SAID)
    return told.groupBy("bucket").applyInArrow(run, SAID)


def _word_figures(told: DataFrame, follows: DataFrame, buckets: int) -> DataFrame:
    """To chunks: two counts of each known word, and two sums of what follows it."""

    def run(table, sums):
        if not len(table):
            return _rows([])
        own, bucket = _Bucket(table), table["bucket"][0].as_py()
        n = int(own.known.sum())
        before, *counts = np.concatenate([np.zeros((3, 0), np.int64), *_heard(sums["said"], 3)], 1)
        found = np.zeros((4, len(own.keys)), np.int64)
        found[:2] = own.counts
        found[2:, own.known] = _summed((before - 1) // buckets, counts, n)
        return _rows(own.answers(bucket, found))

    return told.groupBy("bucket").cogroup(follows.groupBy("bucket")).applyInArrow(run, SAID)


def _for_driver(said: DataFrame, rows: int) -> np.ndarray:
    """The sum of the columns that buckets told the driver: one row of a few figures per bucket."""
    heard = [_unpacked(r["said"], rows).sum(1) for r in said.select("said").toLocalIterator()]
    return np.sum([np.zeros(rows, np.int64), *heard], 0)


def score(
    docs: DataFrame, labels: DataFrame, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """doc_id, n_words, target_loss, background_loss and score of all documents; the target is those labelled good."""
    # Labels grow with the corpus and are never broadcast, so the plan is one at every size.
    good = labels.where("quality = 1").select("doc_id").distinct().withColumn("good", F.lit(True)).hint("merge")
    rows = docs.select("doc_id", "text").join(good, "doc_id", "left").withColumn("good", F.coalesce("good", F.lit(False)))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = BUCKETS + size // bucket_bytes

    table = _step(_dealt(rows, buckets, chunk_bytes), "chunks")
    rows, told = table.where("bucket is null").drop("bucket", "said"), table.where("bucket is not null").select(*SAID_NAMES)
    words = _step(_word_numbers(told, buckets), "words")
    numbers = words.where(F.col("chunk") != DRIVER).withColumn("kind", F.lit(0))
    n_known, *counts = _for_driver(words.where(F.col("chunk") == DRIVER), 5)
    pairs = _step(_pair_counts(rows, numbers, buckets), "bigrams")
    follows = pairs.where((F.col("chunk") == DRIVER) & (F.col("bucket") != DRIVER))
    _, *after_unknown = _for_driver(pairs.where((F.col("chunk") == DRIVER) & (F.col("bucket") == DRIVER)), 3)
    figures = _word_figures(told, follows, buckets)
    answers = numbers
    for kind, said in ((1, pairs.where(F.col("chunk") != DRIVER)), (2, figures)):
        answers = answers.unionAll(said.withColumn("kind", F.lit(kind)))
    return _scored(rows, answers, buckets, n_known + 1, np.array(counts).reshape(2, 2), np.array(after_unknown))


def _scored(
    rows: DataFrame, answers: DataFrame, buckets: int, n: int, counts: np.ndarray, after_unknown: np.ndarray
) -> DataFrame:
    """``counts``: of all words and of the known ones, by model."""
    totals, unknown = counts[0][:, None], np.concatenate([counts[0] - counts[1], after_unknown])[:, None]

    def run(docs, said):
        n_docs = len(docs)
        hashes, document = _tokens(docs["text"])
        _, _, place = _asked(hashes, buckets)
        numbers, figures = _answers(said, 0, 1)[0], _answers(said, 2, 4)
        figures = np.where(numbers > 0, figures, unknown)
        share = (figures[:2] + ADDED) / (totals + ADDED * n)
        context = np.maximum(figures[:2], 1)
        rest = np.maximum(1 - FOLLOWING * figures[2:] / context, 1 - FOLLOWING)
        follows, keys = _pairs(numbers[place], document)
        _, _, pair = _asked(keys, buckets)
        after, before = place[follows], place[follows - 1]
        # What a word's probability is made of: its overall share, and what is known to follow the word before.
        p = share[:, place]
        p[:, follows] = FOLLOWING * _answers(said, 1, 2)[:, pair] / context[:, before] + rest[:, before] * share[:, after]
        n_words = np.bincount(document, minlength=n_docs)
        sums = [np.bincount(document, -np.log(own), n_docs) for own in p]
        background, target = np.stack(sums) / np.maximum(n_words, 1)
        empty = n_words == 0
        made = {
            "doc_id": docs["doc_id"],
            "n_words": pa.array(n_words, pa.int64()),
            "target_loss": pa.array(target, mask=empty),
            "background_loss": pa.array(background, mask=empty),
            "score": pa.array(target - background),
        }
        return pa.table(made)

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, target_loss double, background_loss double, score double"
    return rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, schema)
