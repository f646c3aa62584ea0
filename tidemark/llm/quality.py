"""Quality by compression: which of two zstandard dictionaries, of good or of bad text, shortens a text more.

A dictionary is trained on a bounded sample of labelled texts of its class. A text is compressed in blocks, all of
it, with either dictionary, so that the dictionaries count in long texts as well as in short ones; the difference of
the sizes over their sum, and how it varies over the blocks, become a probability by logistic calibration on labelled
rows that no dictionary has seen.

An empty or null text has no block and gets the share of good labels. Without labels of both classes every text gets
that share too. Repeated rows are scored alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.labelled import class_weights, fit_logistic, fit_sample, prior, sigmoid
from tidemark.llm.spread import remainder
from tidemark.llm.words import buffers

MODULUS, HELD_OUT = 5, 0
THRESHOLD = 0.3
# The fit takes at most so many labelled rows of each class.
FIT_ROWS = 2000
BLOCK = 1024
DICTIONARY_BYTES = 64 << 10
LEVEL = 3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    coefficients: tuple[float, ...]
    share: float


class Compressors:
    def __init__(self, model: Model):
        self.pair = [_compressor(d) for d in (model.good, model.bad)]

    def features(self, text: bytes) -> tuple[float, float, float, float]:
        """Relative size difference of the whole and of the best block for the bad dictionary; logs of the
        compressed share with the good dictionary (repeated words shrink to almost nothing) and of the length."""
        all_good = all_bad = 0
        worst = -1.0
        for lo in range(0, len(text), BLOCK):
            block = text[lo : lo + BLOCK]
            good, bad = (len(c.compress(block)) for c in self.pair)
            all_good += good
            all_bad += bad
            if len(block) >= BLOCK // 4 or lo == 0:
                worst = max(worst, (good - bad) / (good + bad))
        return (all_good - all_bad) / (all_good + all_bad), worst, np.log(all_good / len(text)), np.log1p(len(text))


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(content)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False)


def dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; of too few samples to train on, their ends themselves."""
    blocks = [t[lo : lo + BLOCK] for t in texts for lo in range(0, len(t), BLOCK)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[-DICTIONARY_BYTES:]


def _inputs(features: np.ndarray) -> np.ndarray:
    """Scaled, and with the evidence growing with the length of the text."""
    whole, worst, share, length = features.T
    dense = np.maximum(-share - 1, 0)
    return np.column_stack([20 * whole, 20 * worst, 5 * whole * length, share, dense, dense * (length - 7), length - 7])


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    sample, counts = fit_sample(docs, labels, "quality", MODULUS, HELD_OUT, {0: rows, 1: rows})
    texts = [t.encode() for t in sample["text"]]
    y = sample["label"].to_numpy(dtype=float)
    usable = [i for i, t in enumerate(texts) if t]
    chosen = {value: [i for i in usable if y[i] == value] for value in (0, 1)}
    if min(map(len, chosen.values())) < 2:
        return Model(b"", b"", (), prior(counts))
    learn, rest = {}, []
    for value, own in chosen.items():
        # Every other row makes the dictionary; the others calibrate.
        learn[value], other = own[::2], own[1::2]
        rest += other
    model = Model(
        dictionary([texts[i] for i in learn[1]]), dictionary([texts[i] for i in learn[0]]), (), prior(counts)
    )
    compressors = Compressors(model)
    x = _inputs(np.array([compressors.features(texts[i]) for i in rest]))
    beta = fit_logistic(x, y[rest], class_weights(y[rest], counts))
    return Model(model.good, model.bad, tuple(beta), model.share)


def scorer(model: Model):
    """Texts (an Arrow column) to scores."""
    compressors = Compressors(model) if model.coefficients else None
    beta = np.array(model.coefficients)

    def score(column) -> np.ndarray:
        data, offsets = buffers(column)
        found = np.full(len(column), model.share)
        some = np.flatnonzero(np.diff(offsets))
        if compressors and len(some):
            x = _inputs(np.array([compressors.features(data[offsets[i] : offsets[i + 1]].tobytes()) for i in some]))
            found[some] = sigmoid(x @ beta[:-1] + beta[-1])
        return found

    return score


def score(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (of label 1), predicted. A null id is not held out."""
    model = fit(docs, labels, rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of DICTIONARY_BYTES

    def run(batches):
        of = scorer(shared.value)
        for batch in batches:
            found = pa.array(of(batch.column("text")), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id",
        F.coalesce(remainder("doc_id", MODULUS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is at least the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows))

    def run(batches):
        of = scorer(shared.value)
        for batch in batches:
            yield batch.filter(pa.array(of(batch.column("text")) >= threshold))

    return docs.mapInArrow(run, docs.schema)
