"""Toxic spans by a linear-chain conditional random field of two states, clean and toxic.

Labels are per document. They become token labels by a lexicon: word forms and word beginnings that occur in toxic
documents and hardly ever in clean ones; in a toxic document the tokens that carry one are labelled toxic. On sequences
of such tokens the CRF learns weights of hashed features (the word, its beginnings, its length) and transitions, by
gradient steps with forward-backward expectations. At scoring, forward-backward gives every token of a whole text the
probability to be toxic; over a document these add up to the log odds of "no token is toxic", and a logistic
calibration on labelled rows makes it a score. Runs of tokens of at least one half are the offending spans.

The fit takes a bounded sample of labelled rows (``FIT_ROWS``, ``FIT_CLEAN_ROWS``). The recursions run on all texts of a slice as
one chain that starts anew at each document: blocks of the chain side by side, then block by block.

An empty or null text has no token and gets a score from the calibration's intercept. Without toxic labels all scores are
the smoothed share of toxic labels. Repeated rows are scored alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.labelled import class_weights, fit_logistic, fit_sample, prior, sigmoid
from tidemark.llm.spread import remainder
from tidemark.llm.words import WORD_BYTES, Words, mix, sliced_words

MODULUS, HELD_OUT = 4, 2
THRESHOLD = 0.3
# The fit takes at most so many labelled rows, toxic and clean.
FIT_ROWS = 2000
FIT_CLEAN_ROWS = 3200
BUCKETS = 1 << 20
# Lengths in bytes of the word beginnings that are features, beside the whole word.
BEGINNINGS = (4, 5, 6, 7, 8)
# A lexicon entry stands before so many different words in toxic documents, and its odds are so many times the labels'
# odds. Up to LEXICON_ENOUGH words the bar is also a share of those documents; beyond it does not rise with the sample.
LEXICON_ROWS = 3
LEXICON_SHARE = 0.015
LEXICON_ENOUGH = 12
LEXICON_ODDS = 12.0
STEPS = 60
CHAIN = 64


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of the toxic state, by feature bucket
    start: float  # log odds of toxic at a document's first token
    stay_clean: float  # log of P(clean to clean)-like weights: rows of the transition matrix, unnormalised
    to_toxic: float
    to_clean: float
    stay_toxic: float
    coefficients: tuple[float, ...]
    share: float


def features(found: Words) -> np.ndarray:
    """Feature buckets, a row per token: the word, and its beginnings where it is longer."""
    length = found.end - found.start
    columns = [found.hashes(0)]
    for n in BEGINNINGS:
        part = found.hashes(0, n)
        columns.append(np.where(length > n, mix(part + np.uint64(n)), columns[0]))
    return np.stack([(c % np.uint64(BUCKETS)).astype(np.int32) for c in columns], 1)


def _emission(weights: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return sum(weights[column] for column in tokens.T)


def _summed(tokens: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of the tokens' values by feature bucket."""
    return sum(np.bincount(column, values, BUCKETS) for column in tokens.T)


def _transitions(model) -> np.ndarray:
    return np.exp(np.array([[model.stay_clean, model.to_toxic], [model.to_clean, model.stay_toxic]]))


def marginals(emission: np.ndarray, first: np.ndarray, start: float, steps: np.ndarray) -> np.ndarray:
    """P(toxic) of each token of a chain of documents.

    ``emission`` is the log odds that a token adds, ``first`` marks the first token of each document, ``steps`` is the
    2 by 2 matrix of transition weights. A document's first token does not depend on what stands before.
    """
    n = len(emission)
    if not n:
        return np.zeros(0)
    blocks = -(-n // CHAIN)
    odds = np.exp(np.clip(emission, -30, 30))
    # The step into token t, from either state to either state, as its emission weighs it.
    matrix = np.empty((2, 2, blocks * CHAIN))
    for i in (0, 1):
        matrix[i, 0, :n] = np.where(first, 1.0, steps[i, 0])
        matrix[i, 1, :n] = np.where(first, np.exp(start), steps[i, 1]) * odds
        matrix[i, :, n:] = np.eye(2)[i][:, None]
    by_block = matrix.reshape(2, 2, blocks, CHAIN)

    def scaled(a, b):
        total = a + b
        return a / total, b / total

    # Products over each block, then the vectors at the blocks' edges, then all tokens.
    product = np.broadcast_to(np.eye(2)[:, :, None], (2, 2, blocks)).copy()
    for t in range(CHAIN):
        product = np.einsum("ijb,jkb->ikb", product, by_block[..., t])
        product /= product.sum((0, 1))
    ahead, behind = np.empty((2, blocks)), np.empty((2, blocks))
    p00, p01, p10, p11 = (product[i, k].tolist() for i in (0, 1) for k in (0, 1))
    x = 0.5
    for b in range(blocks):
        ahead[:, b] = x, 1 - x
        zero, one = x * p00[b] + (1 - x) * p10[b], x * p01[b] + (1 - x) * p11[b]
        x = zero / (zero + one)
    x = 0.5
    for b in range(blocks - 1, -1, -1):
        behind[:, b] = x, 1 - x
        zero, one = p00[b] * x + p01[b] * (1 - x), p10[b] * x + p11[b] * (1 - x)
        x = zero / (zero + one)
    forward = np.empty((2, blocks, CHAIN))
    a, b = ahead
    for t in range(CHAIN):
        m = by_block[..., t]
        a, b = scaled(a * m[0, 0] + b * m[1, 0], a * m[0, 1] + b * m[1, 1])
        forward[0, :, t], forward[1, :, t] = a, b
    a, b = behind
    toxic = np.empty((blocks, CHAIN))
    for t in range(CHAIN - 1, -1, -1):
        clean, bad = forward[0, :, t] * a, forward[1, :, t] * b
        toxic[:, t] = bad / (clean + bad)
        m = by_block[..., t]
        a, b = scaled(m[0, 0] * a + m[0, 1] * b, m[1, 0] * a + m[1, 1] * b)
    return toxic.reshape(-1)[:n]


# ---------------------------------------------------------------- fit


def _documents(texts: pd.Series):
    """The place and feature rows of each document, a slice of texts at a time."""
    for lo, hi, found in sliced_words(pa.array(texts, pa.string()), WORD_BYTES, True):
        rows = features(found)
        for d in range(hi - lo):
            yield lo + d, rows[found.first[d] : found.first[d + 1]]


def lexicon(texts: pd.Series, toxic: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Feature buckets that speak for toxic documents.

    Copies of one toxic document share all their words; they do not make an entry, since it must have many contexts.
    """
    by_label = np.zeros((2, BUCKETS))
    pairs = [np.zeros(0, np.int64)]
    for k, rows in _documents(texts):
        by_label[toxic[k], np.unique(rows)] += 1
        if toxic[k] and len(rows):
            pairs.append(np.unique(rows.astype(np.int64) * BUCKETS + np.append(rows[1:, 0], 0)[:, None]))
    contexts = np.bincount(np.unique(np.concatenate(pairs)) // BUCKETS, minlength=BUCKETS)
    scale = [max(weights[toxic == value].mean(), 1e-9) for value in (0, 1)]
    clean, bad = by_label[0] * scale[0], by_label[1] * scale[1]
    odds = scale[1] * (toxic == 1).sum() / (scale[0] * (toxic == 0).sum())
    sure = (bad + 1e-9) / (clean + 0.1 * scale[0]) >= LEXICON_ODDS * odds
    return np.flatnonzero(sure & (contexts >= enough_contexts((toxic == 1).sum())))


def enough_contexts(toxic_rows: int) -> float:
    """The number of different following words that make an entry."""
    return min(max(LEXICON_ROWS, LEXICON_SHARE * toxic_rows), LEXICON_ENOUGH)


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, clean_rows: int = FIT_CLEAN_ROWS) -> Model:
    sample, counts = fit_sample(docs, labels, "toxic", MODULUS, HELD_OUT, {0: clean_rows, 1: rows})
    return fit_texts(sample["text"], sample["label"].to_numpy(dtype=int), counts, rows)


def fit_texts(texts: pd.Series, toxic: np.ndarray, counts: dict[int, int], rows: int = FIT_ROWS) -> Model:
    """The lexicon and the calibration take all texts; the CRF at most ``rows`` of each label."""
    share = prior(counts)
    empty = Model(np.zeros(1), -9.0, 0.0, -9.0, 0.0, 0.0, (), share)
    if not (toxic == 1).any() or not (toxic == 0).any():
        return empty
    weights = class_weights(toxic, counts)
    entries = np.zeros(BUCKETS, bool)
    entries[lexicon(texts, toxic, weights)] = True
    if not entries.any():
        return empty
    taken = np.zeros(len(toxic), bool)
    for value in (0, 1):
        own = np.flatnonzero(toxic == value)
        taken[own[:: -(-len(own) // rows)]] = True
    chosen = [(k, d) for k, d in _documents(texts) if taken[k]]
    lengths = np.array([len(d) for _, d in chosen])
    tokens = np.concatenate([d for _, d in chosen])
    edges = np.concatenate([[0], np.cumsum(lengths)])
    label = entries[tokens].any(1) & np.repeat(toxic[[k for k, _ in chosen]] == 1, lengths)
    first = np.zeros(len(tokens), bool)
    first[edges[:-1][lengths > 0]] = True

    # Gradient steps on the log likelihood, with step sizes by the gradients so far (AdaGrad).
    weight, start, step = np.zeros(BUCKETS), -4.0, np.log(np.array([[0.98, 0.02], [0.7, 0.3]]))
    counted = _summed(tokens, np.ones(len(tokens)))
    seen_w, seen_t = np.full(BUCKETS, 1e-6), np.full((2, 2), 1e-6)
    follows = np.flatnonzero(~first)
    observed = np.array(
        [[np.sum((label[follows - 1] == i) & (label[follows] == j)) for j in (0, 1)] for i in (0, 1)], float
    )
    for _ in range(STEPS):
        p = marginals(_emission(weight, tokens), first, start, np.exp(step))
        residual = label - p
        gradient = _summed(tokens, residual) / np.sqrt(counted + 1)
        gradient -= 1e-3 * weight
        seen_w += gradient**2
        weight += 0.5 * gradient / np.sqrt(seen_w)
        # Expected transitions, from neighbouring marginals and the transition odds.
        expected = _expected(p, follows, np.exp(step))
        t = (observed - expected) / len(tokens)
        seen_t += t**2
        step += 0.1 * t / np.sqrt(seen_t)
        start += 0.1 * np.sign((label[first] - p[first]).sum())
    model = Model(weight.astype(np.float32), float(start), *map(float, step.ravel()), (), share)
    inputs = [evidence(model, found) for _lo, _hi, found in sliced_words(pa.array(texts, pa.string()), WORD_BYTES, True)]
    x = _inputs(*map(np.concatenate, zip(*[(e, n) for _p, e, n in inputs])))
    return Model(**{**model.__dict__, "coefficients": tuple(fit_logistic(x, toxic.astype(float), weights))})


def _expected(p: np.ndarray, follows: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Expected transition counts: pairs of marginals, coupled with the transitions' odds ratio."""
    a, b = p[follows - 1], p[follows]
    ratio = steps[0, 0] * steps[1, 1] / (steps[0, 1] * steps[1, 0])
    # P(toxic, toxic) of two margins with a given odds ratio.
    s = 1 + (a + b) * (ratio - 1)
    both = np.where(
        abs(ratio - 1) < 1e-9, a * b, (s - np.sqrt(np.maximum(s * s - 4 * ratio * (ratio - 1) * a * b, 0))) / (2 * (ratio - 1 or 1))
    )
    return np.array([[(1 - a - b + both).sum(), (b - both).sum()], [(a - both).sum(), both.sum()]])


# ---------------------------------------------------------------- scores


def _document_sums(p: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each document minus the log of "no token is toxic", and the number of tokens."""
    sums = np.concatenate([[0.0], np.cumsum(-np.log1p(-np.minimum(p, 1 - 1e-6)))])
    edges = np.concatenate([[0], np.cumsum(lengths)])
    return sums[edges[1:]] - sums[edges[:-1]], lengths


def evidence(model: Model, found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """P(toxic) of each token; each document's evidence and number of tokens."""
    first = np.zeros(len(found), bool)
    first[found.first[:-1][found.counts > 0]] = True
    p = marginals(_emission(model.weights, features(found)), first, model.start, _transitions(model))
    return p, *_document_sums(p, found.counts)


def _inputs(evidence: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.column_stack([np.log(np.maximum(evidence, 1e-6)), np.minimum(evidence, 20), np.log1p(lengths)])


def _spans(p: np.ndarray, found: Words, offsets: np.ndarray):
    """Runs of toxic tokens: document, and first and last byte in its text."""
    toxic = p >= 0.5
    document = found.document
    goes_on = np.zeros(len(p), bool)
    goes_on[1:] = toxic[1:] & toxic[:-1] & (document[1:] == document[:-1])
    heads = np.flatnonzero(toxic & ~goes_on)
    ends = np.ones(len(p), bool)
    ends[:-1] = ~goes_on[1:]
    tails = np.flatnonzero(toxic & ends)
    base = offsets[document[heads]]
    return document[heads], found.start[heads] - base, found.end[tails] - base


def tag(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, evidence and spans: byte offsets (start, end) of toxic runs in the UTF-8 text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights of four bytes
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        own = shared.value
        beta = np.array(own.coefficients)
        for batch in batches:
            scores, totals, where, spans = [], [], [], []
            for lo, hi, found in sliced_words(batch.column("text"), WORD_BYTES, True):
                if own.coefficients:
                    p, total, lengths = evidence(own, found)
                    score = sigmoid(_inputs(total, lengths) @ beta[:-1] + beta[-1])
                else:
                    p, total, score = np.zeros(len(found)), np.zeros(hi - lo), np.full(hi - lo, own.share)
                scores.append(score)
                totals.append(total)
                document, start, end = _spans(p, found, found.text_start)
                where.append(np.bincount(document, minlength=hi - lo))
                spans.append(np.stack([start, end]))
            counts = np.concatenate([np.zeros(0, np.int64), *where])
            edges = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            start, end = np.concatenate([np.zeros((2, 0), np.int64), *spans], 1)
            pairs = pa.StructArray.from_arrays([pa.array(start), pa.array(end)], ["start", "end"])
            columns = [
                batch.column("doc_id"),
                pa.array(np.concatenate([np.zeros(0), *scores])),
                pa.array(np.concatenate([np.zeros(0), *totals])),
                pa.ListArray.from_arrays(pa.array(edges), pairs),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "evidence", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, score double, evidence double, spans array<struct<start: long, end: long>>"
    )


def score(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (of label 1), predicted, spans. A null id is not held out."""
    return tag(docs, fit(docs, labels, rows)).select(
        "doc_id",
        F.coalesce(remainder("doc_id", MODULUS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "spans",
    )
