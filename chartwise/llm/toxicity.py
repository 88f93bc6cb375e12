"""Toxicity classifier by non-negative positive-unlabelled learning.

Confirmed toxic examples and unlabelled text, both bounded samples off the held-out fold, fit a
numpy classifier with the class-prior-corrected risk; the prior is estimated from these two.  Features are the presence of hashed five-byte
pieces of words and of whole words; those whose frequency differs most between the two samples are kept
(``FEATURES``).  A piece catches a slur inside a longer or inflected word.  Every document is scored
from its whole text in one narrow map.

Defined results: null and empty texts have no features and get the bias's score; repeated rows get equal scores;
an empty table gives no rows; without positives all get the least prior; label rows that disagree make no
positive; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import hash_spans, row_steps, spans_of, text_bytes
from .pu import (POSITIVES, UNLABELLED, estimate_prior, fit_in_task, fit_nnpu, fold, log_odds, sigmoid, training_sample,
                 with_score)

THRESHOLD, FOLDS = 0.5, 5
FEATURES, BITS, PIECE, LEAST_Z = 1024, 20, 5, 4.5
_LOW = np.full(256, 0x20, np.uint8)
_LOW[0x61:0x7B] = np.arange(0x61, 0x7B)
_LOW[0x41:0x5B] = np.arange(0x61, 0x7B)
_LOW[0x80:] = np.arange(0x80, 0x100)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def pieces(texts: pa.Array):
    """(first, last, row, bucket) of all pieces and words, for steps of whole rows."""
    data, bounds = text_bytes(texts)
    shift = np.uint64(64 - BITS)
    for first, last in row_steps(bounds, 1 << 20):
        b = bounds[first:last + 1] - bounds[first]
        low = _LOW[data[bounds[first]:bounds[last]]]
        starts, ends, word_row = spans_of(low != 0x20, b)
        words = hash_spans(low, starts, ends) >> shift
        if len(low) >= PIECE:
            n = len(low) - PIECE + 1
            packed = low[:n].astype(np.uint64)
            blank = np.zeros(n, bool)
            for k in range(1, PIECE):
                packed = (packed << np.uint64(8)) | low[k:n + k]
                blank |= low[k:n + k] == 0x20
            # whole within a word, or the word's first letters with the blank before them
            cut = np.zeros(len(low) + 1, bool)
            cut[b[1:-1]] = True
            inside = np.zeros(n, bool)
            inside |= ~blank
            for k in range(1, PIECE):
                inside &= ~cut[k:n + k]
            at = np.flatnonzero(inside)
            bucket = (packed[at] * _MULTIPLIER) >> shift
            row = np.searchsorted(b, at, side="right") - 1
            yield first, last, np.concatenate([row, word_row]), np.concatenate([bucket, words]).astype(np.int64)
        else:
            yield first, last, word_row, words.astype(np.int64)


def train(flags: list[int], texts: pa.Array) -> dict:
    flags = np.array(flags, int)
    return train_with(flags, texts, estimate_prior(flags, texts, train_with, score))


def train_with(flags: np.ndarray, texts: pa.Array, prior: float | None, n_features: int = FEATURES) -> dict:
    """The model for a class prior; without one, that of P against U."""
    if not (flags == 1).any() or not (flags == 0).any():
        return {"buckets": np.zeros(0, int), "w": np.zeros(0), "b": log_odds(prior), "prior": prior}
    have = np.zeros((2, 1 << BITS), np.int32)
    keys = []
    for first, last, row, bucket in pieces(texts):
        key = np.unique((row << BITS) | bucket)
        row, bucket = key >> BITS, key & ((1 << BITS) - 1)
        keys.append((first + row).astype(np.int64) << BITS | bucket)
        for y in (0, 1):
            have[y] += np.bincount(bucket[flags[first + row] == y], minlength=1 << BITS).astype(np.int32)
    n = np.array([(flags == 0).sum(), (flags == 1).sum()])
    share = have / n[:, None]
    both = have.sum(axis=0) / n.sum()
    z = np.where(have.sum(axis=0) >= 5,
                 np.abs(share[1] - share[0]) / np.sqrt(both * (1 - both) * (1 / n[0] + 1 / n[1]) + 1e-9), 0)
    buckets = np.sort(np.argsort(-z, kind="stable")[:n_features])
    buckets = buckets[z[buckets] > LEAST_Z]      # beyond what chance gives among so many
    place = np.full(1 << BITS, -1, np.int32)
    place[buckets] = np.arange(len(buckets))
    x = np.zeros((len(flags), len(buckets)), np.float32)
    for key in keys:
        col = place[key & ((1 << BITS) - 1)]
        x[(key >> BITS)[col >= 0], col[col >= 0]] = 1
    w, b = fit_nnpu(x[flags == 1], x[flags == 0], prior)
    return {"buckets": buckets, "w": w, "b": b, "prior": prior}


def score(model: dict, texts: pa.Array) -> np.ndarray:
    weight = np.zeros(1 << BITS)
    used = np.zeros(1 << BITS, bool)
    weight[model["buckets"]], used[model["buckets"]] = model["w"], True
    out = np.full(len(texts), float(model["b"]))
    for first, _, row, bucket in pieces(texts):
        hit = used[bucket]
        key = np.unique((row[hit].astype(np.int64) << BITS) | bucket[hit])
        np.add.at(out, first + (key >> BITS), weight[key & ((1 << BITS) - 1)])
    return sigmoid(out)


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD, folds: int = FOLDS, positives: int = POSITIVES,
             unlabelled: int = UNLABELLED) -> DataFrame:
    """Per row: id, held_out, score, predicted."""
    sample = training_sample(docs, labels, label, id_col, text_col, folds, positives, unlabelled)
    model = docs.sparkSession.sparkContext.broadcast(fit_in_task(sample, train))
    fields = [T.StructField("score", T.DoubleType())]
    scored = with_score(docs, text_col, lambda t: [pa.array(score(model.value, t))], fields, [id_col], False)
    return scored.select(
        F.col("doc")[id_col].alias(id_col),
        F.coalesce(fold(F.col("doc")[id_col], folds) == 0, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
