"""Quality classifier by non-negative positive-unlabelled learning.

Trusted positives and unlabelled web text, both bounded samples off the held-out fold, and the
class prior estimated from these two fit a linear scorer over the form of a text: frequencies of pairs of
character classes, and binned ratios of repetition, word and line length.  Every document is then scored
from its whole text in one narrow map; the broadcast model is a few kB whatever the input.

Defined results: null and empty texts have the features of an empty text and get its score; repeated rows
get equal scores; an empty table gives no rows; without positives all get the least prior; label
rows that disagree make no positive; other columns are not read.
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

THRESHOLD, FOLDS = 0.3, 5
_CLASSES = 40
_CLASS = np.full(256, 5, np.uint8)                       # 5: bytes of other alphabets
_CLASS[:0x20] = 39
_CLASS[0x61:0x7B], _CLASS[0x41:0x5B], _CLASS[0x30:0x3A] = 0, 1, 2
_CLASS[[0x09, 0x20]], _CLASS[[0x0A, 0x0D]] = 3, 4
_MARKS = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]
_CLASS[_MARKS] = 6 + np.arange(len(_MARKS))              # each mark is a class of its own
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_EDGES = np.linspace(0.1, 0.9, 9)
_RATIOS = 5
DIMENSIONS = _CLASSES * _CLASSES + _RATIOS * (len(_EDGES) + 1)


def _distinct_share(hashes: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Distinct values over values, by row; 1 without values."""
    order = np.lexsort((hashes, row))
    h, r = hashes[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    total = np.bincount(row, minlength=n)
    return np.where(total > 0, np.bincount(r[new], minlength=n) / np.maximum(total, 1), 1.0)


def features(texts: pa.Array):
    """(first, last, matrix) for steps of whole rows."""
    data, bounds = text_bytes(texts)
    for first, last in row_steps(bounds):
        n = last - first
        b = bounds[first:last + 1] - bounds[first]
        part = data[bounds[first]:bounds[last]]
        size = np.diff(b)
        row = np.repeat(np.arange(n), size)
        kind = _CLASS[part].astype(np.int64)
        same = row[1:] == row[:-1]
        pair = (row[1:] * _CLASSES + kind[:-1]) * _CLASSES + kind[1:]
        counts = np.bincount(pair[same], minlength=n * _CLASSES * _CLASSES).reshape(n, -1)
        shape = np.sqrt(counts / np.maximum(size - 1, 1)[:, None])

        starts, ends, word_row = spans_of(~_SPACE[part], b)
        words = hash_spans(part, starts, ends)
        n_words = np.bincount(word_row, minlength=n)
        again = (words[1:] == words[:-1]) & (word_row[1:] == word_row[:-1])
        lines = spans_of((part != 0x0A) & (part != 0x0D), b)
        line_hash = hash_spans(part, lines[0], lines[1])
        upper = np.bincount(row[kind == 1], minlength=n)
        letters = upper + np.bincount(row[(kind == 0) | (kind == 5)], minlength=n)
        ratios = np.stack([
            np.bincount(word_row[1:][again], minlength=n) / np.maximum(n_words - 1, 1),
            _distinct_share(words, word_row, n),
            _distinct_share(line_hash, lines[2], n),
            np.minimum(letters / np.maximum(n_words, 1) / 20, 1),
            upper / np.maximum(letters, 1)], axis=1)
        bins = np.searchsorted(_EDGES, ratios, side="right") + np.arange(_RATIOS) * (len(_EDGES) + 1)
        hot = np.zeros((n, _RATIOS * (len(_EDGES) + 1)))
        hot[np.arange(n)[:, None], bins] = 1
        yield first, last, np.hstack([shape, hot])


def train(flags: list[int], texts: pa.Array) -> dict:
    flags = np.array(flags, int)
    return train_with(flags, texts, estimate_prior(flags, texts, train_with, score))


def train_with(flags: np.ndarray, texts: pa.Array, prior: float | None) -> dict:
    """The model for a class prior; without one, that of P against U."""
    if not (flags == 1).any() or not (flags == 0).any():
        return {"use": np.zeros(0, int), "w": np.zeros(0), "b": log_odds(prior), "prior": prior}
    x = np.vstack([m.astype(np.float32) for _, _, m in features(texts)])
    use = np.flatnonzero((x > 0).sum(axis=0) >= 5)
    scale = x[:, use].std(axis=0) + 1e-2
    x = x[:, use] / scale
    w, b = fit_nnpu(x[flags == 1], x[flags == 0], prior)
    return {"use": use, "w": w / scale, "b": b, "prior": prior}


def score(model: dict, texts: pa.Array) -> np.ndarray:
    out = np.zeros(len(texts))
    for first, last, m in features(texts):
        out[first:last] = sigmoid(m[:, model["use"]] @ model["w"] + model["b"])
    return out


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        folds: int = FOLDS, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> dict:
    return fit_in_task(training_sample(docs, labels, label, id_col, text_col, folds, positives, unlabelled), train)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD, **options) -> DataFrame:
    """Per row: id, held_out, score, predicted."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col=id_col, text_col=text_col, **options))
    fields = [T.StructField("score", T.DoubleType())]
    scored = with_score(docs, text_col, lambda t: [pa.array(score(model.value, t))], fields, [id_col], False)
    return scored.select(
        F.col("doc")[id_col].alias(id_col),
        F.coalesce(fold(F.col("doc")[id_col], options.get("folds", FOLDS)) == 0, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, unchanged."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col=id_col, text_col=text_col, **options))
    fields = [T.StructField("score", T.DoubleType())]
    keep = [c for c in docs.columns if c != text_col]
    scored = with_score(docs, text_col, lambda t: [pa.array(score(model.value, t))], fields, keep, True)
    return scored.where(F.col("score") >= threshold).select(
        *[F.col("text").alias(c) if c == text_col else F.col("doc").getField(c).alias(c) for c in docs.columns])
