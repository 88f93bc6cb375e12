"""Non-negative positive-unlabelled learning in numpy, and the bounded samples it is fitted on.

The risk of a scorer f under logistic loss l is estimated from positives P, unlabelled U and the
class prior pi as  pi * E_P[l(f)] + max(0, E_U[l(-f)] - pi * E_P[l(-f)]).  The second term
estimates the negatives' risk; once it turns negative the model has begun to memorise, and the
step goes the other way.

The class prior is estimated from P and U alone (no negative label is read): a scorer fitted to tell P from
U on three quarters of the texts ranks the fourth, and the least ratio of U's to P's share above a score,
taken where its confidence bound is least (best bin estimation), bounds the positives' share in U.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import python_ready

#: bounds of the training sample: documents, and bytes of a document that may be in it
POSITIVES, UNLABELLED, TRAIN_BYTES = 3000, 6000, 1 << 16
#: least and greatest class prior, and parts of the sample that are scored by a model of the others to estimate it
PRIORS, PARTS = (0.01, 0.99), 4


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def fit_nnpu(pos: np.ndarray, unl: np.ndarray, prior: float | None, steps: int = 400, rate: float = 0.05,
             decay: float = 3e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear scorer with the least non-negative unbiased risk (Adam, full batch).
    Without a prior: of the scorer that tells P from U, both weighing half."""
    pos, unl = pos.astype(np.float32), unl.astype(np.float32)
    w, b = np.zeros(pos.shape[1], np.float32), 0.0 if prior is None else log_odds(prior)
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, steps + 1):
        fp, fu = pos @ w + b, unl @ w + b
        sp, su = sigmoid(fp), sigmoid(fu)
        # derivatives by the scores: l(f) = log(1 + e^-f), l(-f) = log(1 + e^f)
        if prior is None:
            dp, du = (sp - 1) / (2 * len(sp)), su / (2 * len(su))
        else:
            negatives = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
            dn_p, dn_u = -prior * sp / len(sp), su / len(su)
            if negatives >= 0:
                dp, du = prior * (sp - 1) / len(sp) + dn_p, dn_u
            else:
                dp, du = -dn_p, -dn_u
        g = np.append(pos.T @ dp.astype(np.float32) + unl.T @ du.astype(np.float32) + decay * w, dp.sum() + du.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1].astype(np.float32), b - float(step[-1])
    return w, b


def log_odds(prior: float) -> float:
    return float(np.log(prior / (1 - prior)))


def share_of_positives(pos: np.ndarray, unl: np.ndarray) -> float:
    """The positives' share in U from held-out scores of P and U (best bin estimation, 90 % bound)."""
    at = np.unique(pos)
    above_p = 1 - np.searchsorted(np.sort(pos), at) / len(pos)
    above_u = 1 - np.searchsorted(np.sort(unl), at) / len(unl)
    slack = 1.01 * sum(np.sqrt(np.log(4 / 0.1) / (2 * len(x))) for x in (pos, unl))
    best = np.argmin((above_u + slack) / above_p)
    return float(above_u[best] / above_p[best])


def estimate_prior(flags: np.ndarray, texts: pa.Array, train: Callable, score: Callable) -> float:
    """The class prior by ``share_of_positives``, within ``PRIORS``.  Each of ``PARTS`` parts of the texts (equal texts
    share a part) is scored by ``train(flags, texts, None)`` of the others.  A sample too small to have P and U in all parts
    scores itself; without P the least prior holds, without U the middle."""
    if not (flags == 1).any():
        return PRIORS[0]
    if not (flags == 0).any():
        return 0.5
    part = np.array([zlib.crc32(t.encode()) % PARTS for t in texts.to_pylist()])
    if not all((flags[part == k] == y).any() for k in range(PARTS) for y in (0, 1)):
        scores = score(train(flags, texts, None), texts)
    else:
        scores = np.zeros(len(flags))
        for k in range(PARTS):
            seen, left = pa.array(part != k), pa.array(part == k)
            scores[part == k] = score(train(flags[part != k], texts.filter(seen), None), texts.filter(left))
    return float(np.clip(share_of_positives(scores[flags == 1], scores[flags == 0]), *PRIORS))


def fold(id_col: Column, parts: int) -> Column:
    """crc32 of the id as text, by which rows are held out; null for a null id."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(parts))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, parts: int,
                    positives: int, unlabelled: int) -> DataFrame:
    """(id, flag, text) rows (flag 1: positive, 0: unlabelled) of a bounded sample off the held-out fold.

    Positives are documents all of whose labels are 1; the unlabelled are documents drawn without
    regard to labels; of rows that repeat an id the one with the least text is taken.  Ids are drawn by
    hash, and they alone are broadcast, at most ``positives + unlabelled`` of them.
    """
    learn = F.coalesce(fold(F.col("id"), parts) != 0, F.lit(False))
    marked = (labels.select(F.col(id_col).alias("id"), F.col(label).alias("y")).where(learn & F.col("y").isNotNull())
              .groupBy("id").agg(F.min("y").alias("y")))
    usable = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(learn & F.col("text").isNotNull())
    draw = lambda df, n: df.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(n)
    short = usable.where(F.octet_length("text") <= TRAIN_BYTES).select("id")
    chosen = draw(marked.where("y = 1"), positives).select("id", F.lit(1).alias("flag")).unionAll(
        draw(short, unlabelled).select("id", F.lit(0).alias("flag")))
    # one row an id: rows that repeat it, however many, add nothing
    return (usable.where(F.octet_length("text") <= TRAIN_BYTES).join(F.broadcast(chosen), "id")
            .groupBy("id", "flag").agg(F.min("text").alias("text")))


def fit_in_task(sample: DataFrame, train: Callable[[list, pa.Array], object]):
    """Run ``train(flags, texts)`` over a bounded sample in one task, in the order of ids; returns its model."""
    python_ready(sample.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if batches:
            rows = pa.Table.from_batches(batches).sort_by([("id", "ascending"), ("flag", "ascending")])
            model = train(rows.column("flag").to_pylist(), rows.column("text").combine_chunks())
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    found = sample.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else train([], pa.array([], pa.string()))


def with_score(docs: DataFrame, text_col: str, score: Callable[[pa.Array], list[pa.Array]],
               fields: list[T.StructField], keep: list[str], keep_text: bool) -> DataFrame:
    """``keep`` of every row, the text if ``keep_text``, and the columns ``fields`` that ``score`` makes of
    the whole text.  The kept columns travel as one struct, so that no name can clash."""
    python_ready(docs.sparkSession)
    rows = docs.select(F.struct(*[F.col(c) for c in keep], F.lit(0).alias("__pad")).alias("doc"),
                       F.col(text_col).alias("text"))
    carried = ["doc", "text"] if keep_text else ["doc"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carried], *score(batch.column("text"))],
                                             names=[*carried, *[f.name for f in fields]])

    return rows.mapInArrow(run, T.StructType([*[rows.schema[c] for c in carried], *fields]))
