"""Language identification with error-correcting output codes.

Each language has a codeword; one binary classifier a bit, over frequencies of hashed letter n-grams,
predicts it.  Decoding weighs each bit's loss by the bit's reliability on the training sample and
picks the codeword with the least loss; a lead below ``AMBIGUOUS`` is flagged.  The
sample is bounded (``SAMPLE`` documents, dealt evenly to languages); prediction is one narrow map over whole texts.

Defined results: null texts and texts without a letter are ``und`` with score 0; so is all when nothing
could be learned; rows without a language are predicted, not learned from; repeated rows get equal
results; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import row_steps, text_bytes
from .pu import TRAIN_BYTES, fit_in_task, fold, sigmoid, with_score

SAMPLE, FOLDS, HELD_OUT, AMBIGUOUS = 3000, 4, 2, 0.2
BITS = 12
_LOW = np.full(256, 0x20, np.uint8)
_LOW[0x61:0x7B] = np.arange(0x61, 0x7B)
_LOW[0x41:0x5B] = np.arange(0x61, 0x7B)
_LOW[0x80:] = np.arange(0x80, 0x100)


def features(texts: pa.Array):
    """(first, last, square roots of the frequencies of hashed two- and three-byte grams)."""
    data, bounds = text_bytes(texts)
    dims = 1 << BITS
    for first, last in row_steps(bounds):
        n = last - first
        b = bounds[first:last + 1] - bounds[first]
        low = _LOW[data[bounds[first]:bounds[last]]].astype(np.uint32)
        row = np.repeat(np.arange(n), np.diff(b))
        out = np.zeros(n * dims, np.int64)
        for size in (2, 3):
            m = len(low) - size + 1
            if m < 1:
                continue
            gram = low[:m]
            for k in range(1, size):
                gram = (gram << np.uint32(8)) | low[k:m + k]
            bucket = ((gram + np.uint32(size)) * np.uint32(2654435761)) >> np.uint32(32 - BITS)
            whole = row[:m] == row[size - 1:]
            out += np.bincount((row[:m] * dims + bucket)[whole], minlength=n * dims)
        counts = out.reshape(n, dims)
        yield first, last, np.sqrt(counts / np.maximum(counts.sum(axis=1), 1)[:, None])


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n rows of +1 / -1: all distinct splits while there are few, else the best of random codes."""
    if n <= 6:
        splits = [[1 if (s >> i) & 1 else -1 for i in range(n)] for s in range(1, 1 << (n - 1))]
        return np.array(splits, int).reshape(-1, n).T
    rng, width = np.random.default_rng(seed), 12 * int(np.ceil(np.log2(n)))
    best, code = -1, None
    for _ in range(100):
        c = rng.choice([-1, 1], (n, width))
        apart = ((width - c @ c.T) // 2 + width * np.eye(n, dtype=int)).min()
        if apart > best and (np.abs(c.sum(axis=0)) < n).all():
            best, code = apart, c
    return code


def train(flags: list[str], texts: pa.Array, steps: int = 150, rate: float = 0.3) -> dict:
    names = sorted(set(flags))
    if not names:
        return {"names": [], "code": np.zeros((0, 0)), "w": np.zeros((1 << BITS, 0)), "b": np.zeros(0), "trust": np.zeros(0)}
    code = codewords(len(names))
    x = np.vstack([m.astype(np.float32) for _, _, m in features(texts)])
    y = code[np.searchsorted(names, flags)]
    share = np.array([flags.count(v) for v in names], float)
    weight = (1.0 / share)[np.searchsorted(names, flags)]
    weight = (weight / weight.sum()).astype(np.float32)
    w, b = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1])
    m, v = np.zeros((len(w) + 1, len(b))), np.zeros((len(w) + 1, len(b)))
    for t in range(1, steps + 1):
        slope = (-y * sigmoid(-y * (x @ w + b)) * weight[:, None]).astype(np.float32)
        g = np.vstack([x.T @ slope + 1e-6 * w, slope.sum(axis=0)])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1].astype(np.float32), b - step[-1]
    right = ((x @ w + b) * y > 0).mean(axis=0) if code.shape[1] else np.zeros(0)
    return {"names": names, "code": code, "w": w, "b": b, "trust": np.log((right + 0.01) / (1.01 - right))}


def decode(model: dict, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the language, its share of the weighted likelihood, and its lead over the next."""
    margin = m @ model["w"] + model["b"]
    loss = np.logaddexp(0, -margin[:, None, :] * model["code"][None]) @ model["trust"]
    loss -= loss.min(axis=1, keepdims=True)
    p = np.exp(-loss)
    p /= p.sum(axis=1, keepdims=True)
    best = loss.argmin(axis=1)
    top = np.sort(p, axis=1)
    lead = top[:, -1] - top[:, -2] if p.shape[1] > 1 else np.ones(len(p))
    return best, top[:, -1], lead


def predict(model: dict, texts: pa.Array) -> list[pa.Array]:
    names, scores, doubt = [], [], []
    data, bounds = text_bytes(texts)
    for first, last, m in features(texts):
        part = data[bounds[first]:bounds[last]]
        ascii_letter = np.zeros(last - first, bool)
        letter = (part < 0x80) & (_LOW[part] != 0x20)
        ascii_letter[np.searchsorted(bounds[first:last + 1] - bounds[first], np.flatnonzero(letter), side="right") - 1] = True
        best, p, lead = decode(model, m) if model["names"] else (None,) * 3
        for r in range(last - first):
            known = bool(model["names"]) and (
                ascii_letter[r] or any(c.isalpha() for c in texts[first + r].as_py() or ""))
            names.append(model["names"][best[r]] if known else "und")
            scores.append(float(p[r]) if known else 0.0)
            doubt.append(bool(not known or lead[r] < AMBIGUOUS))
    return [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(doubt, pa.bool_())]


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             folds: int = FOLDS, held_out: int = HELD_OUT, sample: int = SAMPLE) -> DataFrame:
    """Per row: id, held_out, lang_pred, score, ambiguous."""
    spark = docs.sparkSession
    usable = (docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("flag"), F.col(text_col).alias("text"))
              .where(F.coalesce(fold(F.col("id"), folds) != held_out, F.lit(False)) & F.col("flag").isNotNull()
                     & F.col("text").isNotNull() & (F.octet_length("text") <= TRAIN_BYTES)))
    counts = usable.groupBy("flag").count().collect()          # one row a language
    each = max(1, sample // max(1, len(counts)))
    if counts:
        # documents whose hash falls below the language's share; the bound holds by the final limit, in the order of the hash
        share = F.create_map(*[x for r in counts for x in (F.lit(r["flag"]), F.lit(each / r["count"]))])
        drawn = usable.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share[F.col("flag")] * (1 << 20))
        usable = drawn.select("id", "flag", "text").orderBy(F.xxhash64("id"), "id", F.xxhash64("text"), "flag").limit(2 * sample)
    model = spark.sparkContext.broadcast(fit_in_task(usable, train))
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
              T.StructField("ambiguous", T.BooleanType())]
    scored = with_score(docs, text_col, lambda t: predict(model.value, t), fields, [id_col], False)
    return scored.select(
        F.col("doc")[id_col].alias(id_col),
        F.coalesce(fold(F.col("doc")[id_col], folds) == held_out, F.lit(False)).alias("held_out"),
        "lang_pred", "score", "ambiguous")
