"""Substring dedup over words: windows that occur again, found behind a count-min sketch.

A window is ``WINDOW`` consecutive words of one document.  Every word in a window whose sequence
also starts elsewhere goes.  Two passes read the documents.

First pass, the sketch.  The windows' counts are overestimated by a count-min sketch.  A window is counted through its
anchor, the part of ``PART`` words with the least hash in it (the leftmost of equals), so that the consecutive windows
that share an anchor share one increment: equal windows have equal anchors, so the anchor's count is never below the window's.  Each
task makes a sparse sketch of its rows (cells and counts that stop at two); the sketches are merged block by
block; what is broadcast is one bit a cell: at least two, or not.  It has about five cells for each expected anchor, and at most
``MOST_CELLS`` (128 MB of bits).  Beyond that it lets more windows pass, and never drops one.

Second pass, the exact groups.  Windows whose anchor the sketch gives two or more in both rows are grouped exactly, in two steps.  The
stretch of consecutive windows that share an anchor is taken as a whole: equal stretches are one class, and a
class of two or more is settled, however large it is (narrow partial aggregates).  Classes that share an anchor with another class go on: each class, not each copy,
gives its windows, and they are counted by (anchor, window).  Words are compared by 64-bit hashes, of the anchor and of the
window or stretch together, so by 128 bits.

Defined results: a null text has no words; an empty one neither; rows that repeat an id are documents of their own, as are rows without one, so their equal
windows count; documents with fewer than ``WINDOW`` words are whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import hash_spans, mix, python_ready, row_steps, stored, text_bytes

WINDOW, PART = 35, 8
#: cells of a block and of the largest sketch; cells a byte of text (words of six bytes, and an anchor for every 14 of them, get five cells an anchor)
BLOCK, MOST_CELLS, CELLS_A_BYTE = 1 << 20, 1 << 30, 0.06
#: pending increments of a task's sketch before they are sent on
PENDING = 1 << 20

_INCREMENT = "block int, once binary, twice binary"
_RUN = "anchor long, stretch long, id {id}, doc long, start int, n int, windows binary"

_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_SHRINK = np.uint64(pow(int(_SPREAD), -1, 1 << 64))


def _words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the first word of each row (one more at the end)."""
    gap = np.ones(len(data) + 2, bool)
    gap[1:-1] = (data == 0x20) | ((data >= 9) & (data <= 13))
    edge = gap[1:] != gap[:-1]
    inside = ~gap[1:-1]
    start = inside & edge[:-1]
    stop = np.append(edge[1:] & inside, False)[:len(data)]
    cut = bounds[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    start[cut] = inside[cut]
    stop[cut - 1] = inside[cut - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def _powers(of: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([[np.uint64(1)], np.full(n, of, np.uint64).cumprod(dtype=np.uint64)])


def _sequences(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each ``size`` consecutive words, by doubling."""
    out, length = None, 0
    part, n, power = words, 1, _SPREAD
    with np.errstate(over="ignore"):
        while True:
            if size & n:
                if out is None:
                    out, length = part, n
                else:
                    m = min(len(out), len(part) - length)
                    out, length = out[:m] * power + part[length:length + m], length + n
            if 2 * n > size:
                return mix(out)
            part, n, power = part[:len(part) - n] * power + part[n:], 2 * n, power * power


def _leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of each ``width`` consecutive values, the leftmost of equals."""
    at, n = np.arange(len(values)), 1

    def better(a, b):
        return np.where(values[a] <= values[b], a, b)
    while 2 * n <= width:
        at, n = better(at[:len(at) - n], at[n:]), 2 * n
    return better(at[:len(at) - (width - n)], at[width - n:]) if width > n else at


class Stretches:
    """The stretches of a step of documents: consecutive windows of one row with one anchor."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        starts, ends, first = _words(data, bounds)
        empty = np.zeros(0, np.int64)
        self.row, self.start, self.n, self.anchor = empty, empty, empty, empty.view(np.uint64)
        self.n_words = np.diff(first)
        if len(starts) < WINDOW or self.n_words.max(initial=0) < WINDOW:
            return
        self.words = hash_spans(data, starts, ends)
        parts = _sequences(self.words, PART)
        anchor = _leftmost_least(parts, WINDOW - PART + 1)
        row = np.searchsorted(first, np.arange(len(anchor)), side="right") - 1
        whole = np.flatnonzero(np.arange(len(anchor)) + WINDOW <= first[row + 1])
        if not len(whole):
            return
        # a new stretch where the row, the anchor or the run of windows changes
        new = np.ones(len(whole), bool)
        new[1:] = (np.diff(whole) != 1) | (np.diff(row[whole]) != 0) | (np.diff(anchor[whole]) != 0)
        at = np.flatnonzero(new)
        self.n = np.diff(np.append(at, len(whole)))
        self.at = whole[at]                                     # first window, as a place among all words
        self.row = row[self.at]
        self.start = self.at - first[self.row]
        self.anchor = parts[anchor[self.at]]

    def hashes(self, some: np.ndarray) -> np.ndarray:
        """Hash of all words of each of the stretches ``some``."""
        with np.errstate(over="ignore"):
            power = _powers(_SPREAD, len(self.words))
            sums = np.concatenate([[np.uint64(0)], np.cumsum(self.words * power[:-1], dtype=np.uint64)])
            lo = self.at[some]
            hi = lo + self.n[some] + WINDOW - 1
            # back to the power of a first word, so that the place does not matter
            return mix((sums[hi] - sums[lo]) * _powers(_SHRINK, len(self.words))[lo]) + self.n[some].astype(np.uint64) * _ODD

    def windows(self, some: np.ndarray) -> list[bytes]:
        """The hashes of the windows of each stretch, eight bytes each."""
        if not len(some):
            return []
        all_windows = _sequences(self.words, WINDOW)
        return [all_windows[a:a + n].tobytes() for a, n in zip(self.at[some].tolist(), self.n[some].tolist())]


def _cells(anchor: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each anchor in the sketch's two rows; ``cells`` is a power of two, half of it for each row."""
    half = np.uint64(cells // 2 - 1)
    return (anchor & half).astype(np.int64), (mix(anchor ^ _ODD) & half).astype(np.int64) + cells // 2


def _partial_sketch(cells: int):
    def out(pending: list) -> Iterator[pa.RecordBatch]:
        cell, n = np.unique(np.concatenate(pending), return_counts=True)
        block = cell // BLOCK
        cuts = np.flatnonzero(np.diff(block)) + 1
        for places, count in zip(np.split(cell, cuts), np.split(n, cuts)):
            inner = (places % BLOCK).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(places[0]) // BLOCK], pa.int32()), pa.array([inner[count == 1].tobytes()], pa.binary()),
                 pa.array([inner[count > 1].tobytes()], pa.binary())], names=["block", "once", "twice"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, size = [], 0
        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            for a, b in row_steps(bounds):
                anchors = Stretches(data[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a]).anchor
                pending.extend(_cells(anchors, cells))
                size += 2 * len(anchors)
                if size > PENDING:
                    yield from out(pending)
                    pending, size = [], 0
        if size:
            yield from out(pending)
    return run


def _merge_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the partial sketches of a task's blocks (counts stop at two); a bit for each cell with two."""
    blocks: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, once, twice in zip(*(batch.column(c).to_pylist() for c in ("block", "once", "twice"))):
            count = blocks.setdefault(block, np.zeros(BLOCK, np.uint8))
            for add, places in ((1, once), (2, twice)):
                places = np.frombuffer(places, np.int32)       # no cell twice in one partial sketch
                count[places] = np.minimum(count[places] + add, 2)
    for block, count in blocks.items():
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([np.packbits(count > 1).tobytes()], pa.binary())],
                                         names=["block", "bits"])


def sketch_cells(n_bytes: int) -> int:
    """Cells for ``n_bytes`` of text: a power of two between two blocks and ``MOST_CELLS``."""
    cells = 2 * BLOCK
    while cells < min(n_bytes * CELLS_A_BYTE, MOST_CELLS):
        cells *= 2
    return cells


def repeated_cells(docs: DataFrame, text_col: str = "text", cells: int | None = None) -> np.ndarray:
    """One bit for each cell of the merged sketch: its count is two or more.  At most ``MOST_CELLS`` bits come to the driver."""
    python_ready(docs.sparkSession)
    texts = docs.select(F.col(text_col).alias("text")).where(F.octet_length("text") >= 2 * WINDOW - 1)
    if cells is None:
        cells = sketch_cells(docs.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0)
    partial = texts.mapInArrow(_partial_sketch(cells), _INCREMENT)
    merged = partial.repartition("block").mapInArrow(_merge_sketches, "block int, bits binary")
    bits = np.zeros(cells // 8, np.uint8)
    for r in merged.collect():
        bits[r["block"] * (BLOCK // 8):(r["block"] + 1) * (BLOCK // 8)] = np.frombuffer(r["bits"], np.uint8)
    return bits


def _maybe_repeated(anchor: np.ndarray, bits: np.ndarray) -> np.ndarray:
    out = np.ones(len(anchor), bool)
    for cell in _cells(anchor, 8 * len(bits)):
        out &= (bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1).astype(bool)
    return out


def _stretch_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        sent: set = set()                                       # classes whose windows this task has sent
        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            for a, b in row_steps(bounds):
                s = Stretches(data[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a])
                some = np.flatnonzero(_maybe_repeated(s.anchor, bits))
                if not len(some):
                    continue
                stretch = s.hashes(some).view(np.int64)
                windows = s.windows(some)
                for k, key in enumerate(zip(s.anchor[some].tolist(), stretch.tolist())):
                    if key in sent:
                        windows[k] = None
                    else:
                        sent.add(key)
                if len(sent) > PENDING:
                    sent.clear()
                at = pa.array(s.row[some] + a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.anchor[some].view(np.int64)), pa.array(stretch), batch.column("id").take(at), batch.column("doc").take(at),
                     pa.array(s.start[some], pa.int32()), pa.array(s.n[some], pa.int32()), pa.array(windows, pa.binary())],
                    names=["anchor", "stretch", "id", "doc", "start", "n", "windows"])
    return run


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, window, stretch, place) for each window of a class."""
    for batch in batches:
        n = np.array([len(w) // 8 for w in batch.column("windows").to_pylist()], np.int64)
        if not len(n):
            continue
        of = pa.array(np.repeat(np.arange(len(n)), n))
        windows = np.frombuffer(b"".join(batch.column("windows").to_pylist()), np.int64)
        place = np.arange(len(windows)) - np.repeat(np.cumsum(n) - n, n)
        yield pa.RecordBatch.from_arrays([batch.column("anchor").take(of), pa.array(windows), batch.column("stretch").take(of),
                                          pa.array(place, pa.int32())], names=["anchor", "window", "stretch", "place"])


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cells: int | None = None) -> DataFrame:
    """(id, doc, start, n, mask): stretches of windows, of which those in ``mask`` (bit k: the window at word ``start + k``) are
    repeated; all of them where it is null.  ``doc`` is the hash of the text."""
    spark = docs.sparkSession
    python_ready(spark)
    shared = spark.sparkContext.broadcast(repeated_cells(docs, text_col, cells).tobytes())
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("doc")).where(
        F.octet_length("text") >= 2 * WINDOW - 1)
    kind = texts.schema["id"].dataType.simpleString()
    rows = stored(texts.mapInArrow(_stretch_rows(shared), _RUN.format(id=kind)), "window-stretches")
    classes = stored(rows.groupBy("anchor", "stretch").agg(F.count("*").alias("members")), "window-classes")
    # anchors with two classes or more of which one is not settled; two places of one stretch are never equal windows, as their
    # anchor lies at another distance
    mixed = classes.groupBy("anchor").agg(F.count("*").alias("classes"), F.min("members").alias("least")).where(
        "classes > 1 and least = 1").select("anchor")
    windows = stored(rows.where("windows is not null").select("anchor", "stretch", "windows").join(mixed, "anchor", "left_semi")
                     .mapInArrow(_exploded, "anchor long, window long, stretch long, place int"), "window-rows")
    again = windows.groupBy("anchor", "window").agg(F.min("stretch").alias("least"), F.max("stretch").alias("most")).where(
        "least < most").select("anchor", "window")
    masks = windows.join(again, ["anchor", "window"], "left_semi").groupBy("anchor", "stretch").agg(
        F.expr("bit_or(shiftleft(1L, place))").alias("mask"))
    # stored, so that the join with all stretches reads two shuffles and a class with very many members can be split
    settled = stored(classes.join(masks, ["anchor", "stretch"], "left").where("members > 1 or mask is not null").select(
        "anchor", "stretch", F.when(F.col("members") == 1, F.col("mask")).alias("mask")), "window-settled")
    return rows.drop("windows").join(settled, ["anchor", "stretch"]).select("id", "doc", "start", "n", "mask")


def _covered(spans, n_words: int) -> list[tuple[int, int]]:
    """Merged word ranges of the repeated windows."""
    out: list[list[int]] = []
    for start, n, mask in sorted((s["start"], s["n"], s["mask"]) for s in spans):
        places = range(n) if mask is None else [k for k in range(n) if mask >> k & 1]
        for k in places:
            lo, hi = start + k, start + k + WINDOW
            if out and lo <= out[-1][1]:
                out[-1][1] = max(out[-1][1], hi)
            else:
                out.append([lo, hi])
    return [(lo, min(hi, n_words)) for lo, hi in out]


def _cut(with_kept: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, removed, sha, texts = [], [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                words = (text or "").encode().split()           # at 0x20 and 0x09-0x0D
                kept, at = [], 0
                for lo, hi in _covered(spans or [], len(words)):
                    kept += words[at:lo]
                    at = hi
                kept += words[at:]
                left = b" ".join(kept)
                n.append(len(words))
                removed.append(len(words) - len(kept))
                sha.append(hashlib.sha256(left).hexdigest())
                texts.append(left)
            columns = [batch.column("id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())]
            names = ["id", "n_words", "n_removed", "kept_sha256"]
            if with_kept:
                columns, names = [*columns, pa.array(texts, pa.binary()).cast(pa.string())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


def cut_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = False,
                         cells: int | None = None) -> DataFrame:
    """Per row: id, n_words, n_removed, kept_sha256 and, if asked for, the ``kept`` words joined by one space."""
    spans = repeated_windows(docs, id_col, text_col, cells).groupBy("id", "doc").agg(
        F.collect_set(F.struct("start", "n", "mask")).alias("spans"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("doc"))
    spans = spans.select(F.col("id").alias("span_id"), F.col("doc").alias("span_doc"), "spans")
    rows = texts.join(spans, F.col("id").eqNullSafe(F.col("span_id")) & (F.col("doc") == F.col("span_doc")), "left")
    schema = T.StructType([T.StructField("id", texts.schema["id"].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())])
    if with_kept:
        schema = schema.add("kept", T.StringType())
    return rows.select("id", "text", "spans").mapInArrow(_cut(with_kept), schema).withColumnRenamed("id", id_col)
