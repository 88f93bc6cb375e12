"""Helpers shared by the text operators: tables, shared storage, byte views of Arrow text."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: bytes of one Arrow batch: bounds a Python worker's memory when texts are long
BATCH_BYTES = 4 << 20
#: rows and bytes of text that one vectorised step works on
STEP_ROWS, STEP_BYTES = 256, 4 << 20

def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else the session's own
    checkpoint folder, else a folder of the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_chartwise"


#: paths of the tables that ``stored`` wrote, by application
_STORED: dict[str, list[str]] = {}


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage, so that a
    lost executor costs a re-read and not a recomputation."""
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), "chartwise-llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    _STORED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def stored_for(spark: SparkSession) -> Iterator[None]:
    """Tables that ``stored`` writes inside are deleted at the end: for work whose result is written inside, too."""
    paths = _STORED.setdefault(spark.sparkContext.applicationId, [])
    first = len(paths)
    try:
        yield
    finally:
        for path in paths[first:]:
            remove(spark, path)
        del paths[first:]


_SHIPPED: set[str] = set()


def python_ready(spark: SparkSession) -> None:
    """Before work in Python on executors: ship this subpackage's code to them (once per
    application), and bound Arrow batches by bytes, which long texts would make huge."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(key, str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    here = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="chartwise-code-"), "chartwise_llm.zip")
    with zipfile.ZipFile(target, "w") as z:
        for f in [here.parent / "__init__.py", *sorted(here.glob("*.py"))]:
            z.write(f, f.relative_to(here.parent.parent))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the bounds of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]


def row_steps(bounds: np.ndarray, most: int = STEP_BYTES, rows: int = STEP_ROWS) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``rows`` whole rows of about ``most`` bytes each (a longer row stands alone)."""
    first, n = 0, len(bounds) - 1
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + most, side="right")) - 1
        last = min(max(last, first + 1), first + rows, n)
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_PERIOD = 4096
_rng = np.random.default_rng(20240611)
_BYTE_KEY = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE_KEY = _rng.integers(1, 1 << 63, _PERIOD, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def spans_of(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs where ``inside`` is true, cut at row bounds: starts, ends, row of each."""
    n = len(inside)
    if not n:
        e = np.zeros(0, np.int64)
        return e, e, e
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    cut = bounds[1:-1]
    cut = cut[cut < n]
    begin[cut] = inside[cut]
    starts = np.flatnonzero(begin)
    stop = ~inside
    end = np.zeros(n + 1, bool)
    end[1:n] = stop[1:] & inside[:-1]
    end[n] = inside[-1]
    cut = cut[cut > 0]
    end[cut] |= inside[cut - 1]
    ends = np.flatnonzero(end)
    return starts, ends, np.searchsorted(bounds, starts, side="right") - 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span (spans disjoint and ascending), in steps of bounded memory."""
    out = np.zeros(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = int(np.searchsorted(ends, starts[first] + (1 << 20), side="right"))
        last = max(last, first + 1)
        s, e = starts[first:last], ends[first:last]
        size = e - s
        at = np.concatenate([[0], np.cumsum(size)[:-1]])
        place = np.arange(int(size.sum())) - np.repeat(at, size)
        byte = data[place + np.repeat(s, size)]
        value = _BYTE_KEY[byte] * _PLACE_KEY[place % _PERIOD]
        value ^= value >> np.uint64(29)
        out[first:last] = np.add.reduceat(value, at) + size.astype(np.uint64) * _PLACE_KEY[7]
        first = last
    return mix(out)


def rows_to_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
