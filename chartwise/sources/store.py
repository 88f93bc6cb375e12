"""Materialise derived base tables once, laid out for predicate pushdown.

Derived inputs are written as parquet under the shared
folder named by ``spark.checkpoint.dir`` and read back, so every concept
scans a stored table instead of shuffling for it.  EAV tables are not written: their
narrow source is, and they unfold from its scan.  It is range partitioned and sorted by
entity and time (:func:`clustered`), so the items of one entity and time share a
file and a scan task, and a busy entity is split by time.  The location is keyed
by the source files' identity and the code that derives the tables.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

LAYOUT_VERSION = "4"
_LOCK = threading.Lock()
_READS: dict = {}
_WRITING: dict = {}


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p)


def source_key(spark: SparkSession, sf_dir: str, files: Sequence[str]) -> str:
    """Identity of the inputs: path, total length and latest modification time
    of each input (file or directory), read through the Hadoop FileSystem API so
    local, HDFS and object-store paths behave alike."""
    h = hashlib.sha1(LAYOUT_VERSION.encode())
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    for f in files:
        path = f"{sf_dir.rstrip('/')}/{f}"
        h.update(path.encode())
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            summary = fs.getContentSummary(p)
            h.update(f"{summary.getLength()}:{fs.getFileStatus(p).getModificationTime()}".encode())
    return h.hexdigest()[:16]


def partitions_for(spark: SparkSession, sf_dir: str, files: Sequence[str], bytes_each: int = 128 << 20) -> int | None:
    """Range partitions for data derived from ``files``; None where the session's own number is enough
    (AQE joins small partitions but cannot add any)."""
    conf, jvm, size = spark._jsc.hadoopConfiguration(), spark._jvm, 0
    for f in files:
        p = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{f}")
        size += p.getFileSystem(conf).getContentSummary(p).getLength()
    n = -(-size // bytes_each)
    return n if n > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def clustered(df: DataFrame, by: Sequence[str], rows_each: int) -> DataFrame:
    """``df`` range partitioned and sorted by ``by``, with ``rows_each`` rows a partition: their number follows the rows, which
    are counted (bytes say little of rows, and AQE would join partitions by the bytes that they have before they are unfolded)."""
    partitions = max(1, -(-df.count() // rows_each))
    return df.repartitionByRange(partitions, *by).sortWithinPartitions(*by)


def _code_version() -> str:
    """Hash of the modules that define the stored tables: new code never reads old tables."""
    here = Path(__file__).parent
    h = hashlib.sha1()
    for name in ("adapters.py", "fixture_spec.py", "store.py"):
        h.update((here / name).read_bytes())
    return h.hexdigest()[:8]


def _publish(spark: SparkSession, written: str, path: str) -> None:
    """Rename a finished table into place; one that another application published first stays."""
    jvm = spark._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(written), jvm.org.apache.hadoop.fs.Path(path)
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target) and fs.rename(source, target):
        return
    fs.delete(source, True)
    if not fs.exists(target):
        raise OSError(f"cannot publish {path}")


def mark(path: str, run: str) -> str:
    """The empty file, hidden from readers, that says a table is complete and of the run ``run``."""
    return f"{path}/_run-{run}"


def replace(df: DataFrame, path: str, run: str | None = None) -> None:
    """Write ``df`` under a hidden name beside ``path`` and rename it there when complete, over what was there before."""
    spark = df.sparkSession
    folder, name = path.rsplit("/", 1)
    written = f"{folder}/_{name}-{uuid.uuid4().hex}"
    df.write.parquet(written)
    jvm = spark._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(written), jvm.org.apache.hadoop.fs.Path(path)
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if run:
        fs.create(jvm.org.apache.hadoop.fs.Path(mark(written, run))).close()
    fs.delete(target, True)
    if not fs.rename(source, target):
        raise OSError(f"cannot publish {path}")


def stored(spark: SparkSession, key: str, name: str, build: Callable[[], DataFrame],
           cluster_by: Sequence[str] = (), sort_by: Sequence[str] = (), partitions: int | None = None,
           store_path: str | None = None) -> DataFrame:
    """Return ``build()`` as a stored parquet table, written on first use and shared by later applications.

    ``store_path`` (default: the shared folder) holds a folder per input identity and code version; it is
    kept until someone deletes it.  Without ``partitions`` their number follows the data: AQE joins
    the shuffle's partitions to its advisory size.  A table is written under a name of its own (hidden from readers)
    and renamed when complete.
    """
    root = (store_path or ensure_checkpoint_dir(spark)).rstrip("/")
    folder = f"{root}/chartwise-store/{key}-{_code_version()}"
    path = f"{folder}/{name}"
    cache_key = (spark.sparkContext.applicationId, path)
    with _LOCK:
        known = _READS.get(cache_key)
        writing = _WRITING.setdefault(cache_key, threading.Lock())
    if known is not None:
        return known
    with writing:                   # one writer per table; other tables go on
        if not exists(spark, f"{path}/_SUCCESS"):
            df = build()
            if cluster_by:
                df = df.repartitionByRange(*([partitions] if partitions else []), *cluster_by)
            if sort_by:
                df = df.sortWithinPartitions(*sort_by)
            written = f"{folder}/_{name}-{uuid.uuid4().hex}"
            df.write.parquet(written)
            _publish(spark, written, path)
        # stored tables are immutable once written: reuse the scan (no re-listing
        # or footer reads per query)
        _READS[cache_key] = spark.read.parquet(path)
    return _READS[cache_key]
