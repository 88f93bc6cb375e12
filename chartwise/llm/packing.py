"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become token sequences; only those longer than the capacity are cut.  Pieces that fill a
sequence stand alone.  The others are dealt evenly into blocks of about ``BLOCK`` pieces, and each
block evolves on several islands: an individual is a set of bins; crossover injects whole well-filled bins
of one parent into the other, removes the bins that hold duplicates, and best-fits the documents
displaced by that, longest first.  Between epochs each island's elite migrates to the next one.  Evolution ends
early at the block's lower bound.  The best individual's bins that are not well filled are opened, the least filled
first and up to half of the block's pieces, and dealt into half as many blocks or fewer, level by level, until one block is
left, so that blocks cost little space; the bins that stay closed are the better filled ones.

Scale: a piece is a few numbers; token ids never leave the task that made them unless asked for.  A block holds about
``BLOCK`` pieces at every level, whatever their lengths (even where none can be filled), so each task is bounded; blocks are dealt by a hash of the row's own number, so no document, source
or length is hot.

Defined results: null and empty texts are one end token; repeated rows are packed as documents of their own;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import python_ready, stored
from .tokens import public_path, word_tokens

CAPACITY, END_ID = 2048, 0
BLOCK, ISLANDS, EPOCHS, GENERATIONS, POPULATION, ELITE = 4096, 2, 2, 6, 4, 2
WELL_FILLED = 0.98


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                 vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """Rows (id, piece, start, length, ids_crc32[, ids]) of at most ``capacity`` tokens."""
    python_ready(docs.sparkSession)
    path = vocabulary or public_path()
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    end = END_ID.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_tokens(path).encode
        for batch in batches:
            row, piece, length, crc, ids = [], [], [], [], []
            for r, text in enumerate(batch.column("text").to_pylist()):
                raw = (encode(text) if text else b"") + end
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at:at + 4 * capacity]
                    row.append(r)
                    piece.append(k)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
            columns = [batch.column("id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                       pa.array([k * capacity for k in piece], pa.int64()), pa.array(length, pa.int64()),
                       pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(ids, pa.binary())] if with_ids else []),
                                             names=[f.name for f in schema])

    schema = T.StructType([
        T.StructField(id_col, narrow.schema["id"].dataType), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType())])
    if with_ids:
        schema = schema.add("ids", T.BinaryType())
    return narrow.mapInArrow(run, schema)


class Bins:
    """Bins of one block: the items of each and its room."""

    def __init__(self, size: np.ndarray, capacity: int):
        self.size, self.capacity = size, capacity
        self.items: list[list[int]] = []
        self.room: list[int] = []

    def insert(self, order) -> Bins:
        """Best fit: each item goes where the least room is left, else into a new bin."""
        size = self.size
        rooms = sorted((r, b) for b, r in enumerate(self.room))
        for i in order:
            s = int(size[i])
            at = bisect_left(rooms, (s, -1))
            if at < len(rooms):
                room, b = rooms.pop(at)
                self.items[b].append(i)
            else:
                room, b = self.capacity, len(self.items)
                self.items.append([i])
                self.room.append(0)
            self.room[b] = room - s
            if room > s:
                insort(rooms, (room - s, b))
        return self

    def take(self, items: list[int], room: int) -> None:
        self.items.append(items)
        self.room.append(room)

    def merit(self) -> float:
        """Mean squared fill: few bins, and full ones rather than even ones."""
        fill = 1 - np.array(self.room) / self.capacity
        return float((fill * fill).mean()) if len(fill) else 1.0

    def labels(self) -> np.ndarray:
        out = np.zeros(len(self.size), np.int32)
        for b, items in enumerate(self.items):
            out[items] = b
        return out

    @classmethod
    def of(cls, labels: np.ndarray, size: np.ndarray, capacity: int) -> Bins:
        out = cls(size, capacity)
        order = np.argsort(labels, kind="stable")
        cuts = np.flatnonzero(np.diff(labels[order])) + 1
        for items in np.split(order, cuts):
            out.take(items.tolist(), capacity - int(size[items].sum()))
        return out


def crossover(a: Bins, b: Bins, rng: np.random.Generator) -> Bins:
    """Whole well-filled bins of ``b`` go into ``a``; what they displace is best-fitted again."""
    child = Bins(a.size, a.capacity)
    full = np.argsort(b.room, kind="stable")
    full = full[:max(1, int(len(full) * rng.uniform(0.2, 0.7)))]
    held = np.zeros(len(a.size), bool)
    for k in full[rng.random(len(full)) < 0.7]:
        child.take(list(b.items[k]), b.room[k])
        held[b.items[k]] = True
    displaced: list[int] = []
    open_from = rng.uniform(0.01, 0.1) * a.capacity        # bins with more room than this are dealt anew too
    for items, room in zip(a.items, a.room):
        twice = held[items]
        if not twice.any() and room <= open_from:
            child.take(list(items), room)
        else:
            displaced += [i for i, h in zip(items, twice) if not h]
    displaced.sort(key=lambda i: -int(a.size[i]))
    return child.insert(displaced)


def evolve(size: np.ndarray, capacity: int, rng: np.random.Generator, elite: list[Bins],
           generations: int = GENERATIONS, population: int = POPULATION) -> list[Bins]:
    """The best individuals after ``generations``, best first; ends at the lower bound."""
    least = -(-int(size.sum()) // capacity)
    order = np.argsort(-size, kind="stable")
    pool = list(elite) or [Bins(size, capacity).insert(order.tolist())]
    rank = lambda p: (len(p.items), -p.merit())
    if min(len(p.items) for p in pool) > least:
        while len(pool) < population:
            noisy = np.argsort(-size * rng.uniform(0.7, 1.0, len(size)), kind="stable")
            pool.append(Bins(size, capacity).insert(noisy.tolist()))
        for _ in range(generations):
            pool.sort(key=rank)
            if len(pool[0].items) <= least:
                break
            first, second = rng.integers(0, max(1, len(pool) // 2)), rng.integers(0, len(pool))
            pool[-1] = crossover(pool[first], pool[second], rng)
    return sorted(pool, key=rank)[:ELITE]


_ISLAND = "block bigint, island int, n_bins bigint, merit double, pids binary, sizes binary, elite array<binary>"


def _island_row(block, island, pids, size, best: list[Bins]) -> pd.DataFrame:
    return pd.DataFrame({
        "block": [block], "island": [island], "n_bins": [len(best[0].items)], "merit": [best[0].merit()],
        "pids": [pids.tobytes()], "sizes": [size.tobytes()], "elite": [[p.labels().tobytes() for p in best]]})


def _pack_blocks(items: DataFrame, blocks: int, capacity: int, level: int) -> DataFrame:
    """(pid, length, sequence_id, offset, spare) of ``items`` (pid, length) dealt into ``blocks``; ``spare`` pieces, at most half
    of a block's, lie in its least filled bins."""
    dealt = items.select(
        F.pmod(F.xxhash64("pid", F.lit(level)), F.lit(blocks)).alias("block"), "pid", "length",
        F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island"))

    def settle(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pid")
        pids, size = rows.pid.to_numpy(np.int64), rows.length.to_numpy(np.int64)
        rng = np.random.default_rng([level, int(key[0]), int(key[1])])
        return _island_row(key[0], key[1], pids, size, evolve(size, capacity, rng, []))

    def visit(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        """The island's own elite and that of its neighbour evolve together."""
        pids, size = np.frombuffer(rows.pids.iloc[0], np.int64), np.frombuffer(rows.sizes.iloc[0], np.int64)
        elite = [Bins.of(np.frombuffer(e, np.int32), size, capacity)
                 for r in rows.sort_values("home").elite for e in r]
        rng = np.random.default_rng([level, int(key[0]), int(key[1]), 1])
        return _island_row(key[0], key[1], pids, size, evolve(size, capacity, rng, elite))

    islands = dealt.groupBy("block", "island").applyInPandas(settle, _ISLAND)
    for _ in range(EPOCHS - 1):
        islands = stored(islands, "packing-islands")
        moved = islands.withColumn("home", F.lit(0)).unionByName(
            islands.withColumn("home", F.lit(1)).withColumn("island", F.pmod(F.col("island") + 1, F.lit(ISLANDS))))
        islands = moved.groupBy("block", "island").applyInPandas(visit, _ISLAND)
    best = islands.groupBy("block").agg(F.min_by(
        F.struct("pids", "sizes", F.col("elite")[0].alias("bins")),
        F.struct("n_bins", -F.col("merit"), "island")).alias("b")).select("block", "b.*")

    def lay_out(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                pids, size = np.frombuffer(row.pids, np.int64), np.frombuffer(row.sizes, np.int64)
                bins = np.frombuffer(row.bins, np.int32)
                order = np.argsort(bins, kind="stable")
                b, s = bins[order], size[order]
                end = np.cumsum(s)
                first = np.searchsorted(b, b, side="left")
                offset = end - s - (end - s)[first]
                fill = np.bincount(b, weights=s)
                poor = np.argsort(fill, kind="stable")
                poor = poor[(np.cumsum(np.bincount(b)[poor]) <= len(b) // 2) & (fill[poor] < WELL_FILLED * capacity)]
                spare = np.zeros(len(fill), bool)
                spare[poor] = True
                yield pd.DataFrame({"pid": pids[order], "length": s, "offset": offset, "spare": spare[b],
                                    "sequence_id": (level << 56) + row.block * (1 << 20) + b.astype(np.int64)})

    return best.mapInPandas(lay_out, "pid bigint, length bigint, offset bigint, spare boolean, sequence_id bigint")


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """``pieces`` with sequence_id and offset."""
    python_ready(pieces.sparkSession)
    pieces = stored(pieces.withColumn("pid", F.monotonically_increasing_id()), "packing-pieces")
    alone = pieces.where(F.col("length") >= capacity).select(
        "pid", (F.lit(63 << 56) + F.col("pid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    placed = [alone]
    items = pieces.where(F.col("length") < capacity).select("pid", "length")
    level = 0
    while True:
        n = items.count()
        if not n:
            break
        # at most half of the pieces are left at each level: ends at one block
        blocks = -(-n // block)
        packed = stored(_pack_blocks(items, blocks, capacity, level), f"packing-level{level}")
        done = packed if blocks == 1 else packed.where(~F.col("spare"))
        placed.append(done.select("pid", "sequence_id", "offset"))
        if blocks == 1:
            break
        items = packed.where("spare").select("pid", "length")
        level += 1
    where = placed[0]
    for p in placed[1:]:
        where = where.unionByName(p)
    return pieces.join(where, "pid").drop("pid")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         vocabulary: str | None = None) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack_pieces(token_pieces(docs, id_col, text_col, capacity, vocabulary), capacity).select(
        id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
