"""Benchmark decontamination with a generalised suffix automaton.

The words of all benchmark items form one automaton over word ids.  Document words stream through
it; the state keeps the longest suffix of what was read that occurs in an item.  Where that
length reaches ``window`` words (or the whole of a shorter item), those words are hit.  Before that, vectorised
steps drop what cannot match: a word or word pair that no item has ends every match, so only
stretches of known pairs that are as long as the shortest window are streamed.

Automata are built in tasks and broadcast as bytes.  An item longer than an eighth of a shard is cut into pieces that overlap by
all but one word of a window; pieces fill shards of at most ``shard_words`` words by measured size, whatever ids they have.  The documents
stream through one shard after the other, and the hits are united; the rows are written out in between, so
that one shard is in memory at a time.  A word takes about 0.9 kB of a worker's memory and 60 bytes of the broadcast (measured on 100,000).

Defined results: null and empty texts have no words; items without words match nothing; items
are told apart by id (repeated ids count once, a null id is the empty string); repeated rows give
repeated results; empty tables give no rows or no hits; other columns are kept or not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import hash_spans, row_steps, python_ready, spans_of, stored, text_bytes

WINDOW = 10
SHARD_WORDS = 250_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = True      # after lower-casing
_WORD[0x80:] = True


class Automaton:
    """Suffix automaton of several word sequences; a state stands for the substrings that occur at the same places."""

    def __init__(self, items: list[tuple[str, list[int]]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        # items by the state of each of their windows; a window is found by state and length
        self.owners: dict[tuple[int, int], set[str]] = {}
        for name, words in items:
            span = min(window, len(words))
            for i in range(len(words) - span + 1):
                state = 0
                for w in words[i:i + span]:
                    state = self.next[state][w]
                self.owners.setdefault((state, span), set()).add(name)
        self.windows: list[tuple[int, ...]] = [()] * len(self.size)
        for state, span in self.owners:
            self.windows[state] += (span,)
        # nearest state at or above with a window, so that a walk up costs only hits
        order = sorted(range(len(self.size)), key=self.size.__getitem__)
        self.above = [-1] * len(self.size)
        for v in order:
            up = self.link[v]
            self.above[v] = v if self.windows[v] else (self.above[up] if up >= 0 else -1)

    def _extend(self, last: int, w: int) -> int:
        known = self.next[last].get(w)
        if known is not None:
            return known if self.size[known] == self.size[last] + 1 else self._split(last, w, known)
        new = self._state(self.size[last] + 1, {}, 0)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, w, q)
        return new

    def _state(self, size: int, moves: dict[int, int], link: int) -> int:
        self.size.append(size)
        self.next.append(moves)
        self.link.append(link)
        return len(self.size) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        copy = self._state(self.size[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def stream(self, words: list[int]) -> Iterator[tuple[int, int, int]]:
        """(end, length, state) of each window that ends in ``words``."""
        state = length = 0
        for i, w in enumerate(words):
            move = self.next[state].get(w)
            while move is None and state:
                state = self.link[state]
                length = self.size[state]
                move = self.next[state].get(w)
            if move is None:
                length = 0
                continue
            state, length = move, length + 1
            at = self.above[state]
            while at > 0:
                for span in self.windows[at]:
                    if span <= length:
                        yield i + 1, span, at
                up = self.link[at]
                at = self.above[up] if up >= 0 else -1


class Matcher:
    """The automaton with the sorted hashes of its words and word pairs."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        texts = pa.array([t for _, t in items], pa.string())
        hashes, row, _, _, _ = word_hashes(*text_bytes(texts))
        self.vocabulary = np.unique(hashes)
        ids = np.searchsorted(self.vocabulary, hashes) + 1
        bounds = np.searchsorted(row, np.arange(len(items) + 1))
        lists = [(name, ids[bounds[i]:bounds[i + 1]].tolist()) for i, (name, _) in enumerate(items)]
        lists = [(name, words) for name, words in lists if words]
        self.shortest = min([window, *(len(w) for _, w in lists)]) if lists else window
        self.base = np.int64(len(self.vocabulary) + 1)
        same = row[1:] == row[:-1]
        self.pairs = np.unique((ids[:-1] * self.base + ids[1:])[same])
        self.automaton = Automaton(lists, window)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Word ids from 1; 0 for words that no item has."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)

    def stretches(self, ids: np.ndarray, row: np.ndarray) -> Iterator[tuple[int, int]]:
        """Ranges of words of one row whose words and neighbouring pairs all occur in items."""
        if not len(ids) or not len(self.vocabulary):
            return
        linked = np.zeros(len(ids), bool)          # linked to the word before
        if len(self.pairs):
            near = np.flatnonzero((ids[1:] > 0) & (ids[:-1] > 0) & (row[1:] == row[:-1]))
            pair = ids[near] * self.base + ids[near + 1]
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            linked[near[self.pairs[at] == pair] + 1] = True
        start = np.flatnonzero(~linked)
        end = np.append(start[1:], len(ids))
        keep = (end - start >= self.shortest) & (ids[start] > 0)
        yield from zip(start[keep].tolist(), end[keep].tolist())


class Packed:
    """A pickled matcher; each Python worker loads it once."""

    def __init__(self, raw: bytes):
        self.raw = raw

    def __getstate__(self):
        return {"raw": self.raw}

    def matcher(self) -> Matcher:
        if "loaded" not in self.__dict__:
            self.loaded = pickle.loads(self.raw)
        return self.loaded


def word_hashes(data: np.ndarray, bounds: np.ndarray):
    """Words of lower-cased rows: hash, row, start and end byte; and the bytes."""
    low = _LOWER[data]
    starts, ends, row = spans_of(_WORD[low], bounds)
    return hash_spans(low, starts, ends), row, starts, ends, low


def _find(text: pa.Array, before: list[list[tuple[int, int]]], matcher: Matcher):
    """Per row: words, hit words, hit byte spans (neighbouring hit words in one span), items found.
    ``before``: spans that earlier shards hit."""
    data, bounds = text_bytes(text)
    for first, last in row_steps(bounds):
        b = bounds[first:last + 1] - bounds[first]
        hashes, row, starts, ends, _ = word_hashes(data[bounds[first]:bounds[last]], b)
        ids = matcher.ids(hashes)
        change = np.zeros(len(ids) + 1, np.int64)
        items: dict[int, set[str]] = {}
        for s, e in matcher.stretches(ids, row):
            for end, span, state in matcher.automaton.stream(ids[s:e].tolist()):
                change[s + end - span] += 1
                change[s + end] -= 1
                items.setdefault(int(row[s]), set()).update(matcher.automaton.owners[(state, span)])
        hit = np.cumsum(change[:-1]) > 0
        of_row = np.searchsorted(row, np.arange(last - first + 1))
        for r in range(last - first):
            lo, hi = int(of_row[r]), int(of_row[r + 1])
            own = hit[lo:hi]
            for s, e in before[first + r]:
                own = own | ((starts[lo:hi] >= b[r] + s) & (ends[lo:hi] <= b[r] + e))
            spans: list[tuple[int, int]] = []
            if own.any():
                edge = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]])))
                spans = [(int(starts[lo + x] - b[r]), int(ends[lo + y - 1] - b[r]))
                         for x, y in zip(edge[::2], edge[1::2])]
            yield hi - lo, int(own.sum()), spans, items.get(r, set())


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    raw, kept, at = text.encode(), [], 0
    for s, e in spans:
        kept.append(raw[at:s])
        at = e
    return b"".join([*kept, raw[at:]]).decode()


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _finder(shared, cut: bool):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            before = [[(s["start"], s["end"]) for s in row] for row in batch.column("spans").to_pylist()]
            found = list(_find(text, before, shared.value.matcher()))
            items = [sorted(set(old) | f[3]) for old, f in zip(batch.column("items").to_pylist(), found)]
            if cut and any(f[2] for f in found):
                text = pa.array([_without(t, f[2]) if f[2] else t for t, f in zip(text.to_pylist(), found)], text.type)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), text, pa.array([f[0] for f in found], pa.int64()),
                 pa.array([f[1] for f in found], pa.int64()),
                 pa.array([[{"start": s, "end": e} for s, e in f[2]] for f in found], _SPANS),
                 pa.array(items, pa.list_(pa.string()))],
                names=["doc", "text", "n_words", "n_hit", "spans", "items"])
    return find


def _cutter(window: int, most: int):
    """Items to pieces (item, text, n words) of at most ``most`` words; each window lies whole in a piece."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            names, texts, sizes = [], [], []
            for r, name in enumerate(batch.column("item").to_pylist()):
                part = data[bounds[r]:bounds[r + 1]]
                _, _, starts, ends, _ = word_hashes(part, np.array([0, len(part)]))
                for at in range(0, max(len(starts) - window + 1, min(len(starts), 1)), most - window + 1):
                    last = min(at + most, len(starts))
                    names.append(name)
                    texts.append(part[starts[at]:ends[last - 1]].tobytes().decode())
                    sizes.append(last - at)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string()), pa.array(sizes, pa.int64())],
                                             names=["item", "text", "n"])
    return cut


def _builder(window: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = [(r["item"], r["text"]) for batch in batches for r in batch.to_pylist()]
        if items:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(Matcher(items, window))], pa.binary())], names=["matcher"])
    return build


def shards(items: DataFrame, item_id: str, item_text: str, window: int, shard_words: int) -> list[DataFrame]:
    """The items' pieces in shards of at most ``shard_words`` words, each of one partition."""
    most = max(shard_words // 8, 2 * window)
    known = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
                         F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    pieces = stored(known.mapInArrow(_cutter(window, most), "item string, text string, n bigint").distinct(), "decontaminate-items")
    total = pieces.agg(F.sum("n").alias("n")).first()["n"] or 0
    buckets = 64 * max(1, -(-total // shard_words))
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("item", "text"), F.lit(buckets)))
    sizes = {r["bucket"]: r["n"] for r in pieces.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    edges, filled = [0], 0
    for b in range(buckets):
        if filled and filled + sizes.get(b, 0) > shard_words:
            edges.append(b)
            filled = 0
        filled += sizes.get(b, 0)
    return [pieces.where((F.col("bucket") >= lo) & (F.col("bucket") < hi)).select("item", "text").coalesce(1)
            for lo, hi in zip(edges, [*edges[1:], buckets])]


def _matched(docs: DataFrame, keep: list[str], items: DataFrame, text_col: str, item_id: str, item_text: str,
             window: int, shard_words: int, cut: bool) -> DataFrame:
    """doc (struct of ``keep``), text (without the hit spans if ``cut``), n_words, n_hit, spans, items."""
    spark = docs.sparkSession
    python_ready(spark)
    rows = docs.select(
        F.struct(*[F.col(c) for c in keep], F.lit(0).alias("__pad")).alias("doc"), F.col(text_col).alias("text"),
        F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
        F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)").alias("spans"),
        F.expr("cast(array() as array<string>)").alias("items"))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
    parts = shards(items, item_id, item_text, window, shard_words)
    for k, part in enumerate(parts):
        built = part.mapInArrow(_builder(window), "matcher binary").first()       # bounded by shard_words
        shared = spark.sparkContext.broadcast(Packed(bytes(built["matcher"]) if built else pickle.dumps(Matcher([], window))))
        last = k == len(parts) - 1
        rows = rows.mapInArrow(_finder(shared, cut and last), schema)
        if not last:
            rows = stored(rows, "decontaminate-shard")
    return rows


def find_contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                       shard_words: int = SHARD_WORDS) -> DataFrame:
    """Per row: id, n_words, n_hit, hit byte spans, and the ids of the items whose windows occur."""
    found = _matched(docs, [id_col], items, text_col, item_id, item_text, window, shard_words, cut=False)
    return found.select(F.col("doc")[id_col].alias(id_col), "n_words", "n_hit", "spans", "items")


def contamination_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return found.select(
        id_col, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def remove_contamination(docs: DataFrame, items: DataFrame, max_coverage: float = 0.5, text_col: str = "text",
                         chars_col: str = "n_chars", item_id: str = "item_id", item_text: str = "text",
                         window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` without the spans that occur in items (``chars_col``, where there is one, follows the text).
    Rows with more than ``max_coverage`` of their words in such spans go; rows without hits stay as they are."""
    keep = [c for c in docs.columns if c != text_col]
    found = _matched(docs, keep, items, text_col, item_id, item_text, window, shard_words, cut=True)
    found = found.where(F.col("n_hit") <= max_coverage * F.col("n_words"))
    cut = F.col("n_hit") > 0

    def column(c: str):
        if c == text_col:
            return F.col("text").alias(c)
        value = F.col("doc").getField(c)
        if c == chars_col:
            value = F.when(cut, F.char_length("text").cast(docs.schema[c].dataType)).otherwise(value)
        return value.alias(c)

    return found.select(*[column(c) for c in docs.columns])
