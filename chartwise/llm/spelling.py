"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

A word is the vector of how often each of ``GROUPS`` occurs in it.  One inserted, deleted or
replaced letter changes the vector by a surplus of at most one and a deficit of at most one.  The
trie has a level for each group, a child for each count.  A depth-first search takes a word down the trie
of all others with a budget of one surplus and one deficit; the words of the leaves that it
reaches are verified letter by letter.  Of two words, the one that has fewer letters of the first
group in which they differ is the one that searches, so that a pair is met once.

How it is spread.  Words are counted by task and then by word, so a word of any frequency is one row a task.  The top levels of the
trie are Spark's key: a word lives in the subtrie of its own first counts and is sent to the few subtries that its search can
enter.  The number of levels in the key follows from the measured size of the largest subtrie (``SUBTRIE`` words).  A subtrie
sends back one row a word (count and best neighbour), never pairs.  A search goes down in blocks of ``BLOCK`` (word, node) pairs, the last first.

Defined results: a null text has no words; a null id is written as an empty string before the colon; rows that repeat an id count each; equal ``n`` are settled
by the smaller word in code-point order; an empty table gives no rows; other columns are not read.  Words of any length are whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import python_ready, stored

# FIXED VALUES: letter groups, one trie level each; letters that are in none form the last level
GROUPS = ["e", "t", "a", "o", "i", "n", "s", "r", "h", "l", "d", "c", "u", "m", "fp", "gw", "by", "jkqvxz"]

LEAST_LENGTH = 7
#: words of the largest subtrie that one task should hold; levels of the trie that may be in the key
SUBTRIE, MOST_LEVELS = 60_000, 8
#: pairs of a word and a trie node that one step of the search handles; words of a task's count before they are sent on
BLOCK, FLUSH = 200_000, 400_000

_RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % LEAST_LENGTH)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_WORDS = "word string, n long"
_ROUTED = "subtrie long, word string, n long, home boolean"
_FOUND = "word string, n long, n_near long, near_n long, near string"


def _group_of() -> np.ndarray:
    table = np.full(256, len(GROUPS), np.int64)
    for k, letters in enumerate(GROUPS):
        table[[ord(c) for c in letters]] = k
    return table


_GROUP = _group_of()
N_GROUPS = len(GROUPS) + 1


def _damaged(word: str, h: int) -> str:
    """``word`` without one code point if 31 divides the hash ``h``."""
    if h % 31:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1:]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()

    def out():
        rows = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                          names=["word", "n"])
        total.clear()
        return rows

    for batch in batches:
        for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
            if not text:
                continue
            seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
            for word, n in Counter(_RUN.findall(text.encode().translate(_LOWER).decode())).items():
                word = _damaged(word, zlib.crc32(word.encode(), seed))
                if len(word) >= LEAST_LENGTH:
                    total[word] += n
            if len(total) > FLUSH:
                yield out()
    if total:
        yield out()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 2) -> DataFrame:
    """(word, n) of every word with at least ``least`` occurrences in all texts."""
    python_ready(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_count, _WORDS).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words one after the other, and the bounds of each."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8), np.concatenate([[0], np.cumsum(size)])


def _vectors(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    n = len(bounds) - 1
    row = np.repeat(np.arange(n), np.diff(bounds))
    return np.bincount(row * N_GROUPS + _GROUP[codes], minlength=n * N_GROUPS).reshape(n, N_GROUPS).astype(np.int32)


def _steps(levels: int) -> list[np.ndarray]:
    """What a search may add to the first ``levels`` counts: nothing, a surplus, or a surplus and a later deficit."""
    one = np.eye(levels, dtype=np.int32)
    return [np.zeros(levels, np.int32), *one, *(one[g] - one[h] for g in range(levels) for h in range(g + 1, levels))]


def _key(head: np.ndarray) -> np.ndarray:
    """One integer for the counts of the first levels (equal ones have equal keys)."""
    key = np.zeros(len(head), np.uint64)
    for k in range(head.shape[1]):
        key = (key + head[:, k].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return key.view(np.int64)


def _route(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            words, n = batch.column("word"), batch.column("n")
            head = _vectors(*_codes(words.to_pylist()))[:, :levels]
            own, seen = _key(head), []
            for k, step in enumerate(_steps(levels)):
                to = head + step
                key = _key(to)
                go = (to >= 0).all(axis=1)
                for before, was in seen:                        # a word searches a subtrie once, also where keys collide
                    go &= (key != before) | ~was
                seen.append((key, go))
                at = pa.array(np.flatnonzero(go))
                yield pa.RecordBatch.from_arrays([pa.array(key[go], pa.int64()), words.take(at), n.take(at),
                                                  pa.array(key[go] == own[go])], names=["subtrie", "word", "n", "home"])
    return run


class CountTrie:
    """Trie over rows of counts: a level's nodes are numbered, and found by (parent, count)."""

    def __init__(self, vectors: np.ndarray):
        self.base = int(vectors.max(initial=0)) + 3
        self.levels, node = [], np.zeros(len(vectors), np.int64)
        for k in range(vectors.shape[1]):
            edges, node = np.unique(node * self.base + vectors[:, k] + 1, return_inverse=True)
            self.levels.append(edges)
        self.leaf = node

    def search(self, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query, leaf, budget used: 0 none, 1 a surplus, 2 both) of every leaf in reach, depth first."""
        depth = len(self.levels)
        stack = [(0, np.arange(a, min(a + BLOCK, len(queries))), None, None) for a in range(0, len(queries), BLOCK)]
        while stack:
            level, query, node, used = stack.pop()
            if node is None:
                node, used = np.zeros(len(query), np.int64), np.zeros(len(query), np.int8)
            if level == depth:
                yield query, node, used
                continue
            edges, count = self.levels[level], queries[query, level]
            parts = []
            for step, may in ((0, None), (1, used == 0), (-1, used == 1)):
                some = np.arange(len(query)) if may is None else np.flatnonzero(may)
                c = np.minimum(count[some] + step, self.base - 2)               # beyond all counts of the trie: no edge
                want = node[some] * self.base + c + 1
                at = np.searchsorted(edges, want)
                hit = (c >= 0) & (at < len(edges))
                hit[hit] = edges[at[hit]] == want[hit]
                some = some[hit]
                parts.append((query[some], at[hit], used[some] + np.int8(step != 0)))
            query, node, used = (np.concatenate(p) for p in zip(*parts))
            for a in range(0, len(query), BLOCK):
                stack.append((level + 1, query[a:a + BLOCK], node[a:a + BLOCK], used[a:a + BLOCK]))


def _members(of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows by class, and the bounds of each class."""
    return np.argsort(of, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))])


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges [first, last), and the range each is of."""
    size = last - first
    of = np.repeat(np.arange(len(size)), size)
    return np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size), of


def _end_keys(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first three and the last four letters of each word as integers; one edit leaves the ones or the others alone."""
    def key(places):
        return sum(codes[p].astype(np.int64) << (8 * k) for k, p in enumerate(places))
    return key([bounds[:-1] + k for k in range(3)]), key([bounds[1:] - k for k in range(1, 5)])


def _same_ends(a_leaf, b_leaf, a, b, key):
    """Pairs of members of the same leaf pair whose ``key`` is equal."""
    _, rank = np.unique(key, return_inverse=True)
    span = int(rank.max(initial=0)) + 1
    ka, kb = a_leaf * span + rank[a], b_leaf * span + rank[b]
    order = np.argsort(kb, kind="stable")
    kb = kb[order]
    at, of = _spread(np.searchsorted(kb, ka, "left"), np.searchsorted(kb, ka, "right"))
    return a[of], b[order[at]]


def _one_edit(codes: np.ndarray, bounds: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs differ by exactly one edit; ``b`` is as long as ``a`` or longer by one."""
    size, longer = np.diff(bounds), np.diff(bounds)[b] - np.diff(bounds)[a]
    ok = np.zeros(len(a), bool)
    order = np.argsort(size[a], kind="stable")
    first = 0
    while first < len(order):                                   # words of about one length, about 4 million letters at a time
        width = int(size[a[order[first]]])
        last = int(np.searchsorted(size[a[order]], width + 8, "left"))
        last = max(first + 1, min(last, first + max(1, (4 << 20) // (width + 8))))
        some = order[first:last]
        width = int(size[a[some[-1]]])
        place = np.arange(width)
        x, y, m = a[some], b[some], size[a[some]]
        inside = place < m[:, None]

        def at(start):
            return codes[np.minimum(start[:, None] + place, len(codes) - 1)]
        front = ~inside | (at(bounds[x]) == at(bounds[y]))
        wrong = (~front).sum(axis=1)
        back = ~inside | (at(bounds[x]) == at(bounds[y] + 1))
        lead = np.where(wrong == 0, m, np.argmin(front, axis=1))
        tail = np.where(back.all(axis=1), m, m - (width - np.argmin(back[:, ::-1], axis=1)))
        ok[some] = np.where(longer[some] == 1, lead + tail >= m, wrong == 1)
        first = last
    return ok


def near_pairs(words: list[str], home: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows (searching, found) that are one edit apart; only rows with ``home`` are found, and of two
    such rows with equal counts each pair comes once."""
    codes, bounds = _codes(words)
    vectors = _vectors(codes, bounds)
    head, tail = _end_keys(codes, bounds)
    own = np.flatnonzero(home)
    if not len(own):
        return
    trie = CountTrie(vectors[own])
    found, found_at = _members(trie.leaf, int(trie.leaf.max()) + 1)
    found = own[found]
    packed = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.itemsize * N_GROUPS))).ravel()
    _, sample, kind = np.unique(packed, return_index=True, return_inverse=True)
    seek, seek_at = _members(kind, len(sample))
    for query, leaf, used in trie.search(vectors[sample]):
        size = np.cumsum(np.diff(seek_at)[query] + np.diff(found_at)[leaf])
        cuts = [0, *np.unique(np.searchsorted(size, np.arange(BLOCK, size[-1] if len(size) else 0, BLOCK))).tolist(), len(query)]
        for lo, hi in zip(cuts, cuts[1:]):
            if lo == hi:
                continue
            at, a_leaf = _spread(seek_at[query[lo:hi]], seek_at[query[lo:hi] + 1])
            a = seek[at]
            at, b_leaf = _spread(found_at[leaf[lo:hi]], found_at[leaf[lo:hi] + 1])
            b = found[at]
            same = used[lo:hi] == 0
            for key, other in ((head, None), (tail, head)):
                x, y = _same_ends(a_leaf, b_leaf, a, b, key)
                if other is not None:
                    apart = other[x] != other[y]
                    x, y = x[apart], y[apart]
                if same.any():                                  # equal counts: both search, and one of the two meetings goes
                    once = (kind[x] != kind[y]) | (x < y)
                    x, y = x[once], y[once]
                ok = _one_edit(codes, bounds, x, y)
                yield x[ok], y[ok]


def _near_words(table: pa.Table) -> pa.Table:
    words, home = table.column("word").to_pylist(), table.column("home").to_numpy()
    n = table.column("n").to_numpy()
    order = np.array(sorted(range(len(words)), key=lambda k: (-int(n[k]), words[k])), np.int64)
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    count, best = np.zeros(len(words), np.int64), np.full(len(words), len(words), np.int64)
    for a, b in near_pairs(words, home):
        for x, y in ((a, b), (b, a)):
            count += np.bincount(x, minlength=len(words))
            np.minimum.at(best, x, rank[y])
    some = np.flatnonzero(home | (count > 0))
    near = [int(order[k]) if k < len(words) else None for k in best[some]]
    return pa.table({"word": pa.array([words[k] for k in some], pa.string()), "n": pa.array(n[some], pa.int64()),
                     "n_near": pa.array(count[some], pa.int64()),
                     "near_n": pa.array([None if k is None else int(n[k]) for k in near], pa.int64()),
                     "near": pa.array([None if k is None else words[k] for k in near], pa.string())})


def key_levels(words: DataFrame, subtrie: int = SUBTRIE) -> int:
    """The least number of levels whose largest subtrie has at most ``subtrie`` words."""
    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = _vectors(*_codes(batch.column("word").to_pylist()))
                for k in range(1, MOST_LEVELS + 1):
                    key, n = np.unique(_key(v[:, :k]), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), k), pa.int64()), pa.array(key),
                                                      pa.array(n, pa.int64())], names=["levels", "key", "n"])
    sizes = (words.select("word").mapInArrow(heads, "levels long, key long, n long").groupBy("levels", "key").agg(F.sum("n").alias("n"))
             .groupBy("levels").agg(F.max("n").alias("n")).collect())     # a row a level
    fits = [r["levels"] for r in sizes if r["n"] <= subtrie]
    return min(fits) if fits else MOST_LEVELS


def near_words(words: DataFrame, subtrie: int = SUBTRIE) -> DataFrame:
    """(word, n, n_near, near_n, near) for every row of ``words`` (word, n): its neighbours' number, and the one of largest n."""
    python_ready(words.sparkSession)
    routed = words.mapInArrow(_route(key_levels(words, subtrie)), _ROUTED)
    found = routed.groupBy("subtrie").applyInArrow(_near_words, _FOUND)
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), "near"))).alias("best")
    return found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best).select(
        "word", "n", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.near").alias("near"))


def with_roots(links: DataFrame) -> DataFrame:
    """(word, root): where the chain of ``links`` (word, form) ends.  Each round doubles the steps taken; a form's n is
    at least ten times its word's, so chains are short."""
    up = links.select("word", F.col("form").alias("root"))
    while True:
        on = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = stored(up.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                        F.col("next").isNotNull().alias("moved")), "spelling-roots")
        up = new.select("word", "root")
        if not new.where("moved").limit(1).count():
            return up


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", factor: int = 10) -> DataFrame:
    """Per word: form (the near word of largest n, if that is ``factor`` times the word's), root, n, n_near, form_n."""
    words = stored(word_counts(docs, id_col, text_col), "spelling-words")
    is_form = F.col("near_n") >= factor * F.col("n")
    forms = stored(near_words(words).select(
        "word", F.when(is_form, F.col("near")).alias("form"), "n", "n_near", F.when(is_form, F.col("near_n")).alias("form_n")), "spelling-forms")
    roots = with_roots(forms.where("form is not null"))
    return forms.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
