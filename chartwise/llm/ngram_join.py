"""N-gram Jaccard self-join of documents with count-vector R-trees.

A document is its set of word n-grams, as 56-bit hashes.  The n-grams are hashed into ``GROUPS`` groups; the
counts of a document's n-grams per group are its point.  The overlap of two sets is at most the sum of the
smaller counts of each group, so a box of points bounds the overlap of all documents in it.  Trees of
such boxes prune, and only pairs that survive are verified on the whole sets.

Where trees are built: two documents that link share most of their n-grams, so they share some
of their ``KEYS`` smallest hashes; documents that share one meet in that hash's tree.  A tree of up to ``HOT`` documents is one leaf and emits the
few pairs whose bound allows a link.  An n-gram with more holders makes a large tree, of those documents that may meet a
partner nowhere else: those with more than ``FEW`` hot hashes among their smallest, or whose hot hashes alone could make up a link.  The
others need no large tree: of the ``KEYS`` smallest hashes of two linked documents together, a share of the threshold is in both and so a
key of both, and at most ``FEW`` of those are hot, so one that is not makes them meet.  That all shared ones are hot has the odds P(Bin(KEYS, t) <= FEW):
2e-13 at t = 0.85, 5e-11 at t = 0.8; that none is shared (1 - t)^KEYS, at most 2e-17.  A document is in the large trees of its ``TREES``
smallest hashes, as a pair is looked at in the tree of its least shared one only: that it lies beyond them has the odds (1 - t)^TREES, 7e-14 and 7e-12.
(Hashes have 56 bits.  A set of up to ``KEYS`` n-grams has all of them as keys, and no odds.)

Large trees are searched in three rounds, so that a group of near copies costs in proportion to its size.  First each document is in the tree
of its least hot hash only, cut in tiles of ``TILE`` documents that are searched one by one.  Then, in trees of several tiles, ``SCOUTS``
of each component found so far are searched together.  Last, in every tree, the documents outside the component that is the
tree's largest are searched against all of the tree, tile by tile, so no pair of different components is left out; a
tree whose documents are all in one component is not searched.  A tree verifies in place and emits only links that join two of its parts.

Equal sets are one node from the start (an aggregate), whatever the number of copies.  Links become
components by rounds of joins.

Defined results: documents without words have an empty set, no links, and are their own component; with fewer words than an n-gram
the whole sequence is the one element; a null id keeps its row and gets the least id of its component, if it has one; rows that repeat
an id are one node with the links of all its texts; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import hash_spans, mix, python_ready, row_steps, spans_of, stored, text_bytes
from .graph import components

WORDS, PERCENT = 4, 85
GROUPS, KEYS, FEW, HOT, TREES = 32, 24, 4, 64, 16
LEAF, TILE, TILE_BYTES, SCOUTS = 64, 3000, 64 << 20, 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ROW_BITS = 8
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """For each row, its distinct n-grams as ascending 56-bit hashes."""
    data, bounds = text_bytes(texts)
    for first, last in row_steps(bounds, rows=1 << _ROW_BITS):
        b = bounds[first:last + 1] - bounds[first]
        n = last - first
        low = _LOWER[data[bounds[first]:bounds[last]]]
        starts, ends, row = spans_of(~_SPACE[low], b)
        h = hash_spans(low, starts, ends)
        at = np.searchsorted(row, np.arange(n + 1))
        size = np.diff(at)
        if len(h) >= words:
            gram = np.zeros(len(h) - words + 1, np.uint64)
            for k in range(words):
                gram += h[k:len(h) - words + 1 + k] * _ODD[k % 8] + np.uint64(k)
            whole = row[:len(gram)] == row[words - 1:]
            key, of = mix(gram[whole]), row[:len(gram)][whole]
        else:
            key, of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        few = np.flatnonzero((size > 0) & (size < words))
        if len(few):
            short = np.array([(h[at[r]:at[r + 1]] * _ODD[:size[r]]).sum() + np.uint64(size[r] << 32) for r in few], np.uint64)
            key, of = np.concatenate([key, mix(short)]), np.concatenate([of, few])
        full = np.sort((of.astype(np.uint64) << np.uint64(64 - _ROW_BITS)) | (key >> np.uint64(_ROW_BITS)))
        if len(full):
            full = full[np.concatenate([[True], full[1:] != full[:-1]])]
        cut = np.searchsorted(full, np.arange(1, n, dtype=np.uint64) << np.uint64(64 - _ROW_BITS))
        for part in np.split(full & np.uint64((1 << (64 - _ROW_BITS)) - 1), cut):
            yield part


def _profiles(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, fa, fb, keys, counts = [], [], [], [], []
            for s in shingle_sets(batch.column("text"), words):
                n.append(len(s))
                fa.append(mix(s).sum().astype(np.int64))
                fb.append(mix(s ^ _ODD[7]).sum().astype(np.int64))
                keys.append(s[:KEYS].astype(np.int64))
                counts.append(np.bincount((s & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS)
                              .astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(fa, pa.int64()), pa.array(fb, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(counts, pa.binary())],
                names=["id", "n", "fa", "fb", "keys", "counts"])
    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([s.tobytes() for s in shingle_sets(batch.column("text"), words)],
                                              pa.binary())], names=["id", "grams"])
    return run


def _can_link(n_a, n_b, overlap, percent: int):
    """Whether sets of these sizes with (at most) this overlap reach the threshold."""
    return 100 * overlap >= percent * (n_a + n_b - overlap)


class CountTree:
    """R-tree over count vectors: leaves of ``LEAF`` points, boxes of ``LEAF`` nodes above them.

    Points are ordered by size, then by their first coordinates, so boxes are narrow where it prunes most.  Only the upper corner of a
    box matters for the bound, and the range of sizes.
    """

    def __init__(self, n: np.ndarray, counts: np.ndarray):
        step = np.floor(np.log(np.maximum(n, 1)) / 0.05)
        self.order = np.lexsort((counts[:, 1], counts[:, 0], step))
        self.n, self.counts = n[self.order], counts[self.order]
        self.levels = []
        low, high, top = self.n, self.n, self.counts
        while len(low) > 1:
            cut = np.arange(0, len(low), LEAF)
            low, high = np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)
            top = np.maximum.reduceat(top, cut, axis=0)
            self.levels.append((low, high, top))

    def near(self, n: int, counts: np.ndarray, percent: int) -> np.ndarray:
        """Rows (as given) whose bound allows a link with this point."""
        at = np.arange(len(self.levels[-1][0]) if self.levels else len(self.n))
        for k in range(len(self.levels) - 1, -1, -1):
            low, high, top = self.levels[k]
            at = at[(100 * high[at] >= percent * n) & (percent * low[at] <= 100 * n)]
            most = np.minimum(np.minimum(top[at], counts).sum(axis=1), n)
            # the smallest set in the box that can hold so large an overlap makes the least union
            at = at[_can_link(n, np.maximum(low[at], most), most, percent)]
            at = (at[:, None] * LEAF + np.arange(LEAF)).ravel()
            at = at[at < (len(self.levels[k - 1][0]) if k else len(self.n))]
        most = np.minimum(self.counts[at], counts).sum(axis=1)
        return self.order[at[_can_link(n, self.n[at], most, percent)]]


def _leaf_pairs(percent: int):
    """Small trees (one leaf each), rows ordered by key: pairs whose bound allows a link."""
    def pairs(key, ids, n, counts):
        a, b = [], []
        for d in range(1, HOT):
            same = np.flatnonzero(key[d:] == key[:-d]) if d < len(key) else np.zeros(0, np.int64)
            if not len(same):
                break
            x, y = same, same + d
            ok = 100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])
            x, y = x[ok], y[ok]
            ok = _can_link(n[x], n[y], np.minimum(counts[x], counts[y]).sum(axis=1), percent)
            a.append(ids[x[ok]])
            b.append(ids[y[ok]])
        a = np.concatenate(a) if a else np.zeros(0, np.int64)
        b = np.concatenate(b) if b else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            key, ids, n = (batch.column(c).to_numpy() for c in ("key", "rep", "n"))
            counts = np.frombuffer(b"".join(batch.column("counts").to_pylist()), np.int32).reshape(-1, GROUPS)
            if held is not None:
                key, ids, n, counts = (np.concatenate([p, q]) for p, q in zip(held, (key, ids, n, counts)))
            if not len(key):
                continue
            cut = int(np.searchsorted(key, key[-1]))          # the last key may go on in the next batch
            yield pairs(key[:cut], ids[:cut], n[:cut], counts[:cut])
            held = (key[cut:], ids[cut:], n[cut:], counts[cut:])
        if held is not None:
            yield pairs(*held)
    return run


def _large_tree(percent: int):
    """One tile of a tree: links between rows that ``seek`` and all rows, of those that join two parts of it.  A pair is looked at in the
    tree of its least shared key only."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        own = key[0].as_py()
        table = table.sort_by([("rep", "ascending"), ("seek", "descending")])
        ids, n, seek, part = (table.column(c).to_numpy() for c in ("rep", "n", "seek", "part"))
        once = np.concatenate([[True], ids[1:] != ids[:-1]])      # a row that seeks may be among those that are sought
        ids, n, seek, part = ids[once], n[once], seek[once], np.unique(part[once], return_inverse=True)[1]
        table = table.filter(pa.array(once))
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.int32).reshape(-1, GROUPS)
        hot = [set(k) for k in table.column("hot").to_pylist()]
        grams = [np.frombuffer(g, np.uint64) for g in table.column("grams").to_pylist()]
        words, place = np.unique(np.concatenate(grams), return_inverse=True)
        cuts = np.concatenate([[0], np.cumsum([len(g) for g in grams])])
        mark = np.zeros(len(words), bool)
        tree = CountTree(n, counts)
        found = []
        for x in np.flatnonzero(seek)[np.argsort(-n[seek], kind="stable")]:
            y = tree.near(int(n[x]), counts[x], percent)
            y = y[part[y] != part[x]]
            y = y[[min(hot[x] & hot[j]) == own for j in y]] if len(y) else y
            if not len(y):
                continue
            mark[place[cuts[x]:cuts[x + 1]]] = True
            overlap = np.array([np.count_nonzero(mark[place[cuts[j]:cuts[j + 1]]]) for j in y])
            mark[place[cuts[x]:cuts[x + 1]]] = False
            for j in y[_can_link(n[x], n[y], overlap, percent)]:
                if part[j] != part[x]:
                    found.append((min(ids[x], ids[j]), max(ids[x], ids[j])))
                    part[part == part[j]] = part[x]             # union by relabelling
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})
    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("ga").to_pylist(), batch.column("gb").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                keep.append(bool(_can_link(len(x), len(y), len(np.intersect1d(x, y, assume_unique=True)), percent)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _search(rows: DataFrame, by: list[str], percent: int) -> DataFrame:
    return rows.select(*by, "rep", "n", "counts", "hot", "grams", "seek", "part").groupBy(*by).applyInArrow(_large_tree(percent), "a bigint, b bigint")


def _tiles(count, size) -> Column:
    """Tiles for so many rows with so many n-grams."""
    return F.greatest(F.ceil(count / TILE), F.ceil(size * 8 / TILE_BYTES), F.lit(1)).cast("int")


def _large_links(large: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """``links`` and those of the large trees of ``large`` (rep, n, counts, hot, grams) that join its components."""
    deal = lambda tiles: F.pmod(F.xxhash64("rep"), F.col(tiles)).cast("int")

    def labelled(rows: DataFrame, links: DataFrame) -> DataFrame:
        label = components(links)
        return rows.join(label.withColumnRenamed("node", "rep"), "rep", "left").withColumn("part", F.coalesce("component", "rep")).drop("component")

    # first round: each document in one tree, each tile for itself
    one = large.withColumn("key", F.array_min("hot"))
    size = one.groupBy("key").agg(F.count("*").alias("m"), F.sum("n").alias("s")).where("m > 1").select("key", _tiles(F.col("m"), F.col("s")).alias("tiles"))
    one = one.join(size, "key").select("key", "rep", "n", "counts", "hot", "grams", "tiles", F.lit(True).alias("seek"), F.col("rep").alias("part"))
    near = stored(_search(one.withColumn("tile", deal("tiles")), ["key", "tile"], percent), "ngram-near")
    links = stored(links.union(near).distinct(), "ngram-links")

    # second round: some of each component of a tree with several tiles
    narrow = large.select("rep", "n", "hot")
    several = size.where("tiles > 1").select("key")
    if several.limit(1).count():
        some = labelled(narrow.select("rep", F.array_min("hot").alias("key")).join(several, "key", "left_semi"), links)
        some = some.withColumn("slot", F.pmod(F.xxhash64("rep", F.lit(7)), F.lit(SCOUTS)))
        some = some.groupBy("key", "part", "slot").agg(F.min("rep").alias("rep"))
        count = some.groupBy("key").agg(F.count("*").alias("m")).select("key", _tiles(F.col("m"), F.lit(0)).alias("tiles"))
        some = some.join(count, "key").join(large, "rep").select("key", "rep", "n", "counts", "hot", "grams", F.lit(True).alias("seek"), "part",
                                                                 deal("tiles").alias("tile"))
        links = stored(links.union(_search(some, ["key", "tile"], percent)).distinct(), "ngram-links")

    # third round: whoever is not in a tree's largest component against the whole tree
    placed = stored(labelled(narrow, links).select("rep", "n", "part", F.explode("hot").alias("key")), "ngram-placed")
    parts = placed.groupBy("key", "part").agg(F.count("*").alias("m"), F.sum("n").alias("s"), F.min("n").alias("lo"), F.max("n").alias("hi"))
    trees = parts.groupBy("key").agg(F.count("*").alias("parts"), F.sum("m").alias("m"), F.sum("s").alias("s"),
                                     F.max_by("part", F.struct("m", "part")).alias("largest")).where("parts > 1")
    rest = parts.join(trees.select("key", "largest"), "key").where("part != largest").groupBy("key").agg(
        F.sum("m").alias("rm"), F.sum("s").alias("rs"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    # stored: the join with all rows then reads two shuffles, and a tree with very many rows can be split
    plan = stored(trees.join(rest, "key").select("key", "largest", "lo", "hi", _tiles(F.col("m"), F.col("s")).alias("tiles"),
                                          _tiles(F.col("rm"), F.col("rs")).alias("seek_tiles")), "ngram-plan")
    dealt = placed.join(plan, "key")
    span = lambda tiles: F.explode(F.sequence(F.lit(0), F.col(tiles) - 1))
    seekers = dealt.where("part != largest").select("key", "rep", "part", F.lit(True).alias("seek"), deal("seek_tiles").alias("seek_tile"), span("tiles").alias("tile"))
    # a set that is too small or too large for all seekers has no link to one
    sought = dealt.where(f"100 * n >= {percent} * lo and {percent} * n <= 100 * hi").select(
        "key", "rep", "part", F.lit(False).alias("seek"), span("seek_tiles").alias("seek_tile"), deal("tiles").alias("tile"))
    rows = seekers.unionByName(sought).join(large, "rep")
    return stored(links.union(_search(rows, ["key", "seek_tile", "tile"], percent)).distinct(), "ngram-links")


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                     percent: int = PERCENT) -> DataFrame:
    """Per row: id, n_shingles, component_id.  Two documents link when 100 * intersection >= percent * union."""
    python_ready(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    profile = stored(narrow.mapInArrow(
        _profiles(words), "id bigint, n bigint, fa bigint, fb bigint, keys array<bigint>, counts binary"), "ngram-profiles")
    same = ["n", "fa", "fb"]
    reps = stored(profile.where("n > 0").groupBy(*same).agg(
        F.min("id").alias("rep"), F.first("keys").alias("keys"), F.first("counts").alias("counts")), "ngram-sets")
    nodes = reps.where("rep is not null")

    keyed = nodes.select("rep", *same, F.explode("keys").alias("key"))
    holders = keyed.groupBy("key").agg(F.count("*").alias("holders")).where("holders > 1")
    shared = keyed.join(holders, "key").groupBy("rep", *same).agg(
        F.collect_list(F.struct("key", "holders")).alias("shared"))
    nodes = nodes.join(shared, ["rep", *same]).withColumn(
        "hot", F.expr(f"transform(filter(shared, s -> s.holders > {HOT}), s -> s.key)"))
    used = stored(nodes.select(
        "rep", "n", "counts",
        F.expr(f"transform(filter(shared, s -> s.holders <= {HOT}), s -> s.key)").alias("cold"),
        F.when((F.size("hot") > FEW) | (100 * F.size("hot") >= percent * F.size("keys")),
               F.expr(f"filter(hot, k -> k <= coalesce(get(keys, {TREES - 1}), k))"))
        .otherwise(F.expr("cast(array() as array<bigint>)")).alias("hot")), "ngram-keys")

    small = used.select(F.explode("cold").alias("key"), "rep", "n", "counts").repartition("key").sortWithinPartitions(
        "key", "n", "rep")
    pairs = stored(small.mapInArrow(_leaf_pairs(percent), "a bigint, b bigint").distinct(), "ngram-pairs")
    in_large = used.where(F.size("hot") > 0)

    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).union(in_large.select("rep")).distinct()
    grams = stored(narrow.join(wanted, "id", "left_semi").mapInArrow(_sets(words), "id bigint, grams binary"), "ngram-grams")
    checked = (pairs.join(grams.select(F.col("id").alias("a"), F.col("grams").alias("ga")), "a")
               .join(grams.select(F.col("id").alias("b"), F.col("grams").alias("gb")), "b")
               .select("a", "b", "ga", "gb").mapInArrow(_verify(percent), "a bigint, b bigint"))

    links = stored(checked, "ngram-links")
    links = _large_links(stored(in_large.join(grams.select(F.col("id").alias("rep"), "grams"), "rep"), "ngram-large"), links, percent)
    part = components(links)
    whole = reps.select(*same, "rep").join(part.withColumnRenamed("node", "rep"), "rep", "left").select(
        *same, F.coalesce("component", "rep").alias("component_id"))
    out = profile.select("id", *same).join(whole, same, "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.coalesce("component_id", "id").alias("component_id"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                     percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without those whose component has a smaller id.  A node is an id with its text (a 64-bit hash), so
    another text with the same id is a document of its own; rows without an id stay."""
    node = F.when(F.col(id_col).isNotNull(), F.xxhash64(F.col(id_col), F.col(text_col)))
    rows = docs.select(node.alias("node"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    part = ngram_components(rows, "node", "text", words, percent).where("node is not null").distinct()
    part = stored(part.join(rows.select("node", "id").distinct(), "node"), "ngram-parts")
    least = part.where(F.col("node") != F.col("component_id")).select("component_id").distinct().join(
        part, "component_id").groupBy("component_id").agg(F.min("id").alias("least"))
    gone = part.join(least, "component_id").where("id != least").select(F.col("node").alias("__gone"))
    return docs.join(gone, node == F.col("__gone"), "left_anti")
