"""Conversation structure repair: the cheapest edits that give a conversation a legal order of roles.

Legal are the initials ``(s?(ua)+)?``.  A row is kept (K, 0), given the other of user and assistant (R, 2) or deleted (D, 3;
blank rows and repeated ones must be); an empty row can be inserted anywhere (I, 2); a truncated row that is not deleted costs 1
more.  A row's first fault counts: blank (nothing but spaces), duplicate (role and text seen earlier), truncated (its last
character that is no space is none of ``.!?``).  Of equally cheap audits (the edits' initials) the least in ASCII order is taken.

The dynamic programme has a state for the last legal role and one pass over the rows.  A state holds its cheapest
prefix of edits, as a node of a shared tree: a prefix is its parent and one edit, with a rolling hash of the
whole and its ancestors at distances of powers of two.  Two prefixes of equal cost are compared at the first edit after their longest
common prefix, which the ancestors' hashes find by halving; equal hashes of different nodes are verified edit by
edit.  No prefix of a state begins another one of equal cost (more edits for the same rows are insertions, which cost), so the lesser prefix
stays the lesser whatever follows.  Every ``COMPACT`` rows what all states share is written out and the tree is rebuilt from what is alive.

How it is spread.  Faults are found by column functions (a copy of a long text is found by its digest).  A conversation is a stream of narrow rows in
the order of turns, sorted by Spark and never held; its audit then heads the stream of its rows when they are
edited, so neither step keeps texts.  One conversation is one task's stream: the audit, and the digest of the whole, are sequential.

Defined results: null roles and texts are one space; rows are taken by turn, null turns first, equal turns by role, text (its first
64 characters, then its hash); rows that are wholly equal are duplicates; a null conversation id is one conversation; roles whose initials are not s, u or a
cannot be kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import python_ready, stored

SPACES = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
#: states: nothing yet, after system, after user, after assistant; legal ends
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: the only state that a row of a free role leads to, and that role
FREE = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL_PAIRS = {"su", "ua", "au"}
#: rows after which the tree of prefixes is rebuilt
COMPACT = 4096
_MOD, _BASE = (1 << 61) - 1, 911_382_323_911_382_321

ORDER = ["turn", "role", "head", "hash"]
_AUDIT = [("gaps", T.LongType()), ("blank", T.LongType()), ("duplicate", T.LongType()), ("truncated", T.LongType()), ("illegal", T.LongType()),
          ("cost", T.LongType()), ("audit", T.StringType())]


class Prefixes:
    """A tree of edit prefixes; a node is a parent and an edit."""

    def __init__(self):
        self.parent, self.edit, self.size, self.hash, self.up = [0], [""], [0], [0], [[]]

    def add(self, parent: int, edit: str) -> int:
        node, up, at = len(self.parent), [parent], parent
        while len(up) <= len(self.up[at]):                      # the ancestor at 2^k is the one at 2^(k-1) of that at 2^(k-1)
            at = self.up[at][len(up) - 1]
            up.append(at)
        self.parent.append(parent)
        self.edit.append(edit)
        self.size.append(self.size[parent] + 1)
        self.hash.append((self.hash[parent] * _BASE + ord(edit)) % _MOD)
        self.up.append(up)
        return node

    def ancestor(self, node: int, size: int) -> int:
        """The prefix of ``node`` with ``size`` edits."""
        while self.size[node] > size:
            gap = self.size[node] - size
            node = self.up[node][gap.bit_length() - 1]
        return node

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.edit[node])
            node = self.parent[node]
        return "".join(reversed(out))

    def _same(self, a: int, b: int) -> bool:
        """Verifies that two prefixes of one size are equal, back to where they meet."""
        while a != b:
            if self.edit[a] != self.edit[b]:
                return False
            a, b = self.parent[a], self.parent[b]
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether the edits of ``a`` come before those of ``b``."""
        size = min(self.size[a], self.size[b])
        x, y = self.ancestor(a, size), self.ancestor(b, size)
        if self.hash[x] == self.hash[y]:
            if self._same(x, y):
                return self.size[a] < self.size[b]
            return self.text(a) < self.text(b)
        for k in reversed(range(len(self.up[x]))):              # the highest ancestors that still differ
            if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                x, y = self.up[x][k], self.up[y][k]
        if not self._same(self.parent[x], self.parent[y]):      # a collision of hashes
            return self.text(a) < self.text(b)
        return self.edit[x] < self.edit[y]

    def shared(self, nodes: list[int]) -> int:
        """The longest prefix, as a node, that all ``nodes`` descend from."""
        low = nodes[0]
        for other in nodes[1:]:
            size = min(self.size[low], self.size[other])
            low, other = self.ancestor(low, size), self.ancestor(other, size)
            while low != other:
                k = next((k for k in reversed(range(len(self.up[low]))) if self.up[low][k] != self.up[other][k]), 0)
                low, other = self.up[low][k], self.up[other][k]
        return low


class Repair:
    """The dynamic programme over the rows of one conversation."""

    def __init__(self):
        self.tree, self.done, self.rows = Prefixes(), [], 0
        self.best: dict[int, tuple[int, int]] = {START: (0, 0)}

    def _offer(self, best: dict, state: int, cost: int, parent: int, edit: str) -> bool:
        old = best.get(state)
        if old is not None and old[0] < cost:
            return False
        node = self.tree.add(parent, edit)
        if old is None or cost < old[0] or self.tree.less(node, old[1]):
            best[state] = (cost, node)
            return True
        return False

    def _insertions(self) -> None:
        todo = list(self.best)
        while todo:
            state = todo.pop()
            cost, node = self.best[state]
            if self._offer(self.best, FREE[state], cost + COST[INSERT], node, INSERT):
                todo.append(FREE[state])

    def row(self, initial: str, delete: bool, truncated: bool) -> None:
        self._insertions()
        new: dict[int, tuple[int, int]] = {}
        for state, (cost, node) in self.best.items():
            self._offer(new, state, cost + COST[DELETE], node, DELETE)
            if not delete:
                cost += TRUNCATED_COST * truncated
                if (state, initial) in NEXT:
                    self._offer(new, NEXT[state, initial], cost, node, KEEP)
                self._offer(new, FREE[state], cost + COST[REROLE], node, REROLE)
        self.best = new
        self.rows += 1
        if self.rows % COMPACT == 0:
            self._compact()

    def _compact(self) -> None:
        old, low = self.tree, self.tree.shared([n for _, n in self.best.values()])
        self.done.append(old.text(low))
        self.tree, made = Prefixes(), {}
        for state, (cost, node) in self.best.items():
            at = 0
            for edit in old.text(node)[old.size[low]:]:
                if (at, edit) not in made:
                    made[at, edit] = self.tree.add(at, edit)
                at = made[at, edit]
            self.best[state] = (cost, at)

    def end(self) -> tuple[int, str]:
        """Cost and audit of the cheapest repair."""
        self._insertions()
        (cost, node), *rest = (self.best[s] for s in (START, ASSISTANT) if s in self.best)
        for other_cost, other in rest:
            if (other_cost < cost) or (other_cost == cost and self.tree.less(other, node)):
                cost, node = other_cost, other
        return cost, "".join(self.done) + self.tree.text(node)


def repair(rows: list[tuple[str, bool, bool]]) -> tuple[int, str]:
    """(cost, audit) of rows given as (initial, must go, truncated)."""
    r = Repair()
    for row in rows:
        r.row(*row)
    return r.end()


def turns(table: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(id, turn, role, text, head, hash): the rows with the columns that order them."""
    text = F.coalesce(F.col(text_col), F.lit(" "))
    return table.select(F.col(id_col).alias("id"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
                        text.alias("text"), F.substring(text, 1, 64).alias("head"), F.xxhash64(text).alias("hash"))


def faults(rows: DataFrame) -> DataFrame:
    """``turns`` without texts: (id, ORDER, initial, blank, duplicate, truncated); only the first fault of a row is set."""
    rest = F.rtrim(F.col("text"), F.lit(SPACES))
    x = rows.select("id", *ORDER, F.md5("text").alias("digest"), F.substring("role", 1, 1).alias("initial"), (rest == "").alias("blank"),
                    (~F.right(rest, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    earlier = Window.partitionBy("id", "role", "digest").orderBy("turn")
    x = x.withColumn("again", F.row_number().over(earlier) > 1)
    return x.select("id", *ORDER, "initial", "blank", (~F.col("blank") & F.col("again")).alias("duplicate"),
                    (~F.col("blank") & ~F.col("again") & F.col("cut")).alias("truncated"))


def _streams(df: DataFrame, *order: str) -> DataFrame:
    return df.repartition("id").sortWithinPartitions("id", *order)


def _same_id(a, b) -> bool:
    return a == b and (a is None) == (b is None)


def _audit(names: list[str], id_type: pa.DataType):
    schema = pa.schema([("id", id_type), *[(n, pa.string() if n == "audit" else pa.int64()) for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        now = None

        class One:
            def __init__(self, ident):
                self.id, self.repair, self.count, self.illegal = ident, Repair(), [0, 0, 0], 0
                self.first = self.last = self.initial = None
                self.distinct = 0

            def row(self, turn, initial, *kinds):
                if turn is not None:
                    self.first = turn if self.first is None else self.first
                    self.distinct += turn != self.last
                    self.last = turn
                if self.initial is not None and self.initial + initial not in LEGAL_PAIRS:
                    self.illegal += 1
                self.initial = initial
                for k, kind in enumerate(kinds):
                    self.count[k] += kind
                self.repair.row(initial, kinds[0] or kinds[1], kinds[2])

            def end(self):
                gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
                return (self.id, gaps, *self.count, self.illegal, *self.repair.end())

        def flush():
            rows = pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(zip(*out), schema)], schema=schema)
            out.clear()
            return rows

        for batch in batches:
            for ident, *row in zip(*(batch.column(c).to_pylist() for c in ("id", "turn", "initial", "blank", "duplicate", "truncated"))):
                if now is None or not _same_id(now.id, ident):
                    if now is not None:
                        out.append(now.end())
                    now = One(ident)
                now.row(*row)
            if len(out) >= 1000:
                yield flush()
        if now is not None:
            out.append(now.end())
            yield flush()
    return run


def _arrow_id(df: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema["id"].dataType)


def audits(rows: DataFrame) -> DataFrame:
    """Per conversation of ``turns``: (id, gaps, blank, duplicate, truncated, illegal, cost, audit)."""
    python_ready(rows.sparkSession)
    schema = T.StructType([rows.schema["id"], *[T.StructField(n, t) for n, t in _AUDIT]])
    return _streams(faults(rows), *ORDER).mapInArrow(_audit([n for n, _ in _AUDIT], _arrow_id(rows)), schema)


def _edited(id_type: pa.DataType):
    names = ["id", "place", "edit", "role", "text"]
    types = [id_type, pa.int64(), pa.string(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        ident, audit, at, state, place = None, "", 0, START, 0

        def put(edit, role, text, to):
            nonlocal state, place
            out.append((ident, place, edit, role, text))
            state, place = to, place + 1

        def insertions():
            nonlocal at
            while audit[at:at + 1] == INSERT:
                put(INSERT, ROLE[FREE[state]], "", FREE[state])
                at += 1

        def flush():
            rows = pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(zip(*out), types)], names=names)
            out.clear()
            return rows

        for batch in batches:
            for new, role, text, head in zip(*(batch.column(c).to_pylist() for c in ("id", "role", "text", "audit"))):
                if head is not None:                            # the audit comes before its conversation's rows
                    insertions()
                    ident, audit, at, state, place = new, head, 0, START, 0
                    continue
                insertions()
                edit = audit[at]
                at += 1
                if edit == KEEP:
                    put(KEEP, role, text, NEXT[state, role[:1]])
                elif edit == REROLE:
                    put(REROLE, ROLE[FREE[state]], text, FREE[state])
            if out:
                yield flush()
        insertions()
        if out:
            yield flush()
    return run


def repaired_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(id, place, edit, role, text): the rows of each conversation of ``turns`` after the edits of its audit in ``found``.
    A partition holds whole conversations, each in order."""
    python_ready(rows.sparkSession)
    heads = found.select("id", F.lit(0).alias("part"), *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in (*ORDER, "text")], "audit")
    body = rows.select("id", F.lit(1).alias("part"), *ORDER, "text", F.lit(None).cast("string").alias("audit"))
    schema = T.StructType([rows.schema["id"], T.StructField("place", T.LongType()), T.StructField("edit", T.StringType()),
                           T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    return _streams(heads.unionByName(body), "part", *ORDER).select("id", "role", "text", "audit").mapInArrow(_edited(_arrow_id(rows)), schema)


def _digests(id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, shas, sha = [], [], None
        for batch in batches:
            for ident, place, role, text in zip(*(batch.column(c).to_pylist() for c in ("id", "place", "role", "text"))):
                if place == 0:
                    if sha is not None:
                        shas.append(sha.hexdigest())
                    ids.append(ident)
                    sha = hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
        if sha is not None:
            shas.append(sha.hexdigest())
            yield pa.RecordBatch.from_arrays([pa.array(ids, type=id_type), pa.array(shas, pa.string())], names=["id", "sha"])
    return run


def digests(repaired: DataFrame) -> DataFrame:
    """(id, sha): the digest of ``role:text`` lines of each conversation of ``repaired_rows``, whose order it relies on."""
    return repaired.mapInArrow(_digests(_arrow_id(repaired)), T.StructType([repaired.schema["id"], T.StructField("sha", T.StringType())]))


def repair_conversations(table: DataFrame, ids: DataFrame | None = None, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """Per conversation: id, counts of faults, cost, audit, digest of the repaired rows.  ``ids`` names conversations that
    may have no rows: their counts are zero, audit and digest those of nothing."""
    rows = turns(table, id_col, turn_col, role_col, text_col)
    found = stored(audits(rows), "conversation-audits")
    sha = digests(repaired_rows(rows, found))
    every = (table if ids is None else ids).select(F.col(id_col).alias("key")).distinct()
    names = [n for n, _ in _AUDIT]
    out = every.join(found, F.col("key").eqNullSafe(F.col("id")), "left").select("key", *names)
    out = out.join(sha, F.col("key").eqNullSafe(F.col("id")), "left")
    return out.select(F.col("key").alias(id_col), *[F.coalesce(n, F.lit("" if n == "audit" else 0)).alias(n) for n in names],
                      F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def damage(table: DataFrame) -> DataFrame:
    """``conversations`` with faults made by the crc32 of ``conv_id:turn`` (nulls: one space), by its remainder of 20: 0 drops the
    row, 1 empties the text, 2 removes its ``.!?``, 3 repeats it, 4 makes it the user's."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    rows = table.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("kind")).where("kind != 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")
