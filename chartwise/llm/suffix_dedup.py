"""Suffix-array dedup: cut every byte covered by a string of ``LENGTH`` bytes that also starts earlier.

1. Anchors.  In each window of ``LENGTH`` bytes the least hash of its 32-byte grams picks an anchor, so equal windows
   pick equal anchors, wherever they are.  An anchor serves a run of neighbouring windows: its context.
2. Classes.  Anchors meet by gram; equal contexts form a class.  All but a class's first context are repeats as a whole.
   Each task sends a class at most one row; narrow rows, no text.
3. Windows.  Firsts of different classes of one gram may still share windows.  Their contexts are cut from the texts
   in halves, keyed by the bytes that all windows of the half share, trimmed to what occurs twice, and
   suffix-sorted by linear grouping (``suffix_groups``): windows that are equal are neighbours in the suffix order.
   The pieces of a core with more than ``MANY`` of them are not held: they are read as a stream and sent on as windows, keyed
   by their bytes on both sides of the core; of equal windows a chunk of the stream sends the first only.
4. The spans found are gathered by document and cut.

Every repeated string of ``LENGTH`` bytes is found, whatever its place; strings are judged on the input.

Defined results: a null text is empty; a text of fewer than ``LENGTH`` bytes keeps all; documents are told apart by id, so
of the rows that repeat one none is earlier than another at the same start: rows with the same text get equal results, which are
those of one such row, and each text of an id is cut by spans of its own (rows go by id and a 64-bit hash of the text); rows without an id are left whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mix, python_ready, row_steps, stored, text_bytes
from .suffix_groups import suffix_order

LENGTH, GRAM = 100, 32
WINDOWS = LENGTH - GRAM + 1                     # windows that a gram can be in
HALVES = ((0, (WINDOWS - 1) // 2), ((WINDOWS - 1) // 2 + 1, WINDOWS - 1))    # by the gram's place in the window
CHUNK_ROWS, CHUNK_SYMBOLS = 50_000, 200_000
MANY = 8_192                                    # pieces of one core that are suffix-sorted together
_SIDE = HALVES[0][1]                            # most bytes of a half on either side of its core
_PLACE = np.uint64((1 << 28) - 1)
_rng = np.random.default_rng(99)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = _rng.integers(1, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of each 32-byte gram, by doubling."""
    h, size, k = _BYTE[data], 1, 0
    while size < GRAM:
        h = h[:-size] * _STEP[k] + h[size:]
        size, k = 2 * size, k + 1
    return mix(h)


def _least(v: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    return np.minimum(v[:len(v) - (width - size)], v[width - size:]) if size < width else v


def anchors(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """Row, place, gram and context hash of each anchor; it serves the windows that start ``lo`` to ``hi`` bytes before it."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return {"row": none, "at": none, "lo": none, "hi": none, "key": none.astype(np.uint64), "ctx": none.astype(np.uint64)}
    h = gram_hashes(data)
    # ties go to the first: the place is part of what is compared
    least = _least((h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), WINDOWS)
    at = (least & _PLACE).astype(np.int64)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    start = np.flatnonzero(row[:len(at)] == row[LENGTH - 1:LENGTH - 1 + len(at)])
    at = at[start]
    new = np.ones(len(start), bool)
    new[1:] = (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    if not len(first):
        return anchors(data[:0], bounds[:1])
    begin, last, at = start[first], start[np.append(first[1:], len(start)) - 1], at[first]
    size = last + LENGTH - begin
    ctx = mix(((at - begin).astype(np.uint64) << np.uint64(16)) + size.astype(np.uint64))
    for off in range(0, 2 * LENGTH, GRAM):      # grams that cover the context, the last at its end
        ctx = mix(ctx * _STEP[6] + h[begin + np.minimum(off, size - GRAM)])
    return {"row": row[begin], "at": at - bounds[row[begin]], "lo": at - begin, "hi": at - last, "key": h[at], "ctx": ctx}


_ANCHOR = "id bigint, doc bigint, key bigint, ctx bigint, at int, lo int, hi int, repeat boolean"


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, docs = batch.column("id").to_numpy(), batch.column("doc").to_numpy()
        data, bounds = text_bytes(batch.column("text"))
        for first, last in row_steps(bounds):
            a = anchors(data[bounds[first]:bounds[last]], bounds[first:last + 1] - bounds[first])
            a |= {"id": ids[first + a["row"]], "doc": docs[first + a["row"]]}
            order = np.lexsort((a["doc"], a["at"], a["id"], a["ctx"], a["key"]))
            a = {k: v[order] for k, v in a.items()}
            new = np.ones(len(order), bool)
            new[1:] = (a["key"][1:] != a["key"][:-1]) | (a["ctx"][1:] != a["ctx"][:-1])
            # a row given twice is one
            once = new.copy()
            once[1:] |= (a["id"][1:] != a["id"][:-1]) | (a["at"][1:] != a["at"][:-1]) | (a["doc"][1:] != a["doc"][:-1])
            a, new = {k: v[once] for k, v in a.items()}, new[once]
            head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            again = (a["id"] != a["id"][head]) | (a["at"] != a["at"][head])
            # a repeat is settled here: a key of its own keeps it away from the gram's other holders
            own = mix(a["id"].view(np.uint64)) + a["doc"].view(np.uint64)
            key = np.where(again, mix(a["key"] + own * _STEP[5] + a["at"].astype(np.uint64)), a["key"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(a["id"]), pa.array(a["doc"]), pa.array(key.view(np.int64)), pa.array(a["ctx"].view(np.int64)),
                 *[pa.array(a[c].astype(np.int32)) for c in ("at", "lo", "hi")], pa.array(again)],
                names=["id", "doc", "key", "ctx", "at", "lo", "hi", "repeat"])


_FOUND = "wanted boolean, key bigint, id bigint, doc bigint, at int, lo int, hi int"


def _chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (key, ctx, id, at, doc): repeats, and (wanted) the firsts of the classes of grams with several.

    Rows with the id and the place of their class's first row are firsts too, no repeats; each doc is one of them once.
    Of the gram at the end of a chunk only what the next chunk must know is held: its last class and that class's first and
    last row, whether it has had several, and its only class's firsts while they may still be wanted.  The latter are of one
    id and place; above ``CHUNK_ROWS`` of them they are passed on as wanted, which costs work but changes no result.
    """
    key0 = ctx0 = pending = lead = tail = None
    several = False
    for table in _chunks(batches, CHUNK_ROWS):
        c = {k: table.column(k).to_numpy() for k in table.column_names}
        c.setdefault("doc", c["id"])
        settled = {k: v[c["repeat"]] for k, v in c.items()}
        c = {k: v[~c["repeat"]] for k, v in c.items()}
        n = len(c["key"])
        if not n:
            yield _found(np.zeros(len(settled["key"]), bool), settled)
            continue
        new_key = np.ones(n, bool)
        new_key[1:] = c["key"][1:] != c["key"][:-1]
        new_key[0] = key0 is None or c["key"][0] != key0
        new_ctx = new_key.copy()
        new_ctx[1:] |= c["ctx"][1:] != c["ctx"][:-1]
        new_ctx[0] |= ctx0 is None or c["ctx"][0] != ctx0
        head = np.maximum.accumulate(np.where(new_ctx, np.arange(n), -1))
        lead_id = np.where(head < 0, lead[0] if lead else 0, c["id"][head])
        lead_at = np.where(head < 0, lead[1] if lead else 0, c["at"][head])
        is_first = (c["id"] == lead_id) & (c["at"] == lead_at)
        twice = np.zeros(n, bool)                                    # the same row, from another task
        twice[1:] = ~new_ctx[1:] & (c["id"][1:] == c["id"][:-1]) & (c["at"][1:] == c["at"][:-1]) & (c["doc"][1:] == c["doc"][:-1])
        twice[0] = not new_ctx[0] and tail == (c["id"][0], c["at"][0], c["doc"][0])
        group = np.cumsum(new_key) - (1 if new_key[0] else 0)        # 0: the held gram goes on
        classes = np.bincount(group[new_ctx], minlength=int(group[-1]) + 1)
        if not new_key[0]:
            classes[0] += 2 if several else 1
        first = np.flatnonzero(is_first & ~twice & (classes[group] > 1))
        rest = np.flatnonzero(~is_first & ~twice)
        names = ("key", "id", "doc", "at", "lo", "hi")
        parts = [({k: settled[k] for k in names}, False), ({k: c[k][rest] for k in names}, False), ({k: c[k][first] for k in names}, True)]
        if pending is not None and not new_key[0] and classes[0] > 1:
            parts.append((pending, True))
            pending = None
        if new_key.any():
            pending = None
        key0, ctx0, several = c["key"][-1], c["ctx"][-1], bool(classes[group[-1]] > 1)
        lead, tail = (lead_id[-1], lead_at[-1]), (c["id"][-1], c["at"][-1], c["doc"][-1])
        if several:
            pending = None
        else:
            own = np.flatnonzero((group == group[-1]) & is_first & ~twice)
            more = {k: c[k][own] for k in names}
            pending = more if pending is None else {k: np.concatenate([pending[k], more[k]]) for k in names}
            if len(pending["key"]) > CHUNK_ROWS and len(pending["key"]) > 1:
                parts.append((pending, True))
                pending, several = None, True
        yield _found(np.concatenate([np.full(len(p["key"]), w) for p, w in parts]),
                     {k: np.concatenate([p[k] for p, _ in parts]) for k in names})


def _found(wanted: np.ndarray, out: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(wanted), *[pa.array(out[x], pa.int64()) for x in ("key", "id", "doc")],
         *[pa.array(out[x].astype(np.int32)) for x in ("at", "lo", "hi")]],
        names=["wanted", "key", "id", "doc", "at", "lo", "hi"])


_PIECE = "core bigint, half int, id bigint, doc bigint, at int, l1 int, l2 int, left binary, right binary"


def _cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Halves of the wanted contexts.  ``left`` runs from the core outwards, ``right`` likewise."""
    last = None
    for batch in batches:
        out: list[list] = [[] for _ in range(9)]
        for own, doc, text, wanted in zip(*(batch.column(k).to_pylist() for k in ("id", "doc", "text", "wanted"))):
            if (own, doc) == last:                              # the same row again
                continue
            last = own, doc
            raw = text.encode()
            for w in wanted:
                a = w["at"]
                for half, (h0, h1) in enumerate(HALVES):
                    l1, l2 = max(w["hi"], h0), min(w["lo"], h1)
                    if l1 > l2:
                        continue
                    core = hashlib.blake2b(raw[a - h0:a - h1 + LENGTH], digest_size=8, salt=w["key"].to_bytes(8, "little", signed=True)).digest()
                    for column, value in zip(out, (int.from_bytes(core, "little", signed=True), half, own, doc, a, l1, l2,
                                                   raw[a - l2:a - h0][::-1], raw[a - h1 + LENGTH:a - l1 + LENGTH])):
                        column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(),
                                                  pa.binary(), pa.binary()))],
            names=["core", "half", "id", "doc", "at", "l1", "l2", "left", "right"])


def _shared_extent(group: np.ndarray, side: list[bytes]) -> np.ndarray:
    """How many bytes outwards from the core a piece shares with another piece of its group."""
    m = len(side)
    size = np.fromiter(map(len, side), np.int64, m)
    wide = np.zeros((m, 8 + _SIDE), np.uint8)
    wide[:, :8] = group.astype(">u8").view(np.uint8).reshape(m, 8)
    flat = np.frombuffer(b"".join(side), np.uint8)
    r = np.repeat(np.arange(m), size)
    wide[r, 8 + np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    order = np.lexsort(wide.T[::-1]) if m < 2 else np.argsort(np.ascontiguousarray(wide).view(f"S{8 + _SIDE}").ravel(), kind="stable")
    like = (wide[order][1:] == wide[order][:-1]).cumprod(axis=1).sum(axis=1) - 8
    out = np.full(m, -1, np.int64)
    out[order[1:]] = like
    out[order[:-1]] = np.maximum(out[order[:-1]], like)
    return np.minimum(out, size)


def _equal_windows(rows: list[tuple]) -> dict[int, list[int]]:
    """``rows``: (number, group, half, l1, l2, left, right), numbered in order of (group, id, at), equal ones by the same number of
    their place.  For each row (by its place in ``rows``), the windows that an earlier row of its group has too, found as neighbours in the suffix order of all pieces."""
    parts, owner, place = [], [], []
    numbers = np.array([r[0] for r in rows])
    for at, (_, group, half, l1, l2, left, right) in enumerate(rows):
        symbols = np.empty(len(left) + len(right) + 2, np.int64)
        symbols[:len(left)] = np.frombuffer(left, np.uint8)[::-1]
        symbols[len(left)] = 256 + group                         # the core as one symbol of its group
        symbols[len(left) + 1:-1] = np.frombuffer(right, np.uint8)
        symbols += 2
        symbols[-1] = 1                                          # ends a piece
        parts.append(symbols)
        starts = np.full(len(symbols), -1, np.int64)
        starts[:l2 - l1 + 1] = np.arange(l2, l1 - 1, -1)
        owner.append(np.full(len(symbols), at, np.int64))
        place.append(starts)
    half = rows[0][2]
    width = HALVES[half][1] - HALVES[half][0] + 1                # symbols of a window
    text = np.concatenate([*parts, [0]])
    owner_of, l_of = np.append(np.concatenate(owner), -1), np.append(np.concatenate(place), -1)
    order = suffix_order(text)
    order = order[l_of[order] >= 0]
    window = text[order[:, None] + np.arange(width)]
    same = (window[1:] == window[:-1]).all(axis=1)
    block = np.concatenate([[0], np.cumsum(~same)])
    number = numbers[owner_of[order]]
    least = np.full(block[-1] + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, block, number)
    found: dict[int, list[int]] = {}
    for k in np.flatnonzero(number != least[block]):
        found.setdefault(int(owner_of[order[k]]), []).append(int(l_of[order[k]]))
    return found


_SPAN = "core bigint, l int, win bigint, id bigint, doc bigint, start int, end int"


def _shared_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (core, half, id, at, doc): spans of windows that an earlier piece of the same core has too, and (``win``
    is not null) the windows of cores with more than ``MANY`` pieces, still to be compared.  Held are at most that many."""
    held, hot = None, None
    for table in _chunks(batches, CHUNK_ROWS):
        table = pa.concat_tables([held, table]) if held is not None else table
        core = table.column("core").to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(core[1:] != core[:-1]) + 1, [len(core)]])
        size = np.diff(cuts)
        many = (size > MANY) | ((core[cuts[:-1]] == hot) if hot is not None else False)
        hot = core[-1] if many[-1] else None
        end = len(core) if many[-1] else int(cuts[-2])         # the last core may go on
        held = table.slice(end)
        few = np.flatnonzero(np.repeat(~many, size)[:end])
        if len(few):
            yield _solve(table.take(pa.array(few)) if many.any() else table.slice(0, end))
        for k in np.flatnonzero(many):
            yield from _windows(table.slice(int(cuts[k]), int(size[k])))
    if held is not None and held.num_rows:
        yield _solve(held)


def _windows(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Pieces of one core as windows: spans of those that earlier pieces of the table have too, and the others by their bytes."""
    c = {k: table.column(k).to_numpy() for k in ("core", "half", "id", "doc", "at", "l1", "l2")}
    m = len(c["core"])
    sides = []                                                 # hash of a side's first k bytes, for each k
    for name, odd in (("left", _STEP[0]), ("right", _STEP[1])):
        side = table.column(name).to_pylist()
        size = np.fromiter(map(len, side), np.int64, m)
        flat = np.frombuffer(b"".join(side), np.uint8)
        k = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        value = np.zeros((m, 1 + _SIDE), np.uint64)
        value[np.repeat(np.arange(m), size), k + 1] = mix(_BYTE[flat] + k.astype(np.uint64) * odd)
        sides.append(np.cumsum(value, axis=1, dtype=np.uint64))
    n = (c["l2"] - c["l1"] + 1).astype(np.int64)
    row = np.repeat(np.arange(m), n)
    l = c["l1"][row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    h0, h1 = (np.array([h[k] for h in HALVES])[c["half"][row]] for k in (0, 1))
    win = mix(mix(sides[0][row, l - h0]) * _STEP[2] + sides[1][row, h1 - l])
    start = c["at"][row] - l
    order = np.lexsort((c["doc"][row], start, c["id"][row], win, l))
    row, l, win, start = row[order], l[order], win[order], start[order]
    new = np.ones(len(row), bool)
    new[1:] = (l[1:] != l[:-1]) | (win[1:] != win[:-1])
    head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    later = (c["id"][row] != c["id"][row[head]]) | (start != start[head])
    low, high = np.full(m, LENGTH), np.full(m, -1)             # a piece's windows overlap: one span
    np.minimum.at(low, row[later], l[later])
    np.maximum.at(high, row[later], l[later])
    some = np.flatnonzero(high >= 0)
    yield _spans(None, c["id"][some], c["doc"][some], c["at"][some] - high[some], c["at"][some] - low[some] + LENGTH)
    row, l, win, start = row[~later], l[~later], win[~later], start[~later]
    for k in range(0, len(row), CHUNK_ROWS):
        x = slice(k, k + CHUNK_ROWS)
        yield _spans((c["core"][row[x]], l[x], win[x].view(np.int64)), c["id"][row[x]], c["doc"][row[x]], start[x], start[x] + LENGTH)


def _spans(key, ids, docs, start, end) -> pa.RecordBatch:
    key = key or [pa.nulls(len(ids))] * 3
    return pa.RecordBatch.from_arrays([pa.array(v, t) if not isinstance(v, pa.Array) else v.cast(t) for v, t in zip(
        (*key, ids, docs, start, end), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
        names=["core", "l", "win", "id", "doc", "start", "end"])


def _later_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows in order of (core, l, win, id, start): the spans of all but those with the id and place of the first.  One
    window's first is held, whatever their number."""
    lead = None
    for batch in batches:
        key = [batch.column(k).to_numpy() for k in ("core", "l", "win")]
        ids, start = batch.column("id").to_numpy(), batch.column("start").to_numpy()
        if not len(ids):
            continue
        new = np.ones(len(ids), bool)
        new[1:] = np.any([k[1:] != k[:-1] for k in key], axis=0)
        new[0] = lead is None or lead[0] != tuple(k[0] for k in key)
        head = np.maximum.accumulate(np.where(new, np.arange(len(ids)), -1))
        lead_id = np.where(head < 0, lead[1] if lead else 0, ids[head])
        lead_start = np.where(head < 0, lead[2] if lead else 0, start[head])
        lead = tuple(k[-1] for k in key), lead_id[-1], lead_start[-1]
        yield batch.select(["id", "doc", "start", "end"]).filter(pa.array((ids != lead_id) | (start != lead_start)))


def _solve(table: pa.Table) -> pa.RecordBatch:
    c = {k: table.column(k).to_numpy() for k in ("core", "half", "id", "doc", "at", "l1", "l2")}
    n = len(c["core"])
    new = np.ones(n, bool)
    new[1:] = (c["core"][1:] != c["core"][:-1]) | (c["half"][1:] != c["half"][:-1])
    group = np.cumsum(new) - 1
    keep = np.flatnonzero(np.bincount(group)[group] > 1)
    spans: list[tuple[int, int, int, int]] = []

    def add(k: int, low: int, high: int) -> None:
        spans.append((int(c["id"][k]), int(c["doc"][k]), int(c["at"][k]) - high, int(c["at"][k]) - low + LENGTH))

    if len(keep):
        small = table.take(pa.array(keep))
        left, right = small.column("left").to_pylist(), small.column("right").to_pylist()
        c, group = {k: v[keep] for k, v in c.items()}, group[keep]
        h0 = np.array([h[0] for h in HALVES])[c["half"]]
        h1 = np.array([h[1] for h in HALVES])[c["half"]]
        far_left, far_right = _shared_extent(group, left), _shared_extent(group, right)
        l1, l2 = np.maximum(c["l1"], h1 - far_right), np.minimum(c["l2"], h0 + far_left)
        step = np.ones(len(group), bool)                        # rows of one id and place have one number
        step[1:] = (group[1:] != group[:-1]) | (c["id"][1:] != c["id"][:-1]) | (c["at"][1:] != c["at"][:-1])
        number = np.cumsum(step)
        seen: dict[tuple, int] = {}
        twins: dict[int, list[int]] = {}
        rows: dict[int, list[tuple]] = {0: [], 1: []}
        for k in np.flatnonzero(l1 <= l2).tolist():
            a, b, g = int(l1[k]), int(l2[k]), int(group[k])
            piece = (g, a, b, left[k][:b - int(h0[k])], right[k][:int(h1[k]) - a])
            head = seen.setdefault(piece, k)
            if number[head] != number[k]:                       # equal after trimming: a repeat as a whole
                add(k, a, b)
            elif head != k:                                     # another text of the same id: as its first
                twins.setdefault(head, []).append(k)
            else:
                rows[int(c["half"][k])].append((int(number[k]), g, int(c["half"][k]), *piece[1:], k))
        for some in rows.values():
            alone = {}
            for r in some:
                alone[r[1]] = alone.get(r[1], 0) + 1
            some = [r for r in some if alone[r[1]] > 1]
            begin = 0
            while begin < len(some):                            # whole groups, about CHUNK_SYMBOLS at a time
                end, size, g = begin, 0, -1
                while end < len(some) and (size < CHUNK_SYMBOLS or some[end][1] == g):
                    g = some[end][1]
                    size += len(some[end][5]) + len(some[end][6]) + 2
                    end += 1
                for at, ls in _equal_windows([r[:-1] for r in some[begin:end]]).items():
                    k = some[begin + at][-1]
                    for twin in (k, *twins.get(k, ())):
                        add(twin, min(ls), max(ls))
                begin = end
    return _spans(None, *([s[k] for s in spans] for k in range(4)))


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s in sorted((s["start"], s["end"]) for s in spans):
        if out and s[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s[1])
        else:
            out.append(list(s))
    return [(s, e) for s, e in out]


def _cut(with_kept: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, removed, runs, sha, kept = [], [], [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                raw, merged = (text or "").encode(), _merged(spans or [])
                at, rest = 0, []
                for s, e in merged:
                    rest.append(raw[at:s])
                    at = e
                left = b"".join([*rest, raw[at:]])
                n.append(len(raw))
                removed.append(len(raw) - len(left))
                runs.append(len(merged))
                sha.append(hashlib.sha256(left).hexdigest())
                kept.append(left)
            columns = [batch.column("id"), *[pa.array(v, pa.int64()) for v in (n, removed, runs)], pa.array(sha, pa.string())]
            names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_kept:
                columns, names = [*columns, pa.array(kept, pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, doc, start, end): byte spans of repeated strings, ``doc`` the hash of the text; spans of one text may overlap."""
    python_ready(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("doc")).where(
        F.col("id").isNotNull() & (F.octet_length("text") >= LENGTH))
    rows = texts.mapInArrow(_anchor_rows, _ANCHOR)
    found = stored(rows.repartition("key").sortWithinPartitions("key", "ctx", "id", "at", "doc")
                   .mapInArrow(_classes, _FOUND), "suffix-classes")
    whole = found.where(~F.col("wanted")).select(
        "id", "doc", (F.col("at") - F.col("lo")).alias("start"), (F.col("at") - F.col("hi") + LENGTH).alias("end"))
    wanted = found.where("wanted").groupBy("id", "doc").agg(F.collect_set(F.struct("key", "at", "lo", "hi")).alias("wanted"))
    pieces = texts.join(wanted, ["id", "doc"]).mapInArrow(_cut_pieces, _PIECE)
    partly = stored(pieces.repartition("core").sortWithinPartitions("core", "half", "id", "at", "doc")
                    .mapInArrow(_shared_windows, _SPAN), "suffix-windows")
    late = (partly.where("win is not null").repartition("core", "l", "win").sortWithinPartitions("core", "l", "win", "id", "start", "doc")
            .mapInArrow(_later_windows, "id bigint, doc bigint, start int, end int"))
    settled = partly.where("win is null").select("id", "doc", "start", "end")
    return stored(whole.unionByName(settled).unionByName(late), "suffix-spans")


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = False) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the ``kept`` bytes."""
    spans = repeated_spans(docs, id_col, text_col).groupBy("id", "doc").agg(
        F.collect_set(F.struct("start", "end")).alias("spans"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("doc")).join(
        spans, ["id", "doc"], "left")
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
                           T.StructField("kept_sha256", T.StringType())])
    if with_kept:
        schema = schema.add("kept", T.BinaryType())
    return rows.mapInArrow(_cut(with_kept), schema).withColumnRenamed("id", id_col)
