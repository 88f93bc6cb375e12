"""Plain versions of the operators, row by row."""
import hashlib
import re
import zlib


def lower_az(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


class Union:
    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower_az(text))
    return {tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()


def jaccard_components(docs, words, percent):
    sets = {i: shingles(t, words) for i, t in docs}
    union = Union(sets)
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                union.join(a, b)
    return {i: (len(sets[i]), union.find(i)) for i in ids}


def contamination(docs, items, window=10):
    word = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for i, t in items:
        w = word.findall(lower_az(t))
        k = min(window, len(w))
        for a in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[a:a + k]), set()).add("" if i is None else str(i))
    sizes = {len(x) for x in windows}
    out = {}
    for i, t in docs:
        w = word.findall(lower_az(t))
        hit, found = set(), set()
        for k in sizes:
            for a in range(len(w) - k + 1):
                owners = windows.get(tuple(w[a:a + k]))
                if owners:
                    found |= owners
                    hit.update(range(a, a + k))
        out[i] = (len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit))
    return out


def secrets(docs):
    key = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k)
                   for k in ("password", "passwd", "secret", "token", "api_?key"))
    assign = re.compile(rf"""({key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = {}
    for i, t in docs:
        t = t or ""
        found = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        text = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(found))
        out[i] = (*[sum(k == x for _, x, _ in found) for k in range(3)], sha(text))
    return out


def repeated_bytes(docs, length=100):
    seen, out = set(), {}
    for i, t in sorted(docs):
        raw = (t or "").encode()
        cut = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            s = raw[p:p + length]
            if s in seen:
                cut[p:p + length] = b"\x01" * length
            seen.add(s)
        runs = len(re.findall(b"\x01+", bytes(cut)))
        out[i] = (len(raw), sum(cut), runs, sha(bytes(b for b, c in zip(raw, cut) if not c)))
    return out


def exact_groups(docs):
    groups = {}
    for i, t in docs:
        groups.setdefault(lower_az(t), []).append(i)
    return {i: (max(g), len(g), i == max(g), sha(t)) for t, g in groups.items() for i in g}


def held_out(i, parts, remainder):
    return zlib.crc32(str(i).encode()) % parts == remainder


def edits(word, letters):
    """All words one edit from ``word``."""
    for k in range(len(word) + 1):
        for c in letters:
            yield word[:k] + c + word[k:]
            if k < len(word):
                yield word[:k] + c + word[k + 1:]
        if k < len(word):
            yield word[:k] + word[k + 1:]


def spelling(docs, factor=10):
    """word: (form, root, n, n_near, form_n)"""
    n = {}
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = lower_az(run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] = n.get(w, 0) + 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    letters = sorted(set("".join(n)))
    near = {w: {x for x in edits(w, letters) if x in n and x != w} for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {w: (form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def cut_windows(docs, window=35):
    """Per row: (n_words, n_removed, sha of the kept words)."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    seen = {}
    for w in words:
        for a in range(len(w) - window + 1):
            seen[tuple(w[a:a + window])] = seen.get(tuple(w[a:a + window]), 0) + 1
    out = []
    for (i, _), w in zip(docs, words):
        keep = [True] * len(w)
        for a in range(len(w) - window + 1):
            if seen[tuple(w[a:a + window])] > 1:
                keep[a:a + window] = [False] * window
        kept = [x for x, k in zip(w, keep) if k]
        out.append((i, len(w), len(w) - len(kept), sha(" ".join(kept))))
    return out


def damaged(rows):
    """rows of (conv, turn, role, text) after damage"""
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(c, t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest_edits(rows):
    """(cost, audit, repaired rows) by trying all edits, cheapest and least first; rows are (role, text, must go, truncated)."""
    import heapq
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, k, roles, kept = heapq.heappop(heap)
        state = roles[-1:]
        if (k, state, bool(roles)) in seen:
            continue
        seen.add((k, state, bool(roles)))
        if k == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, kept
        goes = lambda i: i in {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        for role in ("user", "assistant"):
            if goes(role[0]):
                heapq.heappush(heap, (cost + 2, audit + "I", k, roles + role[0], (*kept, (role, ""))))
        if k < len(rows):
            role, text, must, cut = rows[k]
            heapq.heappush(heap, (cost + 3, audit + "D", k + 1, roles, kept))
            if not must:
                if role[:1] and goes(role[:1]):
                    heapq.heappush(heap, (cost + cut, audit + "K", k + 1, roles + role[0], (*kept, (role, text))))
                for to in ("user", "assistant"):
                    if goes(to[0]):
                        heapq.heappush(heap, (cost + 2 + cut, audit + "R", k + 1, roles + to[0], (*kept, (to, text))))


def conversation(rows):
    """Result of one conversation of (turn, role, text) rows."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    t = [r[0] for r in rows if r[0] is not None]
    counts, todo, seen = [0, 0, 0], [], set()
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = 0 if not solid else 1 if (role, text) in seen else 2 if solid[-1] not in ".!?" else 3
        seen.add((role, text))
        if fault < 3:
            counts[fault] += 1
        todo.append((role, text, fault < 2, fault == 2))
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    cost, audit, kept = cheapest_edits(todo)
    return (max(t) - min(t) + 1 - len(set(t)) if t else 0, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            sha("\n".join(f"{r}:{x}" for r, x in kept)))
