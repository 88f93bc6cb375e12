"""Repeated word windows against a dictionary of all windows."""
import random

import numpy as np
import pytest

from chartwise.llm import queries, window_dedup
from chartwise.llm.common import read

from ..conftest import SF_SMALL
from . import brute
from .test_llm import frame, some_texts


def cut(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()), key=repr)


def passages(seed=0):
    """Passages of 34, 35 and more words in differing surroundings, periodic and very long texts, nulls and repeated rows."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    words = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    shared = [words(n) for n in (34, 35, 36, 60, 200)]
    docs = some_texts(seed)
    for k in range(40):
        w = words(rng.randint(0, 40))
        for _ in range(rng.randint(1, 3)):
            p = rng.choice(shared)
            cut_at = rng.choice([0, 0, 1, 30])
            w += p[cut_at:] + words(rng.randint(0, 20))
        docs.append((1000 + k, rng.choice([" ", "\n", " \t "]).join(w)))
    docs += [(2000, " ".join(["a"] * 100)), (2001, "a b " * 30), (2002, " ".join(["a"] * 35)), (2003, "z " * 36)]
    docs += [(None, docs[-5][1]), (None, "only " + " ".join(words(50))), (None, None), docs[5], docs[60], docs[60]]
    docs.append((3000, " ".join(words(3000) + shared[4] + words(3000) + shared[4][:35])))
    return docs


def test_cut_matches_all_windows(spark):
    docs = passages()
    want = sorted(brute.cut_windows(docs), key=repr)
    assert sum(0 < r[2] < r[1] for r in want) > 30
    assert cut(window_dedup.cut_repeated_windows(frame(spark, docs))) == want


def test_cut_with_a_saturated_sketch_and_small_steps(spark, monkeypatch):
    monkeypatch.setattr(window_dedup, "PENDING", 10)
    docs = passages(1)
    rows = frame(spark, docs).repartition(7)
    assert window_dedup.repeated_cells(rows, cells=2 * window_dedup.BLOCK).any()
    out = window_dedup.cut_repeated_windows(rows, cells=2 * window_dedup.BLOCK, with_kept=True)
    assert cut(out) == sorted(brute.cut_windows(docs), key=repr)
    assert all(brute.sha(r["kept"]) == r["kept_sha256"] for r in out.collect())


def test_sketch_never_gives_less_than_the_count(spark):
    docs = passages(2)
    bits = window_dedup.repeated_cells(frame(spark, docs).repartition(5))
    count = {}
    for _, t in docs:
        data = (t or "").encode()
        for a in window_dedup.Stretches(np.frombuffer(data, np.uint8), np.array([0, len(data)])).anchor.tolist():
            count[a] = count.get(a, 0) + 1
    anchors = np.array(list(count), np.uint64)
    maybe = window_dedup._maybe_repeated(anchors, bits)
    assert maybe[np.array(list(count.values())) > 1].all() and not maybe.all()


def test_stretches_do_not_depend_on_their_step():
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["ab", "c", "é", "ddd"]) for _ in range(n)).encode() for n in (0, 34, 35, 90, 1, 200)]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    whole = window_dedup.Stretches(np.frombuffer(b"".join(texts), np.uint8), bounds)
    assert whole.n_words.tolist() == [len(t.split()) for t in texts]
    every = np.arange(len(whole.n))
    rows = list(zip(whole.row.tolist(), whole.start.tolist(), whole.n.tolist(), whole.anchor.tolist(), whole.hashes(every).tolist(),
                    whole.windows(every)))
    alone = []
    for k, t in enumerate(texts):
        s = window_dedup.Stretches(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        some = np.arange(len(s.n))
        if len(some):
            alone += zip([k] * len(some), s.start.tolist(), s.n.tolist(), s.anchor.tolist(), s.hashes(some).tolist(), s.windows(some))
    assert rows == alone and sum(r[2] for r in rows) == sum(max(0, len(t.split()) - 34) for t in texts)


def test_cut_of_an_empty_table(spark):
    assert window_dedup.cut_repeated_windows(frame(spark, [])).collect() == []


@pytest.mark.parametrize("sf", [SF_SMALL])
def test_query_on_the_supplied_documents(spark, sf):
    docs = [tuple(r) for r in read(spark, sf, "documents").select("doc_id", "text").collect()]
    assert cut(queries.op12_window_dedup(spark, sf)) == sorted(brute.cut_windows(docs), key=repr)
