"""Spelling variants against all words one edit away."""
import random

import numpy as np
import pytest

from chartwise.llm import queries, spelling
from chartwise.llm.common import read

from ..conftest import SF_SMALL
from . import brute
from .test_llm import frame

COLUMNS = ["form", "root", "n", "n_near", "form_n"]


def variants(df):
    return {r["word"]: tuple(r[c] for c in COLUMNS) for r in df.collect()}


def typos(seed=0):
    """Frequent words, rare variants of them, variants of variants, anagrams, and words of one letter."""
    rng = random.Random(seed)
    letters = "etaoinshrdlucmfßéÀz"
    words = {}
    for _ in range(40):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(7, 12)))
        words[w] = 400
        for _ in range(4):
            v = rng.choice(list(brute.edits(w, letters)))
            words[v] = rng.choice([2, 3, 30, 40])
            words[rng.choice(list(brute.edits(v, letters)))] = 2
        words["".join(rng.sample(w, len(w)))] = 3
    words |= {"a" * k: 2 + 3 * (k == 9) for k in range(7, 12)} | {"x" * 3000: 2, "x" * 2999 + "y": 2, "x" * 2999: 40}
    docs, bag = [], [w for w, n in words.items() for _ in range(n)]
    rng.shuffle(bag)
    for k in range(0, len(bag), 50):
        docs.append((k, rng.choice([" ", "-", "\n"]).join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in bag[k:k + 50])))
    return docs + [(7, None), (None, "Nullword nullword nullword"), (8, ""), (9, " 12 - "), docs[0], docs[0]]


def test_variants_match_all_edits(spark):
    docs = typos()
    want = brute.spelling(docs)
    assert sum(v[0] is not None for v in want.values()) > 20 and any(v[0] not in (None, v[1]) for v in want.values())
    assert variants(spelling.spelling_variants(frame(spark, docs))) == want


def test_variants_in_many_subtries_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 7)
    docs = typos(1)
    counts = spelling.word_counts(frame(spark, docs))
    assert spelling.key_levels(counts, 10) > 2
    got = {r["word"]: (r["n"], r["n_near"]) for r in spelling.near_words(counts, 10).collect()}
    assert got == {w: (v[2], v[3]) for w, v in brute.spelling(docs).items()}


def test_trie_search_reaches_each_vector_in_budget_once():
    rng = np.random.default_rng(3)
    vectors = rng.integers(0, 3, (300, spelling.N_GROUPS)) * (rng.random((300, spelling.N_GROUPS)) < 0.2)
    vectors = np.unique(np.concatenate([vectors, vectors[:100] + np.eye(spelling.N_GROUPS, dtype=int)[rng.integers(0, 5, 100)]]), axis=0)
    trie = spelling.CountTrie(vectors)
    met = [(int(q), int(np.flatnonzero(trie.leaf == leaf)[0])) for qs, leaves, _ in trie.search(vectors) for q, leaf in zip(qs, leaves)]
    want = set()
    for a, u in enumerate(vectors):
        for b, v in enumerate(vectors):
            d = v - u
            first = d[np.flatnonzero(d)[0]] if d.any() else 1
            if (d > 0).sum() <= 1 and (d < 0).sum() <= 1 and abs(d).max() <= 1 and first > 0:
                want.add((a, b))
    assert len(met) == len(set(met)) and set(met) == want


def test_variants_of_an_empty_table(spark):
    assert spelling.spelling_variants(frame(spark, [])).collect() == []


@pytest.mark.parametrize("sf", [SF_SMALL])
def test_query_on_the_supplied_documents(spark, sf):
    docs = [tuple(r) for r in read(spark, sf, "documents").select("doc_id", "text").collect()]
    assert variants(queries.op11_spelling(spark, sf)) == brute.spelling(docs)
