"""Conversation repair against a search over all edits."""
import itertools
import random

import pytest

from chartwise.llm import conversation_repair as cr
from chartwise.llm import queries
from chartwise.llm.common import read

from ..conftest import SF_SMALL
from . import brute

ROWS = "conv_id bigint, turn bigint, role string, text string, id int, hash string, part int, audit string"
COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "h", 2, "K") for r in rows], ROWS)


def got(df):
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in df.collect()}


def want(rows, ids=()):
    by = {i: [] for i in ids}
    for c, *r in rows:
        by.setdefault(c, []).append((r[0], " " if r[1] is None else r[1], " " if r[2] is None else r[2]))
    return {c: brute.conversation(r) for c, r in by.items()}


def talks(seed=0):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "What?", "", " \n", "é!", "Fine. \t", "x" * 70 + "a.", "x" * 70 + "b.", "two\nlines."]
    rows = []
    for c in range(150):
        for k in range(rng.randint(1, 9)):
            role = rng.choice(["system"] * (k == 0) + ["user", "assistant"] * 3 + ["tool", None, "", "usher"])
            rows.append((c, rng.choice([k, k, k, k + 1, None]), role, rng.choice([*texts, f"text {rng.random()}.", None])))
    rows += [(None, 0, "user", "Who?"), (None, None, "assistant", "Me."), (None, 7, None, None), (500, 3, "user", "z" * 100_000)]
    return rows + rows[:20]


def test_repair_matches_a_search(spark):
    rows = talks()
    assert got(cr.repair_conversations(frame(spark, rows))) == want(rows)


def test_every_short_conversation():
    kinds = [("system", "s."), ("user", "u."), ("assistant", "a."), ("user", "u"), ("assistant", ""), ("tool", "t.")]
    for n in range(5):
        for rows in itertools.product(kinds, repeat=n):
            todo = [(r, t, t == "", bool(t) and t[-1] != ".") for r, t in rows]
            cost, audit, _ = brute.cheapest_edits(todo)
            assert cr.repair([(r[0], must, cut) for r, _, must, cut in todo]) == (cost, audit)


def test_prefixes_are_compared_as_strings_also_when_hashes_collide(monkeypatch):
    rng = random.Random(5)
    for mod in (cr._MOD, 7, 1):
        monkeypatch.setattr(cr, "_MOD", mod)
        tree, nodes = cr.Prefixes(), [0]
        for _ in range(300):
            nodes.append(tree.add(rng.choice(nodes[-12:]), rng.choice("KKRDI")))
        for _ in range(2000):
            a, b = rng.choice(nodes), rng.choice(nodes)
            assert tree.less(a, b) == (tree.text(a) < tree.text(b))


def test_a_long_conversation_is_compacted_on_the_way(monkeypatch):
    rng = random.Random(6)
    rows = [(rng.choice("uaauas"), rng.random() < 0.1, rng.random() < 0.2) for _ in range(900)]
    whole = cr.repair(rows)
    for size in (1, 7, 50):
        monkeypatch.setattr(cr, "COMPACT", size)
        assert cr.repair(rows) == whole
    names = {"u": "user", "a": "assistant", "s": "system"}
    assert whole == brute.cheapest_edits([(names[i], "", must, cut) for i, must, cut in rows])[:2]


def test_dropped_and_empty(spark):
    rows = [(c, t, "user", "Hm.") for c in range(60) for t in range(2)]
    left = brute.damaged(rows)
    gone = set(range(60)) - {r[0] for r in left}
    assert gone or len(left) < len(rows) + 20
    table = frame(spark, rows)
    assert got(cr.repair_conversations(cr.damage(table), ids=table)) == want(left, range(60))
    assert cr.repair_conversations(frame(spark, [])).collect() == []


def test_damage(spark):
    rows = talks(3)
    out = sorted(map(tuple, cr.damage(frame(spark, rows)).collect()), key=repr)
    assert out == sorted(brute.damaged(rows), key=repr)


@pytest.mark.parametrize("sf", [SF_SMALL])
def test_query_on_the_supplied_conversations(spark, sf):
    rows = [tuple(r) for r in read(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.op13_conversation_repair(spark, sf)) == want(brute.damaged(rows), {r[0] for r in rows})
