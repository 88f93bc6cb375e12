"""Held-out quality of the learned operators on the supplied tables, and the bounds of their samples."""
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chartwise.llm import language, pu, quality, queries, secrets, toxicity
from chartwise.llm.common import read

from .test_llm import frame

SF = "/root/testdata/sf0.1"


def held_out(spark, query, label):
    scored = query(spark, SF).where("held_out").join(read(spark, SF, "labels").select("doc_id", label), "doc_id")
    rows = scored.where(F.col(label).isNotNull()).select("score", "predicted", label).collect()
    right = sum(r["predicted"] == r[label] for r in rows) / len(rows)
    ones, zeros = ([r["score"] for r in rows if r[label] == k] for k in (1, 0))
    auc = sum((a > b) + (a == b) / 2 for a in ones for b in zeros) / (len(ones) * len(zeros))
    return right, auc


@pytest.mark.parametrize("query, label, right, auc", [(queries.op1_quality, "quality", 0.99, 0.995), (queries.op8_toxicity, "toxic", 0.96, 0.95)])
def test_held_out_labels(spark, query, label, right, auc):
    got = held_out(spark, query, label)
    assert got[0] >= right and got[1] >= auc


def test_held_out_languages(spark):
    out = queries.op10_language_id(spark, SF).where("held_out").join(read(spark, SF, "documents").select("doc_id", "lang"), "doc_id")
    rows = out.where("lang is not null").select("lang", "lang_pred").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.99 * len(rows)


@pytest.mark.parametrize("share", [0.1, 0.5, 0.9])
def test_the_prior_is_estimated_without_negatives(share):
    rng = np.random.default_rng(5)
    text = lambda y, k: f"{k} " + " ".join(rng.choice(["fine", "calm"] if y else ["vile", "foul"], 6)) + " of all"
    rows = [(1, text(1, k)) for k in range(500)] + [(0, text(rng.random() < share, 1000 + k)) for k in range(2000)]
    model = toxicity.train([f for f, _ in rows], pa.array([t for _, t in rows]))
    assert abs(model["prior"] - share) < 0.05


def test_priors_of_samples_without_positives_or_unlabelled():
    few = pa.array(["a good text", "another text", ""])
    assert toxicity.train([0, 0, 0], few)["prior"] == quality.train([0, 0, 0], few)["prior"] == pu.PRIORS[0]
    assert toxicity.train([1, 1, 1], few)["prior"] == 0.5 and quality.train([], pa.array([], pa.string()))["prior"] == pu.PRIORS[0]
    assert pu.PRIORS[0] <= quality.train([1, 0, 0], few)["prior"] <= pu.PRIORS[1]


def labels(spark, n):
    return spark.createDataFrame([(k, k % 2, k % 2) for k in range(n)], "doc_id bigint, quality int, toxic int")


def test_a_repeated_id_is_one_row_of_the_sample(spark):
    docs = [(k, f"text {k} {'good' if k % 2 else 'bad'}") for k in range(60)] + [(7, f"again {k % 50}") for k in range(400)]
    sample = pu.training_sample(frame(spark, docs), labels(spark, 60), "quality", "doc_id", "text", 5, 10, 20)
    rows = sample.collect()
    assert len(rows) <= 30 and len({(r["id"], r["flag"]) for r in rows}) == len(rows)
    assert [r["text"] for r in rows if r["id"] == 7] in ([], ["again 0"], ["again 0"] * 2)


def test_languages_are_learned_from_the_same_rows_each_time(spark):
    docs = spark.createDataFrame([(k % 40, f"wort {k} und" if k % 2 else f"word {k} the", "de" if k % 2 else "en") for k in range(900)],
                                 "doc_id bigint, text string, lang string")
    first, again = ({(r["doc_id"], r["score"]) for r in language.identify(d, sample=20).collect()} for d in (docs, docs.repartition(5)))
    assert first == again


def test_owners_and_repositories_both_decide(spark):
    token = lambda c: "ghp_" + (c + "Bc3") * 9
    rows = [(3 * k, f"x {token('a')}") for k in range(20)]                  # one owner, twenty repositories: an example
    rows += [(301 + k, f"y {token('d')}") for k in range(2)]                # two owners: an example
    rows += [(600, f"z {token('e')}"), (600, f"z {token('e')}"), (603, token("e"))]     # one owner, two repositories: live
    rows += [(None, f"n {token('f')}"), (None, "")]
    out = secrets.span_digests(secrets.scan_secrets(frame(spark, rows)))
    got = sorted(((r["doc_id"], r["n_live"]) for r in out.collect()), key=repr)
    assert got == sorted([*((3 * k, 0) for k in range(20)), (301, 0), (302, 0), (600, 1), (600, 1), (603, 1), (None, 1), (None, 0)], key=repr)
