"""Corpus pipeline: documents to packed training sequences, one operator a stage.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and returns the next stage's documents, with the
columns of ``documents`` (the last one returns the packing).  ``run`` writes each stage's result as Parquet to the folder that
all executors share and reads it again, so that a lost executor costs one stage's tasks at most; a stage's input and the tables that it
stored on its way are deleted when it is written.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from chartwise.llm import decontaminate, exact_dedup, ngram_join, packing, quality
from chartwise.llm.common import read, remove, shared_dir, stored_for


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject, unchanged."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal after lower-casing A-Z, the one with the largest id."""
    return exact_dedup.keep_last_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a Jaccard similarity of 0.8 or more over five-word shingles, the one with the least id."""
    return ngram_join.keep_one_of_each(docs, words=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the spans that benchmark items hold; mostly contaminated documents go."""
    return decontaminate.remove_contamination(docs, read(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens, placed in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", keep_quality),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    folder = os.path.join(shared_dir(spark), "corpus-pipeline", uuid.uuid4().hex)
    before = None
    for k, (name, stage) in enumerate(STAGES):
        path = os.path.join(folder, f"{k + 1}-{name}")
        with stored_for(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:                      # what the stage read is not needed again
            remove(spark, before)
        before = path
    return docs


QUERIES = {"pipeline": run}
#: a trained classifier, components of links and a packing: no SQL; tests/llm holds it against brute force
ORACLE_SQL = None
