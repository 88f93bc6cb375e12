"""Exact dedup by progressive refinement (DataFrame functions only).

Documents are grouped by length; those that share it, by the hash of a prefix; those that share
both, by the hash of the whole text.  Only members of a surviving group go on, so a text of a
length of its own costs one count.  Each level is one partially aggregated ``groupBy`` (a group
of any size reaches the shuffle as one row per task) and one equi-join of narrow key rows, which
AQE may split when a length or a prefix is hot; ``exact_dedup`` shuffles no texts.  ``keep_last_copies`` does once, to drop the rows
that go: its anti-join is a broadcast where the dropped keys are few enough for Spark's own threshold.

Defined results: a null text counts as empty; texts are equal when identical after lower-casing
A-Z only; of equal texts the row with the largest id stays (null ids rank lowest); rows that
repeat an id with the same text count in ``group_size`` and share its fate, with another text they are judged by that;
an empty table gives no rows;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PREFIX_CHARS = 256


def lower_az(text: Column) -> Column:
    """Lower-case A-Z only; in a pure ASCII text that is what ``lower`` does, and faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """Per row: id, keep_id, group_size, kept, text_sha256 of the normalised text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = stored(docs.select(
        F.col(id_col).alias("id"),
        F.octet_length(text).alias("size"),
        F.xxhash64(lower_az(F.substring(text, 1, prefix_chars))).alias("prefix"),
        # the digest is part of the result of every row, so the one scan that reads the text makes it
        F.sha2(lower_az(text), 256).alias("sha")), "dedup-keys")

    by_size = keys.groupBy("size").agg(F.count("*").alias("n")).where("n > 1").select("size")
    by_prefix = (keys.join(by_size, "size").groupBy("size", "prefix")
                 .agg(F.count("*").alias("n")).where("n > 1").select("size", "prefix"))
    groups = (keys.join(by_prefix, ["size", "prefix"]).groupBy("size", "prefix", "sha")
              .agg(F.count("*").alias("n"), F.max("id").alias("keep")).where("n > 1"))

    out = keys.join(groups, ["size", "prefix", "sha"], "left")
    keep = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep"))
    return out.select(
        F.col("id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        F.col("sha").alias("text_sha256"))


def keep_last_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.  A row goes by its id and its text: another text with the same id,
    or without one, is a document of its own."""
    gone = exact_dedup(docs, id_col, text_col).where(~F.col("kept")).select(
        F.col(id_col).alias("__gone"), F.col("text_sha256").alias("__sha")).distinct()
    sha = F.sha2(lower_az(F.coalesce(F.col(text_col), F.lit(""))), 256)
    return docs.join(gone, F.col(id_col).eqNullSafe(F.col("__gone")) & (sha == F.col("__sha")), "left_anti")
