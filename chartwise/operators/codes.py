"""Code and label operators (P22-P24, P27): diagnosis flags from ICD prefix rules, keyword classes, label synonyms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_any


def rule_matches(code: Column, version: Column, clauses: Sequence[tuple]) -> Column:
    """OR over clauses (icd_version, prefix_len, 'in' | 'between', values)."""
    out = None
    for ver, n, kind, values in clauses:
        prefix = F.substring(code, 1, n)
        test = prefix.isin(list(values)) if kind == "in" else prefix.between(values[0], values[1])
        c = (version == ver) & test
        out = c if out is None else (out | c)
    return out


def code_flags(anchor: DataFrame, dx: DataFrame, key: str, rules: Mapping[str, Sequence[tuple]],
               code_col: str = "icd_code", version_col: str = "icd_version") -> DataFrame:
    """One 0/1 column per rule: does any diagnosis of the key match it.

    The diagnoses are aggregated per key first (partial aggregation, one
    shuffle), then LEFT-joined to the anchor, so keys without diagnoses get 0.
    """
    code, ver = F.col(code_col), F.col(version_col)
    flags = dx.groupBy(key).agg(*[
        F.max(F.when(rule_matches(code, ver, clauses), 1).otherwise(0)).alias(name)
        for name, clauses in rules.items()])
    j = anchor.join(flags, key, "left")
    return j.select(*anchor.columns, *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in rules])


def hierarchical_weight(mild: Column, severe: Column, w_mild: int, w_severe: int) -> Column:
    """GREATEST(w_mild * mild, w_severe * severe) - a severe class supersedes."""
    return F.greatest(F.lit(w_mild) * mild, F.lit(w_severe) * severe)


def match_keywords(rx: DataFrame, col: str, words, case: str = "upper",
                   dictionary_filter=None, keys=("drug",), filter_cols=()) -> DataFrame:
    """Classify the distinct values of ``keys`` once (any keyword as a
    substring), then keep the rows whose keys are in that dictionary.

    The dictionary is as small as the drug vocabulary; the join back is a
    left-semi join (rows cannot multiply), and AQE broadcasts it when its
    runtime size is under the broadcast threshold.  ``dictionary_filter`` reads
    the keys and ``filter_cols`` only.  The tests hang on the count of a value, without which
    the optimiser would move them below the grouping and to the other side of the join, to be made for every row.
    """
    norm = F.upper(F.col(col)) if case == "upper" else F.lower(F.col(col))
    test = contains_any(norm, words) if dictionary_filter is None else dictionary_filter & contains_any(norm, words)
    values = rx.groupBy(*keys, *filter_cols).agg(F.count(F.lit(1)).alias("_n"))
    dictionary = values.where(F.when(F.col("_n") > 0, test)).select(*keys).distinct()
    return rx.join(dictionary, list(keys), "left_semi")


def map_labels(col: Column, synonyms) -> Column:
    """Replace any synonym by its canonical label, else keep the value."""
    out = None
    for variants, label in synonyms:
        out = F.when(col.isin(variants), F.lit(label)) if out is None else out.when(col.isin(variants), F.lit(label))
    return col if out is None else out.otherwise(col)


def text_flag(item: Column, itemid: int, value: Column, one, zero=None) -> Column:
    """P27 text -> 0/1 flag for one item (NULL when neither list matches)."""
    out = F.when((item == itemid) & value.isin(one), 1)
    if zero is not None:
        out = out.when((item == itemid) & value.isin(zero), 0)
    return out
