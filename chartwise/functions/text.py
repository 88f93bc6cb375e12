"""Text helpers: substring keyword matching as one regular expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPECIAL = set(".^$*+?()[]{}|\\/")


def escape_regex(word: str) -> str:
    return "".join("\\" + ch if ch in _SPECIAL else ch for ch in word)


def contains_any(col: Column, words) -> Column:
    """TRUE when ``col`` contains any of ``words`` (NULL col -> NULL)."""
    pattern = "|".join(escape_regex(w) for w in dict.fromkeys(words))
    return col.rlike(pattern)
