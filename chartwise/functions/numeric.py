"""Numeric helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_numeric(x, n: int) -> Column:
    """ROUND(CAST(x AS NUMERIC), n) as a double: half away from zero on decimals."""
    return F.round(_c(x).cast("decimal(38,9)"), n).cast("double")


def nullsafe_sum(*cols, default=0) -> Column:
    """Sum where a NULL term counts as ``default`` (NULL-as-normal)."""
    return reduce(lambda a, b: a + b, [F.coalesce(_c(c), F.lit(default)) for c in cols])


def logistic(logit: Column) -> Column:
    """1 / (1 + exp(-logit))."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))
