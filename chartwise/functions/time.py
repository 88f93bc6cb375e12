"""Zone-free time arithmetic with the reference's semantics.

The reference's ``DATETIME_DIFF(a, b, part)`` counts *part boundaries crossed*
(00:59 -> 01:00 is one hour), whereas Spark's ``timestampdiff`` counts whole
elapsed units.  ``boundary_diff`` truncates both sides to the part first.
All inputs are TIMESTAMP_NTZ; epoch arithmetic goes through TIMESTAMP under a
UTC session (see :mod:`chartwise.session`).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SECONDS = {"SECOND": 1, "MINUTE": 60, "HOUR": 3600}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_seconds(ts) -> Column:
    """Seconds since 1970-01-01 of a zone-free timestamp (UTC session)."""
    return F.unix_seconds(_c(ts).cast("timestamp_ltz"))


def trunc_ntz(part: str, ts) -> Column:
    """DATETIME_TRUNC that stays TIMESTAMP_NTZ."""
    return F.date_trunc(part, _c(ts)).cast("timestamp_ntz")


def boundary_diff(part: str, a, b) -> Column:
    """Number of ``part`` boundaries between ``b`` and ``a`` (a - b), as bigint."""
    part = part.upper()
    a, b = _c(a), _c(b)
    if part in _SECONDS:
        unit = _SECONDS[part]
        fa = F.floor(epoch_seconds(a) / F.lit(unit))
        fb = F.floor(epoch_seconds(b) / F.lit(unit))
        return (fa - fb).cast("long")
    if part == "DAY":
        return F.datediff(a, b).cast("long")
    if part == "YEAR":
        return (F.year(a) - F.year(b)).cast("long")
    if part == "MONTH":
        return ((F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b)).cast("long")
    raise ValueError(f"unsupported part {part}")


def hours(n: int) -> Column:
    return F.expr(f"INTERVAL {int(n)} HOURS")


def days(n: int) -> Column:
    return F.expr(f"INTERVAL {int(n)} DAYS")


def minutes(n: int) -> Column:
    return F.expr(f"INTERVAL {int(n)} MINUTES")


def add_hours(ts, n) -> Column:
    """ts + n hours; ``n`` may be an int literal or an integer column."""
    if isinstance(n, int):
        return _c(ts) + hours(n)
    return _c(ts) + F.make_dt_interval(F.lit(0), _c(n).cast("int"))


def add_minutes(ts, n) -> Column:
    if isinstance(n, int):
        return _c(ts) + minutes(n)
    return _c(ts) + F.make_dt_interval(F.lit(0), F.lit(0), _c(n).cast("int"))


def add_days(ts, n) -> Column:
    if isinstance(n, int):
        return _c(ts) + days(n)
    return _c(ts) + F.make_dt_interval(_c(n).cast("int"))


def ceil_hour(ts) -> Column:
    """Smallest whole hour >= ts (a whole hour maps to itself)."""
    ts = _c(ts)
    floor = trunc_ntz("HOUR", ts)
    return F.when(floor == ts, floor).otherwise(floor + hours(1))
