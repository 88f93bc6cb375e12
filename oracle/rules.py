"""Point rules as rows; the SQL of a score is generated from them."""

from __future__ import annotations


def worst(rules, unknown: str) -> str:
    """The most points of any (points, condition) row that holds, 0 if none does, NULL where ``unknown``."""
    arms = ", ".join(f"CASE WHEN {cond} THEN {points} END" for points, cond in rules)
    return f"CASE WHEN {unknown} THEN NULL ELSE greatest(0, {arms}) END"


def all_null(names) -> str:
    return " AND ".join(f"{n} IS NULL" for n in names)


def bands(value: str, rows, above: int) -> str:
    """Points by the first (upper bound with its comparison, points) row that ``value`` meets."""
    arms = " ".join(f"WHEN {value} {bound} THEN {points}" for bound, points in rows)
    return f"CASE WHEN {value} IS NULL THEN NULL {arms} ELSE {above} END"


def total(names) -> str:
    return " + ".join(f"coalesce({n}, 0)" for n in names)


def rounded(x: str, digits: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38, 9)), {digits}) AS DOUBLE)"
