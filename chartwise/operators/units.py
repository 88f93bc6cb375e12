"""Units and codes of measured values made one, from rules as data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scores import first_match


@dataclass(frozen=True)
class Unit:
    """Values from ``lo`` to ``hi`` (``closed`` as for intervals; None: no bound), with a code of ``codes`` if given, are
    ``(value - shift) * factor``; factor None: a value whose unit is unknown."""

    lo: float | None = None
    hi: float | None = None
    factor: float | None = 1.0
    shift: float = 0.0
    divisor: float = 1.0
    closed: str = "both"
    codes: tuple = ()

    def holds(self, value: Column, code: Column | None) -> Column:
        out = F.lit(True) if self.codes else value.isNotNull()
        if self.codes:
            out = code.isin(list(self.codes))
        if self.lo is not None:
            out = out & (value >= self.lo if self.closed in ("both", "left") else value > self.lo)
        if self.hi is not None:
            out = out & (value <= self.hi if self.closed in ("both", "right") else value < self.hi)
        return out

    def apply(self, value: Column) -> Column:
        if self.factor is None:
            return F.lit(None)
        out = value - F.lit(self.shift) if self.shift else value
        out = out * F.lit(self.factor) if self.factor != 1.0 else out
        return out / F.lit(self.divisor) if self.divisor != 1.0 else out


def check_units(rules: Sequence[Unit]) -> None:
    """The ranges of each code must ascend and not overlap: which unit a value has may not depend on the order of rules."""
    for code in {c for r in rules for c in (r.codes or (None,))}:
        last = None
        for r in (r for r in rules if code in (r.codes or (None,))):
            if r.lo is not None and r.hi is not None and r.lo > r.hi:
                raise ValueError(f"empty range: {r}")
            if last is not None:
                touch = last.hi is not None and r.lo is not None and (
                    last.hi < r.lo or last.hi == r.lo and not (last.closed in ("both", "right") and r.closed in ("both", "left")))
                if not touch:
                    raise ValueError(f"ranges overlap or descend: {last}, {r}")
            last = r


def harmonise(value: Column, rules: Sequence[Unit], code: Column | None = None, unknown: Column | None = None) -> Column:
    """``value`` in the target unit by the rule that holds; ``unknown`` (default NULL) where none does."""
    check_units(rules)
    if code is None and any(r.codes for r in rules):
        raise ValueError("rules by code need a code")
    return first_match([(r.holds(value, code), r.apply(value)) for r in rules], unknown)
