"""Score operators (P19-P21, P28, P29, P34, P35): point tables, NULL-as-normal totals, logistic probabilities,
furthest-from-normal choice, two-axis tables, weighted doses, MELD."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

TESTS = {"<": lambda v, b: v < b, "<=": lambda v, b: v <= b, ">": lambda v, b: v > b, ">=": lambda v, b: v >= b,
         "=": lambda v, b: v == b, "in": lambda v, b: (v >= b[0]) & (v <= b[1])}


def first_match(arms: Sequence[tuple], otherwise=None) -> Column:
    """CASE over ``(condition, result)`` arms."""
    start, rest = arms[0], arms[1:]
    return reduce(lambda out, arm: out.when(*arm), rest, F.when(*start)).otherwise(otherwise)


def _arms(rows) -> list[tuple]:
    """Rows of a component, impossible values first, then the most points; equal points keep their order."""
    ordered = sorted(rows, key=lambda r: (r[3] is not None, -(r[3] or 0)))
    return [(TESTS[test](F.col(measure), bound), measure, points) for measure, test, bound, points in ordered]


def _unknown(component) -> Column:
    kind, measures = component[0]
    missing = [F.col(m).isNull() for m in measures] or [F.lit(False)]
    return reduce((lambda a, b: a | b) if kind == "any" else (lambda a, b: a & b), missing)


def points(component) -> Column:
    """The most points of a component's rows that hold (see :mod:`chartwise.config.scores`)."""
    return first_match([(_unknown(component), F.lit(None)), *[(cond, F.lit(p)) for cond, _, p in _arms(component[1])]], F.lit(0))


def representative(component, otherwise: Column) -> Column:
    """The value of the measure whose row gave the points, ``otherwise`` if none did."""
    return first_match([(_unknown(component), F.lit(None)), *[(cond, F.col(m)) for cond, m, _ in _arms(component[1])]], otherwise)


def scale(value: Column, rows, above) -> Column:
    """P19 on one value: the points of the first ``(test, bound, points)`` that holds, ``above`` beyond them, NULL for NULL."""
    return first_match([(value.isNull(), F.lit(None)), *[(TESTS[t](value, b), F.lit(p)) for t, b, p in rows]], F.lit(above))


def check_cuts(cuts: Sequence) -> None:
    """Upper bounds of neighbouring bands: ascending, the last one open."""
    if not cuts or cuts[-1] is not None or None in cuts[:-1] or any(a >= b for a, b in zip(cuts[:-1], cuts[1:-1])):
        raise ValueError(f"bands must ascend to an open one: {cuts}")


def grid_points(x: Column, y: Column, grid: Sequence[tuple]) -> Column:
    """Points of a table over two cut axes, ``[(x below, [(y below, points), ...]), ...]`` (None: no bound).  The bands of each
    axis must follow one another to an open one, so that each pair of values lies in one cell; NULL if either is."""
    check_cuts([b for b, _ in grid])
    for _, row in grid:
        check_cuts([b for b, _ in row])

    def band(v, rows):
        return first_match([(F.lit(True) if b is None else v < b, r) for b, r in rows])
    cells = band(x, [(b, band(y, [(c, F.lit(p)) for c, p in row])) for b, row in grid])
    return F.when(x.isNotNull() & y.isNotNull(), cells)


def cell_points(a: Column, b: Column, cells: Sequence[tuple], a_values: Sequence, b_values: Sequence) -> Column:
    """P29 on value sets: points of the cell ``(a set, b set, points)`` that holds both values (None: a combination without
    points).  Each combination of the axes' values must lie in exactly one cell; other values give NULL."""
    for pair in product(a_values, b_values):
        n = sum(pair[0] in xs and pair[1] in ys for xs, ys, _ in cells)
        if n != 1:
            raise ValueError(f"{pair} lies in {n} cells")
    return first_match([(a.isin(list(xs)) & b.isin(list(ys)), F.lit(p)) for xs, ys, p in cells])


def total(cols: Sequence[Column], default=0) -> Column:
    """P20: sum with NULL components counted as ``default``."""
    out = None
    for c in cols:
        t = F.coalesce(c, F.lit(default))
        out = t if out is None else out + t
    return out


def logistic(logit: Column) -> Column:
    """1 / (1 + exp(-logit))."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def worst_of(v_min: Column, v_max: Column, normal, s_min: Column, s_max: Column) -> Column:
    """Score of the extreme further from ``normal``; equal distance -> larger score; NULL maximum -> NULL."""
    d_max, d_min = F.abs(v_max - F.lit(normal)), F.abs(v_min - F.lit(normal))
    return (F.when(v_max.isNull(), None).when(d_max > d_min, s_max).when(d_max < d_min, s_min)
            .when(s_max >= s_min, s_max).when(s_max < s_min, s_min))


def linear_dose(terms) -> Column:
    """Weighted sum with NULL terms counted as 0 (terms already weighted)."""
    out = None
    for t in terms:
        c = F.coalesce(t, F.lit(0.0))
        out = c if out is None else out + c
    return out


# FIXED VALUES: weights and floors of the MELD terms, its cap, the sodium correction
MELD_CREATININE, MELD_BILIRUBIN, MELD_INR, MELD_CONSTANT, MELD_CAP = 0.957, 0.378, 1.120, 0.643, 40.0
MELD_SODIUM = (125.0, 137.0, 1.32, 0.033, 11)


def meld_score(creatinine: Column, bilirubin: Column, inr: Column, sodium: Column, dialysis: Column) -> tuple[Column, Column]:
    """(initial MELD, MELD-Na).  Log terms have a floor of 1 and 0 where the value is missing; dialysis or a creatinine above 4
    counts as 4; the sum of the terms is taken ten-fold after rounding to a decimal, and capped; above 11 points low sodium adds to it."""
    def term(weight, value):
        return F.lit(weight) * F.when(value < 1, F.lit(0.0)).otherwise(F.coalesce(F.log(value), F.lit(0.0)))
    kidney = F.when((dialysis == 1) | (creatinine > 4.0), F.lit(MELD_CREATININE) * F.log(F.lit(4.0))).otherwise(term(MELD_CREATININE, creatinine))
    sum_of_terms = kidney + term(MELD_BILIRUBIN, bilirubin) + (term(MELD_INR, inr) + F.lit(MELD_CONSTANT))
    initial = F.when(sum_of_terms > MELD_CAP / 10, F.lit(MELD_CAP)).otherwise(
        (F.round(sum_of_terms.cast("decimal(38,9)"), 1) * 10).cast("double"))
    lowest, normal, gain, damping, above = MELD_SODIUM
    missing = F.when(sodium.isNull() | (sodium > normal), F.lit(0.0)).otherwise(
        F.lit(normal) - F.greatest(sodium.cast("double"), F.lit(lowest)))
    return initial, F.when(initial > above, initial + F.lit(gain) * missing - F.lit(damping) * initial * missing).otherwise(initial)
