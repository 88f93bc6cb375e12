"""Point tables, grids and unit rules: every cell, every bound, and what their checks refuse."""
import itertools

import pytest
from pyspark.sql import functions as F

from chartwise.config import ladders as L
from chartwise.config import scores as S
from chartwise.config import units as U
from chartwise.operators import scores as O
from chartwise.operators.units import Unit, check_units, harmonise


def values(spark, schema, rows, **columns):
    return [r.asDict() for r in spark.createDataFrame(rows, schema).select("*", *[c.alias(n) for n, c in columns.items()]).collect()]


def test_every_acid_base_cell(spark):
    ph = [7.1, 7.2, 7.3, 7.34, 7.35, 7.44, 7.45, 7.5, 7.6, 7.7]
    co2 = [20, 25, 29, 30, 35, 39, 40, 44, 45, 49, 50, 60]
    # by hand, from the published table: rows of pH below, columns of pCO2 below
    table = {7.2: [(50, 12), (1e9, 4)], 7.3: [(30, 9), (40, 6), (50, 3), (1e9, 2)], 7.35: [(30, 9), (45, 0), (1e9, 1)],
             7.45: [(30, 5), (45, 0), (1e9, 1)], 7.5: [(30, 5), (35, 0), (45, 2), (1e9, 12)], 7.6: [(40, 3), (1e9, 12)], 1e9: [(25, 0), (40, 3), (1e9, 12)]}
    rows = list(itertools.product(ph, map(float, co2))) + [(None, 40.0), (7.4, None)]
    for r in values(spark, "x double, y double", rows, p=O.grid_points(F.col("x"), F.col("y"), L.APSIII_ACIDBASE)):
        want = None if None in (r["x"], r["y"]) else next(p for b, p in next(t for bound, t in table.items() if r["x"] < bound) if r["y"] < b)
        assert r["p"] == want, r


@pytest.mark.parametrize("cells, hand", [
    (L.APSIII_GCS_EYES_CLOSED, {1: "48 48 33 33 16 16", 2: "29 29 24 24 - -", 3: "29 29 24 24 - -", 4: "- - - - - -", 5: "- - - - - -"}),
    (L.APSIII_GCS_EYES_OPEN, {1: "29 29 24 24 15 15", 2: "29 29 24 24 13 10", 3: "29 29 24 24 13 10", 4: "13 13 13 13 8 3", 5: "3 3 3 3 3 0"})])
def test_every_coma_cell(spark, cells, hand):
    rows = list(itertools.product(map(float, range(1, 6)), map(float, range(1, 7)))) + [(None, 1.0), (9.0, 1.0)]
    for r in values(spark, "v double, m double", rows, p=O.cell_points(F.col("v"), F.col("m"), cells, L.GCS_VERBAL, L.GCS_MOTOR)):
        want = "-" if r["v"] not in hand else hand[int(r["v"])].split()[int(r["m"]) - 1]
        assert r["p"] == (None if want == "-" else int(want)), r


def test_tables_with_gaps_or_overlaps_are_refused(spark):
    with pytest.raises(ValueError):
        O.grid_points(F.col("x"), F.col("y"), [(2, [(None, 1)]), (1, [(None, 1)]), (None, [(None, 2)])])
    with pytest.raises(ValueError):
        O.grid_points(F.col("x"), F.col("y"), [(2, [(3, 1)]), (None, [(None, 2)])])
    for cells in ([([1], [1], 5)], [([1], [1, 2], 5), ([1], [2], 6)]):
        with pytest.raises(ValueError):
            O.cell_points(F.col("x"), F.col("y"), cells, [1], [1, 2])


@pytest.mark.parametrize("component, rows", [
    (S.OASIS["temp_score"], [((33.0, 38.0), 3), ((33.22, 38.0), 4), ((34.0, 34.0), 4), ((36.0, 36.5), 2), ((36.4, 36.5), 0), ((36.5, 37.0), 2),
                             ((36.5, 39.88), 2), ((30.0, 39.89), 6), ((None, None), None)]),
])
def test_most_points_of_a_component(spark, component, rows):
    got = values(spark, "temperature_min double, temperature_max double", [r for r, _ in rows], p=O.points(component),
                 rep=O.representative(component, F.lit(-1.0)))
    assert [r["p"] for r in got] == [p for _, p in rows]
    assert [r["rep"] for r in got] == [33.0, 33.22, 34.0, 36.0, -1.0, 37.0, 39.88, 39.89, None]


@pytest.mark.parametrize("rules, given", [
    (U.FIO2_LAB, {0.2: None, 0.21: 21.0, 1.0: 100.0, 1.5: None, 20.0: None, 20.5: 20.5, 100.0: 100.0, 101.0: None}),
    (U.FIO2_CHART, {0.2: None, 0.5: 50.0, 1.0: 100.0, 10.0: None, 20.0: 20.0, 100.0: 100.0}),
    (U.FIO2_VENTILATOR, {0.2: 20.0, 1.0: 100.0, 1.1: None, 20.0: 20.0, 100.5: None})])
def test_oxygen_units(spark, rules, given):
    got = values(spark, "v double", [(k,) for k in [*given, None]], u=harmonise(F.col("v"), rules))
    assert [r["u"] for r in got] == pytest.approx([*given.values(), None])


def test_units_by_code_and_the_unknown(spark):
    rows = [(98.6, 223761), (70.0, 223761), (37.0, 223762), (37.0, 1), (None, 223762)]
    got = values(spark, "v double, i int", rows, u=harmonise(F.col("v"), U.TEMPERATURE, F.col("i"), F.lit(-1.0)))
    assert [r["u"] for r in got] == pytest.approx([37.0, -1.0, 37.0, -1.0, -1.0])
    with pytest.raises(ValueError):
        harmonise(F.col("v"), U.TEMPERATURE)
    for wrong in ([Unit(0, 10), Unit(10, 20)], [Unit(10, 20), Unit(0, 5)], [Unit(5, 1)], [Unit(), Unit(1, 2)]):
        with pytest.raises(ValueError):
            check_units(wrong)


def test_meld_by_hand(spark):
    rows = [(1.0, 1.0, 1.0, 140.0, 0), (4.5, 10.0, 2.5, 120.0, 0), (0.5, 0.2, 0.9, None, 1), (2.0, 3.0, 1.8, 130.0, 0), (None, None, None, None, None)]
    initial, sodium = O.meld_score(*(F.col(c) for c in "abcde"))
    got = values(spark, "a double, b double, c double, d double, e int", rows, i=initial, s=sodium)
    assert [r["i"] for r in got] == [6.0, 39.0, 20.0, 24.0, 6.0]
    # 24 points at a sodium of 130: 24 + 1.32 * 7 - 0.033 * 24 * 7
    assert [r["s"] for r in got] == pytest.approx([6.0, 39 + 1.32 * 12 - 0.033 * 39 * 12, 20.0, 24 + 9.24 - 5.544, 6.0])
