"""Unit rules of measured values (P03).  FIXED VALUES: plausible ranges of each unit, and the factors between units."""

from __future__ import annotations

from ..operators.units import Unit
from . import items as I

# inspired oxygen as a fraction or a percentage; between them the unit is unknown
FIO2_LAB = [Unit(0.2, 1.0, factor=100.0, closed="right"), Unit(20, 100, closed="right")]
FIO2_CHART = [Unit(0.2, 1.0, factor=100.0, closed="right"), Unit(1, 20, factor=None, closed="neither"), Unit(20, 100)]
FIO2_VENTILATOR = [Unit(0.20, 1.0, factor=100.0), Unit(1, 20, factor=None, closed="neither"), Unit(20, 100)]
# Fahrenheit and Celsius by item
TEMPERATURE = [Unit(70, 120, shift=32, divisor=1.8, closed="neither", codes=tuple(I.TEMP_F)),
               Unit(10, 50, closed="neither", codes=tuple(I.TEMP_C))]
HEIGHT = [Unit(codes=(I.HEIGHT_CM,)), Unit(factor=2.54, codes=(I.HEIGHT_IN,))]
PEEP = [Unit(0, 100)]
# infusion rates by unit of measurement; other units are taken as they are
NOREPINEPHRINE = [Unit(factor=1000.0, codes=("mg/kg/min",))]
VASOPRESSIN = [Unit(factor=60.0, codes=("units/min",))]
