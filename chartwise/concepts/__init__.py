"""Derived-table functions, one per concept; importing registers them."""
from . import (demographics, measurement, medication, firstday, treatment, comorbidity,  # noqa: F401
               organfailure, sepsis, score)
