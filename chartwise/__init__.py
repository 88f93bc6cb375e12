"""chartwise: derived clinical tables from EHR event logs, built on Spark DataFrames.

Layout
------
sources/    logical table names -> DataFrames (parquet readers, adapter views)
functions/  column-level helpers (time arithmetic, rounding, ladders, text)
operators/  reusable DataFrame operators (pivot, windowed joins, episodes, ...)
config/     item maps, thresholds and code lists (plain data)
concepts/   one function per derived table, composed from operators
plans/      dependency registry and the ``build`` entry point
"""

__version__ = "0.1.0"
