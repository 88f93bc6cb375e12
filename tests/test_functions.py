"""Golden rows for the time helpers (boundary semantics)."""
from datetime import datetime

from pyspark.sql import functions as F

from chartwise.functions.time import boundary_diff, ceil_hour
from chartwise.functions.numeric import round_numeric


def _one(spark, expr, a, b):
    df = spark.createDataFrame([(a, b)], "a timestamp_ntz, b timestamp_ntz")
    return df.select(expr.alias("x")).first()["x"]


def test_hour_boundary_counts_crossings(spark):
    d = boundary_diff("HOUR", F.col("a"), F.col("b"))
    assert _one(spark, d, datetime(2150, 1, 1, 1, 0), datetime(2150, 1, 1, 0, 59)) == 1
    assert _one(spark, d, datetime(2150, 1, 1, 0, 59), datetime(2150, 1, 1, 0, 0)) == 0
    assert _one(spark, d, datetime(2150, 1, 1, 14, 0), datetime(2150, 1, 1, 0, 1)) == 14


def test_year_and_day_boundaries(spark):
    assert _one(spark, boundary_diff("YEAR", F.col("a"), F.col("b")),
                datetime(2151, 1, 1), datetime(2150, 12, 31, 23, 59)) == 1
    assert _one(spark, boundary_diff("DAY", F.col("a"), F.col("b")),
                datetime(2150, 1, 2, 0, 1), datetime(2150, 1, 1, 23, 59)) == 1


def test_ceil_hour(spark):
    assert _one(spark, ceil_hour(F.col("a")), datetime(2150, 1, 1, 3, 0), None) == datetime(2150, 1, 1, 3, 0)
    assert _one(spark, ceil_hour(F.col("a")), datetime(2150, 1, 1, 3, 1), None) == datetime(2150, 1, 1, 4, 0)


def test_round_numeric_half_away_from_zero(spark):
    df = spark.createDataFrame([(2.345,), (-2.345,), (1.005,)], "x double")
    got = [r[0] for r in df.select(round_numeric(F.col("x"), 2)).collect()]
    assert got == [2.35, -2.35, 1.01]
