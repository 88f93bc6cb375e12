"""Ordinals, neighbours and first rows of a group, against one window a key."""
import random
from datetime import datetime, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from chartwise.operators import ordering as O
from chartwise.operators.matching import day_bucket

from .helpers import rows

T0 = datetime(2150, 1, 1)


def series(spark, seed=0):
    rng = random.Random(seed)
    data = [(rng.choice([1, 2, None]), rng.choice([None, *[T0 + timedelta(hours=rng.randint(0, 200))] * 9]), n, rng.choice("abc")) for n in range(200)]
    return spark.createDataFrame(data, "k long, t timestamp_ntz, id long, s string")


def test_ordinal_matches_row_number(spark):
    df = series(spark)
    w = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_first(), "id")
    got = O.ordinal(df, "k", day_bucket(F.col("t")), [F.col("t").asc_nulls_first(), F.col("id")], "n")
    assert rows(got) == rows(df.withColumn("n", F.row_number().over(w)))


def test_neighbours_with_ties_and_missing_times(spark):
    df = series(spark, 1)
    w = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_first(), "s", "id")
    got = O.neighbours(df, "k", day_bucket(F.col("t")), [("t", "asc", None), ("s", "asc", None), ("id", "asc", None)], ["id", "s"])
    want = df.select("*", *[F.lag(c).over(w).alias(f"prev_{c}") for c in ("id", "s")], *[F.lead(c).over(w).alias(f"next_{c}") for c in ("id", "s")])
    assert rows(got, want.columns) == rows(want, want.columns)


def test_top_n_matches_row_number(spark):
    df = series(spark, 2)
    order = [F.col("s").desc(), F.col("t").asc_nulls_last(), F.col("id")]
    for n in (1, 4, 500):
        got = O.top_n(df, ["k"], order, n, "n")
        want = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(*order))).where(F.col("n") <= n)
        assert rows(got) == rows(want)


def test_top_n_limits_before_each_shuffle(spark):
    plan = O.top_n(series(spark), ["k"], [F.col("id")], 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 3


def test_pivot_ordinal(spark):
    df = spark.createDataFrame([(1, n, f"v{n}") for n in range(9)] + [(2, 5, "x")], "k long, n long, v string")
    out = O.pivot_ordinal(df, ["k"], [F.col("n")], "v", 3, "c")
    assert rows(out, ["k", "c1", "c2", "c3"]) == [("1", "v0", "v1", "v2"), ("2", "x", None, None)]
