"""Points against intervals, as-of values and first matches, against loops over all pairs."""
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chartwise.operators import matching as M
from chartwise.operators.windows import lookback_axis, segment_intervals, to_validity

from .helpers import rows

T0 = datetime(2150, 1, 1)


def h(x):
    return T0 + timedelta(hours=x)


def cover(spark, first, last):
    return [tuple(b) for b in spark.range(1).select(M.dyadic_cover(F.lit(first).cast("long"), F.lit(last).cast("long")).alias("c")).first()["c"] or []]


@pytest.mark.parametrize("first, last", [(0, 0), (5, 5), (-7, 9), (3, 4), (0, 15), (1, 63), (-100, 1000), (65742, 65742 + 16), (7, 6)])
def test_dyadic_cover_is_exact_and_disjoint(spark, first, last):
    days = sorted(d for level, block in cover(spark, first, last) for d in range(block * 4 ** level, (block + 1) * 4 ** level))
    assert days == list(range(first, last + 1))


def test_an_interval_to_the_year_2999_is_few_rows(spark):
    epoch = date(1970, 1, 1)
    for start in (date(2150, 1, 1), date(2024, 2, 29), date(1971, 3, 4)):
        blocks = cover(spark, (start - epoch).days, (date(2999, 12, 30) - epoch).days)
        assert 0 < len(blocks) < 60
        assert sum(4 ** level for level, _ in blocks) == (date(2999, 12, 30) - start).days + 1


def test_contains_join_with_far_and_broken_intervals(spark):
    rng = random.Random(1)
    points = [(rng.randint(1, 3), n, h(rng.randint(-500, 5000) / 3)) for n in range(150)] + [(None, 900, h(1)), (1, 901, None)]
    far = datetime(2999, 1, 1)
    intervals = [(rng.randint(1, 4), n, h(s := rng.randint(-500, 1500)), h(s + rng.choice([0, 1, 30, 700]))) for n in range(60)]
    intervals += [(1, 800, h(3), far), (2, 801, datetime(1900, 1, 1), far), (3, 802, h(9), h(2)), (1, 803, None, h(2)), (1, 804, h(2), None), (None, 805, h(0), far)]
    p = spark.createDataFrame(points, "k long, pid long, t timestamp_ntz")
    i = spark.createDataFrame(intervals, "k long, iid long, starttime timestamp_ntz, endtime timestamp_ntz")
    for closed in ("both", "left", "right", "neither"):
        def inside(t, s, e):
            return (s <= t if closed in ("both", "left") else s < t) and (t <= e if closed in ("both", "right") else t < e)
        pairs = {(a[1], b[1]) for a in points for b in intervals if a[0] is not None and a[0] == b[0]
                 and None not in (a[2], b[2], b[3]) and inside(a[2], b[2], b[3])}
        near = i.where("iid not in (800, 801, 805)")
        for how in ("left", "inner", "left_semi", "left_anti"):
            assert rows(M.contains_join(p, near, "k", "t", closed=closed, how=how, short=True)) == rows(M.contains_join(p, near, "k", "t", closed=closed, how=how))
        out = M.contains_join(p, i, "k", "t", closed=closed).select("p.pid", "i.iid").collect()
        assert len(out) == len(set(out)) and {(a, b) for a, b in out if b is not None} == pairs
        assert {a for a, b in out if b is None} == {a[1] for a in points} - {a for a, _ in pairs}
    anti = M.contains_join(p, i, "k", "t", closed="neither", how="left_anti")
    assert {r["pid"] for r in anti.collect()} == {a[1] for a in points} - {a for a, _ in pairs}


def test_asof_against_all_pairs(spark):
    rng = random.Random(2)
    left = [(rng.choice([1, 2, None]), n, h(rng.randint(0, 300) / 2)) for n in range(80)] + [(1, 500, None)]
    right = [(rng.choice([1, 2, None]), n, h(rng.randint(0, 300) / 2), float(n)) for n in range(60)] + [(1, 700, None, 1.0)]
    l = spark.createDataFrame(left, "k long, id long, t timestamp_ntz")
    r = spark.createDataFrame(right, "k long, rid long, rt timestamp_ntz, v double")
    for tol in (1800, 7200, 40 * 3600):
        want = {}
        for k, n, t in left:
            ok = [(x[2], x[1], x[3]) for x in right if k is not None and k == x[0] and t and x[2] and t - timedelta(seconds=tol) <= x[2] <= t]
            want[n] = max(ok)[2] if ok else None
        out = M.asof_within(l, r, "k", "t", "rt", tol, ["v"], tiebreak=[F.col("rid")])
        assert out.columns == ["k", "id", "t", "v"] and {x["id"]: x["v"] for x in out.collect()} == want


def test_asof_makes_no_pairs_of_a_dense_day(spark):
    """Rows of a dense day go through one window: no join is planned at all."""
    l = spark.range(10).select(F.lit(1).alias("k"), "id", F.lit(T0).alias("t"))
    out = M.asof_within(l, l.withColumnRenamed("t", "rt"), "k", "t", "rt", 3600, ["rt"])
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


def test_first_in_windows_by_any_order_with_open_sides(spark):
    rng = random.Random(3)
    a = [(rng.choice([1, 2, None]), n, rng.randint(-40, 40)) for n in range(60)] + [(1, 500, None)]
    b = [(rng.choice([1, 2, None]), n, rng.randint(-40, 40), rng.randint(0, 9)) for n in range(50)] + [(1, 600, None, 0)]
    fa = spark.createDataFrame(a, "k long, aid long, t long")
    fb = spark.createDataFrame(b, "k long, bid long, at long, rank long")
    looks = [(3, 4), (0, 0), (None, 2), (5, None), (12, 0), (-1, 6)]
    out = M.first_in_windows(fa, fb, "k", ["aid"], [M.Look(f"w{n}", F.col("t"), F.col("at"), lo, hi, block=7) for n, (lo, hi) in enumerate(looks)],
                             [("rank", "desc", None), ("bid", "asc", None)], ["bid"])
    got = {r["aid"]: tuple(r[f"w{n}_bid"] for n in range(len(looks))) for r in out.collect()}
    for k, n, t in a:
        for i, (lo, hi) in enumerate(looks):
            ok = [x for x in b if k is not None and k == x[0] and t is not None and x[2] is not None
                  and (lo is None or x[2] >= t - lo) and (hi is None or x[2] <= t + hi)]
            best = min(ok, key=lambda x: (-x[3], x[1]), default=None)
            assert got[n][i] == (best and best[1]), (n, looks[i])
    assert len(got) == len(a)
    with pytest.raises(ValueError):
        M.first_in_windows(fa, fb, "k", ["aid"], [M.Look("w", F.col("t"), F.col("at"), None, None)], [("bid", "asc", None)], ["bid"])


def test_date_or_time_takes_the_first_of_both_kinds(spark):
    a = spark.createDataFrame([(1, 1, h(30)), (1, 2, h(200)), (2, 3, h(30))], "k long, aid long, t timestamp_ntz")
    b = spark.createDataFrame([(1, 10, h(30), False), (1, 11, h(29), False), (1, 12, h(24), True), (1, 13, h(40), True), (2, 14, h(31), False)],
                              "k long, bid long, bt timestamp_ntz, dated boolean")
    looks = M.date_or_time("m", F.col("t"), F.col("bt"), F.col("dated"), 3600, 0, 0, 0, strict_after=True)
    out = M.first_in_windows(a, b, "k", ["aid"], looks, [("bt", "asc", None)], ["bid"])
    assert {r["aid"]: r["m_bid"] for r in out.collect()} == {1: 12, 2: None, 3: None}       # the dated row of the day is before the timed one
    timed = M.first_in_windows(a, b.where("bid != 12"), "k", ["aid"], looks, [("bid", "asc", None)], ["bid"])
    assert {r["aid"]: r["m_bid"] for r in timed.collect()} == {1: 11, 2: None, 3: None}     # strict: not the one at the same time


def test_frames_on_an_axis_of_one_long_series(spark):
    rng = random.Random(4)
    data = [(1, n, x, rng.random()) for n, x in enumerate(rng.randint(-3000, 3000) for _ in range(400))] + [(1, 900, None, 5.0), (1, 901, None, 7.0)]
    df = spark.createDataFrame(data, "k long, id long, x long, v double")
    out = lookback_axis(df, "k", F.col("x"), {"s": (F.sum("v"), 100, True), "n": (F.count("v"), 7, False), "m": (F.max("v"), 333, True)})
    assert out.columns == ["k", "id", "x", "v", "s", "n", "m"]
    got = {r["id"]: (r["s"], r["n"], r["m"]) for r in out.collect()}
    for _, n, x, v in data:
        def frame(span, now):
            return [w for _, _, y, w in data if (x is None and y is None) or (None not in (x, y) and x - span <= y <= x - (not now))]
        assert got[n][0] == pytest.approx(sum(frame(100, True))) and got[n][1] == len(frame(7, False)) and got[n][2] == max(frame(333, True))


def test_dense_ordinals_serve_as_rows_frames(spark):
    df = spark.range(300).select(F.lit(1).alias("k"), F.col("id").alias("hr"), (F.col("id") * 37 % 101).alias("v"))
    got = {r["hr"]: r["m"] for r in lookback_axis(df, "k", F.col("hr"), {"m": (F.max("v"), 23, True)}).collect()}
    v = [n * 37 % 101 for n in range(300)]
    assert got == {n: max(v[max(0, n - 23):n + 1]) for n in range(300)}


def test_validity_with_ties_and_a_gap(spark):
    df = spark.createDataFrame([(1, h(5), "b", 2.0), (1, h(5), "a", 1.0), (1, h(90), "a", 3.0), (2, h(0), "a", 4.0)],
                               "k long, s timestamp_ntz, kind string, v double")
    out = to_validity(df, "k", "s", ["kind"], F.lit(h(100)), "e", gap_start=F.lit(h(0)), gap_from=F.lit(h(2)))
    assert rows(out, ["k", "s", "e", "v"]) == sorted([
        ("1", str(h(0)), str(h(5)), "1"), ("1", str(h(5)), str(h(5)), "1"), ("1", str(h(5)), str(h(90)), "2"),
        ("1", str(h(90)), str(h(100)), "3"), ("2", str(h(0)), str(h(100)), "4")])


def test_segments_of_random_intervals_against_pairs(spark):
    rng = random.Random(5)
    schema = "k long, starttime timestamp_ntz, endtime timestamp_ntz, v double"
    data = {}
    for name in "abc":
        data[name] = [(rng.choice([1, 2]), h(s := rng.randint(0, 200)), h(s + rng.randint(-3, 90)), rng.choice([None, float(n)])) for n in range(12)]
    data["a"] += [data["a"][0], (1, datetime(2150, 1, 3), datetime(2999, 1, 1), 99.0)]
    seg = segment_intervals({n: spark.createDataFrame(d, schema) for n, d in data.items()}, "k", "v")
    want = []
    for k in (1, 2):
        ends = sorted({t for d in data.values() for x in d if x[0] == k for t in x[1:3]})
        for s, e in zip(ends, ends[1:]):
            held = {n: [x[3] for x in d if x[0] == k and x[1] <= s and x[2] >= e] or [None] for n, d in data.items()}
            want += [(k, s, e, x, y, z) for x in held["a"] for y in held["b"] for z in held["c"]]
    got = [(r["k"], r["starttime"], r["endtime"], r["a"], r["b"], r["c"]) for r in seg.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_segments_take_one_join_and_two_scans_a_source(spark, tmp_path):
    frames = {}
    for name in "abcdefg":
        spark.createDataFrame([(1, h(0), h(1), 1.0)], "k long, starttime timestamp_ntz, endtime timestamp_ntz, v double").write.parquet(f"{tmp_path}/{name}")
        frames[name] = spark.read.parquet(f"{tmp_path}/{name}")
    plan = segment_intervals(frames, "k", "v")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and plan.count("Relation [") == 14


def test_contains_join_within_windows_reads_points_once(spark, tmp_path):
    """Intervals of any length, broken ones too, meet points of known windows; the rows are those of the general way."""
    p = [(k, h(t), n) for n, (k, t) in enumerate([(1, 1), (1, 30), (1, 49), (2, 5), (2, 80), (None, 3)])]
    i = [(1, h(-9000), h(40), "long"), (1, h(20), h(20), "point"), (1, None, h(60), "open"), (1, h(50), h(10), "turned"),
         (2, h(0), h(5), "touch"), (2, h(70), h(900_000), "far"), (3, h(0), h(9), "other"), (None, h(0), h(9), "null")]
    points = spark.createDataFrame(p, "k long, t timestamp_ntz, pid long")
    points.write.parquet(str(tmp_path / "p"))
    points = spark.read.parquet(str(tmp_path / "p"))
    intervals = spark.createDataFrame(i, "k long, starttime timestamp_ntz, endtime timestamp_ntz, iid string")
    windows = spark.createDataFrame([(1, h(0), h(49)), (1, h(0), h(49)), (1, None, h(9)), (2, h(2), h(90)), (None, h(0), h(9))],
                                    "k long, a timestamp_ntz, z timestamp_ntz")
    for how, cols in (("left", ["p.pid", "i.iid"]), ("left_semi", ["p.pid"])):
        plain = rows(M.contains_join(points, intervals, "k", "t", how=how).select(*cols))
        assert rows(M.contains_join(points, intervals, "k", "t", how=how, within=(windows, "a", "z")).select(*cols)) == plain
        assert rows(M.contains_join(points, intervals, "k", "t", how=how, times=points.unionByName(points).select("k", "t")).select(*cols)) == plain
    plan = M.contains_join(points, intervals, "k", "t", within=(windows, "a", "z"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_a_short_interval_is_covered_by_its_days(spark):
    got = spark.range(1).select(M._blocks(F.lit(5).cast("long"), F.lit(9).cast("long")).alias("few"), M._blocks(F.lit(9), F.lit(5)).alias("none"),
                                M._blocks(F.lit(5).cast("long"), F.lit(99_999).cast("long")).alias("many")).first()
    assert [tuple(b) for b in got["few"]] == [(0, d) for d in range(5, 10)] and got["none"] is None
    assert [tuple(b) for b in got["many"]] == cover(spark, 5, 99_999)
