"""Hand-written rows for the temporal operators: window ends, ties, NULL keys."""
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from chartwise.operators.matching import asof_within, contains_join
from chartwise.operators.windows import carry_previous, hourly_spine, lookback, segment_intervals

from .helpers import rows

T0 = datetime(2150, 1, 1, 0, 0)


def h(x):
    return T0 + timedelta(hours=x)


def test_asof_within_tolerance_and_equal_time(spark):
    left = spark.createDataFrame([(1, h(4)), (1, h(10)), (2, h(1))], "k long, t timestamp_ntz")
    right = spark.createDataFrame([(1, h(0), 5.0), (1, h(4), 7.0), (1, h(5), 9.0), (2, h(3), 1.0)],
                                  "k long, rt timestamp_ntz, v double")
    out = asof_within(left, right, "k", "t", "rt", 2 * 3600, ["v"])
    # equal time counts; 5 h old value at t=10 is outside 2 h; right after left never counts
    assert rows(out, ["k", "t", "v"]) == sorted([
        ("1", str(h(4)), "7"), ("1", str(h(10)), None), ("2", str(h(1)), None)],
        key=lambda r: tuple("" if x is None else x for x in r))


def test_contains_join_closed_modes(spark):
    pts = spark.createDataFrame([(1, h(1)), (1, h(2)), (1, h(3))], "k long, t timestamp_ntz")
    iv = spark.createDataFrame([(1, h(1), h(3))], "k long, starttime timestamp_ntz, endtime timestamp_ntz")
    for closed, expect in [("both", 3), ("left", 2), ("right", 2), ("neither", 1)]:
        j = contains_join(pts, iv, "k", "t", closed=closed, how="inner")
        assert j.count() == expect, closed


def test_carry_previous_gap_and_null_key(spark):
    df = spark.createDataFrame(
        [(1, h(0), 3.0), (1, h(5), None), (1, h(11), None), (None, h(1), 4.0), (None, h(2), None)],
        "k long, t timestamp_ntz, v double")
    out = carry_previous(df, "k", "t", ["v"], 6 * 3600)
    got = rows(out.select("k", "t", "prev_v"))
    assert ("1", str(h(5)), "3") in got          # 5 h old: carried
    assert ("1", str(h(11)), None) in got        # exactly 6 h: not carried
    assert (None, str(h(2)), None) in got        # NULL key: never carried


def test_lookback_strictly_earlier(spark):
    df = spark.createDataFrame([(1, h(0), 2.0), (1, h(48), 1.0), (1, h(49), 3.0)],
                               "k long, t timestamp_ntz, v double")
    out = lookback(df, "k", "t", {"lo": F.min("v")}, 48 * 3600, include_current=False)
    got = {r["t"]: r["lo"] for r in out.collect()}
    assert got[h(0)] is None and got[h(48)] == 2.0 and got[h(49)] == 1.0


def test_segments_are_disjoint(spark):
    cols = "k long, starttime timestamp_ntz, endtime timestamp_ntz, v int"
    one, two = (spark.createDataFrame([(1, *x, 1)], cols) for x in ((h(0), h(3)), (h(1), h(2))))
    seg = segment_intervals({"a": one, "b": two}, "k", "v")
    assert rows(seg, ["k", "starttime", "endtime"]) == [("1", str(h(0)), str(h(1))), ("1", str(h(1)), str(h(2))), ("1", str(h(2)), str(h(3)))]


def test_hourly_spine_empty_range(spark):
    st = spark.createDataFrame([(1, h(0) + timedelta(minutes=30), 2), (2, h(0), -30)],
                               "k long, t timestamp_ntz, n long")
    sp = hourly_spine(st, "k", F.col("t"), F.col("n"), 24)
    assert sp.where("k = 1").count() == 27 and sp.where("k = 2").count() == 0
    first = sp.where("k = 1 and hr = 0").first()
    assert first["endtime"] == h(1)


def test_contains_join_bucketed_no_duplicates(spark):
    pts = spark.createDataFrame([(1, h(1)), (1, h(30)), (1, h(80)), (None, h(1))], "k long, t timestamp_ntz")
    iv = spark.createDataFrame([(1, h(0), h(50)), (1, h(29), h(31))],
                               "k long, starttime timestamp_ntz, endtime timestamp_ntz")
    j = contains_join(pts, iv, "k", "t", closed="both", how="left")
    assert j.count() == 5   # h1 -> 1, h30 -> 2, h80 -> none (1 row), NULL key -> 1 row
    assert contains_join(pts, iv, "k", "t", how="left_anti").count() == 2


def test_top1_agg_matches_row_number(spark):
    from pyspark.sql import Window

    from chartwise.operators.ordering import top1_agg
    df = spark.createDataFrame([(1, None, h(1), 1), (1, 5.0, h(2), 2), (1, 5.0, h(0), 3), (2, None, None, 4),
                                (2, None, h(3), 5), (3, -1.0, h(9), 6)], "k long, v double, t timestamp_ntz, id long")
    cases = [
        ([("v", "desc", None), ("t", "asc", None)], [F.col("v").desc_nulls_last(), F.col("t").asc_nulls_first()]),
        ([("v", "asc", True), ("t", "desc", None)], [F.col("v").asc_nulls_last(), F.col("t").desc_nulls_last()]),
        ([("v", "asc", None), ("t", "asc", True)], [F.col("v").asc_nulls_first(), F.col("t").asc_nulls_last()]),
        ([("t", "desc", False), ("id", "asc", None)], [F.col("t").desc_nulls_first(), F.col("id")]),
    ]
    for spec, cols in cases:
        assert rows(top1_agg(df, ["k"], spec)) == rows(df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(*cols))).where("n = 1").drop("n")), spec


def test_bucketed_neighbours_and_episodes_match_windows(spark):
    import random

    from pyspark.sql import Window

    from chartwise.operators.windows import neighbours, running_sum, state_episodes
    rnd = random.Random(7)
    data, t = [], {}
    for k in range(1, 4):
        cur = h(0)
        for _ in range(60):
            cur = cur + timedelta(minutes=rnd.choice([5, 30, 200, 900, 2000]))
            data.append((k, cur, rnd.choice(["a", "b"])))
    df = spark.createDataFrame(data, "k long, t timestamp_ntz, s string")
    w = Window.partitionBy("k").orderBy("t")
    ref = df.select("k", "t", F.lag("t").over(w).alias("prev_t"), F.lag("s").over(w).alias("prev_s"),
                    F.lead("t").over(w).alias("next_t"))
    got = neighbours(df, "k", "t", ["s"]).select("k", "t", "prev_t", "prev_s", "next_t")
    assert rows(got) == rows(ref)
    rs = running_sum(df, "k", "t", F.when(F.col("s") == "a", 1).otherwise(0), "n")
    ref_rs = df.select("k", "t", F.sum(F.when(F.col("s") == "a", 1).otherwise(0)).over(
        w.rangeBetween(Window.unboundedPreceding, Window.currentRow)).alias("n"))
    assert rows(rs.select("k", "t", "n")) == rows(ref_rs)
    # episodes by hand: a run of equal states whose next row is less than 14 hour boundaries away
    want = []
    for k in range(1, 4):
        own = sorted((t, s) for kk, t, s in data if kk == k)
        hour = lambda x: int((x - T0).total_seconds() // 3600)
        runs = []
        for n, (t, s) in enumerate(own):
            gap = n and hour(t) - hour(own[n - 1][0]) >= 14
            if not n or gap or s != own[n - 1][1]:
                runs.append([s, t, t, t])
            after = own[n + 1][0] if n + 1 < len(own) else None
            runs[-1][2] = t if after is None or hour(after) - hour(t) >= 14 else after
            runs[-1][3] = t
        want += [(str(k), str(a), str(e), s) for s, a, e, last in runs if a != last]
    assert rows(state_episodes(df, "k", "t", "s", 14), ["k", "starttime", "endtime", "state"]) == sorted(want)


def test_segment_intervals_null_boundary_and_overlaps(spark):
    from chartwise.operators.windows import segment_intervals
    cols = "k long, starttime timestamp_ntz, endtime timestamp_ntz, v double"
    a = spark.createDataFrame([(1, h(0), h(4), 1.0), (1, h(2), h(6), 2.0), (1, h(5), None, 9.0)], cols)
    b = spark.createDataFrame([(1, h(4), h(5), 3.0)], cols)
    seg = segment_intervals({"a": a, "b": b}, "k", "v").collect()
    got = sorted(((r["starttime"] or T0 - timedelta(days=1)), r["endtime"], r["a"], r["b"]) for r in seg)
    assert got == sorted([(T0 - timedelta(days=1), h(0), None, None),      # NULL boundary opens (NULL, first)
                          (h(0), h(2), 1.0, None), (h(2), h(4), 1.0, None), (h(2), h(4), 2.0, None),
                          (h(4), h(5), 2.0, 3.0), (h(5), h(6), 2.0, None)])


def test_agg_in_window_by_day_keeps_anchors_and_counts_events_once(spark):
    from chartwise.operators.temporal import agg_in_window

    anchor = spark.createDataFrame([(1, h(20), h(60)), (2, h(1), h(2)), (3, None, None), (4, h(9), h(2))],
                                   "k long, lo timestamp_ntz, hi timestamp_ntz")
    events = spark.createDataFrame([(1, h(20), 1.0), (1, h(30), 2.0), (1, h(60), 4.0), (1, h(61), 8.0), (2, None, 9.0),
                                    (3, h(1), 1.0), (4, h(5), 1.0), (None, h(1), 1.0)], "k long, t timestamp_ntz, v double")
    for closed, total in (("both", "7"), ("left", "3"), ("right", "6"), ("neither", "2")):
        out = agg_in_window(anchor, events, "k", "t", F.col("a.lo"), F.col("a.hi"), [F.sum("e.v").alias("s")], ["k"], closed)
        assert rows(out, ["k", "s"]) == [("1", total), ("2", None), ("3", None), ("4", None)], closed


def test_overlap_flag_by_day_matches_the_three_tests(spark):
    from chartwise.operators.temporal import overlap_flag

    far = datetime(2999, 1, 1)
    anchor = spark.createDataFrame([(k, h(10), h(60)) for k in range(9)], "k long, lo timestamp_ntz, hi timestamp_ntz")
    iv = spark.createDataFrame([
        (0, h(0), far), (1, h(61), far), (2, h(0), h(9)), (3, h(12), None), (4, None, h(12)), (5, None, None),
        (6, h(70), h(50)), (7, h(70), h(0)), (8, h(60), h(61))], "k long, starttime timestamp_ntz, endtime timestamp_ntz")
    out = overlap_flag(anchor, iv, "k", F.col("a.lo"), F.col("a.hi"), ["k"], "hit")
    assert rows(out, ["k", "hit"]) == [(str(k), str(v)) for k, v in enumerate((1, 0, 0, 1, 1, 0, 1, 0, 1))]


def test_text_event_window_spans_days(spark):
    from chartwise.operators.temporal import text_event_window

    anchor = spark.createDataFrame([(1, h(0), h(50)), (2, h(0), h(50))], "k long, lo timestamp_ntz, hi timestamp_ntz")
    events = spark.createDataFrame([(1, h(1), "x"), (1, h(30), "x"), (1, h(49), "y"), (1, h(51), "x"), (2, h(3), "y")],
                                   "k long, charttime timestamp_ntz, value string")
    out = text_event_window(anchor, events, "k", F.col("e.value") == "x", F.col("a.lo"), F.col("a.hi"), 3600, 7200)
    assert rows(out, ["k", "starttime", "endtime"]) == [("1", str(h(0)), str(h(32)))]


def test_lookback_by_bucket_matches_one_window_a_key(spark):
    from pyspark.sql import Window

    df = spark.createDataFrame([(k, None if t is None else h(t), float(n)) for k in (1, 2)
                                for n, t in enumerate((0, 5, 23, 24, 47, 48, 49, 72, 72, 96, 400, None))],
                               "k long, t timestamp_ntz, v double")
    secs = F.unix_seconds(F.col("t").cast("timestamp_ltz"))
    for current in (True, False):
        for span in (3600, 86400, 2 * 86400):
            w = Window.partitionBy("k").orderBy(secs).rangeBetween(-span, 0 if current else -1)
            expected = df.select("*", F.sum("v").over(w).alias("s"), F.min("v").over(w).alias("m"))
            out = lookback(df, "k", "t", {"s": F.sum("v"), "m": F.min("v")}, span, current)
            assert rows(out) == rows(expected), (span, current)


def test_pivot_panels_in_one_pass(spark):
    from chartwise.operators.pivot import ItemSpec, Panel, pivot_items, pivot_panels
    rows = [(1, 10, 5.0, 100), (1, 11, -2.0, 101), (1, 12, 7.0, 102), (2, 11, 3.0, 103), (3, 12, None, 104), (4, 99, 1.0, 105), (None, 10, 4.0, 106)]
    df = spark.createDataFrame(rows, "k int, itemid int, valuenum double, t int")
    v = F.col("valuenum")
    panels = {"a": Panel({"x": ItemSpec([10]), "y": ItemSpec([11])}, v > 0),
              "b": Panel({"y": ItemSpec([11], lo=-5), "n": F.count(F.when(F.col("itemid") == 12, 1))}, v.isNotNull(), [12])}
    last = F.max("t").alias("t")
    got = pivot_panels(df, ["k"], panels, extra_aggs=[last])
    for name, p in panels.items():
        own = got.where(F.col("panel") == name).select("k", "t", *[F.col(f"{name}__{c}").alias(c) for c in p.specs])
        want = pivot_items(df, ["k"], p.specs, extra_aggs=[last], prefilter=p.prefilter, extra_ids=p.extra_ids)
        assert sorted(map(repr, own.collect())) == sorted(map(repr, want.select(own.columns).collect()))
    other = got.where("panel = 'a'").select("b__y").collect()
    assert [r[0] for r in other] == [None] * len(other)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 1


def test_panels_share_a_row_where_their_ids_agree(spark):
    from chartwise.operators.pivot import ItemSpec, Panel, pivot_items, pivot_panels_together
    rows = [(1, 10, 5.0, 100), (1, 11, -2.0, 100), (1, 12, 7.0, 100), (2, 11, 3.0, 103), (2, 12, 8.0, 107), (3, 12, None, 104), (4, 99, 1.0, 105),
            (None, 10, 4.0, None), (None, 12, 4.0, 9)]
    df = spark.createDataFrame(rows, "k int, itemid int, valuenum double, t int")
    v = F.col("valuenum")
    panels = {"a": Panel({"x": ItemSpec([10]), "y": ItemSpec([11])}, v > 0), "b": Panel({"z": ItemSpec([12], agg="sum")}, v.isNotNull(), [11])}
    got = pivot_panels_together(df, ["k"], panels, ["t"])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(100, 1, 5.0, None, 7.0), (103, 2, None, 3.0, None), (107, 2, None, None, 8.0), (None, None, 4.0, None, None), (9, None, None, None, 4.0)], key=repr)
    for name, p in panels.items():              # each panel's values are those of its own pivot
        own = [f"{name}__{c}" for c in p.specs]
        want = pivot_items(df, ["k"], p.specs, extra_aggs=[F.max("t").alias("t")], prefilter=p.prefilter, extra_ids=p.extra_ids)
        some = F.coalesce(*own).isNotNull()
        want = want.select("t", "k", *[F.col(c).alias(o) for c, o in zip(p.specs, own)])
        assert sorted(map(repr, got.where(some).select("t", "k", *own).collect())) == sorted(map(repr, want.where(some).collect()))


def test_lab_panels_give_one_row_a_specimen(spark):
    from chartwise.concepts.measurement import lab_panels
    types = "subject_id int, hadm_id int, specimen_id int, itemid int, charttime timestamp_ntz, valuenum double"
    labs = spark.sql("select 1 subject_id, 2 hadm_id, s specimen_id, i itemid, timestamp_ntz'2150-01-01 05:00:00' charttime, 4.0D valuenum "
                     "from values (7, 50912), (7, 50861), (7, 51237), (7, 51301), (8, 50912) as t(s, i)")
    assert labs.columns == [c.split()[0] for c in types.split(", ")]
    got = lab_panels(labs, ["complete_blood_count", "chemistry", "blood_differential", "coagulation", "enzyme"])
    assert sorted((r.specimen_id, r.chemistry__creatinine, r.coagulation__inr, r.enzyme__alt) for r in got.collect()) == [
        (7, 4.0, 4.0, 4.0), (8, 4.0, None, None)]


def test_keywords_are_looked_for_once_a_distinct_value(spark, tmp_path):
    """The optimiser neither tests every row before the grouping nor copies the test to the other side of the join."""
    from chartwise.operators.codes import match_keywords

    data = [("Aspirin 5", "PO", "MAIN"), ("Aspirin 5", "PO", "BASE"), ("Aspirin 5", None, "MAIN"), ("aspirin cream", "PO", "MAIN"),
            ("Other", "PO", "MAIN"), (None, "PO", "MAIN"), ("aspirin b", "PO", "BASE"), ("aspirin c", "PO", None)]
    spark.createDataFrame(data, "drug string, route string, drug_type string").write.parquet(str(tmp_path / "rx"))
    rx = spark.read.parquet(str(tmp_path / "rx"))
    keep = (F.col("drug_type") != "BASE") & ~F.lower("drug").rlike("cream")
    out = match_keywords(rx, "drug", ["aspirin"], "lower", keep, keys=("drug", "route"), filter_cols=("drug_type",))
    assert sorted(map(tuple, out.collect())) == [("Aspirin 5", "PO", "BASE"), ("Aspirin 5", "PO", "MAIN")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("rlike") == 2 and plan.lower().index("rlike") < plan.index("Aggregate [drug", plan.index("Aggregate [drug") + 1)
