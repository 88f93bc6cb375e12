"""Hand-written rows for concept rules and quirks (FIXTURES.md §4).

Each test builds tiny base tables, runs one concept and checks the rule that
is easy to get wrong: window ends, carry-forward gaps, quirks Q1/Q2/Q11,
episode splits, ladders.  Spark and the SQL oracle could share a misreading;
these rows are computed by hand from the rules.
"""
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chartwise.plans.registry import Context
from chartwise.sources import Sources

T0 = datetime(2150, 1, 1, 0, 0)


def h(x, m=0):
    return T0 + timedelta(hours=x, minutes=m)


CHART = ("subject_id long, hadm_id long, stay_id long, charttime timestamp_ntz, storetime timestamp_ntz, "
         "itemid int, value string, valuenum double, valueuom string")


def chart(spark, rows):
    return spark.createDataFrame(
        [(s, 100 + s if s is not None else None, st, t, t, i, v, vn, None) for (s, st, t, i, v, vn) in rows], CHART)


def ctx(spark, **tables):
    return Context(Sources.from_tables(spark, tables))


def test_gcs_ett_and_carry_forward(spark):
    rows = [
        (1, 11, h(0), 223901, "6", 6.0), (1, 11, h(0), 223900, "No Response-ETT", 1.0), (1, 11, h(0), 220739, "4", 4.0),
        (1, 11, h(2), 223901, "5", 5.0),                      # only motor; previous verbal is ETT
        (1, 11, h(8), 220739, "3", 3.0),                      # 6 h after the previous row: nothing carried
        (1, 11, h(9), 223900, "4", 4.0),                      # previous (1 h old) has eyes 3
    ]
    g = ctx(spark, chartevents=chart(spark, rows)).table("gcs").orderBy("charttime").collect()
    assert [r["gcs"] for r in g] == [15.0, 15.0, 6.0 + 5.0 + 3.0, 6.0 + 4.0 + 3.0]
    assert g[0]["gcs_unable"] == 1 and g[0]["gcs_verbal"] == 0.0
    assert g[1]["gcs_verbal"] == 0.0          # carried from the ETT row
    assert g[2]["gcs_motor"] is None          # exactly 6 h: not carried
    assert g[3]["gcs_eyes"] == 3.0


def test_height_inch_only_rows_lose_ids_q1(spark):
    rows = [
        (1, 11, h(0), 226730, "170", 170.0), (1, 11, h(0), 226707, "60", 60.0),   # both: cm wins
        (1, 11, h(1), 226707, "70", 70.0),                                         # inch only -> NULL ids
        (1, 11, h(2), 226730, "230", 230.0), (1, 11, h(3), 226730, "120", 120.0),  # bounds excluded
    ]
    out = ctx(spark, chartevents=chart(spark, rows)).table("height").collect()
    got = {(r["subject_id"], r["charttime"], r["height"]) for r in out}
    assert got == {(1, h(0), 170.0), (None, None, 177.8)}


def test_ventilation_episodes_split_and_single_rows_dropped(spark):
    vs = spark.createDataFrame([
        (1, 11, h(0), "CMV"), (1, 11, h(2), "CMV"), (1, 11, h(3), None),
        (1, 11, h(20), "CMV"), (1, 11, h(21), "CMV"),
    ], "subject_id long, stay_id long, charttime timestamp_ntz, ventilator_mode string") \
        .withColumn("ventilator_mode_hamilton", F.lit(None).cast("string"))
    od = spark.createDataFrame([(1, 11, h(3), "Nasal cannula")],
                               "subject_id long, stay_id long, charttime timestamp_ntz, o2_delivery_device_1 string")
    from chartwise.concepts.treatment import ventilation
    ep = ventilation(vs, od).orderBy("starttime").collect()
    # CMV 0-2 ends at the next documented time (3 h, < 14 h away); the O2 row at 3 h is a
    # single-time episode (dropped); CMV again after >= 14 h is a new episode ending at 21 h
    assert [(r["starttime"], r["endtime"], r["ventilation_status"]) for r in ep] == [
        (h(0), h(3), "InvasiveVent"), (h(20), h(21), "InvasiveVent")]


def test_antibiotic_base_row_reenters_by_drug_route_q11(spark):
    rx = spark.createDataFrame([
        (1, 101, "Vancomycin", "MAIN", "IV", h(1), h(5)),
        (1, 101, "Vancomycin", "BASE", "IV", h(2), h(6)),     # excluded type, but (drug, route) is in the dictionary
        (1, 101, "Vancomycin", "MAIN", None, h(3), h(7)),     # NULL route never matches
        (1, 101, "Bacitracin Ointment", "MAIN", "TP", h(4), h(8)),
    ], "subject_id long, hadm_id long, drug string, drug_type string, route string, "
       "starttime timestamp_ntz, stoptime timestamp_ntz")
    ie = spark.createDataFrame([(1, 101, 11, h(0), h(30))],
                               "subject_id long, hadm_id long, stay_id long, intime timestamp_ntz, outtime timestamp_ntz")
    out = ctx(spark, prescriptions=rx, icustays=ie).table("antibiotic").collect()
    assert sorted(r["starttime"] for r in out) == [h(1), h(2)]
    assert all(r["stay_id"] == 11 for r in out)


def test_urine_output_irrigant_is_negative(spark):
    oe = spark.createDataFrame([(11, h(1), 226559, 100.0), (11, h(1), 227488, 30.0), (11, h(2), 227488, -5.0)],
                               "stay_id long, charttime timestamp_ntz, itemid int, value double")
    out = {r["charttime"]: r["urineoutput"] for r in ctx(spark, outputevents=oe).table("urine_output").collect()}
    assert out == {h(1): 70.0, h(2): -5.0}


@pytest.mark.parametrize("row,expected", [
    (dict(pao2fio2ratio_vent=99.0), {"respiration": 4}),
    (dict(pao2fio2ratio_novent=350.0), {"respiration": 1}),
    (dict(), {"respiration": None, "coagulation": None, "liver": None, "cardiovascular": None,
              "cns": None, "renal": None}),
    (dict(platelet_min=19.0, bilirubin_max=1.2, gcs_min=14.0), {"coagulation": 4, "liver": 1, "cns": 1}),
    (dict(rate_epinephrine=0.05), {"cardiovascular": 3}),
    (dict(rate_dopamine=16.0), {"cardiovascular": 4}),
    (dict(meanbp_min=69.0), {"cardiovascular": 1}),
    (dict(uo_24hr=199.0), {"renal": 4}),
    (dict(creatinine_max=1.2), {"renal": 1}),
])
def test_sofa_ladders(spark, row, expected):
    from chartwise.config import scores as S
    from chartwise.operators.scores import points
    cols = ["pao2fio2ratio_vent", "pao2fio2ratio_novent", "platelet_min", "bilirubin_max", "meanbp_min",
            "gcs_min", "rate_dopamine", "rate_epinephrine", "rate_norepinephrine", "rate_dobutamine",
            "creatinine_max", "uo_24hr"]
    df = spark.createDataFrame([tuple(row.get(c) for c in cols)], ", ".join(f"{c} double" for c in cols))
    got = df.select(*[points(c).alias(k) for k, c in {"respiration": S.SOFA_RESPIRATION, **S.SOFA}.items()]).first().asDict()
    for k, v in expected.items():
        assert got[k] == v, (k, got)


def test_kdigo_creatinine_lookback_is_strictly_earlier(spark):
    ie = spark.createDataFrame([(1, 101, 11, h(0), h(100))],
                               "subject_id long, hadm_id long, stay_id long, intime timestamp_ntz, outtime timestamp_ntz")
    le = spark.createDataFrame([
        (1, 101, 1, 50912, h(-200), h(-200), "", 0.5),   # before intime - 7 d: ignored
        (1, 101, 2, 50912, h(1), h(1), "", 1.0),
        (1, 101, 3, 50912, h(49), h(49), "", 2.0),       # 48 h after: window [t-48h, t) includes h(1)
        (1, 101, 4, 50912, h(50), h(50), "", 3.0),       # h(1) is 49 h back: outside 48 h, inside 7 d
    ], "subject_id long, hadm_id long, specimen_id long, itemid int, charttime timestamp_ntz, "
       "storetime timestamp_ntz, value string, valuenum double")
    out = {r["charttime"]: (r["creat_low_past_48hr"], r["creat_low_past_7day"])
           for r in ctx(spark, icustays=ie, labevents=le).table("kdigo_creatinine").collect()}
    assert out == {h(1): (None, None), h(49): (1.0, 1.0), h(50): (2.0, 1.0)}


def test_weight_durations_admit_start_and_backfill(spark):
    ie = spark.createDataFrame([(1, 101, 11, h(10), h(40)), (2, 102, 21, h(10), h(40))],
                               "subject_id long, hadm_id long, stay_id long, intime timestamp_ntz, outtime timestamp_ntz")
    rows = [
        (1, 11, h(12), 226512, "80", 80.0),   # first admit weight -> starts at intime - 2 h
        (1, 11, h(20), 224639, "78", 78.0),
        (2, 21, h(15), 224639, "60", 60.0),   # daily only, after intime -> back-filled from intime - 2 h
    ]
    out = ctx(spark, chartevents=chart(spark, rows), icustays=ie).table("weight_durations").collect()
    got = sorted((r["stay_id"], r["starttime"], r["endtime"], r["weight"]) for r in out)
    assert got == [(11, h(8), h(20), 80.0), (11, h(20), h(42), 78.0),
                   (21, h(8), h(15), 60.0), (21, h(15), h(42), 60.0)]


def test_vasoactive_segments_and_same_drug_overlap_q8(spark):
    cols = "stay_id long, linkorderid long, vaso_rate double, vaso_amount double, starttime timestamp_ntz, endtime timestamp_ntz"
    nor = spark.createDataFrame([(11, 1, 0.1, 1.0, h(0), h(4)), (11, 2, 0.2, 1.0, h(2), h(6))], cols)
    epi = spark.createDataFrame([(11, 3, 0.05, 1.0, h(4), h(5))], cols)
    empty = spark.createDataFrame([], cols)
    from chartwise.concepts.medication import vasoactive_agent
    seg = vasoactive_agent(empty, empty, epi, nor, empty, empty, empty).collect()
    got = sorted((r["starttime"], r["endtime"], r["norepinephrine"], r["epinephrine"]) for r in seg)
    assert got == [(h(0), h(2), 0.1, None),
                   (h(2), h(4), 0.1, None), (h(2), h(4), 0.2, None),   # two infusions of one drug: two rows
                   (h(4), h(5), 0.2, 0.05), (h(5), h(6), 0.2, None)]


def test_suspicion_windows(spark):
    ab = spark.createDataFrame([(1, 101, 11, "Vancomycin", "IV", h(100), h(110)),
                                (1, 101, 11, "Cefepime", "IV", h(300), h(310)),
                                (1, 101, 11, "Meropenem", "IV", h(500), h(510))],
                               "subject_id long, hadm_id long, stay_id long, antibiotic string, route string, "
                               "starttime timestamp_ntz, stoptime timestamp_ntz")
    me = spark.createDataFrame([
        (1, 1, 101, h(24), h(29), "BLOOD", 80002, "E COLI"),        # 71 h before the first antibiotic
        (2, 1, 101, h(24), h(30), "URINE", None, "E COLI"),         # NULL org_itemid -> negative (Q25)
        (3, 1, 101, h(312), None, "SPUTUM", None, None),            # date-only: day 13 = antibiotic day 12 + 1
    ], "micro_specimen_id long, subject_id long, hadm_id long, chartdate timestamp_ntz, charttime timestamp_ntz, "
       "spec_type_desc string, org_itemid int, org_name string")
    from chartwise.concepts.sepsis import suspicion_of_infection
    out = {r["antibiotic"]: r for r in suspicion_of_infection(ab, me).collect()}
    assert out["Vancomycin"]["suspected_infection_time"] == h(29)
    assert out["Vancomycin"]["positive_culture"] == 1 and out["Vancomycin"]["specimen"] == "BLOOD"
    assert out["Cefepime"]["culture_time"] == h(312) and out["Cefepime"]["suspected_infection_time"] == h(300)
    assert out["Meropenem"]["suspected_infection"] == 0 and out["Meropenem"]["suspected_infection_time"] is None


def test_icustay_hourly_spine(spark):
    times = spark.createDataFrame([(1, 101, 11, h(0, 30), h(2, 10)), (2, 102, 21, None, None)],
                                  "subject_id long, hadm_id long, stay_id long, intime_hr timestamp_ntz, "
                                  "outtime_hr timestamp_ntz")
    from chartwise.concepts.demographics import icustay_hourly
    sp = icustay_hourly(times).orderBy("hr").collect()
    assert [r["hr"] for r in sp] == list(range(-24, 3))       # 2 hour boundaries crossed
    assert sp[24]["endtime"] == h(1) and all(r["stay_id"] == 11 for r in sp)


def test_charlson_hierarchies_and_age_points(spark):
    adm = spark.createDataFrame([(1, 101), (2, 102)], "subject_id long, hadm_id long")
    dx = spark.createDataFrame([
        (1, 101, "5712", 9), (1, 101, "4560", 9),     # mild + severe liver -> max(1, 3) = 3
        (1, 101, "2500", 9), (1, 101, "E112", 10),    # diabetes without + with cc -> 2
        (1, 101, "C78", 10), (1, 101, "C34", 10),     # cancer + metastatic -> 6
        (2, 102, "I21", 10), (2, 102, "B20", 10),     # MI 1 + AIDS 6
    ], "subject_id long, hadm_id long, icd_code string, icd_version int")
    age = spark.createDataFrame([(101, 50), (102, 81)], "hadm_id long, age long")
    from chartwise.concepts.comorbidity import charlson
    out = {r["hadm_id"]: r for r in charlson(adm, dx, age).collect()}
    a, b = out[101], out[102]
    assert (a["mild_liver_disease"], a["severe_liver_disease"], a["age_score"]) == (1, 1, 0)
    assert a["charlson_comorbidity_index"] == 3 + 2 + 6
    assert (b["myocardial_infarct"], b["aids"], b["age_score"]) == (1, 1, 4)
    assert b["charlson_comorbidity_index"] == 4 + 1 + 6


def test_infusion_hours_need_both_times(spark):
    from chartwise.concepts.score import _infusion_hours

    bounds = spark.sql("select 1 as stay_id, timestamp_ntz'2020-01-01 00:00:00' as _lo, timestamp_ntz'2020-01-01 05:00:00' as _hi")
    infusions = spark.sql("""
        select 1 as stay_id, 'rate_x' as _drug, 2.0d as vaso_rate, timestamp_ntz'2020-01-01 01:30:00' as starttime,
               cast(null as timestamp_ntz) as endtime
        union all select 1, 'rate_x', 3.0d, cast(null as timestamp_ntz), timestamp_ntz'2020-01-01 04:30:00'
        union all select 1, 'rate_x', 5.0d, timestamp_ntz'2020-01-01 00:30:00', timestamp_ntz'2020-01-01 02:00:00'""")
    got = sorted((r._h % 24, r.rate_x) for r in _infusion_hours(bounds, infusions, [("rate_x", None)]).collect())
    assert got == [(1, 5.0), (2, 5.0)]


def test_worst_of_needs_a_maximum(spark):
    from pyspark.sql import functions as F

    from chartwise.operators.scores import worst_of

    df = spark.sql("select cast(null as double) as hi, 1.0d as lo, 8 as s_lo, cast(null as int) as s_hi "
                   "union all select 9.0d, 4.0d, 1, 3")
    got = [r[0] for r in df.select(worst_of(F.col("lo"), F.col("hi"), 5.0, F.col("s_lo"), F.col("s_hi"))).collect()]
    assert got == [None, 3]


def test_neighbours_and_running_sum_of_null_keys(spark):
    from pyspark.sql import functions as F

    from chartwise.operators.windows import neighbours, running_sum

    df = spark.sql("select cast(null as int) as k, timestamp_ntz'2020-01-01 10:00:00' as t, 1 as v "
                   "union all select cast(null as int), timestamp_ntz'2020-01-02 10:00:00', 2")
    assert [r.prev_v for r in neighbours(df, "k", "t", ["v"]).orderBy("t").collect()] == [None, 1]
    assert [r.s for r in running_sum(df, "k", "t", F.col("v"), "s").orderBy("t").collect()] == [1, 3]


def test_map_labels_without_synonyms(spark):
    from pyspark.sql import functions as F

    from chartwise.concepts.treatment import map_labels

    assert spark.range(1).select(map_labels(F.lit("a"), [])).first()[0] == "a"


def test_bg_hashes_its_numbers_and_keeps_ids_of_text_rows(spark):
    """The greatest id of a specimen may stand in its text rows; a specimen without a number has one too."""
    from chartwise.concepts.measurement import bg

    t = datetime(2150, 1, 1, 1)
    lab = [(1, 5, 10, 50821, t, t, None, 90.0), (1, 7, 10, 52033, t, t, "ART.", None), (1, 9, 10, 50807, t, t, "x", None),
           (2, 5, None, 50821, t, t, None, 80.0), (2, 5, None, 52033, t, t, "VEN.", None),
           (3, 5, 11, 50820, t, t, None, 7.0), (3, 5, 11, 52033, t, t, "ART.", None), (4, 5, 12, 50821, t, t, None, 70.0)]
    labs = spark.createDataFrame(lab, "subject_id long, hadm_id long, specimen_id long, itemid int, charttime timestamp_ntz, "
                                      "storetime timestamp_ntz, value string, valuenum double")
    charted = spark.createDataFrame([], "subject_id long, charttime timestamp_ntz, itemid int, valuenum double")
    out = bg(labs, charted)
    got = sorted(tuple(r) for r in out.select("subject_id", "hadm_id", "specimen", "po2").collect())
    assert got == [(1, 9, "ART.", 90.0), (2, 5, "VEN.", 80.0), (4, 5, None, 70.0)]
    assert "HashAggregate(keys=[specimen_id" in out._jdf.queryExecution().executedPlan().toString()
