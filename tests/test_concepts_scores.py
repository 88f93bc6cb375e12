"""Scores and long stays by hand: the inputs of one concept are given, its rows computed from the published rules."""
from datetime import datetime, timedelta

import pytest

from chartwise.plans.registry import Context
from chartwise.sources import Sources

T0 = datetime(2150, 1, 1)
STAY = dict(subject_id=1, hadm_id=101, stay_id=11, intime=T0, outtime=T0 + timedelta(days=12))


def h(x):
    return T0 + timedelta(hours=x)


def frame(spark, rows, types):
    kinds = {int: "long", float: "double", str: "string", datetime: "timestamp_ntz"}
    return spark.createDataFrame([tuple(r.get(c) for c in types) for r in rows], ", ".join(f"{c} {kinds[t]}" for c, t in types.items()))


def given(spark, concept, **tables):
    """Rows of ``concept`` when its inputs are ``tables``: name -> (rows, column types)."""
    c = Context(Sources.from_tables(spark, {}))
    for name, (rows, types) in tables.items():
        c.pin(name, frame(spark, rows, types))
    return [r.asDict() for r in c.table(concept).collect()]


KEYS = {"subject_id": int, "hadm_id": int, "stay_id": int}
ICU = ([STAY], {**KEYS, "intime": datetime, "outtime": datetime})


def first_day(**values):
    return [{"stay_id": 11, **values}], {"stay_id": int, **{k: (int if k == "gcs_unable" else float) for k in values}}


def test_apsiii(spark):
    bg_types = {"hadm_id": int, "charttime": datetime, "specimen": str, **dict.fromkeys(["po2", "aado2", "ph", "pco2", "fio2", "fio2_chartevents"], float)}
    vent = ([dict(stay_id=11, starttime=h(200), endtime=h(210), ventilation_status="InvasiveVent")],
            {"stay_id": int, "starttime": datetime, "endtime": datetime, "ventilation_status": str})
    lab = dict(hematocrit_min=40.0, hematocrit_max=45.0, wbc_min=2.0, wbc_max=10.0, creatinine_min=1.0, creatinine_max=2.0, bun_min=10.0, bun_max=30.0,
               sodium_min=130.0, sodium_max=140.0, albumin_min=2.2, albumin_max=3.0, bilirubin_total_min=1.0, bilirubin_total_max=4.0,
               glucose_min=None, glucose_max=None)
    vital = dict(heart_rate_min=60.0, heart_rate_max=130.0, mbp_min=50.0, mbp_max=110.0, temperature_min=35.5, temperature_max=38.0, resp_rate_min=10.0,
                 resp_rate_max=20.0, glucose_min=50.0, glucose_max=300.0)
    gases = [dict(hadm_id=101, charttime=h(5), specimen="ART.", po2=60.0, ph=7.25, pco2=35.0),
             dict(hadm_id=101, charttime=h(205), specimen="ART.", po2=99.0, fio2=60.0, aado2=300.0),     # on the ventilator: its AaDO2 counts, not its PaO2
             dict(hadm_id=101, charttime=h(6), specimen="VEN.", po2=40.0, ph=7.0, pco2=90.0),
             dict(hadm_id=101, charttime=h(-1), specimen="ART.", po2=500.0)]                             # before the stay
    r, = given(spark, "apsiii", icustays=ICU, admissions=([STAY], {"hadm_id": int}), patients=([STAY], {"subject_id": int}),
               diagnoses_icd=([dict(hadm_id=101, icd_code="4019", icd_version=9)], {"hadm_id": int, "icd_code": str, "icd_version": int}),
               bg=(gases, bg_types), ventilation=vent, first_day_gcs=first_day(gcs_motor=3.0, gcs_verbal=1.0, gcs_eyes=1.0, gcs_unable=0),
               first_day_vitalsign=first_day(**vital), first_day_urine_output=first_day(urineoutput=300.0), first_day_lab=first_day(**lab))
    want = dict(hr_score=7, mbp_score=15, temp_score=2, resp_rate_score=8, hematocrit_score=3, wbc_score=5, creatinine_score=10, bun_score=7, sodium_score=2,
                albumin_score=6, bilirubin_score=6, glucose_score=3, uo_score=15, gcs_score=33, pao2_aado2_score=5, acidbase_score=6)
    assert {k: r[k] for k in want} == want and r["apsiii"] == sum(want.values()) == 133


def test_oasis_reports_the_value_that_scored(spark):
    r, = given(
        spark, "oasis", icustays=ICU, patients=([STAY], {"subject_id": int}), age=([dict(hadm_id=101, age=60)], {"hadm_id": int, "age": int}),
        admissions=([dict(hadm_id=101, admittime=h(-1), admission_type="ELECTIVE")], {"hadm_id": int, "admittime": datetime, "admission_type": str}),
        services=([dict(hadm_id=101, transfertime=h(0), curr_service="CSURG")], {"hadm_id": int, "transfertime": datetime, "curr_service": str}),
        ventilation=([], {"stay_id": int, "starttime": datetime, "endtime": datetime, "ventilation_status": str}), first_day_gcs=first_day(gcs_min=14.0),
        first_day_vitalsign=first_day(heart_rate_max=110.0, heart_rate_min=30.0, mbp_max=150.0, mbp_min=70.0, resp_rate_max=20.0, resp_rate_min=14.0,
                                      temperature_max=37.0, temperature_min=36.0), first_day_urine_output=first_day(urineoutput=1000.0))
    want = dict(preiculos=60, preiculos_score=3, age_score=6, gcs_score=3, heartrate=30.0, heart_rate_score=4, meanbp=150.0, mbp_score=3, resprate=17.0,
                resp_rate_score=0, temp=36.0, temp_score=2, urineoutput_score=5, mechvent_score=0, electivesurgery_score=0)
    assert {k: r[k] for k in want} == want and r["oasis"] == 26


def test_lods_counts_gases_under_help_only(spark):
    gases = [dict(hadm_id=101, charttime=h(100), pao2fio2ratio=140.0),       # on the ventilator
             dict(hadm_id=101, charttime=h(3), pao2fio2ratio=90.0),          # without help
             dict(hadm_id=101, charttime=h(300), pao2fio2ratio=50.0)]        # after the stay
    chart = dict(charttime=datetime, itemid=int, value=str, stay_id=int)
    r, = given(
        spark, "lods", icustays=ICU, admissions=([STAY], {"hadm_id": int}), patients=([STAY], {"subject_id": int}), chartevents=([], chart),
        bg=(gases, {"hadm_id": int, "charttime": datetime, "pao2fio2ratio": float}),
        ventilation=([dict(stay_id=11, starttime=h(90), endtime=datetime(2999, 1, 1), ventilation_status="InvasiveVent")],
                     {"stay_id": int, "starttime": datetime, "endtime": datetime, "ventilation_status": str}),
        first_day_gcs=first_day(gcs_min=8.0), first_day_vitalsign=first_day(heart_rate_max=150.0, heart_rate_min=60.0, sbp_max=120.0, sbp_min=65.0),
        first_day_urine_output=first_day(urineoutput=700.0),
        first_day_lab=first_day(bun_max=20.0, bun_min=9.0, wbc_max=60.0, wbc_min=30.0, bilirubin_total_max=1.0, creatinine_max=1.0, pt_min=11.0, pt_max=14.0,
                                platelets_min=200.0))
    want = dict(neurologic=3, cardiovascular=3, renal=3, pulmonary=3, hematologic=1, hepatic=0)
    assert {k: r[k] for k in want} == want and r["lods"] == 13


def test_sirs_missing_values_count_nothing(spark):
    vital = dict(temperature_min=35.0, temperature_max=39.0, heart_rate_max=None, resp_rate_max=None)
    r, = given(spark, "sirs", icustays=ICU, first_day_bg_art=first_day(pco2_min=30.0), first_day_vitalsign=first_day(**vital),
               first_day_lab=first_day(wbc_min=5.0, wbc_max=11.0, bands_max=11.0))
    assert {k: r[k] for k in ("sirs", "temp_score", "heart_rate_score", "resp_score", "wbc_score")} == dict(
        sirs=3, temp_score=1, heart_rate_score=None, resp_score=1, wbc_score=1)


def test_creatinine_over_a_stay_of_twelve_days(spark):
    """The 7-day look-back forgets what is older; days far apart lie in different buckets."""
    times = {1: 1.0, 30: 1.4, 167: 0.9, 170: 2.0, 200: 1.9, 280: 3.0}
    lab = [dict(subject_id=1, charttime=h(t), itemid=50912, valuenum=v) for t, v in times.items()]
    rows = given(spark, "kdigo_creatinine", icustays=ICU, labevents=(lab, {"subject_id": int, "charttime": datetime, "itemid": int, "valuenum": float}))
    got = {int((r["charttime"] - T0).total_seconds() // 3600): (r["creat_low_past_48hr"], r["creat_low_past_7day"]) for r in rows}
    assert got == {1: (None, None), 30: (1.0, 1.0), 167: (None, 1.0), 170: (0.9, 0.9), 200: (0.9, 0.9), 280: (None, 0.9)}


def test_urine_over_a_stay_of_twelve_days(spark):
    """Hourly outputs of 50 ml for 30 hours, nothing for a week, then again."""
    hours = [*range(1, 31), *range(200, 231)]
    uo = ([dict(stay_id=11, charttime=h(t), urineoutput=50.0) for t in hours], {"stay_id": int, "charttime": datetime, "urineoutput": float})
    wd = ([dict(stay_id=11, starttime=h(-2), endtime=h(300), weight=50.0)], {"stay_id": int, "starttime": datetime, "endtime": datetime, "weight": float})
    rows = {int((r["charttime"] - T0).total_seconds() // 3600): r for r in given(spark, "kdigo_uo", icustays=ICU, urine_output=uo, weight_durations=wd)}
    assert rows[30]["urineoutput_24hr"] == 50.0 * 25 and rows[30]["uo_tm_24hr"] == 25.0 and rows[30]["uo_rt_24hr"] == 1.0
    assert rows[200]["urineoutput_24hr"] == 50.0 and rows[200]["uo_tm_24hr"] == 170.0        # the first output after a week covers it
    assert rows[206]["urineoutput_6hr"] == 50.0 * 7 and rows[230]["urineoutput_24hr"] == 50.0 * 25


def test_oxygen_devices_in_alphabetical_order_and_latest_flow(spark):
    types = dict(subject_id=int, stay_id=int, charttime=datetime, storetime=datetime, itemid=int, value=str, valuenum=float)
    row = lambda item, value, num, stored: dict(subject_id=1, stay_id=11, charttime=h(1), storetime=h(stored), itemid=item, value=value, valuenum=num)
    rows = [row(223834, "4", 4.0, 2), row(227582, "6", 6.0, 3), row(227287, "2", 2.0, 2)]
    rows += [row(226732, name, None, 2) for name in ("Nasal cannula", "Face tent", "None", "Aerosol-cool", "Trach mask")]
    r, = given(spark, "oxygen_delivery", chartevents=(rows, types))
    assert (r["o2_flow"], r["o2_flow_additional"]) == (6.0, 2.0)          # the later stored of the two flow items
    assert [r[f"o2_delivery_device_{k}"] for k in range(1, 5)] == ["Aerosol-cool", "Face tent", "Nasal cannula", "None"]


def test_blood_gas_takes_the_latest_fraction_within_four_hours(spark):
    lab_types = dict(specimen_id=int, subject_id=int, hadm_id=int, charttime=datetime, storetime=datetime, itemid=int, value=str, valuenum=float)
    lab = [dict(specimen_id=s, subject_id=1, hadm_id=101, charttime=h(t), itemid=50821, value="80", valuenum=80.0) for s, t in ((1, 24), (2, 30), (3, 30))]
    chart_types = dict(subject_id=int, charttime=datetime, itemid=int, valuenum=float)
    chart = [dict(subject_id=1, charttime=h(t), itemid=223835, valuenum=v) for t, v in ((20, 0.5), (19, 40.0), (23, 15.0), (25, 60.0))]
    rows = sorted(given(spark, "bg", labevents=(lab, lab_types), chartevents=(chart, chart_types)), key=lambda r: r["charttime"])
    # at 24 h the fraction of 20 h counts (15 has no known unit); at 30 h the one of 25 h is too old; one row a time
    assert [(r["charttime"], r["fio2_chartevents"]) for r in rows] == [(h(24), 50.0), (h(30), None)]
    assert rows[0]["pao2fio2ratio"] == pytest.approx(160.0)


def test_dialysis_points_inside_an_interval_take_its_values(spark):
    chart_types = dict(stay_id=int, charttime=datetime, itemid=int, value=str, valuenum=float)
    chart = [dict(stay_id=11, charttime=h(t), itemid=i, value=v) for t, i, v in ((5, 225725, "x"), (50, 226499, "900"), (60, 225965, "In use"))]
    proc = [dict(stay_id=11, starttime=h(40), endtime=h(55), itemid=225802, value="15")]
    rows = given(spark, "rrt", chartevents=(chart, chart_types), procedureevents=(proc, dict(stay_id=int, starttime=datetime, endtime=datetime, itemid=int, value=str)),
                 inputevents=([], dict(stay_id=int, starttime=datetime, endtime=datetime, itemid=int, amount=float)))
    got = sorted((r["charttime"], r["dialysis_present"], r["dialysis_active"], r["dialysis_type"]) for r in rows if r["charttime"] != h(5) and r["charttime"] != h(60))
    assert got == [(h(40), 1, 1, "CRRT"), (h(50), 1, 1, "CRRT")]
    assert {(r["charttime"], r["dialysis_active"]) for r in rows if r["charttime"] in (h(5), h(60))} == {(h(5), 0), (h(60), 1)}
