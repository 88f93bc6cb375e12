"""Oracle SQL: SOFA, first-day SOFA, LODS and OASIS, from rule rows over long measurements."""

from __future__ import annotations

from .compose import define
from .rules import all_null, bands, total, worst

# FIXED VALUES: (points, condition) of each organ
SOFA = {
    "respiration": (["pf_vent", "pf_novent"], [
        (4, "pf_vent < 100"), (3, "pf_vent < 200"), (2, "least(pf_vent, pf_novent) < 300"),
        (1, "least(pf_vent, pf_novent) < 400")]),
    "coagulation": (["platelet"], [(4, "platelet < 20"), (3, "platelet < 50"), (2, "platelet < 100"), (1, "platelet < 150")]),
    "liver": (["bilirubin"], [(4, "bilirubin >= 12"), (3, "bilirubin >= 6"), (2, "bilirubin >= 2"), (1, "bilirubin >= 1.2")]),
    "cardiovascular": (["mbp", "dopamine", "dobutamine", "epinephrine", "norepinephrine"], [
        (4, "dopamine > 15"), (4, "epinephrine > 0.1"), (4, "norepinephrine > 0.1"),
        (3, "dopamine > 5"), (3, "epinephrine IS NOT NULL"), (3, "norepinephrine IS NOT NULL"),
        (2, "dopamine > 0"), (2, "dobutamine > 0"), (1, "mbp < 70")]),
    "cns": (["gcs"], [(4, "gcs < 6"), (3, "gcs <= 9"), (2, "gcs <= 12"), (1, "gcs <= 14")]),
    "renal": (["urine", "creatinine"], [
        (4, "creatinine >= 5"), (4, "urine < 200"), (3, "creatinine >= 3.5"), (3, "urine < 500"),
        (2, "creatinine >= 2"), (1, "creatinine >= 1.2")]),
}
DRUGS = ["epinephrine", "norepinephrine", "dopamine", "dobutamine"]
ORGANS = list(SOFA)
# on the first day a ventilated ratio of 200 or more gives no points
FIRST_DAY_SOFA = SOFA | {"respiration": (["pf_vent", "pf_novent"], [
    (4, "pf_vent < 100"), (3, "pf_vent < 200"), (2, "pf_novent < 300"), (1, "pf_novent < 400")])}


def organ_points(table) -> str:
    return ", ".join(f"{worst(rules, all_null(inputs))} AS {organ}" for organ, (inputs, rules) in table.items())


#: arterial gases of a stay's patient, with whether the stay was ventilated then
GASES = """SELECT ie.stay_id, bg.charttime, bg.specimen, bg.pao2fio2ratio AS v,
        EXISTS (SELECT 1 FROM ventilation e WHERE e.stay_id = ie.stay_id AND e.ventilation_status = 'InvasiveVent'
                AND bg.charttime BETWEEN e.starttime AND e.endtime) AS vent
      FROM icustays ie JOIN bg USING (subject_id)"""

# measure -> (output name, worst value of the hour, stay-level rows (stay_id, charttime, v))
HOURLY = {
    "pf_novent": ("pao2fio2ratio_novent", "min", "SELECT stay_id, charttime, v FROM gases WHERE specimen = 'ART.' AND NOT vent"),
    "pf_vent": ("pao2fio2ratio_vent", "min", "SELECT stay_id, charttime, v FROM gases WHERE specimen = 'ART.' AND vent"),
    "mbp": ("meanbp_min", "min", "SELECT stay_id, charttime, mbp FROM vitalsign"),
    "gcs": ("gcs_min", "min", "SELECT stay_id, charttime, gcs FROM gcs"),
    "urine": ("uo_24hr", "max", "SELECT stay_id, charttime, urineoutput_24hr / uo_tm_24hr * 24 FROM urine_output_rate"
                                " WHERE uo_tm_24hr BETWEEN 22 AND 30"),
    "bilirubin": ("bilirubin_max", "max", "SELECT stay_id, charttime, bilirubin_total FROM enzyme JOIN icustays USING (hadm_id)"),
    "creatinine": ("creatinine_max", "max", "SELECT stay_id, charttime, creatinine FROM chemistry JOIN icustays USING (hadm_id)"),
    "platelet": ("platelet_min", "min", "SELECT stay_id, charttime, platelet FROM complete_blood_count JOIN icustays USING (hadm_id)"),
}

_readings = " UNION ALL ".join(f"SELECT '{m}', * FROM ({rows})" for m, (_, _, rows) in HOURLY.items())
_infusions = " UNION ALL ".join(f"SELECT '{d}', stay_id, starttime, endtime, vaso_rate FROM {d}" for d in DRUGS)
_pivot = ", ".join([f"{agg}(v) FILTER (WHERE measure = '{m}') AS {m}" for m, (_, agg, _) in HOURLY.items()]
                   + [f"max(v) FILTER (WHERE measure = '{d}') AS {d}" for d in DRUGS])
_day = ", ".join(f"(SELECT coalesce(max(p.{o}), 0) FROM points p WHERE p.stay_id = c.stay_id"
                 f" AND p.hr BETWEEN c.hr - 23 AND c.hr) AS {o}_24hours" for o in ORGANS)
define("sofa", ("icustay_hourly", "bg", "ventilation", "vitalsign", "gcs", "enzyme", "chemistry",
                "complete_blood_count", "urine_output_rate", *DRUGS), f"""
    WITH gases AS ({GASES}),
    readings(measure, stay_id, charttime, v) AS ({_readings}),
    infusions(measure, stay_id, starttime, endtime, v) AS ({_infusions}),
    facts AS (
      SELECT h.stay_id, h.hr, measure, v FROM icustay_hourly h JOIN readings r ON r.stay_id = h.stay_id
        AND r.charttime > h.endtime - INTERVAL 1 HOUR AND r.charttime <= h.endtime
      UNION ALL
      SELECT h.stay_id, h.hr, measure, v FROM icustay_hourly h JOIN infusions i ON i.stay_id = h.stay_id
        AND h.endtime > i.starttime AND h.endtime <= i.endtime),
    hourly AS (SELECT stay_id, hr, {_pivot} FROM facts GROUP BY stay_id, hr),
    points AS (
      SELECT h.stay_id, h.hr, h.endtime, hourly.* EXCLUDE (stay_id, hr), {organ_points(SOFA)}
      FROM icustay_hourly h LEFT JOIN hourly ON hourly.stay_id = h.stay_id AND hourly.hr = h.hr),
    day AS (SELECT c.*, {_day} FROM points c WHERE c.hr >= 0)
    SELECT stay_id, hr, endtime - INTERVAL 1 HOUR AS starttime, endtime,
      {', '.join(f'{m} AS {name}' for m, (name, _, _) in HOURLY.items())},
      {', '.join(f'{d} AS rate_{d}' for d in DRUGS)}, {', '.join(ORGANS)},
      {', '.join(f'{o}_24hours' for o in ORGANS)}, {' + '.join(f'{o}_24hours' for o in ORGANS)} AS sofa_24hours
    FROM day""")

_first_rates = ", ".join(
    f"(SELECT max(d.vaso_rate) FROM {d} d WHERE d.stay_id = ie.stay_id"
    f" AND d.starttime BETWEEN ie.intime - INTERVAL 6 HOUR AND ie.intime + INTERVAL 1 DAY) AS {d}" for d in DRUGS)
define("first_day_sofa", (*DRUGS, "bg", "ventilation", "first_day_vitalsign", "first_day_lab",
                          "first_day_urine_output", "first_day_gcs"), f"""
    WITH gases AS ({GASES}),
    ratios AS (
      SELECT stay_id, min(v) FILTER (WHERE vent) AS pf_vent, min(v) FILTER (WHERE NOT vent) AS pf_novent
      FROM gases JOIN icustays ie USING (stay_id)
      WHERE charttime BETWEEN ie.intime - INTERVAL 6 HOUR AND ie.intime + INTERVAL 1 DAY GROUP BY stay_id),
    measured AS (
      SELECT ie.subject_id, ie.hadm_id, ie.stay_id, pf_vent, pf_novent, mbp_min AS mbp, gcs_min AS gcs, urineoutput AS urine,
        creatinine_max AS creatinine, bilirubin_total_max AS bilirubin, platelets_min AS platelet, {_first_rates}
      FROM icustays ie
      LEFT JOIN ratios USING (stay_id)
      LEFT JOIN (SELECT stay_id, mbp_min FROM first_day_vitalsign) USING (stay_id)
      LEFT JOIN (SELECT stay_id, creatinine_max, bilirubin_total_max, platelets_min FROM first_day_lab) USING (stay_id)
      LEFT JOIN (SELECT stay_id, urineoutput FROM first_day_urine_output) USING (stay_id)
      LEFT JOIN (SELECT stay_id, gcs_min FROM first_day_gcs) USING (stay_id))
    SELECT *, {total(ORGANS)} AS sofa
    FROM (SELECT subject_id, hadm_id, stay_id, {organ_points(FIRST_DAY_SOFA)} FROM measured)""")

# FIXED VALUES: (unknown when, (points, condition) rows)
LODS = {
    "neurologic": ("gcs IS NULL OR gcs < 3", [(5, "gcs <= 5"), (3, "gcs <= 8"), (1, "gcs <= 13")]),
    "cardiovascular": ("heart_rate_max IS NULL AND sbp_min IS NULL", [
        (5, "heart_rate_min < 30"), (5, "sbp_min < 40"), (3, "sbp_min < 70"), (3, "sbp_max >= 270"),
        (1, "heart_rate_max >= 140"), (1, "sbp_max >= 240"), (1, "sbp_min < 90")]),
    "renal": ("bun IS NULL OR urine IS NULL OR creatinine IS NULL", [
        (5, "urine < 500"), (5, "bun >= 56"), (3, "creatinine >= 1.6"), (3, "urine < 750"), (3, "bun >= 28"),
        (3, "urine >= 10000"), (1, "creatinine >= 1.2"), (1, "bun >= 7.5")]),
    "pulmonary": ("FALSE", [(3, "pf < 150"), (1, "pf >= 150")]),
    "hematologic": ("wbc_max IS NULL AND platelet IS NULL", [
        (3, "wbc_min < 1"), (1, "wbc_min < 2.5"), (1, "platelet < 50"), (1, "wbc_max >= 50")]),
    "hepatic": ("pt_max IS NULL AND bilirubin IS NULL", [(1, "bilirubin >= 2"), (1, "pt_max > 15"), (1, "pt_min < 3")]),
}
define("lods", ("bg", "ventilation", "first_day_gcs", "first_day_vitalsign", "first_day_urine_output",
                "first_day_lab"), f"""
    WITH support AS (
      SELECT stay_id, starttime AS lo, endtime AS hi FROM ventilation WHERE ventilation_status = 'InvasiveVent'
      UNION ALL
      SELECT ie.stay_id, min(m.charttime) - INTERVAL 1 HOUR, max(m.charttime) + INTERVAL 4 HOUR
      FROM icustays ie JOIN chartevents m ON m.stay_id = ie.stay_id
        AND m.charttime BETWEEN ie.intime AND ie.intime + INTERVAL 1 DAY
      WHERE m.itemid = 226732 AND regexp_matches(lower(m.value), 'cpap|bipap mask') GROUP BY ie.stay_id),
    supported AS (
      SELECT ie.stay_id, min(bg.pao2fio2ratio) AS pf
      FROM icustays ie JOIN support s USING (stay_id)
      JOIN bg ON bg.hadm_id = ie.hadm_id AND bg.charttime >= ie.intime AND bg.charttime < ie.outtime
        AND bg.charttime BETWEEN s.lo AND s.hi
      GROUP BY ie.stay_id),
    measured AS (
      SELECT ie.subject_id, ie.hadm_id, ie.stay_id, pf, gcs_min AS gcs, urineoutput AS urine, v.* EXCLUDE (stay_id),
        l.* EXCLUDE (stay_id)
      FROM icustays ie
      LEFT JOIN supported USING (stay_id)
      LEFT JOIN (SELECT stay_id, gcs_min FROM first_day_gcs) USING (stay_id)
      LEFT JOIN (SELECT stay_id, urineoutput FROM first_day_urine_output) USING (stay_id)
      LEFT JOIN (SELECT stay_id, heart_rate_min, heart_rate_max, sbp_min, sbp_max FROM first_day_vitalsign) v USING (stay_id)
      LEFT JOIN (SELECT stay_id, bun_max AS bun, creatinine_max AS creatinine, bilirubin_total_max AS bilirubin,
                   platelets_min AS platelet, wbc_min, wbc_max, pt_min, pt_max FROM first_day_lab) l USING (stay_id))
    SELECT *, {total(LODS)} AS lods
    FROM (SELECT subject_id, hadm_id, stay_id,
            {', '.join(f'{worst(rules, unknown)} AS {organ}' for organ, (unknown, rules) in LODS.items())}
          FROM measured)""")

# FIXED VALUES: name -> (shown as, low, high, unknown when, (points, condition, value shown) rows)
OASIS_RANGES = {
    "heart_rate_score": ("heartrate", "hmin", "hmax", "hmax IS NULL", [
        (6, "hmax > 125", "hmax"), (4, "hmin < 33", "hmin"), (3, "hmax BETWEEN 107 AND 125", "hmax"),
        (1, "hmax BETWEEN 89 AND 106", "hmax")]),
    "mbp_score": ("meanbp", "mmin", "mmax", "mmin IS NULL", [
        (4, "mmin < 20.65", "mmin"), (3, "mmin < 51", "mmin"), (3, "mmax > 143.44", "mmax"), (2, "mmin < 61.33", "mmin")]),
    "resp_rate_score": ("resprate", "rmin", "rmax", "rmin IS NULL", [
        (10, "rmin < 6", "rmin"), (9, "rmax > 44", "rmax"), (6, "rmax > 30", "rmax"), (1, "rmax > 22", "rmax"),
        (1, "rmin < 13", "rmin")]),
    "temp_score": ("temp", "tmin", "tmax", "tmax IS NULL", [
        (6, "tmax > 39.88", "tmax"), (4, "tmin BETWEEN 33.22 AND 35.93", "tmin"),
        (4, "tmax BETWEEN 33.22 AND 35.93", "tmax"), (3, "tmin < 33.22", "tmin"),
        (2, "tmin > 35.93 AND tmin <= 36.39", "tmin"), (2, "tmax BETWEEN 36.89 AND 39.88", "tmax")]),
}
OASIS_OTHER = {
    "preiculos_score": bands("preiculos", [("< 10.2", 5), ("< 297", 3), ("< 1440", 0), ("< 18708", 2)], 1),
    "age_score": bands("age", [("< 24", 0), ("<= 53", 3), ("<= 77", 6), ("<= 89", 9)], 7),
    "gcs_score": worst([(10, "gcs <= 7"), (4, "gcs < 14"), (3, "gcs = 14")], "gcs IS NULL"),
    "urineoutput_score": worst([(10, "urineoutput < 671.09"), (8, "urineoutput > 6896.80"),
                                (5, "urineoutput BETWEEN 671.09 AND 1426.99"),
                                (1, "urineoutput BETWEEN 1427.00 AND 2544.14")], "urineoutput IS NULL"),
    "mechvent_score": "9 * mechvent",
    "electivesurgery_score": "6 * (1 - electivesurgery)",
}


def _shown(low, high, unknown, rules) -> str:
    """The value that earned the points, the middle of the range if none did."""
    arms = " ".join(f"WHEN {cond} THEN {value}" for _, cond, value in rules)
    return f"CASE WHEN {unknown} THEN NULL {arms} ELSE ({low} + {high}) / 2 END"


_scores = [f"{worst([r[:2] for r in rules], unknown)} AS {name}"
           for name, (_, _, _, unknown, rules) in OASIS_RANGES.items()]
_scores += [f"{sql} AS {name}" for name, sql in OASIS_OTHER.items()]
_scores += [f"{_shown(*rest)} AS {shown}" for shown, *rest in OASIS_RANGES.values()]
define("oasis", ("age", "ventilation", "first_day_gcs", "first_day_vitalsign", "first_day_urine_output"), f"""
    WITH measured AS (
      SELECT ie.subject_id, ie.hadm_id, ie.stay_id, ag.age, gcs_min AS gcs, urineoutput, v.* EXCLUDE (stay_id),
        date_diff('minute', adm.admittime, ie.intime) AS preiculos,
        CAST(EXISTS (SELECT 1 FROM ventilation e WHERE e.stay_id = ie.stay_id AND e.ventilation_status = 'InvasiveVent'
             AND e.starttime <= ie.intime + INTERVAL 1 DAY AND e.endtime >= ie.intime) AS INTEGER) AS mechvent,
        CASE WHEN adm.admission_type IS NOT NULL THEN CAST(adm.admission_type = 'ELECTIVE' AND EXISTS (
             SELECT 1 FROM services s WHERE s.hadm_id = ie.hadm_id AND s.transfertime < ie.intime + INTERVAL 1 DAY
             AND (contains(lower(s.curr_service), 'surg') OR s.curr_service = 'ORTHO')) AS INTEGER) END AS electivesurgery
      FROM icustays ie JOIN admissions adm ON adm.hadm_id = ie.hadm_id
      LEFT JOIN age ag ON ag.hadm_id = ie.hadm_id
      LEFT JOIN (SELECT stay_id, gcs_min FROM first_day_gcs) USING (stay_id)
      LEFT JOIN (SELECT stay_id, urineoutput FROM first_day_urine_output) USING (stay_id)
      LEFT JOIN (SELECT stay_id, heart_rate_min AS hmin, heart_rate_max AS hmax, mbp_min AS mmin, mbp_max AS mmax,
                   resp_rate_min AS rmin, resp_rate_max AS rmax, temperature_min AS tmin, temperature_max AS tmax
                 FROM first_day_vitalsign) v USING (stay_id)),
    scored AS (SELECT * EXCLUDE (hmin, hmax, mmin, mmax, rmin, rmax, tmin, tmax), {', '.join(_scores)} FROM measured),
    summed AS (SELECT *, {total([*OASIS_RANGES, *OASIS_OTHER])} AS oasis FROM scored)
    SELECT *, 1 / (1 + exp(-(-6.1746 + 0.1275 * oasis))) AS oasis_prob FROM summed""")
