"""Oracle SQL: first-day summaries."""

from __future__ import annotations

from .compose import define

FD = "e.charttime BETWEEN ie.intime - INTERVAL 6 HOUR AND ie.intime + INTERVAL 1 DAY"


def mm(cols, rename=None, mean=False):
    rename = rename or {}
    out = []
    for c in cols:
        n = rename.get(c, c)
        out.append(f"min(e.{c}) AS {n}_min")
        out.append(f"max(e.{c}) AS {n}_max")
        if mean:
            out.append(f"avg(e.{c}) AS {n}_mean")
    return ", ".join(out)


VITALS = ["heart_rate", "sbp", "dbp", "mbp", "resp_rate", "temperature", "spo2", "glucose"]
define("first_day_vitalsign", ("vitalsign",), f"""
    SELECT ie.subject_id, ie.stay_id, {mm(VITALS, mean=True)}
    FROM icustays ie LEFT JOIN vitalsign e ON e.stay_id = ie.stay_id AND {FD}
    GROUP BY ie.subject_id, ie.stay_id""")

define("first_day_urine_output", ("urine_output",), """
    SELECT ie.subject_id, ie.stay_id, sum(e.urineoutput) AS urineoutput
    FROM icustays ie LEFT JOIN urine_output e
      ON e.stay_id = ie.stay_id AND e.charttime >= ie.intime AND e.charttime <= ie.intime + INTERVAL 1 DAY
    GROUP BY ie.subject_id, ie.stay_id""")

define("first_day_height", ("height",), f"""
    SELECT ie.subject_id, ie.stay_id,
      CAST(round(CAST(avg(e.height) AS DECIMAL(38, 9)), 2) AS DOUBLE) AS height
    FROM icustays ie LEFT JOIN height e ON e.stay_id = ie.stay_id AND {FD}
    GROUP BY ie.subject_id, ie.stay_id""")

define("first_day_weight", ("weight_durations",), """
    SELECT ie.subject_id, ie.stay_id,
      avg(e.weight) FILTER (WHERE e.weight_type = 'admit') AS weight_admit,
      avg(e.weight) AS weight, min(e.weight) AS weight_min, max(e.weight) AS weight_max
    FROM icustays ie LEFT JOIN weight_durations e
      ON e.stay_id = ie.stay_id AND e.starttime <= ie.intime + INTERVAL 1 DAY
    GROUP BY ie.subject_id, ie.stay_id""")

define("first_day_rrt", ("rrt",), f"""
    SELECT ie.subject_id, ie.stay_id, max(e.dialysis_present) AS dialysis_present,
      max(e.dialysis_active) AS dialysis_active,
      string_agg(DISTINCT e.dialysis_type, ', ' ORDER BY e.dialysis_type) AS dialysis_type
    FROM icustays ie LEFT JOIN rrt e ON e.stay_id = ie.stay_id AND {FD}
    GROUP BY ie.subject_id, ie.stay_id""")

define("first_day_gcs", ("gcs",), f"""
    SELECT subject_id, stay_id, gcs_min, gcs_motor, gcs_verbal, gcs_eyes, gcs_unable FROM (
      SELECT ie.subject_id, ie.stay_id, e.gcs AS gcs_min, e.gcs_motor, e.gcs_verbal, e.gcs_eyes,
        e.gcs_unable,
        row_number() OVER (PARTITION BY ie.stay_id ORDER BY e.gcs ASC NULLS FIRST,
                           e.charttime ASC NULLS FIRST) AS rk
      FROM icustays ie LEFT JOIN gcs e ON e.stay_id = ie.stay_id AND {FD})
    WHERE rk = 1""")

BG = ["lactate", "ph", "so2", "po2", "pco2", "aado2", "aado2_calc", "pao2fio2ratio",
      "baseexcess", "bicarbonate", "totalco2", "hematocrit", "hemoglobin", "carboxyhemoglobin",
      "methemoglobin", "temperature", "chloride", "calcium", "glucose", "potassium", "sodium"]
define("first_day_bg", ("bg",), f"""
    SELECT ie.subject_id, ie.stay_id, {mm(BG)}
    FROM icustays ie LEFT JOIN bg e ON e.subject_id = ie.subject_id AND {FD}
    GROUP BY ie.subject_id, ie.stay_id""")
define("first_day_bg_art", ("bg",), f"""
    SELECT ie.subject_id, ie.stay_id, {mm(BG)}
    FROM icustays ie LEFT JOIN bg e
      ON e.subject_id = ie.subject_id AND e.specimen = 'ART.' AND {FD}
    GROUP BY ie.subject_id, ie.stay_id""")

_PANELS = [
    ("cbc", "complete_blood_count", ["hematocrit", "hemoglobin", "platelet", "wbc"],
     {"platelet": "platelets"}),
    ("chem", "chemistry", ["albumin", "globulin", "total_protein", "aniongap", "bicarbonate", "bun",
                           "calcium", "chloride", "creatinine", "glucose", "sodium", "potassium"], {}),
    ("diff", "blood_differential", ["basophils_abs", "eosinophils_abs", "lymphocytes_abs",
                                    "monocytes_abs", "neutrophils_abs", "atypical_lymphocytes",
                                    "bands", "immature_granulocytes", "metamyelocytes", "nrbc"],
     {"basophils_abs": "abs_basophils", "eosinophils_abs": "abs_eosinophils",
      "lymphocytes_abs": "abs_lymphocytes", "monocytes_abs": "abs_monocytes",
      "neutrophils_abs": "abs_neutrophils", "atypical_lymphocytes": "atyps",
      "immature_granulocytes": "imm_granulocytes", "metamyelocytes": "metas"}),
    ("coag", "coagulation", ["d_dimer", "fibrinogen", "thrombin", "inr", "pt", "ptt"], {}),
    ("enz", "enzyme", ["alt", "alp", "ast", "amylase", "bilirubin_total", "bilirubin_direct",
                       "bilirubin_indirect", "ck_cpk", "ck_mb", "ggt", "ld_ldh"], {}),
]
_sub = []
_cols = []
for alias, src, cols, ren in _PANELS:
    _sub.append(f"""LEFT JOIN (
      SELECT ie.stay_id, {mm(cols, ren)}
      FROM icustays ie LEFT JOIN {src} e ON e.subject_id = ie.subject_id AND {FD}
      GROUP BY ie.stay_id) {alias} ON {alias}.stay_id = ie.stay_id""")
    for c in cols:
        n = ren.get(c, c)
        _cols += [f"{alias}.{n}_min", f"{alias}.{n}_max"]
define("first_day_lab", tuple(p[1] for p in _PANELS), f"""
    SELECT ie.subject_id, ie.stay_id, {', '.join(_cols)}
    FROM icustays ie
    {' '.join(_sub)}""")
