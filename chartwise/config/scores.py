"""Point tables of the severity scores.

FIXED VALUES.  A component is ``(unknown, rows)``: ``unknown`` is ``("any" | "all", measures)``, the component is NULL when any / all of
them are missing; a row ``(measure, test, bound, points)`` gives its points when the measure passes the test (``in``: both
bounds included); the most points count, 0 if no row holds; points None mean an impossible value.  A scale is ``(rows, above)``:
the points of the first ``(test, bound)`` that holds, and those beyond.
"""

from __future__ import annotations

# hourly and first-day SOFA
SOFA = {
    "coagulation": (("all", ["platelet_min"]), [("platelet_min", "<", 150, 1), ("platelet_min", "<", 100, 2), ("platelet_min", "<", 50, 3),
                                                ("platelet_min", "<", 20, 4)]),
    "liver": (("all", ["bilirubin_max"]), [("bilirubin_max", ">=", 1.2, 1), ("bilirubin_max", ">=", 2.0, 2), ("bilirubin_max", ">=", 6.0, 3),
                                           ("bilirubin_max", ">=", 12.0, 4)]),
    "cardiovascular": (("all", ["rate_dopamine", "rate_dobutamine", "rate_epinephrine", "rate_norepinephrine", "meanbp_min"]), [
        ("meanbp_min", "<", 70, 1), ("rate_dopamine", ">", 0, 2), ("rate_dopamine", ">", 5, 3), ("rate_dopamine", ">", 15, 4),
        ("rate_dobutamine", ">", 0, 2), ("rate_epinephrine", "<=", 0.1, 3), ("rate_epinephrine", ">", 0.1, 4),
        ("rate_norepinephrine", "<=", 0.1, 3), ("rate_norepinephrine", ">", 0.1, 4)]),
    "cns": (("all", ["gcs_min"]), [("gcs_min", "in", (13, 14), 1), ("gcs_min", "in", (10, 12), 2), ("gcs_min", "in", (6, 9), 3),
                                   ("gcs_min", "<", 6, 4)]),
    "renal": (("all", ["uo_24hr", "creatinine_max"]), [
        ("creatinine_max", ">=", 1.2, 1), ("creatinine_max", ">=", 2.0, 2), ("creatinine_max", ">=", 3.5, 3), ("creatinine_max", ">=", 5.0, 4),
        ("uo_24hr", "<", 500, 3), ("uo_24hr", "<", 200, 4)]),
}
_PF = ("all", ["pao2fio2ratio_vent", "pao2fio2ratio_novent"])
SOFA_RESPIRATION = (_PF, [
    ("pao2fio2ratio_novent", "<", 400, 1), ("pao2fio2ratio_novent", "<", 300, 2), ("pao2fio2ratio_vent", "<", 400, 1),
    ("pao2fio2ratio_vent", "<", 300, 2), ("pao2fio2ratio_vent", "<", 200, 3), ("pao2fio2ratio_vent", "<", 100, 4)])
FIRST_DAY_RESPIRATION = (_PF, [
    ("pao2fio2ratio_novent", "<", 400, 1), ("pao2fio2ratio_novent", "<", 300, 2), ("pao2fio2ratio_vent", "<", 200, 3),
    ("pao2fio2ratio_vent", "<", 100, 4)])

SIRS = {
    "temp_score": (("all", ["temperature_min"]), [("temperature_min", "<", 36.0, 1), ("temperature_max", ">", 38.0, 1)]),
    "heart_rate_score": (("all", ["heart_rate_max"]), [("heart_rate_max", ">", 90.0, 1)]),
    "resp_score": (("all", ["resp_rate_max", "paco2_min"]), [("resp_rate_max", ">", 20.0, 1), ("paco2_min", "<", 32.0, 1)]),
    "wbc_score": (("all", ["wbc_min", "bands_max"]), [("wbc_min", "<", 4.0, 1), ("wbc_max", ">", 12.0, 1), ("bands_max", ">", 10, 1)]),
}

LODS = {
    "neurologic": (("all", ["gcs_min"]), [("gcs_min", "<", 3, None), ("gcs_min", "<=", 5, 5), ("gcs_min", "<=", 8, 3), ("gcs_min", "<=", 13, 1)]),
    "cardiovascular": (("all", ["heart_rate_max", "sbp_min"]), [
        ("heart_rate_min", "<", 30, 5), ("heart_rate_max", ">=", 140, 1), ("sbp_min", "<", 40, 5), ("sbp_min", "<", 70, 3),
        ("sbp_min", "<", 90, 1), ("sbp_max", ">=", 240, 1), ("sbp_max", ">=", 270, 3)]),
    "renal": (("any", ["bun_max", "urineoutput", "creatinine_max"]), [
        ("urineoutput", "<", 500.0, 5), ("urineoutput", "<", 750.0, 3), ("urineoutput", ">=", 10000.0, 3), ("bun_max", ">=", 7.50, 1),
        ("bun_max", ">=", 28.0, 3), ("bun_max", ">=", 56.0, 5), ("creatinine_max", ">=", 1.20, 1), ("creatinine_max", ">=", 1.60, 3)]),
    "pulmonary": (("any", []), [("pao2fio2_vent_min", ">=", 150, 1), ("pao2fio2_vent_min", "<", 150, 3)]),
    "hematologic": (("all", ["wbc_max", "platelet_min"]), [
        ("wbc_min", "<", 1.0, 3), ("wbc_min", "<", 2.5, 1), ("wbc_max", ">=", 50.0, 1), ("platelet_min", "<", 50.0, 1)]),
    "hepatic": (("all", ["pt_max", "bilirubin_max"]), [("bilirubin_max", ">=", 2.0, 1), ("pt_max", ">", 15, 1), ("pt_min", "<", 3.0, 1)]),
}

# components with a representative value: of equal points the earlier row's measure is reported
OASIS = {
    "heart_rate_score": (("any", ["heart_rate_max"]), [
        ("heart_rate_max", "in", (89, 106), 1), ("heart_rate_max", "in", (107, 125), 3), ("heart_rate_max", ">", 125, 6), ("heart_rate_min", "<", 33, 4)]),
    "mbp_score": (("any", ["mbp_min"]), [
        ("mbp_min", "<", 20.65, 4), ("mbp_min", "<", 51, 3), ("mbp_min", "<", 61.33, 2), ("mbp_max", ">", 143.44, 3)]),
    "resp_rate_score": (("any", ["resp_rate_min"]), [
        ("resp_rate_max", ">", 22, 1), ("resp_rate_max", ">", 30, 6), ("resp_rate_max", ">", 44, 9), ("resp_rate_min", "<", 6, 10), ("resp_rate_min", "<", 13, 1)]),
    "temp_score": (("any", ["temperature_max"]), [
        ("temperature_min", "<", 33.22, 3), ("temperature_min", "in", (33.22, 35.93), 4), ("temperature_min", "<=", 36.39, 2),
        ("temperature_max", "in", (33.22, 35.93), 4), ("temperature_max", "in", (36.89, 39.88), 2), ("temperature_max", ">", 39.88, 6)]),
    "gcs_score": (("any", ["gcs_min"]), [("gcs_min", "<=", 7, 10), ("gcs_min", "<", 14, 4), ("gcs_min", "=", 14, 3)]),
    "urineoutput_score": (("any", ["urineoutput"]), [
        ("urineoutput", "<", 671.09, 10), ("urineoutput", "in", (671.09, 1426.99), 5), ("urineoutput", "in", (1427.00, 2544.14), 1),
        ("urineoutput", ">", 6896.80, 8)]),
    "mechvent_score": (("any", ["mechvent"]), [("mechvent", "=", 1, 9)]),
    "electivesurgery_score": (("any", ["electivesurgery"]), [("electivesurgery", "=", 0, 6)]),
}
OASIS_VALUES = {"heart_rate_score": ("heartrate", "heart_rate"), "mbp_score": ("meanbp", "mbp"), "resp_rate_score": ("resprate", "resp_rate"),
                "temp_score": ("temp", "temperature")}
OASIS_PREICULOS = ([("<", 10.2, 5), ("<", 297, 3), ("<", 1440, 0), ("<", 18708, 2)], 1)
OASIS_AGE = ([("<", 24, 0), ("<=", 53, 3), ("<=", 77, 6), ("<=", 89, 9)], 7)
OASIS_LOGIT = (-6.1746, 0.1275)

SAPSII = {
    "hr_score": (("any", ["heartrate_max"]), [("heartrate_min", "<", 40, 11), ("heartrate_min", "<", 70, 2), ("heartrate_max", ">=", 120, 4),
                                              ("heartrate_max", ">=", 160, 7)]),
    "sysbp_score": (("any", ["sysbp_min"]), [("sysbp_min", "<", 70, 13), ("sysbp_min", "<", 100, 5), ("sysbp_max", ">=", 200, 2)]),
    "temp_score": (("any", ["tempc_max"]), [("tempc_max", ">=", 39.0, 3)]),
    "pao2fio2_score": (("any", ["pao2fio2_vent_min"]), [("pao2fio2_vent_min", "<", 100, 11), ("pao2fio2_vent_min", "<", 200, 9),
                                                        ("pao2fio2_vent_min", ">=", 200, 6)]),
    "uo_score": (("any", ["urineoutput"]), [("urineoutput", "<", 500.0, 11), ("urineoutput", "<", 1000.0, 4)]),
    "bun_score": (("any", ["bun_max"]), [("bun_max", ">=", 28.0, 6), ("bun_max", ">=", 84.0, 10)]),
    "wbc_score": (("any", ["wbc_max"]), [("wbc_min", "<", 1.0, 12), ("wbc_max", ">=", 20.0, 3)]),
    "potassium_score": (("any", ["potassium_max"]), [("potassium_min", "<", 3.0, 3), ("potassium_max", ">=", 5.0, 3)]),
    "sodium_score": (("any", ["sodium_max"]), [("sodium_min", "<", 125, 5), ("sodium_max", ">=", 145, 1)]),
    "bicarbonate_score": (("any", ["bicarbonate_max"]), [("bicarbonate_min", "<", 15.0, 6), ("bicarbonate_min", "<", 20.0, 3)]),
    "bilirubin_score": (("any", ["bilirubin_max"]), [("bilirubin_max", ">=", 4.0, 4), ("bilirubin_max", ">=", 6.0, 9)]),
    "gcs_score": (("any", ["mingcs"]), [("mingcs", "<", 3, None), ("mingcs", ">", 15, None), ("mingcs", "<", 6, 26), ("mingcs", "<", 9, 13),
                                        ("mingcs", "<", 11, 7), ("mingcs", "<", 14, 5)]),
    "comorbidity_score": (("any", []), [("aids", "=", 1, 17), ("hem", "=", 1, 10), ("mets", "=", 1, 9)]),
}
SAPSII_AGE = ([("<", 40, 0), ("<", 60, 7), ("<", 70, 12), ("<", 75, 15), ("<", 80, 16)], 18)
SAPSII_ADMISSION = {"ScheduledSurgical": 0, "Medical": 6, "UnscheduledSurgical": 8}
SAPSII_LOGIT = (-7.7631, 0.0737, 0.9971)
