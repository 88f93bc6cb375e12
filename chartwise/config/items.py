"""Item maps: which itemids feed which concept column, with plausibility clips.

FIXED VALUES.  The itemids, clip bounds and text labels below are clinical
dictionary constants that must equal the reference's for the derived tables
to mean the same thing; they are stated plainly, grouped per concept.
"""

from __future__ import annotations

# ---------------------------------------------------------------- vital signs
HEART_RATE = [220045]
SBP = [220179, 220050, 225309]
DBP = [220180, 220051, 225310]
MBP = [220052, 220181, 225312]
SBP_NI = [220179]
DBP_NI = [220180]
MBP_NI = [220181]
RESP_RATE = [220210, 224690]
TEMP_F = [223761]
TEMP_C = [223762]
TEMP_SITE = [224642]
SPO2 = [220277]
GLUCOSE_CHART = [225664, 220621, 226537]

# ---------------------------------------------------------------- lab pivots
# name: (itemid, upper clip or None)
CHEMISTRY = {
    "albumin": (50862, 10), "globulin": (50930, 10), "total_protein": (50976, 20),
    "aniongap": (50868, 10000), "bicarbonate": (50882, 10000), "bun": (51006, 300),
    "calcium": (50893, 10000), "chloride": (50902, 10000), "creatinine": (50912, 150),
    "glucose": (50931, 10000), "sodium": (50983, 200), "potassium": (50971, 30),
}
CHEMISTRY_ZERO_ALLOWED = 50868  # anion gap may be <= 0

COAGULATION = {"d_dimer": 51196, "fibrinogen": 51214, "thrombin": 51297, "inr": 51237,
               "pt": 51274, "ptt": 51275}
CARDIAC_MARKER = {"troponin_t": 51003, "ck_mb": 50911, "ntprobnp": 50963}
INFLAMMATION = {"crp": 50889}
COMPLETE_BLOOD_COUNT = {"hematocrit": 51221, "hemoglobin": 51222, "mch": 51248, "mchc": 51249,
                        "mcv": 51250, "platelet": 51265, "rbc": 51279, "rdw": 51277,
                        "rdwsd": 52159, "wbc": 51301}
ENZYME = {"alt": 50861, "alp": 50863, "ast": 50878, "amylase": 50867, "bilirubin_total": 50885,
          "bilirubin_direct": 50883, "bilirubin_indirect": 50884, "ck_cpk": 50910, "ck_mb": 50911,
          "ggt": 50927, "ld_ldh": 50954}

# blood differential
DIFF_WBC = [51300, 51301, 51755]
DIFF_ABS = {  # name: (items in K/uL, items in #/uL divided by 1000)
    "basophils_abs": ([52069], []),
    "eosinophils_abs": ([52073], [51199]),
    "lymphocytes_abs": ([51133], [52769]),
    "monocytes_abs": ([52074], [51253]),
    "neutrophils_abs": ([52075], []),
}
DIFF_PCT = {"basophils": [51146], "eosinophils": [51200], "lymphocytes": [51244, 51245],
            "monocytes": [51254], "neutrophils": [51256]}
DIFF_OTHER = {"atypical_lymphocytes": [51143], "bands": [51144],
              "immature_granulocytes": [52135], "metamyelocytes": [51251], "nrbc": [51257]}
DIFF_IMPUTE_PCT_ITEMS = [51146, 51200, 51244, 51245, 51254, 51256]
DIFF_GRANULOCYTE_COUNT = 51218  # read (selects specimens) but not output

# blood gas (labevents) name: (itemid, upper clip or None); text items separate
BG_SPECIMEN = 52033
BG_NUMERIC = {
    "aado2": (50801, None), "baseexcess": (50802, None), "bicarbonate": (50803, None),
    "totalco2": (50804, None), "carboxyhemoglobin": (50805, None), "chloride": (50806, None),
    "calcium": (50808, None), "glucose": (50809, 10000), "hematocrit": (50810, 100),
    "hemoglobin": (50811, None), "lactate": (50813, 10000), "methemoglobin": (50814, None),
    "o2flow": (50815, None), "so2": (50817, 100), "pco2": (50818, None), "peep": (50819, None),
    "ph": (50820, None), "po2": (50821, None), "potassium": (50822, None),
    "requiredo2": (50823, None), "sodium": (50824, None), "temperature": (50825, None),
}
BG_FIO2 = 50816
BG_COMMENTS = 50807
CHART_SPO2 = 220277
CHART_FIO2 = 223835

# ---------------------------------------------------------------- chart pivots
ICP = [220765, 227989]
RHYTHM = {"heart_rhythm": 220048, "ectopy_type": 224650, "ectopy_frequency": 224651,
          "ectopy_type_secondary": 226479, "ectopy_frequency_secondary": 226480}
URINE_OUTPUT = [226559, 226560, 226561, 226584, 226563, 226564, 226565, 226567, 226557,
                226558, 227488, 227489]
URINE_IRRIGANT_IN = 227488
GCS_MOTOR, GCS_VERBAL, GCS_EYES = 223901, 223900, 220739
HEIGHT_IN, HEIGHT_CM = 226707, 226730
WEIGHT_ADMIT, WEIGHT_DAILY = 226512, 224639
O2_FLOW, O2_FLOW_ALT, O2_FLOW_ADDITIONAL, O2_DEVICE = 223834, 227582, 227287, 226732

VENT_NUMERIC = {
    "respiratory_rate_set": 224688, "respiratory_rate_total": 224690,
    "respiratory_rate_spontaneous": 224689, "minute_volume": 224687,
    "tidal_volume_set": 224684, "tidal_volume_observed": 224685,
    "tidal_volume_spontaneous": 224686, "plateau_pressure": 224696,
}
VENT_PEEP = [220339, 224700]
VENT_FIO2 = 223835
VENT_FLOW_RATE = 224691
VENT_TEXT = {"ventilator_mode": 223849, "ventilator_mode_hamilton": 229314,
             "ventilator_type": 223848}

# ---------------------------------------------------------------- infusions
DOBUTAMINE, DOPAMINE, EPINEPHRINE, MILRINONE = 221653, 221662, 221289, 221986
NOREPINEPHRINE, PHENYLEPHRINE, VASOPRESSIN = 221906, 221749, 222315
NEUROBLOCK = [222062, 221555]
