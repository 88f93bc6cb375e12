"""Generation spec for the adapter views (test inputs, not clinical rules).

The clinical base tables are credentialed, so the supplied ``events`` table is
reshaped into EHR-style tables by deterministic arithmetic that both Spark
and DuckDB evaluate bit-identically (integer ``%`` on non-negative values,
one double expression evaluated in the same order).  This module is the single
source of the generation constants; ``chartwise.sources.adapters`` turns it
into DataFrame code and ``oracle.adapters`` into a DuckDB CTE prefix.

Per-row formulas (``e`` = event_id, ``i`` = itemid):

* minute index ``k = floor((epoch_us(ts) - epoch_us(2024-01-01)) / 600e6)``;
  ``t = 2150-01-01 + k minutes`` (30 days become 3 days)
* item kept when ``(e + i) % 3 = 0``
* ``h = (e * 37 + i * 11) % 1000``; numeric ``valuenum = lo + (h / 1000.0) * span``,
  integer ``valuenum = lo + h % (span + 1)``; NULL when ``e % 53 = 7``
* text choice ``(( e * 7919 + i * 13) % 1009) % len(choices)``
"""

from __future__ import annotations

BASE_TS = "2150-01-01 00:00:00"
EVENT_EPOCH = "2024-01-01 00:00:00"
MINUTE_BUCKET_US = 600_000_000  # 10 real minutes -> 1 adapted minute

STAY1_LEN_MIN = 30 * 60
STAY2_OFFSET_MIN = 36 * 60
STAY2_LEN_MIN = 24 * 60

# kind: "n" double in [lo, lo+span], "i" integer in [lo, lo+span],
# "t" text only (valuenum NULL), "ti" text plus an integer valuenum.
N, I, T, TI = "n", "i", "t", "ti"

VENT_MODES = ["CMV/ASSIST/AutoFlow", "CPAP/PSV", "SIMV", "PRVC/AC", "Standby",
              "MMV", "PCV+", "Apnea Ventilation", "(S) CMV"]
HAMILTON_MODES = ["ASV", "DuoPaP", "NIV", "NIV-ST", "APRV", "P-SIMV", "Standby", "VS"]
O2_DEVICES = ["Nasal cannula", "Face tent", "Aerosol-cool", "Endotracheal tube",
              "Tracheostomy tube", "Trach mask ", "Bipap mask ", "CPAP mask ",
              "High flow nasal cannula", "Non-rebreather", "Venti mask ", "None",
              "High flow neb", "Oxymizer", "T-piece"]
SYSTEM_INTEGRITY = ["Active", "Initiated", "Reinitiated", "New Filter", "Recirculating",
                    "Discontinued", "Clots Present", "No Clot Present", "Clots Increasing",
                    "Clot Increasing", "Clotted", "Line pressure alarm"]
CODE_STATUS_CHART = ["Full code", "Comfort measures only", "DNI (do not intubate)",
                     "DNR / DNI", "DNR (do not resuscitate)", "Unknown"]

CHART_ITEMS = [
    # vital signs
    (220045, N, 20.0, 310.0, None),
    (220179, N, 40.0, 380.0, None), (220050, N, 40.0, 380.0, None), (225309, N, 40.0, 380.0, None),
    (220180, N, 10.0, 300.0, None), (220051, N, 10.0, 300.0, None), (225310, N, 10.0, 300.0, None),
    (220052, N, 15.0, 295.0, None), (220181, N, 15.0, 295.0, None), (225312, N, 15.0, 295.0, None),
    (220210, N, 0.0, 75.0, None), (224690, N, 0.0, 75.0, None),
    (223761, N, 65.0, 60.0, None), (223762, N, 5.0, 47.0, None),
    (224642, T, 0.0, 0.0, ["Oral", "Axillary", "Rectal", "Blood", "Tympanic"]),
    (220277, N, 50.0, 55.0, None),
    (225664, N, -10.0, 610.0, None), (220621, N, -10.0, 610.0, None), (226537, N, -10.0, 610.0, None),
    # GCS
    (223901, I, 1.0, 5.0, None),
    (223900, TI, 1.0, 4.0, ["Oriented", "Confused", "Inappropriate Words",
                            "Incomprehensible sounds", "No Response", "No Response-ETT"]),
    (220739, I, 1.0, 3.0, None),
    # height, weight, ICP
    (226707, N, 40.0, 55.0, None), (226730, N, 100.0, 140.0, None),
    (226512, N, -5.0, 205.0, None), (224639, N, -5.0, 205.0, None),
    (220765, N, -10.0, 120.0, None), (227989, N, -10.0, 120.0, None),
    # rhythm
    (220048, T, 0.0, 0.0, ["SR (Sinus Rhythm)", "AF (Atrial Fibrillation)",
                           "ST (Sinus Tachycardia)", "SB (Sinus Bradycardia)"]),
    (224650, T, 0.0, 0.0, ["PVCs", "PACs", "None"]),
    (224651, T, 0.0, 0.0, ["Rare", "Occasional", "Frequent"]),
    (226479, T, 0.0, 0.0, ["PVCs", "PACs"]),
    (226480, T, 0.0, 0.0, ["Rare", "Frequent"]),
    # oxygen delivery
    (223834, N, 0.0, 80.0, None), (227582, N, 0.0, 80.0, None), (227287, N, 0.0, 40.0, None),
    (226732, T, 0.0, 0.0, O2_DEVICES),
    # ventilator settings
    (224688, N, 0.0, 40.0, None), (224689, N, 0.0, 40.0, None), (224687, N, 0.0, 25.0, None),
    (224684, N, 200.0, 600.0, None), (224685, N, 200.0, 600.0, None), (224686, N, 0.0, 800.0, None),
    (224696, N, 0.0, 50.0, None), (220339, N, -5.0, 115.0, None), (224700, N, -5.0, 115.0, None),
    (223835, N, 0.1, 109.9, None), (224691, N, 0.0, 100.0, None),
    (223849, T, 0.0, 0.0, VENT_MODES), (229314, T, 0.0, 0.0, HAMILTON_MODES),
    (223848, T, 0.0, 0.0, ["Drager", "Hamilton", "PB 840"]),
    # code status
    (223758, T, 0.0, 0.0, CODE_STATUS_CHART),
    # CRRT / dialysis (charted)
    (227290, T, 0.0, 0.0, ["CVVH", "CVVHD", "CVVHDF", "SCUF"]),
    (224149, N, -200.0, 300.0, None), (224144, N, 0.0, 300.0, None), (228004, N, 0.0, 300.0, None),
    (225183, N, 0.0, 300.0, None), (225977, T, 0.0, 0.0, ["Prismasate K4", "Prismasate K2"]),
    (224154, N, 0.0, 3000.0, None), (224151, N, -100.0, 300.0, None), (224150, N, 0.0, 300.0, None),
    (225958, T, 0.0, 0.0, ["1000", "5000", "Other"]), (224145, N, 0.0, 2000.0, None),
    (224191, N, 0.0, 300.0, None), (228005, N, 0.0, 3000.0, None), (228006, N, 0.0, 3000.0, None),
    (225976, T, 0.0, 0.0, ["Prismasate K4", "Normal Saline"]), (224153, N, 0.0, 3000.0, None),
    (224152, N, 0.0, 300.0, None), (226457, N, 0.0, 500.0, None),
    (224146, T, 0.0, 0.0, SYSTEM_INTEGRITY),
    (226118, T, 0.0, 0.0, ["Yes", "No"]), (227357, T, 0.0, 0.0, ["Yes"]),
    (226499, N, 0.0, 500.0, None), (225810, N, 0.0, 600.0, None), (225806, N, 0.0, 3000.0, None),
    (225807, N, 0.0, 3000.0, None), (224135, T, 0.0, 0.0, ["Femoral", "IJ", "Subclavian"]),
    (225965, T, 0.0, 0.0, ["In use", "Capped", "Clamped"]),
    (225953, T, 0.0, 0.0, ["Dianeal 1.5%", "Dianeal 2.5%"]),
]

# lab items: (itemid, kind, lo, span, choices)
LAB_ITEMS = [
    # blood gas
    (52033, T, 0.0, 0.0, ["ART.", "VEN.", "MIX.", "CENTRAL VENOUS."]),
    (50801, N, 0.0, 650.0, None), (50802, N, -25.0, 50.0, None), (50803, N, 5.0, 45.0, None),
    (50804, N, 5.0, 45.0, None), (50805, N, 0.0, 12.0, None), (50806, N, 80.0, 50.0, None),
    (50807, T, 0.0, 0.0, ["Verified", "Hemolyzed", "Clotted"]), (50808, N, 0.5, 1.5, None),
    (50809, N, 20.0, 10100.0, None), (50810, N, 10.0, 100.0, None), (50811, N, 4.0, 16.0, None),
    (50813, N, 0.2, 10040.0, None), (50814, N, 0.0, 5.0, None), (50815, N, 0.0, 15.0, None),
    (50816, N, 0.1, 109.9, None), (50817, N, 50.0, 55.0, None), (50818, N, 15.0, 85.0, None),
    (50819, N, 0.0, 20.0, None), (50820, N, 6.8, 0.8, None), (50821, N, 30.0, 500.0, None),
    (50822, N, 2.0, 5.0, None), (50823, N, 0.0, 100.0, None), (50824, N, 115.0, 45.0, None),
    (50825, N, 32.0, 10.0, None),
    # blood differential
    (51300, N, 0.0, 30.0, None), (51301, N, -1.0, 31.0, None), (51755, N, 0.0, 30.0, None),
    (52069, N, 0.0, 0.3, None), (52073, N, 0.0, 1.0, None), (51199, N, 0.0, 900.0, None),
    (51133, N, 0.0, 5.0, None), (52769, N, 0.0, 4000.0, None), (52074, N, 0.0, 2.0, None),
    (51253, N, 0.0, 2000.0, None), (52075, N, 0.0, 20.0, None), (51146, N, 0.0, 3.0, None),
    (51200, N, 0.0, 10.0, None), (51244, N, 0.0, 50.0, None), (51245, N, 0.0, 50.0, None),
    (51254, N, 0.0, 15.0, None), (51256, N, 0.0, 95.0, None), (51143, N, 0.0, 10.0, None),
    (51144, N, -1.0, 30.0, None), (52135, N, 0.0, 5.0, None), (51251, N, 0.0, 5.0, None),
    (51257, N, 0.0, 5.0, None),
    # cardiac markers
    (51003, N, 0.0, 5.0, None), (50911, N, 0.0, 100.0, None), (50963, N, 0.0, 30000.0, None),
    # chemistry
    (50862, N, 0.5, 10.5, None), (50930, N, 0.5, 10.5, None), (50976, N, 2.0, 19.0, None),
    (50868, N, -5.0, 40.0, None), (50882, N, 5.0, 40.0, None), (51006, N, 2.0, 310.0, None),
    (50893, N, 5.0, 8.0, None), (50902, N, 80.0, 50.0, None), (50912, N, 0.2, 12.0, None),
    (50931, N, 20.0, 700.0, None), (50983, N, 110.0, 95.0, None), (50971, N, 1.5, 30.0, None),
    # coagulation
    (51196, N, 0.0, 5000.0, None), (51214, N, 50.0, 700.0, None), (51297, N, 10.0, 60.0, None),
    (51237, N, 0.8, 4.0, None), (51274, N, 2.0, 40.0, None), (51275, N, 20.0, 100.0, None),
    # complete blood count
    (51221, N, -1.0, 61.0, None), (51222, N, 4.0, 14.0, None), (51248, N, 20.0, 20.0, None),
    (51249, N, 28.0, 10.0, None), (51250, N, 70.0, 40.0, None), (51265, N, 5.0, 500.0, None),
    (51279, N, 2.0, 4.0, None), (51277, N, 10.0, 12.0, None), (52159, N, 35.0, 30.0, None),
    # enzymes
    (50861, N, 5.0, 900.0, None), (50863, N, 20.0, 600.0, None), (50878, N, 5.0, 900.0, None),
    (50867, N, 10.0, 400.0, None), (50885, N, 0.1, 20.0, None), (50883, N, 0.0, 10.0, None),
    (50884, N, 0.0, 10.0, None), (50910, N, 10.0, 3000.0, None), (50927, N, 5.0, 700.0, None),
    (50954, N, 100.0, 900.0, None),
    # inflammation
    (50889, N, -1.0, 250.0, None),
]

URINE_ITEMS = [226559, 226560, 226561, 226584, 226563, 226564, 226565,
               226567, 226557, 226558, 227488, 227489]

# input items: (itemid, rate scale, usual unit, rare unit)
INPUT_ITEMS = [
    (221653, 20.0, "mcg/kg/min", "mcg/kg/min"),    # dobutamine
    (221662, 50.0, "mcg/kg/min", "mcg/kg/min"),    # dopamine
    (221289, 1.0, "mcg/kg/min", "mcg/kg/min"),     # epinephrine
    (221986, 2.0, "mcg/kg/min", "mcg/kg/min"),     # milrinone
    (222062, 10.0, "mg/kg/hour", "mg/kg/hour"),    # neuromuscular blocker
    (221555, 10.0, "mg/kg/hour", "mg/kg/hour"),    # neuromuscular blocker
    (221906, 1.0, "mcg/kg/min", "mg/kg/min"),      # norepinephrine
    (221749, 10.0, "mcg/kg/min", "mcg/min"),       # phenylephrine
    (222315, 0.2, "units/min", "units/hour"),      # vasopressin
    (227536, 1.0, "mL/hour", "mL/hour"),           # CRRT solution
    (227525, 1.0, "mL/hour", "mL/hour"),           # CRRT solution
    (225158, 1.0, "mL/hour", "mL/hour"),           # unrelated fluid
]

# procedure items (invasive lines, dialysis, unrelated)
PROC_ITEMS = [227719, 225752, 224269, 224267, 224270, 224272, 226124, 228169, 225202,
              228286, 225204, 224263, 224560, 224264, 225203, 224273, 225789, 225761,
              228201, 228202, 224268, 225199, 225315, 225205,
              225441, 225802, 225803, 225805, 225809, 225955, 225436, 225459]
PROC_LOCATIONS = ["Left IJ", "Right IJ", "L Subclavian", "Right Subclavian", "Left Femoral",
                  "R Radial", "L Radial", None]

D_ITEMS = [
    (227719, "AVA Line"), (225752, "Arterial Line"), (224269, "CCO PAC"),
    (224267, "Cordis/Introducer"), (224270, "Dialysis Catheter"), (224272, "IABP line"),
    (226124, "ICP Catheter"), (228169, "Impella Line"), (225202, "Indwelling Port (PortaCath)"),
    (228286, "Intraosseous Device"), (225204, "Midline"), (224263, "Multi Lumen"),
    (224560, "PA Catheter"), (224264, "PICC Line"), (225203, "Pheresis Catheter"),
    (224273, "Presep Catheter"), (225789, "Sheath"), (225761, "Sheath Insertion"),
    (228201, "Tandem Heart Access Line"), (228202, "Tandem Heart Return Line"),
    (224268, "Trauma line"), (225199, "Triple Introducer"), (225315, "Tunneled (Hickman) Line"),
    (225205, "RIC"), (225441, "Hemodialysis"), (225802, "Dialysis - CRRT"),
    (225803, "Dialysis - CVVHD"), (225805, "Peritoneal Dialysis"), (225809, "Dialysis - CVVHDF"),
    (225955, "Dialysis - SCUF"), (225436, "CRRT Filter Change"), (225459, "Chest X-Ray"),
]

DRUGS = ["Vancomycin", "Cefepime", "Piperacillin-Tazobactam", "Ciprofloxacin", "Metronidazole",
         "Bacitracin Ointment", "Erythromycin Ophth Oint", "Clindamycin Gel", "Amoxicillin",
         "Lisinopril", "Captopril", "Enalapril Maleate", "Losartan Potassium", "Valsartan",
         "Ibuprofen", "Ketorolac", "Naproxen", "Aspirin", "Acetaminophen", "Sodium Chloride 0.9%",
         "Heparin", "Furosemide", "Penicillin G Desensitization", "Sulfamethoxazole-Trimethoprim",
         "Ceftriaxone", "Azithromycin", "Meropenem", "Nystatin Cream", "Doxycycline Hyclate",
         "Gentamicin"]
DRUG_TYPES = ["MAIN", "MAIN", "BASE", "ADDITIVE"]
ROUTES = ["IV", "PO", "PO/NG", "IV DRIP", "OU", "TP", "LEFT EAR", "BOTH EYES", "IM", None]

SPEC_TYPES = ["BLOOD CULTURE", "URINE", "SPUTUM", "SWAB", "MRSA SCREEN"]
ORGANISMS = [(None, None), (80002, "ESCHERICHIA COLI"), (80023, "STAPH AUREUS COAG +"),
             (90856, "CANCELLED"), (None, "POSITIVE FOR METHICILLIN RESISTANT STAPH AUREUS"),
             (80053, ""), (None, None)]

SERVICES = ["MED", "CSURG", "NSURG", "ORTHO", "CMED", "TSURG", "OMED", "TRAUM", "SURG"]
ADMISSION_TYPES = ["ELECTIVE", "EW EMER.", "URGENT", "SURGICAL SAME DAY ADMISSION",
                   "DIRECT EMER.", "OBSERVATION ADMIT"]
RACES = ["WHITE", "BLACK/AFRICAN AMERICAN", "ASIAN", "HISPANIC/LATINO", "OTHER"]
DISCHARGE_LOCATIONS = ["HOME", "SKILLED NURSING FACILITY", "DIED", "REHAB"]

# (icd_code, icd_version): covers every Charlson / SAPS-II / APS-III / CKD class
DIAGNOSES = [
    ("410", 9), ("41011", 9), ("I21", 10), ("I252", 10), ("39891", 9), ("4280", 9),
    ("I50", 10), ("I110", 10), ("4439", 9), ("V434", 9), ("I70", 10), ("I739", 10),
    ("430", 9), ("36234", 9), ("G45", 10), ("I63", 10), ("290", 9), ("3310", 9),
    ("F01", 10), ("G30", 10), ("490", 9), ("4168", 9), ("J44", 10), ("J684", 10),
    ("4465", 9), ("7100", 9), ("M05", 10), ("531", 9), ("K25", 10), ("5712", 9),
    ("07022", 9), ("K70", 10), ("B18", 10), ("2500", 9), ("2504", 9), ("E100", 10),
    ("E112", 10), ("3341", 9), ("342", 9), ("G81", 10), ("582", 9), ("5859", 9),
    ("N18", 10), ("N185", 10), ("140", 9), ("2000", 9), ("C00", 10), ("C81", 10),
    ("5722", 9), ("4560", 9), ("I85", 10), ("K766", 10), ("196", 9), ("C77", 10),
    ("C78", 10), ("042", 9), ("B20", 10), ("V420", 9), ("2030", 9), ("C90", 10),
    ("20300", 9), ("23877", 9), ("585", 9), ("I10", 10), ("Z992", 10), ("E119", 10),
    ("27801", 9), ("41401", 9), ("N170", 10), ("A419", 10),
]
DIAGNOSES_PER_ADMISSION = 4

POE_FIELD_VALUES = ["Resuscitate (Full code)", "Full code  (attempt resuscitation)",
                    "DNAR (DO NOT attempt resuscitation for cardiac arrest) ",
                    "Do not resuscitate (DNR/DNI)", "Other"]
