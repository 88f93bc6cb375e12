"""Treatment dictionaries: ventilation classes, dialysis items, line synonyms, code status.

FIXED VALUES.  Device / mode strings (including trailing blanks), itemids and
label synonyms must equal the reference's; they are listed plainly, in the
reference's priority order where order matters.
"""

from __future__ import annotations

# ------------------------------------------------------------ ventilation classes
# checked in this order; first match wins
TRACH_DEVICES = ["Tracheostomy tube", "Trach mask "]
INVASIVE_DEVICES = ["Endotracheal tube"]
INVASIVE_MODES = [
    "(S) CMV", "APRV", "APRV/Biphasic+ApnPress", "APRV/Biphasic+ApnVol", "APV (cmv)", "Ambient",
    "Apnea Ventilation", "CMV", "CMV/ASSIST", "CMV/ASSIST/AutoFlow", "CMV/AutoFlow", "CPAP/PPS",
    "CPAP/PSV", "CPAP/PSV+Apn TCPL", "CPAP/PSV+ApnPres", "CPAP/PSV+ApnVol", "MMV", "MMV/AutoFlow",
    "MMV/PSV", "MMV/PSV/AutoFlow", "P-CMV", "PCV+", "PCV+/PSV", "PCV+Assist", "PRES/AC", "PRVC/AC",
    "PRVC/SIMV", "PSV/SBT", "SIMV", "SIMV/AutoFlow", "SIMV/PRES", "SIMV/PSV", "SIMV/PSV/AutoFlow",
    "SIMV/VOL", "SYNCHRON MASTER", "SYNCHRON SLAVE", "VOL/AC",
]
INVASIVE_HAMILTON_MODES = ["APRV", "APV (cmv)", "Ambient", "(S) CMV", "P-CMV", "SIMV",
                           "APV (simv)", "P-SIMV", "VS", "ASV"]
NIV_DEVICES = ["Bipap mask ", "CPAP mask "]
NIV_HAMILTON_MODES = ["DuoPaP", "NIV", "NIV-ST"]
HFNC_DEVICES = ["High flow nasal cannula"]
SUPPLEMENTAL_O2_DEVICES = ["Non-rebreather", "Face tent", "Aerosol-cool", "Venti mask ",
                           "Medium conc mask ", "Ultrasonic neb", "Vapomist", "Oxymizer",
                           "High flow neb", "Nasal cannula"]
NO_O2_DEVICES = ["None"]
VENT_GAP_HOURS = 14

# ------------------------------------------------------------ CRRT (charted)
CRRT_NUMERIC = {
    "access_pressure": 224149, "blood_flow": 224144, "citrate": 228004, "current_goal": 225183,
    "dialysate_rate": 224154, "effluent_pressure": 224151, "filter_pressure": 224150,
    "heparin_dose": 224145, "hourly_patient_fluid_removal": 224191,
    "prefilter_replacement_rate": 228005, "postfilter_replacement_rate": 228006,
    "replacement_rate": 224153, "return_pressure": 224152, "ultrafiltrate_output": 226457,
}
CRRT_TEXT = {"crrt_mode": 227290, "dialysate_fluid": 225977, "heparin_concentration": 225958,
             "replacement_fluid": 225976}
CRRT_SYSTEM_INTEGRITY = 224146
CRRT_ACTIVE = ["Active", "Initiated", "Reinitiated", "New Filter"]
CRRT_INACTIVE = ["Recirculating", "Discontinued"]
CRRT_CLOTS = ["Clots Present"]
CRRT_NO_CLOTS = ["No Clot Present"]
CRRT_CLOTS_INCREASING = ["Clots Increasing", "Clot Increasing"]
CRRT_CLOTTED = ["Clotted"]
CRRT_COLUMNS = ["crrt_mode", "access_pressure", "blood_flow", "citrate", "current_goal",
                "dialysate_fluid", "dialysate_rate", "effluent_pressure", "filter_pressure",
                "heparin_concentration", "heparin_dose", "hourly_patient_fluid_removal",
                "prefilter_replacement_rate", "postfilter_replacement_rate", "replacement_fluid",
                "replacement_rate", "return_pressure", "ultrafiltrate_output"]

# ------------------------------------------------------------ RRT
RRT_PRESENT_ONLY = [226118, 227357, 225725]
RRT_PRESENT_NUMERIC = [226499, 224154, 225810, 225959, 227639, 225183, 227438, 224191, 225806,
                       225807, 228004, 228005, 228006, 224144, 224145, 224149, 224150, 224151,
                       224152, 224153, 224404, 224406, 226457]
RRT_PRESENT_TEXT = [224135, 224139, 224146, 225323, 225740, 225776, 225951, 225952, 225953,
                    225954, 225956, 225958, 225961, 225963, 225965, 225976, 225977, 227124,
                    227290, 227638, 227640, 227753]
RRT_ACTIVE_NUMERIC = [226499, 224154, 225183, 227438, 224191, 225806, 225807, 228004, 228005,
                      228006, 224144, 224145, 224153, 226457]
RRT_PD_CATHETER_STATUS = 225965
RRT_PD_IN_USE = "In use"
RRT_CRRT_MODE = 227290
RRT_PERITONEAL = [225810, 225806, 225807, 227639, 225959, 225951, 225952, 225961, 225953,
                  225963, 225965, 227638, 227640]
RRT_IHD_OUTPUT = 226499
RRT_INPUT_ITEMS = [227536, 227525]
RRT_PROCEDURES = {225441: "IHD", 225802: "CRRT", 225803: "CVVHD", 225805: "Peritoneal",
                  225809: "CVVHDF", 225955: "SCUF", 224270: None, 225436: None}
RRT_PROCEDURES_NOT_ACTIVE = [224270, 225436]

# ------------------------------------------------------------ invasive lines
LINE_ITEMS = [227719, 225752, 224269, 224267, 224270, 224272, 226124, 228169, 225202, 228286,
              225204, 224263, 224560, 224264, 225203, 224273, 225789, 225761, 228201, 228202,
              224268, 225199, 225315, 225205]
LINE_TYPE_SYNONYMS = [
    (["Arterial Line", "A-Line"], "Arterial"),
    (["CCO PA Line", "CCO PAC"], "Continuous Cardiac Output PA"),
    (["Dialysis Catheter", "Dialysis Line"], "Dialysis"),
    (["Hickman", "Tunneled (Hickman) Line"], "Hickman"),
    (["IABP", "IABP line"], "IABP"),
    (["Multi Lumen", "Multi-lumen"], "Multi Lumen"),
    (["PA Catheter", "PA line"], "PA"),
    (["PICC Line", "PICC line"], "PICC"),
    (["Pre-Sep Catheter", "Presep Catheter"], "Pre-Sep"),
    (["Trauma Line", "Trauma line"], "Trauma"),
    (["Triple Introducer", "TripleIntroducer"], "Triple Introducer"),
    (["Portacath", "Indwelling Port (PortaCath)"], "Portacath"),
]
LINE_SITE_SYNONYMS = [
    (["Left Antecub", "Left Antecube"], "Left Antecube"),
    (["Left Axilla", "Left Axilla."], "Left Axilla"),
    (["Left Brachial", "Left Brachial."], "Left Brachial"),
    (["Left Femoral", "Left Femoral."], "Left Femoral"),
    (["Right Antecub", "Right Antecube"], "Right Antecube"),
    (["Right Axilla", "Right Axilla."], "Right Axilla"),
    (["Right Brachial", "Right Brachial."], "Right Brachial"),
    (["Right Femoral", "Right Femoral."], "Right Femoral"),
]

# ------------------------------------------------------------ code status
CODE_STATUS_ITEM = 223758
CHART_FULLCODE = ["Full code"]
CHART_CMO = ["Comfort measures only"]
CHART_DNI = ["DNI (do not intubate)", "DNR / DNI"]
CHART_DNR = ["DNR (do not resuscitate)", "DNR / DNI"]
POE_ORDER_TYPE = "General Care"
POE_ORDER_SUBTYPE = "Code status"
POE_FULLCODE = ["Resuscitate (Full code)", "Full code  (attempt resuscitation)"]
POE_DNR = ["DNAR (DO NOT attempt resuscitation for cardiac arrest) ", "Do not resuscitate (DNR/DNI)"]
POE_DNI = ["Do not resuscitate (DNR/DNI)"]
