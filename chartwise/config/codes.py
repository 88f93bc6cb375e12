"""ICD code rules: comorbidity classes as prefix lists and inclusive string ranges.

FIXED VALUES.  Each class is a list of clauses ``(icd_version, prefix_length,
kind, values)``; ``kind`` is ``"in"`` (prefix in list) or ``"between"``
(inclusive string range).  A diagnosis matches a class when any clause holds.
Codes, versions and ranges must equal the reference's.
"""

from __future__ import annotations

CHARLSON = {
    "myocardial_infarct": [
        (9, 3, "in", ["410", "412"]),
        (10, 3, "in", ["I21", "I22"]),
        (10, 4, "in", ["I252"]),
    ],
    "congestive_heart_failure": [
        (9, 3, "in", ["428"]),
        (9, 5, "in", ["39891", "40201", "40211", "40291", "40401", "40403", "40411", "40413",
                      "40491", "40493"]),
        (9, 4, "between", ("4254", "4259")),
        (10, 3, "in", ["I43", "I50"]),
        (10, 4, "in", ["I099", "I110", "I130", "I132", "I255", "I420", "I425", "I426", "I427",
                       "I428", "I429", "P290"]),
    ],
    "peripheral_vascular_disease": [
        (9, 3, "in", ["440", "441"]),
        (9, 4, "in", ["0930", "4373", "4471", "5571", "5579", "V434"]),
        (9, 4, "between", ("4431", "4439")),
        (10, 3, "in", ["I70", "I71"]),
        (10, 4, "in", ["I731", "I738", "I739", "I771", "I790", "I792", "K551", "K558", "K559",
                       "Z958", "Z959"]),
    ],
    "cerebrovascular_disease": [
        (9, 3, "between", ("430", "438")),
        (9, 5, "in", ["36234"]),
        (10, 3, "in", ["G45", "G46"]),
        (10, 3, "between", ("I60", "I69")),
        (10, 4, "in", ["H340"]),
    ],
    "dementia": [
        (9, 3, "in", ["290"]),
        (9, 4, "in", ["2941", "3312"]),
        (10, 3, "in", ["F00", "F01", "F02", "F03", "G30"]),
        (10, 4, "in", ["F051", "G311"]),
    ],
    "chronic_pulmonary_disease": [
        (9, 3, "between", ("490", "505")),
        (9, 4, "in", ["4168", "4169", "5064", "5081", "5088"]),
        (10, 3, "between", ("J40", "J47")),
        (10, 3, "between", ("J60", "J67")),
        (10, 4, "in", ["I278", "I279", "J684", "J701", "J703"]),
    ],
    "rheumatic_disease": [
        (9, 3, "in", ["725"]),
        (9, 4, "in", ["4465", "7100", "7101", "7102", "7103", "7104", "7140", "7141", "7142", "7148"]),
        (10, 3, "in", ["M05", "M06", "M32", "M33", "M34"]),
        (10, 4, "in", ["M315", "M351", "M353", "M360"]),
    ],
    "peptic_ulcer_disease": [
        (9, 3, "in", ["531", "532", "533", "534"]),
        (10, 3, "in", ["K25", "K26", "K27", "K28"]),
    ],
    "mild_liver_disease": [
        (9, 3, "in", ["570", "571"]),
        (9, 4, "in", ["0706", "0709", "5733", "5734", "5738", "5739", "V427"]),
        (9, 5, "in", ["07022", "07023", "07032", "07033", "07044", "07054"]),
        (10, 3, "in", ["B18", "K73", "K74"]),
        (10, 4, "in", ["K700", "K701", "K702", "K703", "K709", "K713", "K714", "K715", "K717",
                       "K760", "K762", "K763", "K764", "K768", "K769", "Z944"]),
    ],
    "diabetes_without_cc": [
        (9, 4, "in", ["2500", "2501", "2502", "2503", "2508", "2509"]),
        (10, 4, "in", ["E100", "E101", "E106", "E108", "E109", "E110", "E111", "E116", "E118",
                       "E119", "E120", "E121", "E126", "E128", "E129", "E130", "E131", "E136",
                       "E138", "E139", "E140", "E141", "E146", "E148", "E149"]),
    ],
    "diabetes_with_cc": [
        (9, 4, "in", ["2504", "2505", "2506", "2507"]),
        (10, 4, "in", ["E102", "E103", "E104", "E105", "E107", "E112", "E113", "E114", "E115",
                       "E117", "E122", "E123", "E124", "E125", "E127", "E132", "E133", "E134",
                       "E135", "E137", "E142", "E143", "E144", "E145", "E147"]),
    ],
    "paraplegia": [
        (9, 3, "in", ["342", "343"]),
        (9, 4, "in", ["3341", "3440", "3441", "3442", "3443", "3444", "3445", "3446", "3449"]),
        (10, 3, "in", ["G81", "G82"]),
        (10, 4, "in", ["G041", "G114", "G801", "G802", "G830", "G831", "G832", "G833", "G834",
                       "G839"]),
    ],
    "renal_disease": [
        (9, 3, "in", ["582", "585", "586", "V56"]),
        (9, 4, "in", ["5880", "V420", "V451"]),
        (9, 4, "between", ("5830", "5837")),
        (9, 5, "in", ["40301", "40311", "40391", "40402", "40403", "40412", "40413", "40492",
                      "40493"]),
        (10, 3, "in", ["N18", "N19"]),
        (10, 4, "in", ["I120", "I131", "N032", "N033", "N034", "N035", "N036", "N037", "N052",
                       "N053", "N054", "N055", "N056", "N057", "N250", "Z490", "Z491", "Z492",
                       "Z940", "Z992"]),
    ],
    "malignant_cancer": [
        (9, 3, "between", ("140", "172")),
        (9, 4, "between", ("1740", "1958")),
        (9, 3, "between", ("200", "208")),
        (9, 4, "in", ["2386"]),
        (10, 3, "in", ["C43", "C88"]),
        (10, 3, "between", ("C00", "C26")),
        (10, 3, "between", ("C30", "C34")),
        (10, 3, "between", ("C37", "C41")),
        (10, 3, "between", ("C45", "C58")),
        (10, 3, "between", ("C60", "C76")),
        (10, 3, "between", ("C81", "C85")),
        (10, 3, "between", ("C90", "C97")),
    ],
    "severe_liver_disease": [
        (9, 4, "in", ["4560", "4561", "4562"]),
        (9, 4, "between", ("5722", "5728")),
        (10, 4, "in", ["I850", "I859", "I864", "I982", "K704", "K711", "K721", "K729", "K765",
                       "K766", "K767"]),
    ],
    "metastatic_solid_tumor": [
        (9, 3, "in", ["196", "197", "198", "199"]),
        (10, 3, "in", ["C77", "C78", "C79", "C80"]),
    ],
    "aids": [
        (9, 3, "in", ["042", "043", "044"]),
        (10, 3, "in", ["B20", "B21", "B22", "B24"]),
    ],
}

# Charlson age points: upper bounds (inclusive) of age bands, points by band
CHARLSON_AGE_BANDS = [(50, 0), (60, 1), (70, 2), (80, 3)]
CHARLSON_AGE_ELSE = 4

# SAPS-II chronic disease classes (checked in order: aids 17, hem 10, mets 9)
SAPSII_COMORBIDITY = {
    "aids": [
        (9, 3, "between", ("042", "044")),
        (10, 3, "between", ("B20", "B22")),
        (10, 3, "in", ["B24"]),
    ],
    "hem": [
        (9, 5, "between", ("20000", "20238")),
        (9, 5, "between", ("20240", "20248")),
        (9, 5, "between", ("20250", "20302")),
        (9, 5, "between", ("20310", "20312")),
        (9, 5, "between", ("20302", "20382")),
        (9, 5, "between", ("20400", "20522")),
        (9, 5, "between", ("20580", "20702")),
        (9, 5, "between", ("20720", "20892")),
        (9, 4, "in", ["2386", "2733"]),
        (10, 3, "between", ("C81", "C96")),
    ],
    "mets": [
        (9, 4, "between", ("1960", "1991")),
        (9, 5, "between", ("20970", "20975")),
        (9, 5, "in", ["20979", "78951"]),
        (10, 3, "between", ("C77", "C79")),
        (10, 4, "in", ["C800"]),
    ],
}
SAPSII_COMORBIDITY_POINTS = [("aids", 17), ("hem", 10), ("mets", 9)]
