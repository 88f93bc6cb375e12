"""APS-III value scales and tables.

FIXED VALUES.  Each entry of ``APSIII`` is ``(rows, above, normal)``: the points of the first ``(test, bound, points)`` that
holds, those of all larger values, and the value from which the furthest-from-normal rule measures (None: the maximum counts).
"""

from __future__ import annotations

APSIII = {
    "hr": ([("<", 40, 8), ("<", 50, 5), ("<", 100, 0), ("<", 110, 1), ("<", 120, 5), ("<", 140, 7), ("<", 155, 13)], 17, 75),
    "mbp": ([("<", 40, 23), ("<", 60, 15), ("<", 70, 7), ("<", 80, 6), ("<", 100, 0), ("<", 120, 4), ("<", 130, 7), ("<", 140, 9)], 10, 90),
    "temp": ([("<", 33.0, 20), ("<", 33.5, 16), ("<", 34.0, 13), ("<", 35.0, 8), ("<", 36.0, 2), ("<", 40.0, 0)], 4, 38),
    "resp_rate": ([("<", 6, 17), ("<", 12, 8), ("<", 14, 7), ("<", 25, 0), ("<", 35, 6), ("<", 40, 9), ("<", 50, 11)], 18, 19),
    "hematocrit": ([("<", 41.0, 3), ("<", 50.0, 0)], 3, 45.5),
    "wbc": ([("<", 1.0, 19), ("<", 3.0, 5), ("<", 20.0, 0), ("<", 25.0, 1)], 5, 11.5),
    "creatinine": ([("<", 0.5, 3), ("<", 1.5, 0), ("<", 1.95, 4)], 7, 1),
    "bun": ([("<", 17.0, 0), ("<", 20.0, 2), ("<", 40.0, 7), ("<", 80.0, 11)], 12, None),
    "sodium": ([("<", 120, 3), ("<", 135, 2), ("<", 155, 0)], 4, 145.5),
    "albumin": ([("<", 2.0, 11), ("<", 2.5, 6), ("<", 4.5, 0)], 4, 3.5),
    "bilirubin": ([("<", 2.0, 0), ("<", 3.0, 5), ("<", 5.0, 6), ("<", 8.0, 8)], 16, None),
    "glucose": ([("<", 40, 8), ("<", 60, 9), ("<", 200, 0), ("<", 350, 3)], 5, 130),
}
APSIII_UO = ([("<", 400, 15), ("<", 600, 8), ("<", 900, 7), ("<", 1500, 5), ("<", 2000, 4), ("<", 4000, 0)], 1)
APSIII_PAO2 = ([("<", 50, 15), ("<", 70, 5), ("<", 80, 2)], 0)
APSIII_AADO2 = ([("<", 100, 0), ("<", 250, 7), ("<", 350, 9), ("<", 500, 11)], 14)
# creatinine in acute renal failure
APSIII_CREATININE_ARF = ([("<", 1.5, 0)], 10)
APSIII_RR_VENT_FLOOR = 14     # ventilated and rate below this scores 0
APSIII_ARF_CREATININE = 1.5
APSIII_ARF_URINE = 410
APSIII_FIO2_CUT = 50
APSIII_FIO2_DEFAULT = 21
APSIII_LOGIT = (-4.4360, 0.04726)
# ESRD codes that exclude acute renal failure
APSIII_CKD = [(9, 4, "in", ["5854", "5855", "5856"]), (10, 4, "in", ["N184", "N185", "N186"])]

# acid-base: pH upper bound -> [(pCO2 upper bound or None for else, points)]
APSIII_ACIDBASE = [
    (7.20, [(50, 12), (None, 4)]),
    (7.30, [(30, 9), (40, 6), (50, 3), (None, 2)]),
    (7.35, [(30, 9), (45, 0), (None, 1)]),
    (7.45, [(30, 5), (45, 0), (None, 1)]),
    (7.50, [(30, 5), (35, 0), (45, 2), (None, 12)]),
    (7.60, [(40, 3), (None, 12)]),
    (None, [(25, 0), (40, 3), (None, 12)]),
]

# GCS: (verbal values, motor values, points or None for a combination without points) for closed and for open eyes
GCS_VERBAL, GCS_MOTOR = range(1, 6), range(1, 7)
APSIII_GCS_EYES_CLOSED = [
    ([1], [1, 2], 48), ([1], [3, 4], 33), ([1], [5, 6], 16),
    ([2, 3], [1, 2], 29), ([2, 3], [3, 4], 24), ([2, 3], [5, 6], None), ([4, 5], GCS_MOTOR, None),
]
APSIII_GCS_EYES_OPEN = [
    ([1], [1, 2], 29), ([1], [3, 4], 24), ([1], [5, 6], 15),
    ([2, 3], [1, 2], 29), ([2, 3], [3, 4], 24), ([2, 3], [5], 13), ([2, 3], [6], 10),
    ([4], [1, 2, 3, 4], 13), ([4], [5], 8), ([4], [6], 3),
    ([5], [1, 2, 3, 4, 5], 3), ([5], [6], 0),
]
