"""Oracle SQL: urine windows, kidney-injury stages and MELD."""

from __future__ import annotations

from .compose import define
from .rules import rounded, worst

# FIXED VALUES: hours of a window -> when its rate counts
UO_SPANS = {6: "hours >= 6 AND hours < 12", 12: "hours >= 12", 24: "hours >= 24"}

_uo = ", ".join(f"max({col}) FILTER (WHERE span = {h}) AS {name}_{h}hr"
                for name, col in (("urineoutput", "volume"), ("uo_rt", "rate"), ("uo_tm", "hours")) for h in UO_SPANS)
_rate_known = " OR ".join(f"(span = {h} AND {cond})" for h, cond in UO_SPANS.items())
define("kdigo_uo", ("urine_output", "weight_durations"), f"""
    WITH voids AS (
      SELECT u.stay_id, u.charttime, u.urineoutput,
        coalesce(date_diff('second', (SELECT max(e.charttime) FROM urine_output e WHERE e.stay_id = u.stay_id
                                      AND e.charttime < u.charttime), u.charttime) / 3600.0, 1) AS hours
      FROM urine_output u SEMI JOIN icustays USING (stay_id)),
    windows AS (
      SELECT a.stay_id, a.charttime, span, sum(b.urineoutput) AS volume, sum(b.hours ORDER BY b.charttime) AS hours
      FROM voids a CROSS JOIN unnest({list(UO_SPANS)}) s(span)
      JOIN voids b ON b.stay_id = a.stay_id AND date_diff('second', b.charttime, a.charttime) BETWEEN 0 AND span * 3600
      GROUP BY a.stay_id, a.charttime, span),
    weighed AS (
      SELECT w.*, d.weight, CASE WHEN {_rate_known} THEN {rounded('volume / d.weight / hours', 4)} END AS rate
      FROM windows w LEFT JOIN weight_durations d
        ON d.stay_id = w.stay_id AND w.charttime >= d.starttime AND w.charttime < d.endtime)
    SELECT stay_id, charttime, weight, {_uo} FROM weighed GROUP BY stay_id, charttime, weight""")

# FIXED VALUES: (stage, condition)
CREATININE = [
    (3, "creat >= creat_low_past_7day * 3.0"), (3, "creat >= 4 AND creat_low_past_48hr <= 3.7"),
    (3, "creat >= 4 AND creat >= 1.5 * creat_low_past_7day"), (2, "creat >= creat_low_past_7day * 2.0"),
    (1, "creat >= creat_low_past_48hr + 0.3"), (1, "creat >= creat_low_past_7day * 1.5")]
URINE = [
    (3, "uo_tm_24hr >= 24 AND uo_rt_24hr < 0.3"), (3, "uo_tm_12hr >= 12 AND uo_rt_12hr = 0"),
    (2, "uo_tm_12hr >= 12 AND uo_rt_12hr < 0.5"), (1, "uo_tm_6hr >= 6 AND uo_rt_6hr < 0.5")]
URINE = [(stage, f"{cond} AND charttime > intime + INTERVAL 6 HOUR") for stage, cond in URINE]
KDIGO_VALUES = ["creat_low_past_7day", "creat_low_past_48hr", "creat", "aki_stage_creat", "uo_rt_6hr", "uo_rt_12hr",
                "uo_rt_24hr", "aki_stage_uo", "aki_stage_crrt"]
define("kdigo_stages", ("kdigo_creatinine", "kdigo_uo", "crrt"), f"""
    WITH marks AS (
      SELECT stay_id, charttime, creat, creat_low_past_48hr, creat_low_past_7day,
        {worst(CREATININE, 'charttime IS NULL')} AS aki_stage_creat
      FROM kdigo_creatinine
      UNION ALL BY NAME
      SELECT stay_id, charttime, uo_rt_6hr, uo_rt_12hr, uo_rt_24hr, {worst(URINE, 'uo_rt_6hr IS NULL')} AS aki_stage_uo
      FROM kdigo_uo JOIN icustays USING (stay_id)
      UNION ALL BY NAME
      SELECT stay_id, charttime, 3 AS aki_stage_crrt FROM crrt WHERE crrt_mode IS NOT NULL AND charttime IS NOT NULL),
    moments AS (
      SELECT ie.subject_id, ie.hadm_id, ie.stay_id, m.charttime, date_diff('second', ie.intime, m.charttime) AS secs,
        {', '.join(f'max(m.{v}) AS {v}' for v in KDIGO_VALUES)},
        greatest(0, max(aki_stage_creat), max(aki_stage_uo), max(aki_stage_crrt)) AS aki_stage
      FROM icustays ie LEFT JOIN marks m ON m.stay_id = ie.stay_id
      GROUP BY ie.subject_id, ie.hadm_id, ie.stay_id, ie.intime, m.charttime)
    SELECT a.* EXCLUDE (secs),
      (SELECT max(b.aki_stage) FROM moments b WHERE b.subject_id = a.subject_id
         AND (b.secs BETWEEN a.secs - 21600 AND a.secs OR (a.secs IS NULL AND b.secs IS NULL))) AS aki_stage_smoothed
    FROM moments a""")

# each factor enters by its logarithm, at least 0; unknown counts as normal
define("meld", ("first_day_lab", "first_day_rrt"), f"""
    WITH labs AS (
      SELECT ie.subject_id, ie.hadm_id, ie.stay_id, r.dialysis_present AS rrt, l.creatinine_max, l.bilirubin_total_max,
        l.inr_max, l.sodium_min,
        0.957 * ln(CASE WHEN r.dialysis_present = 1 THEN 4.0 ELSE least(greatest(l.creatinine_max, 1.0), 4.0) END)
          + 0.378 * ln(greatest(l.bilirubin_total_max, 1.0)) + (1.120 * ln(greatest(l.inr_max, 1.0)) + 0.643) AS risk,
        137.0 - least(greatest(coalesce(l.sodium_min, 137.0), 125.0), 137.0) AS sodium_gap
      FROM icustays ie LEFT JOIN first_day_lab l USING (stay_id) LEFT JOIN first_day_rrt r USING (stay_id)),
    initial AS (SELECT *, CASE WHEN risk > 4 THEN 40.0 ELSE {rounded('risk', 1)} * 10 END AS meld_initial FROM labs)
    SELECT * EXCLUDE (risk, sodium_gap),
      meld_initial + CASE WHEN meld_initial > 11 THEN 1.32 * sodium_gap - 0.033 * meld_initial * sodium_gap ELSE 0 END AS meld
    FROM initial""")
