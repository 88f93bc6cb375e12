"""Kidney and liver concepts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import items as I
from ..functions.numeric import round_numeric
from ..functions.time import boundary_diff, days, epoch_seconds, hours
from ..operators.matching import contains_join
from ..operators.scores import meld_score
from ..operators.windows import align_times, boundary_hour_sums, lookback_axis, neighbours
from ..plans.registry import concept

CREATININE = 50912
CKD_RULES = [(9, "585"), (10, "N18")]  # FIXED VALUES: (icd_version, 3-character prefix)


@concept(group="organfailure")
def kdigo_creatinine(icustays: DataFrame, labevents: DataFrame) -> DataFrame:
    """Mean creatinine per time in [intime - 7 d, outtime] with the lowest
    strictly earlier value in 48 h and 7 d (P09: range frames, no self-join).
    Stays without creatinine keep one NULL-time row (Q23)."""
    le = labevents.where((F.col("itemid") == CREATININE) & F.col("valuenum").isNotNull()
                         & (F.col("valuenum") <= 150))
    near = icustays.select("subject_id", "stay_id", (F.col("intime") - days(7)).alias("starttime"), F.col("outtime").alias("endtime"))
    j = contains_join(le.select("subject_id", "charttime", "valuenum"), near, "subject_id", "charttime", how="inner")
    cr = j.groupBy(F.col("i.stay_id").alias("stay_id"), F.col("p.charttime").alias("charttime")).agg(F.avg("p.valuenum").alias("creat"))
    cr = icustays.select("hadm_id", "stay_id").join(cr, "stay_id", "left")
    cr = lookback_axis(cr, "stay_id", epoch_seconds("charttime"), {
        "creat_low_past_48hr": (F.min("creat"), 48 * 3600, False), "creat_low_past_7day": (F.min("creat"), 7 * 86400, False)})
    # a NULL time has no earlier rows (the reference's self-join cannot match it)
    nt = F.col("charttime").isNull()
    return cr.select("hadm_id", "stay_id", "charttime", "creat",
                     F.when(~nt, F.col("creat_low_past_48hr")).alias("creat_low_past_48hr"),
                     F.when(~nt, F.col("creat_low_past_7day")).alias("creat_low_past_7day"))


@concept(group="organfailure")
def kdigo_uo(icustays: DataFrame, urine_output: DataFrame, weight_durations: DataFrame) -> DataFrame:
    """Trailing 6/12/24 h urine volume and documented hours (P10 on seconds
    since admission); rates per kg per hour when enough hours are covered
    (6 h rate only for 6 <= hours < 12, Q9).  Weight on [start, end) (Q7)."""
    x = icustays.select("stay_id", "intime").join(urine_output, "stay_id", "inner")
    x = neighbours(x, "stay_id", "charttime", [])
    prev = F.col("prev_charttime")
    x = x.select("stay_id", "charttime", "urineoutput",
                 (epoch_seconds("charttime") - epoch_seconds("intime")).alias("secs"),
                 F.coalesce((epoch_seconds("charttime") - epoch_seconds(prev)) / F.lit(3600.0), F.lit(1.0))
                 .alias("hrs"))
    frames = {}
    for h in (6, 12, 24):
        frames |= {f"urineoutput_{h}hr": (F.sum("urineoutput"), h * 3600, True), f"uo_tm_{h}hr": (F.sum("hrs"), h * 3600, True)}
    x = lookback_axis(x, "stay_id", F.col("secs"), frames).select("stay_id", "charttime", *frames)
    wd = weight_durations.select("stay_id", "starttime", "endtime", "weight")
    j = contains_join(x, wd, "stay_id", "charttime", closed="left", how="left", times=urine_output.select("stay_id", "charttime"))

    def rate(h, lo, hi=None):
        tm = F.col(f"p.uo_tm_{h}hr")
        ok = (tm >= lo) if hi is None else ((tm >= lo) & (tm < hi))
        return F.when(ok, round_numeric(F.col(f"p.urineoutput_{h}hr") / F.col("i.weight") / tm, 4))

    return j.select(F.col("p.stay_id").alias("stay_id"), F.col("p.charttime").alias("charttime"),
                    F.col("i.weight").alias("weight"),
                    *[F.col(f"p.urineoutput_{h}hr").alias(f"urineoutput_{h}hr") for h in (6, 12, 24)],
                    rate(6, 6, 12).alias("uo_rt_6hr"), rate(12, 12).alias("uo_rt_12hr"),
                    rate(24, 24).alias("uo_rt_24hr"),
                    *[F.col(f"p.uo_tm_{h}hr").alias(f"uo_tm_{h}hr") for h in (6, 12, 24)])


@concept(group="measurement")
def urine_output_rate(icustays: DataFrame, chartevents: DataFrame, urine_output: DataFrame,
                      weight_durations: DataFrame) -> DataFrame:
    """Urine output per kg per hour over 6/12/24 h look-backs.

    Minutes since the previous output (first: since the first heart rate
    charted within a month of the stay); the 6 and 12 h look-backs count hour
    boundaries (<= 5, <= 11), the 24 h look-back is t - 23 h .. t.  Rates need
    >= 6 / 12 / 24 documented hours; weight on (start, end] and > 0.
    """
    ie = icustays.select("stay_id", "intime", "outtime")
    hr = chartevents.where(F.col("itemid") == I.HEART_RATE[0]).select("stay_id", "charttime")
    tm = ie.join(hr, (ie.stay_id == hr.stay_id) & (hr.charttime > F.add_months(ie.intime, -1))
                 & (hr.charttime < F.add_months(ie.outtime, 1)), "inner") \
        .groupBy(ie.stay_id).agg(F.min(hr.charttime).alias("intime_hr"))
    x = tm.join(urine_output, "stay_id", "inner")
    x = neighbours(x, "stay_id", "charttime", [])
    prev = F.col("prev_charttime")
    x = x.select("stay_id", "charttime", "urineoutput",
                 F.when(prev.isNull(), boundary_diff("MINUTE", F.col("charttime"), F.col("intime_hr")))
                 .otherwise(boundary_diff("MINUTE", F.col("charttime"), prev)).alias("tm_since_last_uo"))
    x = boundary_hour_sums(x, "stay_id", "charttime", ["urineoutput", "tm_since_last_uo"],
                           {"6hr": 5, "12hr": 11})
    x = lookback_axis(x, "stay_id", epoch_seconds("charttime"), {
        "urineoutput_24hr": (F.sum("urineoutput"), 23 * 3600, True), "tm_24hr": (F.sum("tm_since_last_uo"), 23 * 3600, True)})
    x = x.select("stay_id", "charttime", F.col("urineoutput").alias("uo"),
                 F.col("urineoutput_6hr"), F.col("urineoutput_12hr"),
                 F.col("urineoutput_24hr"),
                 (F.col("tm_since_last_uo_6hr") / F.lit(60.0)).alias("tm6"),
                 (F.col("tm_since_last_uo_12hr") / F.lit(60.0)).alias("tm12"),
                 (F.col("tm_24hr") / F.lit(60.0)).alias("tm24"))
    wd = weight_durations.where(F.col("weight") > 0).select("stay_id", "starttime", "endtime", "weight")
    j = contains_join(x, wd, "stay_id", "charttime", closed="right", how="left", times=urine_output.select("stay_id", "charttime"))

    def rate(h, tm):
        return F.when(F.col(f"p.{tm}") >= h, round_numeric(
            F.col(f"p.urineoutput_{h}hr") / F.col("i.weight") / F.col(f"p.{tm}"), 4))

    return j.select(F.col("p.stay_id").alias("stay_id"), F.col("p.charttime").alias("charttime"),
                    F.col("i.weight").alias("weight"), F.col("p.uo").alias("uo"),
                    *[F.col(f"p.urineoutput_{h}hr").alias(f"urineoutput_{h}hr") for h in (6, 12, 24)],
                    rate(6, "tm6").alias("uo_mlkghr_6hr"), rate(12, "tm12").alias("uo_mlkghr_12hr"),
                    rate(24, "tm24").alias("uo_mlkghr_24hr"),
                    round_numeric(F.col("p.tm6"), 2).alias("uo_tm_6hr"),
                    round_numeric(F.col("p.tm12"), 2).alias("uo_tm_12hr"),
                    round_numeric(F.col("p.tm24"), 2).alias("uo_tm_24hr"))


def _creat_stage(c, lo7, lo48):
    return (F.when(c >= lo7 * F.lit(3.0), 3)
            .when((c >= 4) & ((lo48 <= 3.7) | (c >= F.lit(1.5) * lo7)), 3)
            .when(c >= lo7 * F.lit(2.0), 2)
            .when(c >= lo48 + F.lit(0.3), 1)
            .when(c >= lo7 * F.lit(1.5), 1)
            .otherwise(0))


@concept(group="organfailure")
def kdigo_stages(icustays: DataFrame, kdigo_creatinine: DataFrame, kdigo_uo: DataFrame,
                 crrt: DataFrame) -> DataFrame:
    """KDIGO stage by creatinine, urine output and CRRT on the union of their
    times (P18); the smoothed stage is the max over the trailing 6 h, windowed
    by patient but ordered by seconds since the stay's admission (Q6)."""
    cr = kdigo_creatinine.select(
        "stay_id", "charttime", "creat_low_past_7day", "creat_low_past_48hr", "creat",
        _creat_stage(F.col("creat"), F.col("creat_low_past_7day"), F.col("creat_low_past_48hr"))
        .alias("aki_stage_creat"))
    ie = icustays.select("subject_id", "hadm_id", "stay_id", "intime")
    uo = kdigo_uo.join(ie.select("stay_id", "intime"), "stay_id", "inner").select(
        "stay_id", "charttime", "uo_rt_6hr", "uo_rt_12hr", "uo_rt_24hr",
        F.when(F.col("uo_rt_6hr").isNull(), None)
        .when(F.col("charttime") <= F.col("intime") + hours(6), 0)
        .when((F.col("uo_tm_24hr") >= 24) & (F.col("uo_rt_24hr") < 0.3), 3)
        .when((F.col("uo_tm_12hr") >= 12) & (F.col("uo_rt_12hr") == 0), 3)
        .when((F.col("uo_tm_12hr") >= 12) & (F.col("uo_rt_12hr") < 0.5), 2)
        .when((F.col("uo_tm_6hr") >= 6) & (F.col("uo_rt_6hr") < 0.5), 1)
        .otherwise(0).alias("aki_stage_uo"))
    cx = crrt.where(F.col("crrt_mode").isNotNull()).select(
        "stay_id", "charttime", F.when(F.col("charttime").isNotNull(), 3).alias("aki_stage_crrt"))
    tm = align_times([cr, uo, cx], "stay_id", "charttime")
    j = ie.join(tm, "stay_id", "left")

    def attach(base, other, cols):
        b, o = base.alias("b"), other.alias("o")
        cond = (F.col("b.stay_id") == F.col("o.stay_id")) & (F.col("b.charttime") == F.col("o.charttime"))
        return b.join(o, cond, "left").select("b.*", *[F.col(f"o.{c}").alias(c) for c in cols])

    j = attach(j, cr, ["creat_low_past_7day", "creat_low_past_48hr", "creat", "aki_stage_creat"])
    j = attach(j, uo, ["uo_rt_6hr", "uo_rt_12hr", "uo_rt_24hr", "aki_stage_uo"])
    j = attach(j, cx, ["aki_stage_crrt"])
    stage = F.greatest(F.coalesce("aki_stage_creat", F.lit(0)), F.coalesce("aki_stage_uo", F.lit(0)),
                       F.coalesce("aki_stage_crrt", F.lit(0)))
    secs = epoch_seconds("charttime") - epoch_seconds("intime")
    j = lookback_axis(j.withColumn("aki_stage", stage), "subject_id", secs, {"aki_stage_smoothed": (F.max("aki_stage"), 21600, True)})
    return j.select("subject_id", "hadm_id", "stay_id", "charttime", "creat_low_past_7day",
                    "creat_low_past_48hr", "creat", "aki_stage_creat", "uo_rt_6hr", "uo_rt_12hr",
                    "uo_rt_24hr", "aki_stage_uo", "aki_stage_crrt", "aki_stage", "aki_stage_smoothed")


@concept(group="measurement")
def creatinine_baseline(age: DataFrame, patients: DataFrame, chemistry: DataFrame,
                        diagnoses_icd: DataFrame) -> DataFrame:
    """Baseline creatinine per adult admission: the minimum measured value if
    <= 1.1 or the patient has CKD, else the MDRD estimate for an eGFR of 75."""
    p = age.where(F.col("age") >= 18).join(patients.select("subject_id", "gender"), "subject_id", "left")
    base = F.lit(75.0) / F.lit(186.0) / F.pow(F.col("age"), F.lit(-0.203))
    mdrd = F.when(F.col("gender") == "F", F.pow(base / F.lit(0.742), F.lit(-1 / 1.154))) \
        .otherwise(F.pow(base, F.lit(-1 / 1.154)))
    p = p.select("hadm_id", "gender", "age", mdrd.alias("mdrd_est"))
    lab = chemistry.groupBy("hadm_id").agg(F.min("creatinine").alias("scr_min"))
    code, ver = F.col("icd_code"), F.col("icd_version")
    is_ckd = None
    for v, prefix in CKD_RULES:
        c = (F.substring(code, 1, 3) == prefix) & (ver == v)
        is_ckd = c if is_ckd is None else (is_ckd | c)
    ckd = diagnoses_icd.where(is_ckd).groupBy("hadm_id").agg(F.max(F.lit(1)).alias("ckd_flag"))
    j = p.join(lab, "hadm_id", "left").join(ckd, "hadm_id", "left")
    return j.select("hadm_id", "gender", "age", "scr_min", F.coalesce("ckd_flag", F.lit(1) - 1).alias("ckd"),
                    "mdrd_est",
                    F.when(F.col("scr_min") <= 1.1, F.col("scr_min"))
                    .when(F.col("ckd_flag") == 1, F.col("scr_min")).otherwise(F.col("mdrd_est"))
                    .alias("scr_baseline"))


@concept(group="organfailure")
def meld(icustays: DataFrame, first_day_lab: DataFrame, first_day_rrt: DataFrame) -> DataFrame:
    """MELD and MELD-Na from first-day labs (log terms floored at 1, capped
    at 40; sodium term when the initial score is > 11)."""
    x = icustays.select("subject_id", "hadm_id", "stay_id") \
        .join(first_day_lab.select("stay_id", "creatinine_max", "bilirubin_total_max", "inr_max",
                                   "sodium_min"), "stay_id", "left") \
        .join(first_day_rrt.select("stay_id", F.col("dialysis_present").alias("rrt")), "stay_id", "left")
    initial, sodium = meld_score(F.col("creatinine_max"), F.col("bilirubin_total_max"), F.col("inr_max"), F.col("sodium_min"), F.col("rrt"))
    return x.select("subject_id", "hadm_id", "stay_id", initial.alias("meld_initial"), sodium.alias("meld"), "rrt",
                    "creatinine_max", "bilirubin_total_max", "inr_max", "sodium_min")
