"""First-day summaries (C06-C15): one row per ICU stay, all stays kept.

Each is P04 ``agg_in_window``: a LEFT join of the stay anchor to an upstream
concept on an id, a day and the first-day time window, then an aggregate grouped by
the stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import round_numeric
from ..functions.time import days, hours
from ..operators.temporal import agg_in_window
from ..plans.registry import concept
from .measurement import lab_panels

STAY = ["subject_id", "stay_id"]


def _fd_window(intime="a.intime"):
    return F.col(intime) - hours(6), F.col(intime) + days(1)


def _min_max(cols, rename=None, mean=False):
    rename = rename or {}
    out = []
    for c in cols:
        n = rename.get(c, c)
        out += [F.min(f"e.{c}").alias(f"{n}_min"), F.max(f"e.{c}").alias(f"{n}_max")]
        if mean:
            out.append(F.avg(f"e.{c}").alias(f"{n}_mean"))
    return out


VITAL_COLS = ["heart_rate", "sbp", "dbp", "mbp", "resp_rate", "temperature", "spo2", "glucose"]
BG_COLS = ["lactate", "ph", "so2", "po2", "pco2", "aado2", "aado2_calc", "pao2fio2ratio",
           "baseexcess", "bicarbonate", "totalco2", "hematocrit", "hemoglobin",
           "carboxyhemoglobin", "methemoglobin", "temperature", "chloride", "calcium",
           "glucose", "potassium", "sodium"]


@concept(group="firstday")
def first_day_vitalsign(icustays: DataFrame, vitalsign: DataFrame) -> DataFrame:
    """C14: min/max/mean vitals in [intime - 6 h, intime + 1 d] by stay."""
    start, end = _fd_window()
    aggs = []
    for c in VITAL_COLS:
        aggs += [F.min(f"e.{c}").alias(f"{c}_min"), F.max(f"e.{c}").alias(f"{c}_max"),
                 F.avg(f"e.{c}").alias(f"{c}_mean")]
    return agg_in_window(icustays, vitalsign, "stay_id", "charttime", start, end, aggs, STAY)


@concept(group="firstday")
def first_day_urine_output(icustays: DataFrame, urine_output: DataFrame) -> DataFrame:
    """Urine volume in [intime, intime + 1 d]."""
    return agg_in_window(icustays, urine_output, "stay_id", "charttime",
                         F.col("a.intime"), F.col("a.intime") + days(1),
                         [F.sum("e.urineoutput").alias("urineoutput")], STAY)


@concept(group="firstday")
def first_day_height(icustays: DataFrame, height: DataFrame) -> DataFrame:
    """Average height in the first-day window, rounded to 2."""
    start, end = _fd_window()
    return agg_in_window(icustays, height, "stay_id", "charttime", start, end,
                         [round_numeric(F.avg("e.height"), 2).alias("height")], STAY)


@concept(group="firstday")
def first_day_weight(icustays: DataFrame, weight_durations: DataFrame) -> DataFrame:
    """Weights whose interval starts <= intime + 1 d (no lower bound)."""
    a, e = icustays.alias("a"), weight_durations.alias("e")
    j = a.join(e, (F.col("a.stay_id") == F.col("e.stay_id"))
               & (F.col("e.starttime") <= F.col("a.intime") + days(1)), "left")
    return j.groupBy(F.col("a.subject_id").alias("subject_id"), F.col("a.stay_id").alias("stay_id")).agg(
        F.avg(F.when(F.col("e.weight_type") == "admit", F.col("e.weight"))).alias("weight_admit"),
        F.avg("e.weight").alias("weight"), F.min("e.weight").alias("weight_min"),
        F.max("e.weight").alias("weight_max"))


@concept(group="firstday")
def first_day_rrt(icustays: DataFrame, rrt: DataFrame) -> DataFrame:
    """C11: any dialysis in the first-day window; distinct types listed alphabetically."""
    start, end = _fd_window()
    types = F.expr("listagg(DISTINCT e.dialysis_type, ', ') WITHIN GROUP (ORDER BY e.dialysis_type)")
    return agg_in_window(icustays, rrt, "stay_id", "charttime", start, end,
                         [F.max("e.dialysis_present").alias("dialysis_present"),
                          F.max("e.dialysis_active").alias("dialysis_active"),
                          types.alias("dialysis_type")], STAY)


@concept(group="firstday")
def first_day_gcs(icustays: DataFrame, gcs: DataFrame) -> DataFrame:
    """The lowest GCS row in the first-day window (ties: earliest charttime)."""
    start, end = _fd_window()
    cols = {"gcs_min": "gcs", "gcs_motor": "gcs_motor", "gcs_verbal": "gcs_verbal", "gcs_eyes": "gcs_eyes",
            "gcs_unable": "gcs_unable"}
    row = F.struct(*[F.col(f"e.{c}").alias(n) for n, c in cols.items()])
    # days without an event come last
    order = F.struct(F.col("e.stay_id").isNull(), F.col("e.gcs"), F.col("e.charttime"))
    best = agg_in_window(icustays, gcs, "stay_id", "charttime", start, end, [F.min_by(row, order).alias("_g")], STAY)
    return best.select(*STAY, *[F.col(f"_g.{n}").alias(n) for n in cols])


def _bg_summary(icustays: DataFrame, bg: DataFrame, art_only: bool) -> DataFrame:
    start, end = _fd_window()
    extra = (F.col("e.specimen") == "ART.") if art_only else None
    return agg_in_window(icustays, bg, "subject_id", "charttime", start, end, _min_max(BG_COLS),
                         STAY, extra_on=extra)


@concept(group="firstday")
def first_day_bg(icustays: DataFrame, bg: DataFrame) -> DataFrame:
    """Blood gas min/max by subject in the first-day window."""
    return _bg_summary(icustays, bg, art_only=False)


@concept(group="firstday")
def first_day_bg_art(icustays: DataFrame, bg: DataFrame) -> DataFrame:
    """As C06 with ``specimen = 'ART.'`` in the join condition (stays kept)."""
    return _bg_summary(icustays, bg, art_only=True)


LAB_GROUPS = [
    ("complete_blood_count", ["hematocrit", "hemoglobin", "platelet", "wbc"], {"platelet": "platelets"}),
    ("chemistry", ["albumin", "globulin", "total_protein", "aniongap", "bicarbonate", "bun",
                   "calcium", "chloride", "creatinine", "glucose", "sodium", "potassium"], {}),
    ("blood_differential", ["basophils_abs", "eosinophils_abs", "lymphocytes_abs", "monocytes_abs",
                            "neutrophils_abs", "atypical_lymphocytes", "bands",
                            "immature_granulocytes", "metamyelocytes", "nrbc"],
     {"basophils_abs": "abs_basophils", "eosinophils_abs": "abs_eosinophils",
      "lymphocytes_abs": "abs_lymphocytes", "monocytes_abs": "abs_monocytes",
      "neutrophils_abs": "abs_neutrophils", "atypical_lymphocytes": "atyps",
      "immature_granulocytes": "imm_granulocytes", "metamyelocytes": "metas"}),
    ("coagulation", ["d_dimer", "fibrinogen", "thrombin", "inr", "pt", "ptt"], {}),
    ("enzyme", ["alt", "alp", "ast", "amylase", "bilirubin_total", "bilirubin_direct",
                "bilirubin_indirect", "ck_cpk", "ck_mb", "ggt", "ld_ldh"], {}),
]


@concept(group="firstday")
def first_day_lab(icustays: DataFrame, labevents: DataFrame) -> DataFrame:
    """Min / max of 43 labs from five panels in the first-day window (by
    subject), one row per stay.  All panels come of one pass over the lab events, as rows that
    are never joined to each other, so none can multiply; one window join and one aggregate
    follow (an output column only holds values of its own panel)."""
    start, end = _fd_window()
    rows = lab_panels(labevents, [name for name, _, _ in LAB_GROUPS])
    aggs = []
    for name, cols, rename in LAB_GROUPS:
        for c in cols:
            n = rename.get(c, c)
            aggs += [F.min(f"e.{name}__{c}").alias(f"{n}_min"), F.max(f"e.{name}__{c}").alias(f"{n}_max")]
    return agg_in_window(icustays, rows, "subject_id", "charttime", start, end, aggs, STAY)
