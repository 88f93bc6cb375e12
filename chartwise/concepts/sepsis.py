"""Sepsis concepts (C59, C60): suspicion of infection and Sepsis-3 onset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import epoch_seconds, hours
from ..operators.matching import date_or_time, day_bucket, first_in_windows
from ..operators.ordering import ordinal, top1_agg
from ..plans.registry import concept

NEGATIVE_ORG_ITEMID = 90856  # FIXED VALUE: organism code of a cancelled culture


@concept(group="sepsis")
def suspicion_of_infection(antibiotic: DataFrame, microbiologyevents: DataFrame) -> DataFrame:
    """Each antibiotic with the culture that makes it a suspected infection:
    a culture up to 72 h (date-only: 3 days) before, else up to 24 h (1 day)
    after; the earliest qualifying culture each way; culture-first wins."""
    order = ["starttime", "stoptime", "antibiotic", "stay_id", "route"]
    ab = ordinal(antibiotic.select("subject_id", "hadm_id", *order), "subject_id", day_bucket(F.col("starttime")),
                 [F.col(c).asc_nulls_first() for c in order], "ab_id")
    ab = ab.select("subject_id", "hadm_id", "stay_id", "antibiotic", F.col("starttime").alias("antibiotic_time"), "ab_id")
    org_ok = (F.col("org_name").isNotNull() & (F.col("org_itemid") != NEGATIVE_ORG_ITEMID)
              & (F.col("org_name") != ""))
    me = microbiologyevents.groupBy("micro_specimen_id").agg(
        F.max("subject_id").alias("subject_id"), F.max("hadm_id").alias("hadm_id"),
        F.to_date(F.max("chartdate")).alias("chartdate"), F.max("charttime").alias("charttime"),
        F.max("spec_type_desc").alias("spec_type_desc"),
        F.max(F.when(org_ok, 1).otherwise(0)).alias("positiveculture"))
    me = me.select("*", F.coalesce("charttime", F.col("chartdate").cast("timestamp_ntz")).alias("culture"),
                   F.col("positiveculture").alias("positive"), F.col("spec_type_desc").alias("specimen"))
    t, dated = F.col("antibiotic_time"), F.col("charttime").isNull()
    day = F.col("chartdate")
    # the culture before the antibiotic by up to 72 h (or 3 days), or after it by up to 24 h (or a day)
    looks = (date_or_time("last72", t, F.col("charttime"), dated, 72 * 3600, 0, 3, 0, strict_after=True, b_day=day)
             + date_or_time("next24", t, F.col("charttime"), dated, 0, 24 * 3600, 0, 1, strict_before=True, b_day=day))
    x = first_in_windows(ab, me, "subject_id", ["subject_id", "ab_id"], looks,
                         [("chartdate", "asc", None), ("charttime", "asc", True), ("micro_specimen_id", "asc", None)],
                         ["culture", "positive", "specimen"])
    none = F.col("last72_specimen").isNull() & F.col("next24_specimen").isNull()
    return x.select(
        "subject_id", "stay_id", "hadm_id", "ab_id", "antibiotic", "antibiotic_time",
        F.when(none, 0).otherwise(1).alias("suspected_infection"),
        F.when(none, None).otherwise(F.coalesce("last72_culture", "antibiotic_time")).alias("suspected_infection_time"),
        F.coalesce("last72_culture", "next24_culture").alias("culture_time"),
        F.coalesce("last72_specimen", "next24_specimen").alias("specimen"),
        F.coalesce("last72_positive", "next24_positive").alias("positive_culture"))


@concept(group="sepsis")
def sepsis3(sofa: DataFrame, suspicion_of_infection: DataFrame) -> DataFrame:
    """The earliest suspected infection per stay with a SOFA >= 2 hour
    ending in [suspicion - 48 h, suspicion + 24 h] (``sepsis3`` is always TRUE, Q15).

    SOFA rows end on whole hours, so each suspicion is exploded to the (at most
    73) whole hours of its window and equi-joined on (stay, endtime).
    """
    s = sofa.where(F.col("sofa_24hours") >= 2).select(
        "stay_id", "endtime", F.col("respiration_24hours").alias("respiration"),
        F.col("coagulation_24hours").alias("coagulation"), F.col("liver_24hours").alias("liver"),
        F.col("cardiovascular_24hours").alias("cardiovascular"), F.col("cns_24hours").alias("cns"),
        F.col("renal_24hours").alias("renal"), F.col("sofa_24hours").alias("sofa_score"))
    st = F.col("suspected_infection_time")
    lo = (F.ceil(epoch_seconds(st - hours(48)) / 3600)).cast("long")
    hi = (F.floor(epoch_seconds(st + hours(24)) / 3600)).cast("long")
    soi = suspicion_of_infection.where(F.col("stay_id").isNotNull() & st.isNotNull()).select(
        "subject_id", "stay_id", "ab_id", "antibiotic_time", "culture_time", "suspected_infection",
        "suspected_infection_time", F.explode(F.sequence(lo, hi)).alias("_h"))
    s = s.withColumn("_h", (epoch_seconds("endtime") / 3600).cast("long"))
    j = soi.join(s, ["stay_id", "_h"], "inner")
    best = top1_agg(j, ["stay_id"], [("suspected_infection_time", "asc", None), ("antibiotic_time", "asc", None),
                                     ("culture_time", "asc", None), ("endtime", "asc", None), ("ab_id", "asc", None)])
    return best.select(
        "subject_id", "stay_id", "antibiotic_time", "culture_time", "suspected_infection_time",
        F.col("endtime").alias("sofa_time"), "sofa_score", "respiration", "coagulation", "liver",
        "cardiovascular", "cns", "renal",
        ((F.col("sofa_score") >= 2) & (F.col("suspected_infection") == 1)).alias("sepsis3"))
