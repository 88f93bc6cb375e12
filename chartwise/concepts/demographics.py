"""Demographics (C01-C05): ages, stay details, HR-based stay times, hourly spine, weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import items as I
from ..functions.numeric import round_numeric
from ..functions.time import boundary_diff, hours
from ..operators.matching import day_bucket
from ..operators.ordering import ordinal
from ..operators.windows import hourly_spine, to_validity
from ..plans.registry import concept


def _age(admittime, anchor_age, anchor_year):
    """anchor_age + year boundaries from Jan 1 of anchor_year to admittime."""
    return (anchor_age + (F.year(admittime) - anchor_year)).cast("long")


@concept(group="demographics")
def age(admissions: DataFrame, patients: DataFrame) -> DataFrame:
    """Age at each admission."""
    a, p = admissions.alias("ad"), patients.alias("pa")
    j = a.join(p, F.col("ad.subject_id") == F.col("pa.subject_id"), "inner")
    return j.select(F.col("ad.subject_id").alias("subject_id"), "ad.hadm_id", "ad.admittime",
                    "pa.anchor_age", "pa.anchor_year",
                    _age(F.col("ad.admittime"), F.col("pa.anchor_age"), F.col("pa.anchor_year"))
                    .alias("age"))


@concept(group="demographics")
def icustay_detail(icustays: DataFrame, admissions: DataFrame, patients: DataFrame) -> DataFrame:
    """Stay-level demographics, lengths of stay and admission / stay ordinals.

    The hospital-stay rank is over admissions that have an ICU stay (Q12).
    """
    ie, adm, pat = icustays.alias("ie"), admissions.alias("adm"), patients.alias("pat")
    j = (ie.join(adm, F.col("ie.hadm_id") == F.col("adm.hadm_id"), "inner")
         .join(pat, F.col("ie.subject_id") == F.col("pat.subject_id"), "inner"))
    w_hosp = Window.partitionBy(F.col("adm.subject_id")).orderBy(F.col("adm.admittime"))
    w_icu = Window.partitionBy(F.col("ie.hadm_id")).orderBy(F.col("ie.intime"))
    hosp_seq = F.dense_rank().over(w_hosp).cast("long")
    icu_seq = F.dense_rank().over(w_icu).cast("long")
    return j.select(
        F.col("ie.subject_id").alias("subject_id"), F.col("ie.hadm_id").alias("hadm_id"),
        F.col("ie.stay_id").alias("stay_id"), "pat.gender", "pat.dod",
        "adm.admittime", "adm.dischtime",
        boundary_diff("DAY", F.col("adm.dischtime"), F.col("adm.admittime")).alias("los_hospital"),
        _age(F.col("adm.admittime"), F.col("pat.anchor_age"), F.col("pat.anchor_year"))
        .alias("admission_age"),
        "adm.race", "adm.hospital_expire_flag",
        hosp_seq.alias("hospstay_seq"), (hosp_seq == 1).alias("first_hosp_stay"),
        F.col("ie.intime").alias("icu_intime"), F.col("ie.outtime").alias("icu_outtime"),
        round_numeric(boundary_diff("HOUR", F.col("ie.outtime"), F.col("ie.intime")) / F.lit(24.0), 2)
        .alias("los_icu"),
        icu_seq.alias("icustay_seq"), (icu_seq == 1).alias("first_icu_stay"),
    )


@concept(group="demographics")
def icustay_times(icustays: DataFrame, chartevents: DataFrame) -> DataFrame:
    """First and last heart-rate charting time per stay (NULL if none)."""
    hr = (chartevents.where(F.col("itemid").isin(I.HEART_RATE) & F.col("stay_id").isNotNull())
          .groupBy("stay_id").agg(F.min("charttime").alias("intime_hr"),
                                  F.max("charttime").alias("outtime_hr")))
    return icustays.select("subject_id", "hadm_id", "stay_id").join(hr, "stay_id", "left") \
        .select("subject_id", "hadm_id", "stay_id", "intime_hr", "outtime_hr")


@concept(group="demographics")
def icustay_hourly(icustay_times: DataFrame) -> DataFrame:
    """Hours -24 .. n per stay, n = hour boundaries from first to last HR;
    endtime = ceil_hour(intime_hr) + hr hours.  Stays without HR give no rows."""
    n = boundary_diff("HOUR", F.col("outtime_hr"), F.col("intime_hr"))
    return hourly_spine(icustay_times.where(F.col("intime_hr").isNotNull()), "stay_id",
                        F.col("intime_hr"), n, 24)


@concept(group="demographics")
def weight_durations(chartevents: DataFrame, icustays: DataFrame) -> DataFrame:
    """Weight validity intervals per stay.

    The first admission weight starts 2 h before ICU admission; each weight
    lasts until the next one starts, the last until 2 h after discharge; if
    the first weight starts after intime, [intime - 2 h, first start) is
    back-filled with it.  Ties at equal times are ordered by (type, weight).
    """
    v = F.col("valuenum")
    wt = chartevents.where(v.isNotNull() & F.col("itemid").isin(I.WEIGHT_ADMIT, I.WEIGHT_DAILY) & (v > 0)) \
        .select("stay_id", "charttime",
                F.when(F.col("itemid") == I.WEIGHT_ADMIT, F.lit("admit")).otherwise(F.lit("daily"))
                .alias("weight_type"), v.alias("weight"))
    wt = wt.withColumn("_series", F.struct("stay_id", "weight_type"))
    wt = ordinal(wt, "_series", day_bucket(F.col("charttime")), [F.col("charttime"), F.col("weight")], "rn")
    ie = icustays.select("stay_id", "intime", "outtime")
    first = (F.col("weight_type") == "admit") & (F.col("rn") == 1)
    x = wt.join(ie, "stay_id", "inner").select(
        "stay_id", "intime", "outtime", "weight_type", "weight",
        F.when(first, F.col("intime") - hours(2)).otherwise(F.col("charttime")).alias("starttime"))
    x = to_validity(x, "stay_id", "starttime", ["weight_type", "weight"], F.col("outtime") + hours(2),
                    gap_start=F.col("intime") - hours(2), gap_from=F.col("intime"))
    return x.select("stay_id", "starttime", "endtime", "weight", "weight_type")
