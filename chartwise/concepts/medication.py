"""Medication concepts: infusion extracts (C37-C42, C45, C47) and derived timelines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import drugs as D
from ..config import items as I
from ..config import units as U
from ..functions.numeric import round_numeric
from ..functions.text import contains_any
from ..operators.codes import match_keywords
from ..operators.matching import contains_join
from ..operators.scores import linear_dose
from ..operators.units import harmonise
from ..operators.windows import segment_intervals
from ..plans.registry import concept


def _infusion(inputevents: DataFrame, itemid: int, rate: Column | None = None) -> DataFrame:
    rate = F.col("rate") if rate is None else rate
    return inputevents.where(F.col("itemid") == itemid).select(
        "stay_id", "linkorderid", rate.alias("vaso_rate"), F.col("amount").alias("vaso_amount"),
        "starttime", "endtime")


@concept(group="medication")
def dobutamine(inputevents: DataFrame) -> DataFrame:
    """C37."""
    return _infusion(inputevents, I.DOBUTAMINE)


@concept(group="medication")
def dopamine(inputevents: DataFrame) -> DataFrame:
    """C38."""
    return _infusion(inputevents, I.DOPAMINE)


@concept(group="medication")
def epinephrine(inputevents: DataFrame) -> DataFrame:
    """C39."""
    return _infusion(inputevents, I.EPINEPHRINE)


@concept(group="medication")
def milrinone(inputevents: DataFrame) -> DataFrame:
    """C40."""
    return _infusion(inputevents, I.MILRINONE)


@concept(group="medication")
def norepinephrine(inputevents: DataFrame) -> DataFrame:
    """mg/kg/min -> mcg/kg/min unless the weight is the placeholder 1."""
    rate, unit = F.col("rate"), F.when(F.col("patientweight") == 1, F.lit(None)).otherwise(F.col("rateuom"))
    rate = harmonise(rate, U.NOREPINEPHRINE, unit, unknown=rate)
    return _infusion(inputevents, I.NOREPINEPHRINE, rate)


@concept(group="medication")
def phenylephrine(inputevents: DataFrame) -> DataFrame:
    """mcg/min -> mcg/kg/min by the charted weight (NULL if the weight is 0)."""
    rate = F.when(F.col("rateuom") == "mcg/min",
                  F.try_divide(F.col("rate"), F.col("patientweight"))).otherwise(F.col("rate"))
    return _infusion(inputevents, I.PHENYLEPHRINE, rate)


@concept(group="medication")
def vasopressin(inputevents: DataFrame) -> DataFrame:
    """units/min -> units/hour."""
    rate = harmonise(F.col("rate"), U.VASOPRESSIN, F.col("rateuom"), unknown=F.col("rate"))
    return _infusion(inputevents, I.VASOPRESSIN, rate)


@concept(group="medication")
def neuroblock(inputevents: DataFrame) -> DataFrame:
    """Neuromuscular blocker infusions (rate NOT NULL)."""
    return inputevents.where(F.col("itemid").isin(I.NEUROBLOCK) & F.col("rate").isNotNull()).select(
        "stay_id", "orderid", F.col("rate").alias("drug_rate"), F.col("amount").alias("drug_amount"),
        "starttime", "endtime")


def _drug_class(prescriptions: DataFrame, words, name: str) -> DataFrame:
    x = match_keywords(prescriptions, "drug", words, "upper")
    return x.select("subject_id", "hadm_id", F.col("drug").alias(name), "starttime", "stoptime")


@concept(group="medication")
def acei(prescriptions: DataFrame) -> DataFrame:
    """ACE inhibitor prescriptions."""
    return _drug_class(prescriptions, D.ACEI, "acei")


@concept(group="medication")
def arb(prescriptions: DataFrame) -> DataFrame:
    """Angiotensin receptor blocker prescriptions."""
    return _drug_class(prescriptions, D.ARB, "arb")


@concept(group="medication")
def nsaid(prescriptions: DataFrame) -> DataFrame:
    """NSAID prescriptions."""
    return _drug_class(prescriptions, D.NSAID, "nsaid")


@concept(group="medication")
def antibiotic(prescriptions: DataFrame, icustays: DataFrame) -> DataFrame:
    """Systemic antibiotic prescriptions with the ICU stay they start in.

    The (drug, route) dictionary excludes BASE drug types, eye / ear / topical
    routes and creams / gels / desensitisation; prescriptions are then matched
    on (drug, route) only, so an excluded row sharing a pair re-enters (Q11).
    A NULL route never matches.  The stay is attached when the start lies in
    [intime, outtime).
    """
    route, drug = F.col("route"), F.lower(F.col("drug"))
    keep = (~F.col("drug_type").isin(D.ANTIBIOTIC_EXCLUDED_DRUG_TYPES)
            & ~route.isin(D.ANTIBIOTIC_EXCLUDED_ROUTES)
            & ~contains_any(F.lower(route), D.ANTIBIOTIC_EXCLUDED_ROUTE_WORDS)
            & ~contains_any(drug, D.ANTIBIOTIC_EXCLUDED_DRUG_WORDS))
    abx = match_keywords(prescriptions, "drug", D.ANTIBIOTIC, "lower", keep, keys=("drug", "route"), filter_cols=("drug_type",))
    ie = icustays.select("hadm_id", "stay_id", F.col("intime").alias("starttime"),
                         F.col("outtime").alias("endtime"))
    j = contains_join(abx, ie, "hadm_id", "starttime", closed="left", how="left", short=True)
    return j.select(F.col("p.subject_id").alias("subject_id"), F.col("p.hadm_id").alias("hadm_id"),
                    F.col("i.stay_id").alias("stay_id"), F.col("p.drug").alias("antibiotic"),
                    F.col("p.route").alias("route"), F.col("p.starttime").alias("starttime"),
                    F.col("p.stoptime").alias("stoptime"))


@concept(group="medication")
def vasoactive_agent(dobutamine: DataFrame, dopamine: DataFrame, epinephrine: DataFrame,
                     norepinephrine: DataFrame, phenylephrine: DataFrame, vasopressin: DataFrame,
                     milrinone: DataFrame) -> DataFrame:
    """Consecutive segments between all infusion start / end times per stay,
    with the rate of every drug infusion containing the segment (P15; Q8)."""
    frames = {"dobutamine": dobutamine, "dopamine": dopamine, "epinephrine": epinephrine,
              "norepinephrine": norepinephrine, "phenylephrine": phenylephrine,
              "vasopressin": vasopressin, "milrinone": milrinone}
    seg = segment_intervals(frames, "stay_id", "vaso_rate")
    return seg.select("stay_id", "starttime", "endtime", "dopamine", "epinephrine", "norepinephrine",
                      "phenylephrine", "vasopressin", "dobutamine", "milrinone")


@concept(group="medication")
def norepinephrine_equivalent_dose(vasoactive_agent: DataFrame) -> DataFrame:
    """Norepinephrine-equivalent dose of each segment with any vasopressor:
    nor + epi + phe / 10 + dop / 100 + vas * 2.5 / 60 (units/hour), rounded to 4."""
    c = F.col
    dose = linear_dose([c("norepinephrine"), c("epinephrine"), c("phenylephrine") / F.lit(10.0),
                        c("dopamine") / F.lit(100.0), c("vasopressin") * F.lit(2.5) / F.lit(60.0)])
    any_drug = (c("norepinephrine").isNotNull() | c("epinephrine").isNotNull() | c("phenylephrine").isNotNull()
                | c("dopamine").isNotNull() | c("vasopressin").isNotNull())
    return vasoactive_agent.where(any_drug).select(
        "stay_id", "starttime", "endtime", round_numeric(dose, 4).alias("norepinephrine_equivalent_dose"))
