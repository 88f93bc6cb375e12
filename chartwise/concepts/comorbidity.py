"""Comorbidity (C52): Charlson index from ICD-9/10 diagnoses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import codes as C
from ..operators.codes import code_flags, hierarchical_weight
from ..plans.registry import concept


def age_points(age):
    out = None
    for upper, pts in C.CHARLSON_AGE_BANDS:
        out = F.when(age <= upper, pts) if out is None else out.when(age <= upper, pts)
    return out.otherwise(C.CHARLSON_AGE_ELSE)


@concept(group="comorbidity")
def charlson(admissions: DataFrame, diagnoses_icd: DataFrame, age: DataFrame) -> DataFrame:
    """17 comorbidity flags per admission and the weighted index.

    Hierarchies (P22): severe liver supersedes mild, complicated diabetes
    supersedes uncomplicated, metastatic tumour supersedes malignancy.
    """
    adm = admissions.select("subject_id", "hadm_id")
    x = code_flags(adm, diagnoses_icd, "hadm_id", C.CHARLSON)
    x = x.join(age.select("hadm_id", age_points(F.col("age")).alias("age_score")), "hadm_id", "left")
    c = F.col
    index = (c("age_score") + c("myocardial_infarct") + c("congestive_heart_failure")
             + c("peripheral_vascular_disease") + c("cerebrovascular_disease") + c("dementia")
             + c("chronic_pulmonary_disease") + c("rheumatic_disease") + c("peptic_ulcer_disease")
             + hierarchical_weight(c("mild_liver_disease"), c("severe_liver_disease"), 1, 3)
             + hierarchical_weight(c("diabetes_without_cc"), c("diabetes_with_cc"), 1, 2)
             + hierarchical_weight(c("malignant_cancer"), c("metastatic_solid_tumor"), 2, 6)
             + 2 * c("paraplegia") + 2 * c("renal_disease") + 6 * c("aids"))
    return x.select("subject_id", "hadm_id", "age_score", *C.CHARLSON,
                    index.alias("charlson_comorbidity_index"))
