"""Measurement concepts: EAV pivots of chart and lab events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import items as I
from ..config import units as U
from ..functions.numeric import round_numeric
from ..operators.matching import asof_within
from ..operators.ordering import top1_agg
from ..operators.pivot import ItemSpec, Panel, impute_from_ratio, pivot_items, pivot_panels_together
from ..operators.units import harmonise
from ..operators.windows import carry_previous
from ..plans.registry import concept

LAB_KEYS = ["specimen_id"]


def _lab_ids():
    return [F.max("subject_id").alias("subject_id"), F.max("hadm_id").alias("hadm_id"),
            F.max("charttime").alias("charttime")]


def _lab_order(df: DataFrame, cols) -> DataFrame:
    return df.select("subject_id", "hadm_id", "charttime", "specimen_id", *cols)


def _simple_panel(mapping: dict, positive: bool) -> Panel:
    """MAX per item, valuenum NOT NULL (and > 0)."""
    pre = F.col("valuenum").isNotNull()
    if positive:
        pre = pre & (F.col("valuenum") > 0)
    return Panel({name: ItemSpec([itemid]) for name, itemid in mapping.items()}, pre)


def _by_specimen(labevents: DataFrame, panel: Panel) -> DataFrame:
    return pivot_items(labevents, LAB_KEYS, panel.specs, extra_aggs=_lab_ids(), prefilter=panel.prefilter, extra_ids=panel.extra_ids)


def _simple_lab(labevents: DataFrame, mapping: dict, positive: bool) -> DataFrame:
    return _lab_order(_by_specimen(labevents, _simple_panel(mapping, positive)), list(mapping))


def lab_panels(labevents: DataFrame, names) -> DataFrame:
    """The rows of the named lab concepts in one pass over the events: ``subject_id``, ``hadm_id``, ``charttime``, ``specimen_id``
    and ``<panel>__<column>``; concepts that agree in a specimen's ids share its row."""
    known = {"complete_blood_count": _simple_panel(I.COMPLETE_BLOOD_COUNT, True), "enzyme": _simple_panel(I.ENZYME, True),
             "coagulation": _simple_panel(I.COAGULATION, False), "chemistry": _chemistry_panel(),
             "blood_differential": _differential_panel()}
    x = pivot_panels_together(labevents, LAB_KEYS, {n: known[n] for n in names}, ["subject_id", "hadm_id", "charttime"])
    if "blood_differential" in names:
        x = x.withColumns({f"blood_differential__{n}": v for n, v in _differential_counts("blood_differential__").items()})
    return x


@concept(group="measurement")
def vitalsign(chartevents: DataFrame) -> DataFrame:
    """Per (subject, stay, charttime) average of clipped vital signs."""
    v = F.col("valuenum")
    item = F.col("itemid")
    temperature = round_numeric(F.avg(harmonise(v, U.TEMPERATURE, item)), 2)
    specs = {
        "heart_rate": ItemSpec(I.HEART_RATE, agg="avg", lo=0, hi=300),
        "sbp": ItemSpec(I.SBP, agg="avg", lo=0, hi=400),
        "dbp": ItemSpec(I.DBP, agg="avg", lo=0, hi=300),
        "mbp": ItemSpec(I.MBP, agg="avg", lo=0, hi=300),
        "sbp_ni": ItemSpec(I.SBP_NI, agg="avg", lo=0, hi=400),
        "dbp_ni": ItemSpec(I.DBP_NI, agg="avg", lo=0, hi=300),
        "mbp_ni": ItemSpec(I.MBP_NI, agg="avg", lo=0, hi=300),
        "resp_rate": ItemSpec(I.RESP_RATE, agg="avg", lo=0, hi=70),
        "temperature": temperature,
        "temperature_site": ItemSpec(I.TEMP_SITE, value="value", agg="max"),
        "spo2": ItemSpec(I.SPO2, agg="avg", lo=0, hi=100, strict_hi=False),
        "glucose": ItemSpec(I.GLUCOSE_CHART, agg="avg", lo=0),
    }
    return pivot_items(chartevents, ["subject_id", "stay_id", "charttime"], specs,
                       prefilter=F.col("stay_id").isNotNull(), extra_ids=I.TEMP_F + I.TEMP_C)


def _chemistry_panel() -> Panel:
    pre = F.col("valuenum").isNotNull() & (
        (F.col("valuenum") > 0) | (F.col("itemid") == I.CHEMISTRY_ZERO_ALLOWED))
    return Panel({name: ItemSpec([itemid], hi=hi, strict_hi=False) for name, (itemid, hi) in I.CHEMISTRY.items()}, pre)


@concept(group="measurement")
def chemistry(labevents: DataFrame) -> DataFrame:
    """Chemistry panel by specimen; > 0 except anion gap; per-item upper clips."""
    return _lab_order(_by_specimen(labevents, _chemistry_panel()), list(I.CHEMISTRY))


@concept(group="measurement")
def coagulation(labevents: DataFrame) -> DataFrame:
    """C20: coagulation labs by specimen (non-NULL only, Q26)."""
    return _simple_lab(labevents, I.COAGULATION, positive=False)


@concept(group="measurement")
def cardiac_marker(labevents: DataFrame) -> DataFrame:
    """Cardiac markers by specimen (non-NULL only)."""
    return _simple_lab(labevents, I.CARDIAC_MARKER, positive=False)


@concept(group="measurement")
def inflammation(labevents: DataFrame) -> DataFrame:
    """CRP by specimen, > 0."""
    return _simple_lab(labevents, I.INFLAMMATION, positive=True)


@concept(group="measurement")
def complete_blood_count(labevents: DataFrame) -> DataFrame:
    """CBC by specimen, > 0."""
    return _simple_lab(labevents, I.COMPLETE_BLOOD_COUNT, positive=True)


@concept(group="measurement")
def enzyme(labevents: DataFrame) -> DataFrame:
    """Liver / muscle enzymes by specimen, > 0."""
    return _simple_lab(labevents, I.ENZYME, positive=True)


@concept(group="measurement")
def icp(chartevents: DataFrame) -> DataFrame:
    """Intracranial pressure; out-of-range values become NULL but rows stay."""
    specs = {"icp": ItemSpec(I.ICP, lo=0, hi=100)}
    return pivot_items(chartevents, ["subject_id", "stay_id", "charttime"], specs)


@concept(group="measurement")
def rhythm(chartevents: DataFrame) -> DataFrame:
    """Heart rhythm / ectopy text pivot per (subject, charttime)."""
    specs = {name: ItemSpec([itemid], value="value") for name, itemid in I.RHYTHM.items()}
    return pivot_items(chartevents, ["subject_id", "charttime"], specs,
                       prefilter=F.col("stay_id").isNotNull())


@concept(group="measurement")
def urine_output(outputevents: DataFrame) -> DataFrame:
    """Urine volume per (stay, charttime); irrigant in (> 0) counts negative."""
    v = F.when((F.col("itemid") == I.URINE_IRRIGANT_IN) & (F.col("value") > 0), -F.col("value")) \
        .otherwise(F.col("value"))
    return (outputevents.where(F.col("itemid").isin(I.URINE_OUTPUT))
            .groupBy("stay_id", "charttime").agg(F.sum(v).alias("urineoutput")))


def _differential_panel() -> Panel:
    v, item = F.col("valuenum"), F.col("itemid")
    specs = {"wbc": ItemSpec(I.DIFF_WBC)}
    for name, (k_items, n_items) in I.DIFF_ABS.items():
        specs[name] = ItemSpec([*k_items, *n_items], value=F.when(item.isin(k_items), v).otherwise(v / F.lit(1000.0)) if n_items else v)
    for name, ids in {**I.DIFF_PCT, **I.DIFF_OTHER}.items():
        specs[name] = ItemSpec(ids)
    specs["_pct"] = ItemSpec(I.DIFF_IMPUTE_PCT_ITEMS, agg="sum")
    return Panel(specs, v.isNotNull() & (v >= 0), [I.DIFF_GRANULOCYTE_COUNT])


def _differential_counts(prefix: str = "") -> dict:
    """Absolute counts by name: as measured, else imputed from the percentage where that is allowed."""
    out = {}
    for name in I.DIFF_ABS:
        c = {n: F.col(prefix + n) for n in (name, name.replace("_abs", ""), "wbc", "_pct")}
        allowed = (c["wbc"] > 0) & (c["_pct"] > 0)
        out[name] = round_numeric(impute_from_ratio(c["wbc"], c[name.replace("_abs", "")], c[name], allowed), 4)
    return out


@concept(group="measurement")
def blood_differential(labevents: DataFrame) -> DataFrame:
    """C17: WBC differential by specimen; #/uL counts / 1000; missing absolute
    counts imputed from percentages when WBC > 0 and the percentages sum > 0."""
    x = _by_specimen(labevents, _differential_panel())
    return _lab_order(x, ["wbc", *[v.alias(n) for n, v in _differential_counts().items()], *I.DIFF_PCT, *I.DIFF_OTHER])


@concept(group="measurement")
def bg(labevents: DataFrame, chartevents: DataFrame) -> DataFrame:
    """Blood gases with the latest cleaned charted FiO2 within 4 h before.

    One row per (subject, charttime) among specimens with a pO2; when several
    specimens share that time the lowest specimen_id is kept.  The look-back
    is an as-of join (P06) on subject_id.  (The reference also looks up the
    latest SpO2 within 2 h but never outputs it; it cannot change the rows.)
    """
    v, item = F.col("valuenum"), F.col("itemid")
    specs = {
        **{name: ItemSpec([itemid], hi=hi, strict_hi=False) for name, (itemid, hi) in I.BG_NUMERIC.items()},
        "fio2": ItemSpec([I.BG_FIO2], transform=lambda value: harmonise(value, U.FIO2_LAB)),
    }
    texts = {"specimen": ItemSpec([I.BG_SPECIMEN], value="value"), "comments": ItemSpec([I.BG_COMMENTS], value="value")}
    # apart from the texts, whose maximum needs a sort, the many numeric rows are hashed
    piv = pivot_items(labevents, LAB_KEYS, specs, extra_ids=[I.BG_FIO2], extra_aggs=_lab_ids()).where(F.col("po2").isNotNull()).alias("n")
    said = pivot_items(labevents, LAB_KEYS, texts, extra_aggs=_lab_ids()).alias("t")
    piv = piv.join(said, F.col("n.specimen_id").eqNullSafe(F.col("t.specimen_id")), "left").select(
        "n.specimen_id", *[F.greatest(f"n.{c}", f"t.{c}").alias(c) for c in ("subject_id", "hadm_id", "charttime")],
        *[f"n.{c}" for c in specs], *[f"t.{c}" for c in texts])
    gas = top1_agg(piv, ["subject_id", "charttime"], [("specimen_id", "asc", None)])
    fio2 = (chartevents.where((item == I.CHART_FIO2) & (v > 0) & (v <= 100))
            .groupBy("subject_id", "charttime")
            .agg(F.max(harmonise(v, U.FIO2_CHART)).alias("fio2_chartevents"))
            .where(F.col("fio2_chartevents") > 0))
    x = asof_within(gas, fio2, "subject_id", "charttime", "charttime", 4 * 3600, ["fio2_chartevents"])
    po2, pco2 = F.col("po2"), F.col("pco2")
    fio2_any = F.coalesce(F.col("fio2"), F.col("fio2_chartevents"))
    aado2_calc = F.when(po2.isNull() | pco2.isNull(), None).otherwise(
        (fio2_any / F.lit(100.0)) * F.lit(713.0) - (pco2 / F.lit(0.8)) - po2)
    ratio = F.when(po2.isNull(), None).otherwise(F.lit(100.0) * po2 / fio2_any)
    return x.select(
        "subject_id", "hadm_id", "charttime", "specimen", "so2", "po2", "pco2",
        "fio2_chartevents", "fio2", "aado2", aado2_calc.alias("aado2_calc"),
        ratio.alias("pao2fio2ratio"), "ph", "baseexcess", "bicarbonate", "totalco2", "hematocrit",
        "hemoglobin", "carboxyhemoglobin", "methemoglobin", "chloride", "calcium", "temperature",
        "potassium", "sodium", "lactate", "glucose")


@concept(group="measurement")
def gcs(chartevents: DataFrame) -> DataFrame:
    """Glasgow coma scale with carry-forward of the previous row (< 6 h).

    Verbal 'No Response-ETT' scores 0 and sets ``gcs_unable``; the total is 15
    when the verbal is 0 now (or missing now and 0 before); after an ETT
    verbal the missing components take normal values, otherwise the previous
    row's, then normal values.
    """
    item, v = F.col("itemid"), F.col("valuenum")
    ett = (item == I.GCS_VERBAL) & (F.col("value") == "No Response-ETT")
    specs = {
        "gcsmotor": ItemSpec([I.GCS_MOTOR]),
        "gcsverbal": F.max(F.when(ett, F.lit(0.0)).when(item == I.GCS_VERBAL, v)),
        "gcseyes": ItemSpec([I.GCS_EYES]),
        "endotrachflag": F.max(F.when(ett, 1).otherwise(0)),
    }
    base = pivot_items(chartevents, ["subject_id", "stay_id", "charttime"], specs,
                       extra_ids=[I.GCS_VERBAL])
    # rows are unique per (stay, charttime): the previous row counts only if it is < 6 h old
    x = carry_previous(base, "stay_id", "charttime", ["gcsmotor", "gcsverbal", "gcseyes"], 6 * 3600)
    m, vb, e = F.col("gcsmotor"), F.col("gcsverbal"), F.col("gcseyes")
    pm, pv, pe = F.col("prev_gcsmotor"), F.col("prev_gcsverbal"), F.col("prev_gcseyes")
    total = (F.when(vb == 0, F.lit(15.0))
             .when(vb.isNull() & (pv == 0), F.lit(15.0))
             .when(pv == 0, F.coalesce(m, F.lit(6.0)) + F.coalesce(vb, F.lit(5.0)) + F.coalesce(e, F.lit(4.0)))
             .otherwise(F.coalesce(m, pm, F.lit(6.0)) + F.coalesce(vb, pv, F.lit(5.0))
                        + F.coalesce(e, pe, F.lit(4.0))))
    return x.select("subject_id", "stay_id", "charttime", total.alias("gcs"),
                    F.coalesce(m, pm).alias("gcs_motor"), F.coalesce(vb, pv).alias("gcs_verbal"),
                    F.coalesce(e, pe).alias("gcs_eyes"), F.col("endotrachflag").alias("gcs_unable"))


@concept(group="measurement")
def height(chartevents: DataFrame) -> DataFrame:
    """Heights in cm; the cm item is preferred over inches x 2.54 at the same
    (subject, charttime); keeps 120 < h < 230.  Reproduces Q1: ids and time come
    from the cm side only, so inch-only rows carry NULL subject / stay / time."""
    v = F.col("valuenum")
    cm_value = round_numeric(harmonise(v, U.HEIGHT, F.col("itemid")), 2).alias("height")
    cm = chartevents.where(v.isNotNull() & (F.col("itemid") == I.HEIGHT_CM)).select(
        "subject_id", "stay_id", "charttime", cm_value)
    inch = chartevents.where(v.isNotNull() & (F.col("itemid") == I.HEIGHT_IN)).select(
        "subject_id", "stay_id", "charttime", cm_value)
    j = cm.alias("h1").join(inch.alias("h2"), (F.col("h1.subject_id") == F.col("h2.subject_id"))
                            & (F.col("h1.charttime") == F.col("h2.charttime")), "full")
    h = F.coalesce(F.col("h1.height"), F.col("h2.height"))
    return j.select(F.col("h1.subject_id").alias("subject_id"), F.col("h1.stay_id").alias("stay_id"),
                    F.col("h1.charttime").alias("charttime"), h.alias("height")) \
        .where(F.col("height").isNotNull() & (F.col("height") > 120) & (F.col("height") < 230))
