"""Treatment concepts: ventilation settings and episodes, dialysis, lines, code status
(C28, C32, C61-C65)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import items as I
from ..config import treatment as T
from ..config import units as U
from ..operators.pivot import ItemSpec, pivot_items
from ..operators.codes import map_labels, text_flag
from ..operators.matching import contains_join
from ..operators.ordering import top_n
from ..operators.temporal import override_by_interval
from ..operators.units import harmonise
from ..operators.windows import align_times, state_episodes
from ..plans.registry import concept


@concept(group="measurement")
def ventilator_setting(chartevents: DataFrame) -> DataFrame:
    """Ventilator settings per (subject, charttime); FiO2 fraction -> percent,
    PEEP outside [0, 100] -> NULL; value and stay_id must be present."""
    specs = {name: ItemSpec([i]) for name, i in I.VENT_NUMERIC.items()}
    specs["peep"] = ItemSpec(I.VENT_PEEP, transform=lambda v: harmonise(v, U.PEEP))
    specs["fio2"] = ItemSpec([I.VENT_FIO2], transform=lambda v: harmonise(v, U.FIO2_VENTILATOR))
    specs["flow_rate"] = ItemSpec([I.VENT_FLOW_RATE])
    for name, i in I.VENT_TEXT.items():
        specs[name] = ItemSpec([i], value="value")
    pre = F.col("value").isNotNull() & F.col("stay_id").isNotNull()
    out = pivot_items(chartevents, ["subject_id", "charttime"], specs, prefilter=pre,
                      extra_aggs=[F.max("stay_id").alias("stay_id")])
    return out.select("subject_id", "stay_id", "charttime", *specs)


@concept(group="measurement")
def oxygen_delivery(chartevents: DataFrame) -> DataFrame:
    """O2 flow (227582 merged into 223834; latest stored per item) and up to
    four delivery devices (alphabetical) per (subject, charttime).

    Reproduces Q2: the reference's FULL JOIN is filtered on the flow side, so
    times with devices but no flow are dropped (a LEFT join from the flows).
    """
    item = F.when(F.col("itemid").isin(I.O2_FLOW, I.O2_FLOW_ALT), F.lit(I.O2_FLOW)).otherwise(F.col("itemid"))
    flows = chartevents.where(F.col("value").isNotNull()
                              & F.col("itemid").isin(I.O2_FLOW, I.O2_FLOW_ALT, I.O2_FLOW_ADDITIONAL)) \
        .select("subject_id", "stay_id", "charttime", item.alias("itemid"), "value", "valuenum", "storetime")
    flows = top_n(flows, ["subject_id", "charttime", "itemid"],
                  [F.col("storetime").desc(), F.col("valuenum").desc(), F.col("value").desc()], 1)
    dev = chartevents.where(F.col("itemid") == I.O2_DEVICE).select(
        "subject_id", "stay_id", "charttime", F.col("value").alias("o2_device"))
    dev = top_n(dev, ["subject_id", "charttime"], [F.col("o2_device").asc_nulls_first()], 4, "rn")
    j = flows.alias("c").join(dev.alias("o"), (F.col("c.subject_id") == F.col("o.subject_id"))
                              & (F.col("c.charttime") == F.col("o.charttime")), "left")
    rn = F.col("o.rn")
    return j.groupBy(F.col("c.subject_id").alias("subject_id"), F.col("c.charttime").alias("charttime")).agg(
        F.max(F.coalesce(F.col("c.stay_id"), F.col("o.stay_id"))).alias("stay_id"),
        F.max(F.when(F.col("c.itemid") == I.O2_FLOW, F.col("c.valuenum"))).alias("o2_flow"),
        F.max(F.when(F.col("c.itemid") == I.O2_FLOW_ADDITIONAL, F.col("c.valuenum"))).alias("o2_flow_additional"),
        *[F.max(F.when(rn == k, F.col("o.o2_device"))).alias(f"o2_delivery_device_{k}") for k in range(1, 5)],
    ).select("subject_id", "stay_id", "charttime", "o2_flow", "o2_flow_additional",
             *[f"o2_delivery_device_{k}" for k in range(1, 5)])


def _ventilation_status(device: Column, mode: Column, hamilton: Column) -> Column:
    return (F.when(device.isin(T.TRACH_DEVICES), "Tracheostomy")
            .when(device.isin(T.INVASIVE_DEVICES) | mode.isin(T.INVASIVE_MODES)
                  | hamilton.isin(T.INVASIVE_HAMILTON_MODES), "InvasiveVent")
            .when(device.isin(T.NIV_DEVICES) | hamilton.isin(T.NIV_HAMILTON_MODES), "NonInvasiveVent")
            .when(device.isin(T.HFNC_DEVICES), "HFNC")
            .when(device.isin(T.SUPPLEMENTAL_O2_DEVICES), "SupplementalOxygen")
            .when(device.isin(T.NO_O2_DEVICES), "None"))


@concept(group="treatment")
def ventilation(ventilator_setting: DataFrame, oxygen_delivery: DataFrame) -> DataFrame:
    """Ventilation episodes (P18 + P14).

    Each documented time is classified (tracheostomy > invasive > non-invasive
    > HFNC > supplemental O2 > none).  A new episode starts on a change of
    class or when >= 14 hour boundaries passed since the previous time of the
    same class; an episode ends at the next documented time unless that is
    >= 14 h away; single-time episodes are dropped.
    """
    tm = align_times([ventilator_setting, oxygen_delivery], "stay_id", "charttime")
    vs = ventilator_setting.select("stay_id", "charttime", "ventilator_mode", "ventilator_mode_hamilton")
    od = oxygen_delivery.select("stay_id", "charttime", "o2_delivery_device_1")
    x = tm.join(vs, ["stay_id", "charttime"], "left").join(od, ["stay_id", "charttime"], "left")
    x = x.select("stay_id", "charttime",
                 _ventilation_status(F.col("o2_delivery_device_1"), F.col("ventilator_mode"),
                                     F.col("ventilator_mode_hamilton")).alias("status")) \
        .where(F.col("status").isNotNull())
    return state_episodes(x, "stay_id", "charttime", "status", T.VENT_GAP_HOURS, "ventilation_status")


@concept(group="treatment")
def crrt(chartevents: DataFrame) -> DataFrame:
    """CRRT settings per (stay, charttime); system integrity text -> 4 flags."""
    item, val = F.col("itemid"), F.col("value")
    si = T.CRRT_SYSTEM_INTEGRITY
    specs = {}
    for name in T.CRRT_COLUMNS:
        if name in T.CRRT_TEXT:
            specs[name] = ItemSpec([T.CRRT_TEXT[name]], value="value")
        else:
            specs[name] = ItemSpec([T.CRRT_NUMERIC[name]])
    specs["system_active"] = F.max(text_flag(item, si, val, T.CRRT_ACTIVE, T.CRRT_INACTIVE))
    specs["clots"] = F.max(text_flag(item, si, val, T.CRRT_CLOTS, T.CRRT_NO_CLOTS))
    specs["clots_increasing"] = F.max(text_flag(item, si, val, T.CRRT_CLOTS_INCREASING))
    specs["clotted"] = F.max(text_flag(item, si, val, T.CRRT_CLOTTED))
    return pivot_items(chartevents, ["stay_id", "charttime"], specs, prefilter=val.isNotNull(),
                       extra_ids=[si])


@concept(group="treatment")
def rrt(chartevents: DataFrame, inputevents: DataFrame, procedureevents: DataFrame) -> DataFrame:
    """Dialysis present / active / type per (stay, time): charted rows plus
    interval starts; an interval containing a point overrides its values (P37).
    Several rows per (stay, time) can remain (Q17)."""
    item, val = F.col("itemid"), F.col("value")
    present_items = T.RRT_PRESENT_ONLY + T.RRT_PRESENT_NUMERIC + T.RRT_PRESENT_TEXT
    ce = chartevents.where(item.isin(present_items) & val.isNotNull()).select(
        "stay_id", "charttime",
        F.lit(1).alias("dialysis_present"),
        F.when((item == T.RRT_PD_CATHETER_STATUS) & (val == T.RRT_PD_IN_USE), 1)
        .when(item.isin(T.RRT_ACTIVE_NUMERIC), 1).otherwise(0).alias("dialysis_active"),
        F.when(item == T.RRT_CRRT_MODE, val).when(item.isin(T.RRT_PERITONEAL), F.lit("Peritoneal"))
        .when(item == T.RRT_IHD_OUTPUT, F.lit("IHD")).alias("dialysis_type"))
    inp = inputevents.where(F.col("itemid").isin(T.RRT_INPUT_ITEMS) & (F.col("amount") > 0)).select(
        "stay_id", "starttime", "endtime", F.lit(1).alias("dialysis_present"),
        F.lit(1).alias("dialysis_active"), F.lit("CRRT").alias("dialysis_type"))
    ptype = None
    for i, label in T.RRT_PROCEDURES.items():
        if label is None:
            continue
        ptype = F.when(item == i, F.lit(label)) if ptype is None else ptype.when(item == i, F.lit(label))
    proc = procedureevents.where(item.isin(list(T.RRT_PROCEDURES)) & F.col("value").isNotNull()).select(
        "stay_id", "starttime", "endtime", F.lit(1).alias("dialysis_present"),
        F.when(~item.isin(T.RRT_PROCEDURES_NOT_ACTIVE), 1).otherwise(0).alias("dialysis_active"),
        ptype.alias("dialysis_type"))
    ranges = inp.unionByName(proc).distinct()
    points = ce.where(F.col("dialysis_present") == 1)
    return override_by_interval(points, ranges, "stay_id", "charttime",
                                ["dialysis_present", "dialysis_active", "dialysis_type"])


@concept(group="treatment")
def code_status(chartevents: DataFrame, poe: DataFrame, poe_detail: DataFrame,
                icustays: DataFrame) -> DataFrame:
    """Charted code status flags plus provider orders (cmo = 0 for orders)."""
    v = F.col("value")

    def flag(values):
        return F.when(v.isin(values), 1).otherwise(0)

    charted = chartevents.where(F.col("itemid") == T.CODE_STATUS_ITEM).select(
        "subject_id", "hadm_id", "stay_id", "charttime",
        flag(T.CHART_FULLCODE).alias("fullcode"), flag(T.CHART_CMO).alias("cmo"),
        flag(T.CHART_DNI).alias("dni"), flag(T.CHART_DNR).alias("dnr"))
    orders = poe.where((F.col("order_type") == T.POE_ORDER_TYPE) & (F.col("order_subtype") == T.POE_ORDER_SUBTYPE))
    od = orders.join(poe_detail.select("poe_id", "field_value"), "poe_id", "inner")
    od = contains_join(od, icustays.select("hadm_id", "stay_id", F.col("intime").alias("starttime"),
                                           F.col("outtime").alias("endtime")),
                       "hadm_id", "ordertime", closed="both", how="left", short=True)
    fv = F.col("p.field_value")

    def pflag(values):
        return F.when(fv.isin(values), 1).otherwise(0)

    ordered = od.select(F.col("p.subject_id").alias("subject_id"), F.col("p.hadm_id").alias("hadm_id"),
                        F.col("i.stay_id").alias("stay_id"), F.col("p.ordertime").alias("charttime"),
                        pflag(T.POE_FULLCODE).alias("fullcode"), F.lit(0).alias("cmo"),
                        pflag(T.POE_DNI).alias("dni"), pflag(T.POE_DNR).alias("dnr"))
    return charted.unionByName(ordered)


@concept(group="treatment")
def invasive_line(procedureevents: DataFrame, d_items: DataFrame) -> DataFrame:
    """Invasive lines with merged type / site synonyms, ordered output.

    ``d_items`` is a dictionary (one row per item), joined by size-based
    broadcast rather than a hint.
    """
    mv = procedureevents.where(F.col("itemid").isin(T.LINE_ITEMS)).join(
        d_items.select("itemid", F.col("label").alias("line_type")), "itemid", "inner")
    return mv.select(
        "stay_id", map_labels(F.col("line_type"), T.LINE_TYPE_SYNONYMS).alias("line_type"),
        map_labels(F.col("location"), T.LINE_SITE_SYNONYMS).alias("line_site"),
        "starttime", "endtime",
    ).orderBy("stay_id", "starttime", "line_type", "line_site")
