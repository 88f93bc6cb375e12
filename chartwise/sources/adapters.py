"""EHR-shaped base tables derived from the supplied ``events`` table.

Every table is a narrow, shuffle-free transformation of ``events`` (or of its
distinct users), so its size grows linearly with the input:

* per event, the array literal of its item specs is exploded (a Generate
  node, no join) -> chartevents / labevents / outputevents
* per event, one element of a spec array is picked -> inputevents,
  procedureevents, prescriptions, microbiologyevents, poe
* per user -> patients, admissions, icustays, services, diagnoses_icd

The formulas are documented in :mod:`chartwise.sources.fixture_spec` and are
mirrored in DuckDB SQL by ``oracle.adapters``; ``tests/test_adapters.py``
checks both produce identical rows.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixture_spec as S


def _ts(literal: str) -> Column:
    return F.lit(literal).cast("timestamp_ntz")


def _plus_minutes(ts: Column, minutes: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"))


def _plus_hours(ts: Column, hours: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), hours.cast("int"))


def _str_array(values) -> Column:
    if not values:
        return F.array().cast("array<string>")
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _pick(values, idx: Column) -> Column:
    """values[idx] for a Python list literal (0-based idx)."""
    return F.element_at(_str_array(values), (idx + 1).cast("int"))


def events_base(events: DataFrame) -> DataFrame:
    """events -> (event_id, user_id, event_type, k, t, stay_id, hadm_id)."""
    epoch_us = F.unix_micros(_ts(S.EVENT_EPOCH).cast("timestamp_ltz"))
    k = F.floor((F.unix_micros(F.col("ts").cast("timestamp_ltz")) - epoch_us)
                / F.lit(float(S.MINUTE_BUCKET_US))).cast("long")
    uid = F.col("user_id")
    i1 = (uid % 12) * 60
    stay = (
        F.when((F.col("k") >= i1) & (F.col("k") <= i1 + S.STAY1_LEN_MIN), uid * 10 + 1)
        .when((uid % 7 == 0) & (F.col("k") >= i1 + S.STAY2_OFFSET_MIN)
              & (F.col("k") <= i1 + S.STAY2_OFFSET_MIN + S.STAY2_LEN_MIN), uid * 10 + 2)
    )
    return (
        events.select("event_id", "user_id", "event_type", k.alias("k"))
        .withColumn("t", _plus_minutes(_ts(S.BASE_TS), F.col("k")))
        .withColumn("stay_id", stay.cast("long"))
        .withColumn("hadm_id", (uid + 100000).cast("long"))
    )


_ITEM_TYPE = "array<struct<itemid:int,kind:string,lo:double,span:double,choices:array<string>>>"


def _kept_items(items, e: Column, modulus: int) -> Column:
    """The items with ``(e + itemid) % modulus = 0``: one array for each remainder of ``e``, all in ONE constant (a JSON literal
    parsed by ``from_json``, which constant folding turns into an array literal), so that no item is tested for
    an event and the unfolding stays in generated code."""
    doc = [[{"itemid": i, "kind": kind, "lo": float(lo), "span": float(span), "choices": list(ch or [])}
            for (i, kind, lo, span, ch) in items if (r + i) % modulus == 0] for r in range(modulus)]
    return F.element_at(F.from_json(F.lit(json.dumps(doc)), f"array<{_ITEM_TYPE}>"), (F.pmod(e, F.lit(modulus)) + 1).cast("int"))


def _eav(ev: DataFrame, items, modulus: int) -> DataFrame:
    """Explode the items kept for each event and derive value / valuenum."""
    e = F.col("event_id")
    x = ev.select("*", F.explode(_kept_items(items, e, modulus)).alias("it"))
    itemid = F.col("it.itemid")
    kind = F.col("it.kind")
    h = (e * 37 + itemid * 11) % 1000
    as_int = F.col("it.lo") + (h % (F.col("it.span").cast("long") + 1)).cast("double")
    as_num = F.col("it.lo") + (h.cast("double") / F.lit(1000.0)) * F.col("it.span")
    valuenum = (
        F.when(e % 53 == 7, F.lit(None).cast("double"))
        .when(kind == S.N, as_num)
        .when(kind.isin(S.I, S.TI), as_int)
    )
    choice_idx = ((e * 7919 + itemid * 13) % 1009) % F.greatest(F.size(F.col("it.choices")), F.lit(1))
    value = (
        F.when(kind.isin(S.T, S.TI), F.element_at(F.col("it.choices"), (choice_idx + 1).cast("int")))
        .when(kind == S.I, as_int.cast("long").cast("string"))
        .otherwise(h.cast("string"))
    )
    return x.select(
        "event_id", "user_id", "stay_id", "hadm_id", "t",
        itemid.alias("itemid"), value.alias("value"), valuenum.alias("valuenum"),
    )


def chartevents(ev: DataFrame) -> DataFrame:
    x = _eav(ev, S.CHART_ITEMS, 3)
    return x.select(
        F.col("user_id").alias("subject_id"), "hadm_id", "stay_id",
        F.col("t").alias("charttime"),
        _plus_minutes(F.col("t"), F.col("event_id") % 90).alias("storetime"),
        "itemid", "value", "valuenum", F.lit(None).cast("string").alias("valueuom"),
    )


def labevents(ev: DataFrame) -> DataFrame:
    x = _eav(ev, S.LAB_ITEMS, 3)
    return x.select(
        F.col("user_id").alias("subject_id"), "hadm_id",
        F.col("event_id").alias("specimen_id"), "itemid",
        F.col("t").alias("charttime"),
        _plus_minutes(F.col("t"), F.col("event_id") % 90).alias("storetime"),
        "value", "valuenum",
    )


def outputevents(ev: DataFrame) -> DataFrame:
    e = F.col("event_id")
    items = F.array(*[F.lit(i).cast("int") for i in S.URINE_ITEMS])
    kept = F.filter(items, lambda i: (e + i) % 4 == 0)
    return (
        ev.where(F.col("stay_id").isNotNull())
        .select("event_id", "stay_id", "t", F.explode(kept).alias("itemid"))
        .select("stay_id", F.col("t").alias("charttime"), "itemid",
                (F.lit(20.0) + (e % 400).cast("double")).alias("value"))
    )


def _spread(e: Column, n: int, salt: int = 0) -> Column:
    return ((e * 7919 + salt) % 1009) % n


def inputevents(ev: DataFrame) -> DataFrame:
    e = F.col("event_id")
    specs = F.array(*[
        F.struct(F.lit(i).cast("int").alias("itemid"), F.lit(float(scale)).alias("scale"),
                 F.lit(u).alias("unit"), F.lit(r).alias("rare"))
        for (i, scale, u, r) in S.INPUT_ITEMS
    ])
    spec = F.element_at(specs, (_spread(e, len(S.INPUT_ITEMS)) + 1).cast("int"))
    x = ev.where(F.col("event_type").isin("click", "view") & F.col("stay_id").isNotNull())
    return x.select(
        "stay_id", e.alias("orderid"), (e - e % 3).alias("linkorderid"),
        spec["itemid"].alias("itemid"),
        F.when(e % 17 == 0, F.lit(None).cast("double"))
        .otherwise(((e % 40).cast("double") / F.lit(100.0)) * spec["scale"]).alias("rate"),
        F.when(e % 50 == 0, spec["rare"]).otherwise(spec["unit"]).alias("rateuom"),
        ((e % 70).cast("double") / F.lit(10.0)).alias("amount"),
        F.when(e % 97 == 0, F.lit(1.0)).otherwise(F.lit(50.0) + (e % 60).cast("double"))
        .alias("patientweight"),
        F.col("t").alias("starttime"),
        _plus_minutes(F.col("t"), F.lit(30) + e % 300).alias("endtime"),
    )


def procedureevents(ev: DataFrame) -> DataFrame:
    e = F.col("event_id")
    items = F.array(*[F.lit(i).cast("int") for i in S.PROC_ITEMS])
    x = ev.where((F.col("event_type") == "purchase") & F.col("stay_id").isNotNull())
    return x.select(
        "stay_id",
        F.element_at(items, (_spread(e, len(S.PROC_ITEMS)) + 1).cast("int")).alias("itemid"),
        _pick(S.PROC_LOCATIONS, e % len(S.PROC_LOCATIONS)).alias("location"),
        F.when(e % 19 == 0, F.lit(None).cast("double"))
        .otherwise((F.lit(1) + e % 100).cast("double")).alias("value"),
        F.col("t").alias("starttime"),
        _plus_minutes(F.col("t"), F.lit(60) + e % 2000).alias("endtime"),
    )


def d_items(spark) -> DataFrame:
    return spark.createDataFrame(S.D_ITEMS, "itemid int, label string")


def prescriptions(ev: DataFrame) -> DataFrame:
    e = F.col("event_id")
    x = ev.where(F.col("event_type").isin("purchase", "signup"))
    return x.select(
        F.col("user_id").alias("subject_id"), "hadm_id",
        _pick(S.DRUGS, _spread(e, len(S.DRUGS), 1)).alias("drug"),
        _pick(S.DRUG_TYPES, e % len(S.DRUG_TYPES)).alias("drug_type"),
        _pick(S.ROUTES, ((e * 104729 + 7) % 1013) % len(S.ROUTES)).alias("route"),
        F.col("t").alias("starttime"),
        _plus_hours(F.col("t"), e % 96).alias("stoptime"),
    )


def microbiologyevents(ev: DataFrame) -> DataFrame:
    e = F.col("event_id")
    org_ids = F.array(*[F.lit(o[0]).cast("int") for o in S.ORGANISMS])
    org_idx = (_spread(e, len(S.ORGANISMS), 3) + 1).cast("int")
    day_start = _plus_minutes(_ts(S.BASE_TS), (F.col("k") - F.col("k") % 1440))
    x = ev.where(F.col("event_type") == "error")
    return x.select(
        e.alias("micro_specimen_id"), F.col("user_id").alias("subject_id"), "hadm_id",
        day_start.alias("chartdate"),
        F.when(e % 5 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("t")).alias("charttime"),
        _pick(S.SPEC_TYPES, ((e - e % 5) / 5).cast("long") % len(S.SPEC_TYPES)).alias("spec_type_desc"),
        F.element_at(org_ids, org_idx).alias("org_itemid"),
        F.element_at(_str_array([o[1] for o in S.ORGANISMS]), org_idx).alias("org_name"),
    )


def poe(ev: DataFrame) -> DataFrame:
    e = F.col("event_id")
    x = ev.where(F.col("event_type") == "signup")
    return x.select(
        F.concat(F.lit("P"), e.cast("string")).alias("poe_id"),
        F.col("user_id").alias("subject_id"), "hadm_id", F.col("t").alias("ordertime"),
        F.when(e % 2 == 0, F.lit("General Care")).otherwise(F.lit("Medications")).alias("order_type"),
        F.when(e % 3 == 0, F.lit("Code status")).otherwise(F.lit("Other")).alias("order_subtype"),
    )


def poe_detail(ev: DataFrame) -> DataFrame:
    e = F.col("event_id")
    x = ev.where(F.col("event_type") == "signup")
    return x.select(
        F.concat(F.lit("P"), e.cast("string")).alias("poe_id"),
        F.lit("Code status").alias("field_name"),
        _pick(S.POE_FIELD_VALUES, ((e - e % 6) / 6).cast("long") % len(S.POE_FIELD_VALUES))
        .alias("field_value"),
    )


def users(events: DataFrame) -> DataFrame:
    return events.select("user_id").where(F.col("user_id").isNotNull()).distinct()


def patients(u: DataFrame) -> DataFrame:
    uid = F.col("user_id")
    return u.select(
        uid.alias("subject_id"),
        F.when(uid % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        (F.lit(18) + uid % 75).cast("int").alias("anchor_age"),
        (F.lit(2150) - uid % 3).cast("int").alias("anchor_year"),
        F.when(uid % 11 == 0, F.lit("2150-01-04").cast("date")).alias("dod"),
    )


def admissions(u: DataFrame) -> DataFrame:
    uid = F.col("user_id")
    base = _ts(S.BASE_TS)
    first = u.select(
        uid.alias("subject_id"), (uid + 100000).cast("long").alias("hadm_id"),
        (base - F.make_dt_interval(F.lit(0), (uid % 30).cast("int"))).alias("admittime"),
        _plus_hours(base, F.lit(70)).alias("dischtime"),
        F.when(uid % 11 == 0, _plus_hours(base, F.lit(70))).alias("deathtime"),
        F.when(uid % 4 == 0, F.lit("ELECTIVE"))
        .otherwise(_pick(S.ADMISSION_TYPES[1:], uid % (len(S.ADMISSION_TYPES) - 1)))
        .alias("admission_type"),
        _pick(S.DISCHARGE_LOCATIONS, uid % len(S.DISCHARGE_LOCATIONS)).alias("discharge_location"),
        _pick(S.RACES, uid % len(S.RACES)).alias("race"),
        F.when(uid % 11 == 0, 1).otherwise(0).cast("int").alias("hospital_expire_flag"),
    )
    # a later admission without an ICU stay for every fifth patient
    second = u.where(uid % 5 == 0).select(
        uid.alias("subject_id"), (uid + 200000).cast("long").alias("hadm_id"),
        _plus_hours(base, F.lit(100)).alias("admittime"),
        _plus_hours(base, F.lit(120)).alias("dischtime"),
        F.lit(None).cast("timestamp_ntz").alias("deathtime"),
        F.lit("EW EMER.").alias("admission_type"),
        F.lit("HOME").alias("discharge_location"),
        _pick(S.RACES, uid % len(S.RACES)).alias("race"),
        F.lit(0).cast("int").alias("hospital_expire_flag"),
    )
    return first.unionByName(second)


def icustays(u: DataFrame) -> DataFrame:
    uid = F.col("user_id")
    intime1 = _plus_hours(_ts(S.BASE_TS), uid % 12)
    first = u.select(
        uid.alias("subject_id"), (uid + 100000).cast("long").alias("hadm_id"),
        (uid * 10 + 1).cast("long").alias("stay_id"),
        intime1.alias("intime"), _plus_minutes(intime1, F.lit(S.STAY1_LEN_MIN)).alias("outtime"),
    )
    intime2 = _plus_minutes(intime1, F.lit(S.STAY2_OFFSET_MIN))
    second = u.where(uid % 7 == 0).select(
        uid.alias("subject_id"), (uid + 100000).cast("long").alias("hadm_id"),
        (uid * 10 + 2).cast("long").alias("stay_id"),
        intime2.alias("intime"), _plus_minutes(intime2, F.lit(S.STAY2_LEN_MIN)).alias("outtime"),
    )
    return first.unionByName(second)


def services(u: DataFrame) -> DataFrame:
    uid = F.col("user_id")
    admit = _ts(S.BASE_TS) - F.make_dt_interval(F.lit(0), (uid % 30).cast("int"))
    n = len(S.SERVICES)
    first = u.select((uid + 100000).cast("long").alias("hadm_id"),
                     _pick(S.SERVICES, uid % n).alias("curr_service"),
                     admit.alias("transfertime"))
    second = u.where(uid % 3 == 0).select(
        (uid + 100000).cast("long").alias("hadm_id"),
        _pick(S.SERVICES, (uid + 4) % n).alias("curr_service"),
        _plus_hours(admit, F.lit(10)).alias("transfertime"))
    return first.unionByName(second)


def diagnoses_icd(u: DataFrame) -> DataFrame:
    uid = F.col("user_id")
    n = len(S.DIAGNOSES)
    codes = _str_array([c for c, _ in S.DIAGNOSES])
    versions = F.array(*[F.lit(v).cast("int") for _, v in S.DIAGNOSES])
    x = u.select("user_id", F.explode(F.sequence(F.lit(0), F.lit(S.DIAGNOSES_PER_ADMISSION - 1)))
                 .alias("seq_num"))
    idx = ((uid * 7 + F.col("seq_num") * 13) % n + 1).cast("int")
    return x.select(
        uid.alias("subject_id"), (uid + 100000).cast("long").alias("hadm_id"),
        (F.col("seq_num") + 1).cast("int").alias("seq_num"),
        F.element_at(codes, idx).alias("icd_code"), F.element_at(versions, idx).alias("icd_version"),
    )
