"""DuckDB CTE prefix that derives the EHR-shaped base tables from ``events``.

Mirror of :mod:`chartwise.sources.adapters` (same constants from
:mod:`chartwise.sources.fixture_spec`, same expression order so doubles are
bit-identical).  ``tests/test_adapters.py`` compares the two.
"""

from __future__ import annotations

from chartwise.sources import fixture_spec as S


def q(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def str_list(values) -> str:
    if not values:
        return "([]::VARCHAR[])"
    return "([" + ", ".join(q(v) for v in values) + "]::VARCHAR[])"


def int_list(values) -> str:
    return "([" + ", ".join("NULL" if v is None else str(int(v)) for v in values) + "]::INTEGER[])"


def _items(items) -> str:
    rows = [
        "{'itemid': %d, 'kind': %s, 'lo': CAST(%r AS DOUBLE), 'span': CAST(%r AS DOUBLE), "
        "'choices': %s}" % (i, q(kind), float(lo), float(span), str_list(ch))
        for (i, kind, lo, span, ch) in items
    ]
    return "[" + ",\n    ".join(rows) + "]"


BASE = f"TIMESTAMP '{S.BASE_TS}'"


def _eav(items, modulus: int) -> str:
    return f"""
    SELECT event_id, user_id, stay_id, hadm_id, t, it.itemid AS itemid,
      CASE WHEN it.kind IN ('t', 'ti')
             THEN it.choices[((event_id * 7919 + it.itemid * 13) % 1009) % greatest(len(it.choices), 1) + 1]
           WHEN it.kind = 'i'
             THEN CAST(CAST(it.lo + CAST((event_id * 37 + it.itemid * 11) % 1000 % (CAST(it.span AS BIGINT) + 1) AS DOUBLE) AS BIGINT) AS VARCHAR)
           ELSE CAST((event_id * 37 + it.itemid * 11) % 1000 AS VARCHAR) END AS value,
      CASE WHEN event_id % 53 = 7 THEN CAST(NULL AS DOUBLE)
           WHEN it.kind = 'n'
             THEN it.lo + (CAST((event_id * 37 + it.itemid * 11) % 1000 AS DOUBLE) / CAST(1000.0 AS DOUBLE)) * it.span
           WHEN it.kind IN ('i', 'ti')
             THEN it.lo + CAST((event_id * 37 + it.itemid * 11) % 1000 % (CAST(it.span AS BIGINT) + 1) AS DOUBLE)
      END AS valuenum
    FROM (SELECT ev.*, unnest({_items(items)}) AS it FROM ev)
    WHERE (event_id + it.itemid) % {modulus} = 0"""


def _spread(n: int, salt: int = 0) -> str:
    return f"(((event_id * 7919 + {salt}) % 1009) % {n})"


def ctes() -> dict[str, str]:
    n_in = len(S.INPUT_ITEMS)
    in_specs = "[" + ", ".join(
        "{'itemid': %d, 'scale': CAST(%r AS DOUBLE), 'unit': %s, 'rare': %s}" % (i, float(sc), q(u), q(r))
        for (i, sc, u, r) in S.INPUT_ITEMS) + "]"
    i1 = "((user_id % 12) * 60)"
    d = {}
    d["ev"] = f"""
    SELECT event_id, user_id, event_type, k,
      {BASE} + to_minutes(CAST(k AS BIGINT)) AS t,
      CAST(CASE WHEN k >= {i1} AND k <= {i1} + {S.STAY1_LEN_MIN} THEN user_id * 10 + 1
           WHEN user_id % 7 = 0 AND k >= {i1} + {S.STAY2_OFFSET_MIN}
                AND k <= {i1} + {S.STAY2_OFFSET_MIN + S.STAY2_LEN_MIN} THEN user_id * 10 + 2
      END AS BIGINT) AS stay_id,
      CAST(user_id + 100000 AS BIGINT) AS hadm_id
    FROM (SELECT event_id, user_id, event_type,
            CAST(floor(CAST(epoch_us(ts) - epoch_us(TIMESTAMP '{S.EVENT_EPOCH}') AS DOUBLE)
                       / CAST({S.MINUTE_BUCKET_US} AS DOUBLE)) AS BIGINT) AS k
          FROM events)"""
    d["users"] = "SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL"
    d["chartevents"] = f"""
    SELECT user_id AS subject_id, hadm_id, stay_id, t AS charttime,
      t + to_minutes(CAST(event_id % 90 AS BIGINT)) AS storetime,
      itemid, value, valuenum, CAST(NULL AS VARCHAR) AS valueuom
    FROM ({_eav(S.CHART_ITEMS, 3)})"""
    d["labevents"] = f"""
    SELECT user_id AS subject_id, hadm_id, event_id AS specimen_id, itemid, t AS charttime,
      t + to_minutes(CAST(event_id % 90 AS BIGINT)) AS storetime, value, valuenum
    FROM ({_eav(S.LAB_ITEMS, 3)})"""
    d["outputevents"] = f"""
    SELECT stay_id, t AS charttime, itemid, CAST(20.0 AS DOUBLE) + CAST(event_id % 400 AS DOUBLE) AS value
    FROM (SELECT event_id, stay_id, t, unnest({int_list(S.URINE_ITEMS)}) AS itemid
          FROM ev WHERE stay_id IS NOT NULL)
    WHERE (event_id + itemid) % 4 = 0"""
    d["inputevents"] = f"""
    SELECT stay_id, event_id AS orderid, event_id - event_id % 3 AS linkorderid,
      spec.itemid AS itemid,
      CASE WHEN event_id % 17 = 0 THEN CAST(NULL AS DOUBLE)
           ELSE (CAST(event_id % 40 AS DOUBLE) / CAST(100.0 AS DOUBLE)) * spec.scale END AS rate,
      CASE WHEN event_id % 50 = 0 THEN spec.rare ELSE spec.unit END AS rateuom,
      CAST(event_id % 70 AS DOUBLE) / CAST(10.0 AS DOUBLE) AS amount,
      CASE WHEN event_id % 97 = 0 THEN CAST(1.0 AS DOUBLE)
           ELSE CAST(50.0 AS DOUBLE) + CAST(event_id % 60 AS DOUBLE) END AS patientweight,
      t AS starttime, t + to_minutes(CAST(30 + event_id % 300 AS BIGINT)) AS endtime
    FROM (SELECT ev.*, {in_specs}[{_spread(n_in)} + 1] AS spec FROM ev
          WHERE event_type IN ('click', 'view') AND stay_id IS NOT NULL)"""
    d["procedureevents"] = f"""
    SELECT stay_id, {int_list(S.PROC_ITEMS)}[{_spread(len(S.PROC_ITEMS))} + 1] AS itemid,
      {str_list(S.PROC_LOCATIONS)}[event_id % {len(S.PROC_LOCATIONS)} + 1] AS location,
      CASE WHEN event_id % 19 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(1 + event_id % 100 AS DOUBLE) END AS value,
      t AS starttime, t + to_minutes(CAST(60 + event_id % 2000 AS BIGINT)) AS endtime
    FROM ev WHERE event_type = 'purchase' AND stay_id IS NOT NULL"""
    d["d_items"] = "SELECT * FROM (VALUES " + ", ".join(
        f"({i}, {q(lbl)})" for i, lbl in S.D_ITEMS) + ") AS v(itemid, label)"
    d["prescriptions"] = f"""
    SELECT user_id AS subject_id, hadm_id,
      {str_list(S.DRUGS)}[{_spread(len(S.DRUGS), 1)} + 1] AS drug,
      {str_list(S.DRUG_TYPES)}[event_id % {len(S.DRUG_TYPES)} + 1] AS drug_type,
      {str_list(S.ROUTES)}[((event_id * 104729 + 7) % 1013) % {len(S.ROUTES)} + 1] AS route,
      t AS starttime, t + to_hours(CAST(event_id % 96 AS BIGINT)) AS stoptime
    FROM ev WHERE event_type IN ('purchase', 'signup')"""
    org_ids = int_list([o[0] for o in S.ORGANISMS])
    org_names = str_list([o[1] for o in S.ORGANISMS])
    d["microbiologyevents"] = f"""
    SELECT event_id AS micro_specimen_id, user_id AS subject_id, hadm_id,
      {BASE} + to_minutes(CAST(k - k % 1440 AS BIGINT)) AS chartdate,
      CASE WHEN event_id % 5 = 0 THEN CAST(NULL AS TIMESTAMP) ELSE t END AS charttime,
      {str_list(S.SPEC_TYPES)}[((event_id - event_id % 5) // 5) % {len(S.SPEC_TYPES)} + 1] AS spec_type_desc,
      {org_ids}[{_spread(len(S.ORGANISMS), 3)} + 1] AS org_itemid,
      {org_names}[{_spread(len(S.ORGANISMS), 3)} + 1] AS org_name
    FROM ev WHERE event_type = 'error'"""
    d["poe"] = """
    SELECT 'P' || CAST(event_id AS VARCHAR) AS poe_id, user_id AS subject_id, hadm_id, t AS ordertime,
      CASE WHEN event_id % 2 = 0 THEN 'General Care' ELSE 'Medications' END AS order_type,
      CASE WHEN event_id % 3 = 0 THEN 'Code status' ELSE 'Other' END AS order_subtype
    FROM ev WHERE event_type = 'signup'"""
    d["poe_detail"] = f"""
    SELECT 'P' || CAST(event_id AS VARCHAR) AS poe_id, 'Code status' AS field_name,
      {str_list(S.POE_FIELD_VALUES)}[((event_id - event_id % 6) // 6) % {len(S.POE_FIELD_VALUES)} + 1] AS field_value
    FROM ev WHERE event_type = 'signup'"""
    d["patients"] = """
    SELECT user_id AS subject_id, CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
      CAST(18 + user_id % 75 AS INTEGER) AS anchor_age, CAST(2150 - user_id % 3 AS INTEGER) AS anchor_year,
      CASE WHEN user_id % 11 = 0 THEN DATE '2150-01-04' END AS dod
    FROM users"""
    n_at = len(S.ADMISSION_TYPES) - 1
    d["admissions"] = f"""
    SELECT user_id AS subject_id, CAST(user_id + 100000 AS BIGINT) AS hadm_id,
      {BASE} - to_hours(CAST(user_id % 30 AS BIGINT)) AS admittime,
      {BASE} + to_hours(70) AS dischtime,
      CASE WHEN user_id % 11 = 0 THEN {BASE} + to_hours(70) END AS deathtime,
      CASE WHEN user_id % 4 = 0 THEN 'ELECTIVE'
           ELSE {str_list(S.ADMISSION_TYPES[1:])}[user_id % {n_at} + 1] END AS admission_type,
      {str_list(S.DISCHARGE_LOCATIONS)}[user_id % {len(S.DISCHARGE_LOCATIONS)} + 1] AS discharge_location,
      {str_list(S.RACES)}[user_id % {len(S.RACES)} + 1] AS race,
      CAST(CASE WHEN user_id % 11 = 0 THEN 1 ELSE 0 END AS INTEGER) AS hospital_expire_flag
    FROM users
    UNION ALL
    SELECT user_id, CAST(user_id + 200000 AS BIGINT), {BASE} + to_hours(100), {BASE} + to_hours(120),
      CAST(NULL AS TIMESTAMP), 'EW EMER.', 'HOME',
      {str_list(S.RACES)}[user_id % {len(S.RACES)} + 1], CAST(0 AS INTEGER)
    FROM users WHERE user_id % 5 = 0"""
    d["icustays"] = f"""
    SELECT user_id AS subject_id, CAST(user_id + 100000 AS BIGINT) AS hadm_id,
      CAST(user_id * 10 + 1 AS BIGINT) AS stay_id,
      {BASE} + to_hours(CAST(user_id % 12 AS BIGINT)) AS intime,
      {BASE} + to_hours(CAST(user_id % 12 AS BIGINT)) + to_minutes({S.STAY1_LEN_MIN}) AS outtime
    FROM users
    UNION ALL
    SELECT user_id, CAST(user_id + 100000 AS BIGINT), CAST(user_id * 10 + 2 AS BIGINT),
      {BASE} + to_hours(CAST(user_id % 12 AS BIGINT)) + to_minutes({S.STAY2_OFFSET_MIN}),
      {BASE} + to_hours(CAST(user_id % 12 AS BIGINT)) + to_minutes({S.STAY2_OFFSET_MIN})
        + to_minutes({S.STAY2_LEN_MIN})
    FROM users WHERE user_id % 7 = 0"""
    n_sv = len(S.SERVICES)
    d["services"] = f"""
    SELECT CAST(user_id + 100000 AS BIGINT) AS hadm_id,
      {str_list(S.SERVICES)}[user_id % {n_sv} + 1] AS curr_service,
      {BASE} - to_hours(CAST(user_id % 30 AS BIGINT)) AS transfertime
    FROM users
    UNION ALL
    SELECT CAST(user_id + 100000 AS BIGINT), {str_list(S.SERVICES)}[(user_id + 4) % {n_sv} + 1],
      {BASE} - to_hours(CAST(user_id % 30 AS BIGINT)) + to_hours(10)
    FROM users WHERE user_id % 3 = 0"""
    n_dx = len(S.DIAGNOSES)
    d["diagnoses_icd"] = f"""
    SELECT user_id AS subject_id, CAST(user_id + 100000 AS BIGINT) AS hadm_id,
      CAST(seq_num + 1 AS INTEGER) AS seq_num,
      {str_list([c for c, _ in S.DIAGNOSES])}[(user_id * 7 + seq_num * 13) % {n_dx} + 1] AS icd_code,
      {int_list([v for _, v in S.DIAGNOSES])}[(user_id * 7 + seq_num * 13) % {n_dx} + 1] AS icd_version
    FROM (SELECT user_id, unnest(range(0, {S.DIAGNOSES_PER_ADMISSION})) AS seq_num FROM users)"""
    return d


def prefix() -> str:
    """``WITH`` clause defining every adapter table (DuckDB skips unused CTEs)."""
    parts = [f"{name} AS ({body}\n)" for name, body in ctes().items()]
    return "WITH " + ",\n".join(parts)
