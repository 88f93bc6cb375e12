"""Oracle SQL for the operator queries on the supplied tables.

Written as the literal SQL constructs (range / self / OR joins, correlated
sub-queries) that the Spark operators replace, so each query checks one
rewrite.
"""

from __future__ import annotations

from chartwise.plans import native as N

from . import compose

E = "(SELECT event_id, user_id, event_type, value, props, date_trunc('minute', ts) AS t FROM events)"

SQL: dict[str, str] = {}

SQL["daily_event_pivot"] = f"""
SELECT user_id, date_trunc('day', t) AS day,
  max(value) FILTER (WHERE event_type = 'click' AND value > 0 AND value < 300) AS click_max,
  avg(value) FILTER (WHERE event_type = 'view' AND value <= 200) AS view_avg,
  sum(value * 100.0) FILTER (WHERE event_type = 'purchase') AS purchase_cents,
  min(value) FILTER (WHERE event_type = 'signup') AS signup_min,
  max(value) FILTER (WHERE event_type = 'error' AND value > 10 AND value <= 300) AS error_max
FROM {E} e
WHERE event_type IN ('click', 'view', 'purchase', 'signup', 'error')
GROUP BY user_id, date_trunc('day', t)"""

SQL["first_signup_window"] = f"""
WITH e AS {E},
a AS (SELECT user_id, min(t) AS anchor_time FROM e WHERE event_type = 'signup' GROUP BY user_id)
SELECT a.user_id, a.anchor_time, min(e.value) AS value_min, max(e.value) AS value_max, avg(e.value) AS value_avg,
  sum(e.value) AS value_sum
FROM a LEFT JOIN e ON e.user_id = a.user_id AND e.t BETWEEN a.anchor_time - INTERVAL 6 HOUR
  AND a.anchor_time + INTERVAL 1 DAY
GROUP BY a.user_id, a.anchor_time"""

SQL["order_window_events"] = f"""
WITH e AS {E},
iv AS (
  SELECT o_orderkey, o_custkey AS user_id, TIMESTAMP '2024-01-01' + to_days(CAST(o_orderkey % 30 AS INTEGER)) AS s
  FROM orders),
iv2 AS (SELECT o_orderkey, user_id, s, s + INTERVAL 1 DAY + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS en FROM iv)
SELECT iv2.o_orderkey, e.event_id, e.user_id, e.t,
  e.t >= s AND e.t < en AS in_left_closed, e.t > s AND e.t <= en AS in_right_closed,
  e.t > s AND e.t < en AS in_open
FROM iv2 JOIN e ON e.user_id = iv2.user_id AND e.t >= s AND e.t <= en"""

SQL["asof_view_before_purchase"] = f"""
WITH e AS {E},
p AS (SELECT user_id, event_id, t FROM e WHERE event_type = 'purchase'),
v AS (SELECT user_id, t AS view_time, event_id AS view_id, value AS view_value FROM e WHERE event_type = 'view')
SELECT user_id, event_id, t, view_id, view_value FROM (
  SELECT p.*, v.view_id, v.view_value,
    row_number() OVER (PARTITION BY p.event_id ORDER BY v.view_time DESC NULLS LAST, v.view_id DESC NULLS LAST) AS rk
  FROM p LEFT JOIN v ON v.user_id = p.user_id AND v.view_time <= p.t AND v.view_time >= p.t - INTERVAL 2 HOUR)
WHERE rk = 1"""

SQL["purchase_error_match"] = f"""
WITH e AS {E},
p AS (SELECT user_id, event_id, t, date_trunc('day', t) AS day FROM e WHERE event_type = 'purchase'),
er AS (SELECT user_id, event_id AS error_id, t AS error_time, CAST(round(value * 100) AS BIGINT) % 2 = 0 AS date_only
       FROM e WHERE event_type = 'error'),
cand AS (
  SELECT p.event_id, er.error_id,
    CASE WHEN er.date_only THEN date_trunc('day', er.error_time) ELSE er.error_time END AS match_time
  FROM p JOIN er ON er.user_id = p.user_id AND (
    (NOT er.date_only AND er.error_time >= p.t - INTERVAL 72 HOUR AND er.error_time < p.t)
    OR (er.date_only AND date_trunc('day', er.error_time) >= p.day - INTERVAL 3 DAY
        AND date_trunc('day', er.error_time) <= p.day))),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY match_time, error_id) AS rk FROM cand)
  WHERE rk = 1)
SELECT p.event_id, p.user_id, p.t, best.error_id, best.match_time
FROM p LEFT JOIN best ON best.event_id = p.event_id"""

_EPISODES = f"""
WITH e AS {E},
s AS (SELECT user_id, t, max(event_type) AS state FROM e GROUP BY user_id, t),
l AS (
  SELECT user_id, t, state,
    lag(t) OVER (PARTITION BY user_id, state ORDER BY t) AS t_lag,
    lead(t) OVER (PARTITION BY user_id ORDER BY t) AS t_lead,
    lag(state) OVER (PARTITION BY user_id ORDER BY t) AS s_lag
  FROM s),
f AS (
  SELECT *, sum(CASE WHEN s_lag IS NULL THEN 1 WHEN date_diff('hour', t_lag, t) >= 14 THEN 1
                     WHEN s_lag <> state THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t) AS seq
  FROM l),
ep AS (
  SELECT user_id, min(t) AS starttime,
    max(CASE WHEN t_lead IS NULL OR date_diff('hour', t, t_lead) >= 14 THEN t ELSE t_lead END) AS endtime,
    max(state) AS state
  FROM f GROUP BY user_id, seq HAVING min(t) <> max(t))"""

SQL["event_type_episodes"] = _EPISODES + "\nSELECT * FROM ep"

SQL["episode_first_day_flag"] = _EPISODES + """,
fd AS (SELECT user_id, min(t) AS first_time FROM e GROUP BY user_id)
SELECT fd.user_id, max(CASE WHEN ep.user_id IS NOT NULL THEN 1 ELSE 0 END) AS touches_first_day
FROM fd LEFT JOIN ep ON ep.user_id = fd.user_id AND (
  (ep.starttime >= fd.first_time AND ep.starttime <= fd.first_time + INTERVAL 1 DAY)
  OR (ep.endtime >= fd.first_time AND ep.endtime <= fd.first_time + INTERVAL 1 DAY)
  OR (ep.starttime <= fd.first_time AND ep.endtime >= fd.first_time + INTERVAL 1 DAY))
GROUP BY fd.user_id"""

SQL["lookback_min_48h"] = f"""
WITH e AS (SELECT user_id, event_id, t, value FROM {E})
SELECT e.*, (SELECT min(b.value) FROM e b WHERE b.user_id = e.user_id AND b.t < e.t
             AND b.t >= e.t - INTERVAL 48 HOUR) AS value_min_48h
FROM e"""

SQL["trailing_sums"] = f"""
WITH e AS (SELECT user_id, event_id, t, value FROM {E})
SELECT e.*, sum(b.value) FILTER (WHERE b.t >= e.t - INTERVAL 6 HOUR) AS value_sum_6h,
  sum(b.value) FILTER (WHERE b.t >= e.t - INTERVAL 12 HOUR) AS value_sum_12h,
  sum(b.value) AS value_sum_24h
FROM e JOIN e b ON b.user_id = e.user_id AND b.t <= e.t AND b.t >= e.t - INTERVAL 24 HOUR
GROUP BY ALL"""

SQL["boundary_hour_sums"] = f"""
WITH e AS (SELECT user_id, event_id, t, value FROM {E})
SELECT e.*, sum(b.value) FILTER (WHERE date_diff('hour', b.t, e.t) <= 5) AS value_6hr,
  sum(b.value) FILTER (WHERE date_diff('hour', b.t, e.t) <= 11) AS value_12hr
FROM e JOIN e b ON b.user_id = e.user_id AND b.t <= e.t AND b.t >= e.t - INTERVAL 12 HOUR
GROUP BY ALL"""

SQL["hourly_spine_minmax"] = f"""
WITH e AS {E},
sp AS (SELECT user_id, min(t) AS t0, max(t) AS t1 FROM e GROUP BY user_id),
h AS (
  SELECT user_id, CAST(hr AS BIGINT) AS hr,
    CASE WHEN date_trunc('hour', t0) = t0 THEN t0 ELSE date_trunc('hour', t0) + INTERVAL 1 HOUR END
      + to_hours(CAST(hr AS BIGINT)) AS endtime
  FROM (SELECT *, unnest(range(-24, date_diff('hour', t0, t1) + 1)) AS hr FROM sp))
SELECT h.user_id, h.endtime, h.hr, min(e.value) AS value_min, max(e.value) AS value_max
FROM h LEFT JOIN e ON e.user_id = h.user_id AND e.t > h.endtime - INTERVAL 1 HOUR AND e.t <= h.endtime
GROUP BY h.user_id, h.endtime, h.hr"""

SQL["carry_previous_value"] = f"""
WITH e AS (SELECT user_id, event_id, t, value,
                  row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS rn FROM {E})
SELECT a.user_id, a.event_id, a.t, a.value, b.value AS prev_value
FROM e a LEFT JOIN e b ON b.user_id = a.user_id AND b.rn + 1 = a.rn AND b.t > a.t - INTERVAL 6 HOUR"""

_TYPES = ["click", "error", "purchase", "signup", "view"]
_IV = f"(SELECT user_id, event_type, t AS starttime, t + to_minutes(CAST(floor(value) AS INTEGER)) AS endtime, value FROM {E})"
SQL["event_type_segments"] = f"""
WITH iv AS {_IV},
tm AS (SELECT user_id, starttime AS b FROM iv UNION SELECT user_id, endtime FROM iv),
seg AS (SELECT user_id, b AS starttime, lead(b) OVER (PARTITION BY user_id ORDER BY b NULLS FIRST) AS endtime FROM tm)
SELECT seg.user_id, seg.starttime, seg.endtime, {', '.join(f'{t}.value AS {t}' for t in _TYPES)}
FROM seg {' '.join(f"LEFT JOIN iv {t} ON {t}.user_id = seg.user_id AND {t}.event_type = '{t}' AND seg.starttime >= {t}.starttime AND seg.endtime <= {t}.endtime" for t in _TYPES)}
WHERE seg.endtime IS NOT NULL"""

SQL["union_event_times"] = f"""
WITH e AS {E},
c AS (SELECT user_id, t, max(value) AS click_value FROM e WHERE event_type = 'click' GROUP BY user_id, t),
v AS (SELECT user_id, t, max(value) AS view_value FROM e WHERE event_type = 'view' GROUP BY user_id, t),
tm AS (SELECT user_id, t FROM c UNION SELECT user_id, t FROM v)
SELECT tm.user_id, tm.t, c.click_value, v.view_value
FROM tm LEFT JOIN c ON c.user_id = tm.user_id AND c.t = tm.t LEFT JOIN v ON v.user_id = tm.user_id AND v.t = tm.t"""

SQL["value_validity"] = f"""
WITH e AS {E},
sp AS (SELECT user_id, min(t) AS t0, max(t) AS t1 FROM e GROUP BY user_id),
o AS (
  SELECT e.user_id, e.t AS starttime, e.value, sp.t0,
    coalesce(lead(e.t) OVER (PARTITION BY e.user_id ORDER BY e.t, e.event_id), sp.t1 + INTERVAL 2 HOUR) AS endtime,
    row_number() OVER (PARTITION BY e.user_id ORDER BY e.t, e.event_id) AS rk
  FROM e JOIN sp ON sp.user_id = e.user_id WHERE e.event_type = 'signup')
SELECT user_id, starttime, endtime, value FROM o
UNION ALL
SELECT user_id, t0, starttime, value FROM o WHERE rk = 1 AND t0 < starttime"""

SQL["lineitem_ladders"] = """
WITH o AS (
  SELECT l_orderkey, min(l_quantity) AS qty_min, max(l_quantity) AS qty_max, max(l_discount) AS disc_max,
    max(l_tax) AS tax_max, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS returned,
    max(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS open_line
  FROM lineitem GROUP BY l_orderkey),
s AS (
  SELECT o.*,
    CASE WHEN qty_min IS NULL THEN NULL WHEN qty_min < 5 THEN 4 WHEN qty_min < 15 THEN 2 WHEN qty_min < 35 THEN 0
         WHEN qty_min < 45 THEN 1 ELSE 3 END AS s_min,
    CASE WHEN qty_max IS NULL THEN NULL WHEN qty_max < 5 THEN 4 WHEN qty_max < 15 THEN 2 WHEN qty_max < 35 THEN 0
         WHEN qty_max < 45 THEN 1 ELSE 3 END AS s_max
  FROM o),
s2 AS (
  SELECT l_orderkey, qty_min, qty_max, disc_max, tax_max, returned, open_line,
    CASE WHEN qty_max IS NULL THEN s_min WHEN qty_min IS NULL THEN s_max
         WHEN abs(qty_max - 25.0) > abs(qty_min - 25.0) THEN s_max
         WHEN abs(qty_max - 25.0) < abs(qty_min - 25.0) THEN s_min ELSE greatest(s_min, s_max) END AS qty_score,
    CASE WHEN disc_max IS NULL OR tax_max IS NULL THEN NULL
         WHEN disc_max < 0.03 THEN CASE WHEN tax_max < 0.04 THEN 0 ELSE 2 END
         WHEN disc_max < 0.07 THEN CASE WHEN tax_max < 0.02 THEN 1 WHEN tax_max < 0.06 THEN 3 ELSE 5 END
         ELSE CASE WHEN tax_max < 0.04 THEN 4 ELSE 6 END END AS disc_tax_score,
    greatest(1 * open_line, 3 * returned) AS status_weight
  FROM s),
s3 AS (SELECT s2.*, coalesce(qty_score, 0) + coalesce(disc_tax_score, 0) + coalesce(status_weight, 0) AS total FROM s2)
SELECT s3.*, 1 / (1 + exp(-(-3.0 + 0.25 * total))) AS prob FROM s3"""


def _syn(col):
    return "CASE " + " ".join(
        "WHEN " + col + " IN (" + ", ".join(f"'{v}'" for v in vs) + f") THEN '{lbl}'"
        for vs, lbl in N.SEGMENT_SYNONYMS) + f" ELSE {col} END"


SQL["order_part_flags"] = f"""
WITH dx AS (
  SELECT l.l_orderkey AS o_orderkey, p.p_brand, p.p_type FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
f AS (
  SELECT o_orderkey, max(CASE WHEN left(p_brand, 7) IN ('Brand#1') THEN 1 ELSE 0 END) AS brand_1x,
    max(CASE WHEN left(p_type, 1) BETWEEN 'A' AND 'M' THEN 1 ELSE 0 END) AS type_a_to_m
  FROM dx GROUP BY o_orderkey)
SELECT o.o_orderkey, {_syn('c.c_mktsegment')} AS segment_group, coalesce(f.brand_1x, 0) AS brand_1x,
  coalesce(f.type_a_to_m, 0) AS type_a_to_m
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN f ON f.o_orderkey = o.o_orderkey"""

SQL["part_name_keywords"] = """
SELECT p.p_name, l.l_partkey, l.l_orderkey, l.l_linenumber, l.l_quantity
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
WHERE """ + " OR ".join(f"contains(lower(p.p_name), '{w}')" for w in N.PART_KEYWORDS)

SQL["props_pattern_window"] = f"""
WITH e AS {E},
fd AS (SELECT user_id, min(t) AS first_time FROM e GROUP BY user_id)
SELECT fd.user_id, min(e.t - INTERVAL 1 HOUR) AS starttime, max(e.t + INTERVAL 4 HOUR) AS endtime
FROM fd JOIN e ON e.user_id = fd.user_id AND e.t >= fd.first_time AND e.t <= fd.first_time + INTERVAL 1 DAY
WHERE contains(e.props, '{N.PROPS_PATTERN}')
GROUP BY fd.user_id"""

SQL["top_event_per_user"] = f"""
SELECT user_id, event_id, event_type, value, t FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC NULLS LAST, t, event_id) AS rk FROM {E})
WHERE rk = 1"""

SQL["first_four_event_types"] = f"""
WITH r AS (SELECT user_id, date_trunc('day', t) AS day, event_type,
                  row_number() OVER (PARTITION BY user_id, date_trunc('day', t) ORDER BY t, event_id) AS rk FROM {E})
SELECT user_id, day, {', '.join(f'max(event_type) FILTER (WHERE rk = {k}) AS type_{k}' for k in range(1, 5))}
FROM r GROUP BY user_id, day"""

SQL["daily_ratio_and_dose"] = f"""
WITH d AS (
  SELECT user_id, date_trunc('day', t) AS day,
    sum(value) FILTER (WHERE event_type = 'purchase') AS purchase_total,
    avg(value) FILTER (WHERE event_type = 'click') AS click_pct,
    max(value) FILTER (WHERE event_type = 'view') AS view_max,
    max(value) FILTER (WHERE event_type = 'click') AS click_max,
    max(value) FILTER (WHERE event_type = 'purchase') AS purchase_max
  FROM {E} GROUP BY user_id, date_trunc('day', t))
SELECT user_id, day,
  CAST(round(CAST(CASE WHEN view_max IS NULL AND purchase_total > 0 THEN click_pct / 5.0 * purchase_total / 100.0
                       ELSE view_max END AS DECIMAL(38, 9)), 4) AS DOUBLE) AS view_imputed,
  CAST(round(CAST(coalesce(click_max, 0) + coalesce(view_max / 10.0, 0) + coalesce(purchase_max * 2.5 / 60.0, 0)
                  AS DECIMAL(38, 9)), 4) AS DOUBLE) AS weighted_dose
FROM d"""

SQL["merge_click_view"] = f"""
WITH e AS {E},
c AS (SELECT user_id, t, max(value) AS value FROM e WHERE event_type = 'click' GROUP BY user_id, t),
v AS (SELECT user_id, t, max(value) AS value FROM e WHERE event_type = 'view' GROUP BY user_id, t)
SELECT coalesce(c.user_id, v.user_id) AS user_id, coalesce(c.t, v.t) AS t, coalesce(c.value, v.value) AS value
FROM c FULL OUTER JOIN v ON v.user_id = c.user_id AND v.t = c.t"""

SQL["interval_override"] = f"""
WITH e AS {E},
pts AS (SELECT user_id, t, value FROM e WHERE event_type = 'error'),
iv AS (SELECT user_id, t AS starttime, t + to_minutes(CAST(floor(value) AS INTEGER)) AS endtime, value
       FROM e WHERE event_type = 'purchase'),
u AS (SELECT user_id, t, value FROM pts UNION SELECT user_id, starttime, value FROM iv)
SELECT u.user_id, u.t, coalesce(iv.value, u.value) AS value
FROM u LEFT JOIN iv ON iv.user_id = u.user_id AND u.t BETWEEN iv.starttime AND iv.endtime"""

SQL["build_chain"] = compose.concept_sql("first_day_vitalsign") if "first_day_vitalsign" in compose.CTE else ""

SQL["far_intervals"] = f"""
WITH e AS {E},
iv AS (
  SELECT o_orderkey, o_custkey, TIMESTAMP '2024-01-01' + to_days(CAST(o_orderkey % 30 AS INTEGER)) AS s,
    CASE WHEN o_orderkey % 7 = 0 THEN TIMESTAMP '2999-01-01'
         ELSE TIMESTAMP '2024-01-01' + to_days(CAST(o_orderkey % 30 + o_orderkey % 40 AS INTEGER)) END AS en
  FROM orders)
SELECT o_orderkey, count(*) AS n_events, min(t) AS first_time, max(value) AS value_max
FROM iv JOIN e ON e.user_id = iv.o_custkey AND e.t >= s AND e.t < en GROUP BY o_orderkey"""

SQL["first_matches_open"] = f"""
WITH e AS {E}
SELECT p.user_id, p.event_id, p.t,
  (SELECT arg_min(x.event_id, (x.t, x.event_id)) FROM e x WHERE x.user_id = p.user_id AND x.event_type = 'signup' AND x.t <= p.t) AS signup_id,
  (SELECT arg_min(x.event_id, (x.t, x.event_id)) FROM e x WHERE x.user_id = p.user_id AND x.event_type = 'error' AND x.t >= p.t) AS error_id,
  (SELECT arg_min(x.event_id, (-x.value, x.event_id)) FROM e x WHERE x.user_id = p.user_id AND x.event_type = 'view'
     AND x.t BETWEEN p.t - INTERVAL 2 DAY AND p.t + INTERVAL 2 DAY) AS view_id
FROM e p WHERE p.event_type = 'purchase'"""

SQL["unit_values"] = """
SELECT event_id, CASE event_type
    WHEN 'click' THEN CASE WHEN value > 0 AND value <= 100 THEN value * 100 WHEN value > 100 AND value < 200 THEN NULL
                           WHEN value BETWEEN 200 AND 400 THEN value ELSE -1 END
    WHEN 'view' THEN CASE WHEN value BETWEEN 32 AND 212 THEN (value - 32) / 1.8 ELSE -1 END
    WHEN 'error' THEN CASE WHEN value >= 0 AND value < 60 THEN value * 60 WHEN value >= 60 AND value < 3600 THEN value ELSE -1 END
    ELSE -1 END AS value_std
FROM events"""

SQL["trailing_rows_max"] = f"""
SELECT user_id, event_id, t, value, row_number() OVER u AS n,
  max(value) OVER (u ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS max_of_5,
  max(value) OVER (u ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS max_of_3_before
FROM {E} e WINDOW u AS (PARTITION BY user_id ORDER BY t, event_id)"""

SQL["order_meld"] = """
WITH o AS (
  SELECT l_orderkey, max(l_tax) * 60.0::DOUBLE AS cr, max(l_discount) * 70.0::DOUBLE AS bili,
    max(l_quantity / 16.0::DOUBLE) FILTER (WHERE l_quantity > 20) AS inr, 115.0::DOUBLE + min(l_quantity) AS na, bool_or(l_returnflag = 'R') AS rrt
  FROM lineitem GROUP BY l_orderkey),
terms AS (
  SELECT *, 0.957::DOUBLE * if(rrt OR cr > 4, ln(4.0::DOUBLE), ln(greatest(coalesce(cr, 1), 1)))
    + 0.378::DOUBLE * ln(greatest(coalesce(bili, 1), 1)) + (1.12::DOUBLE * ln(greatest(coalesce(inr, 1), 1)) + 0.643::DOUBLE) AS terms,
    137 - least(greatest(coalesce(na, 137), 125), 137) AS lack
  FROM o),
first AS (SELECT *, if(terms > 4, 40, CAST(round(CAST(terms AS DECIMAL(38, 9)), 1) * 10 AS DOUBLE)) AS meld_initial FROM terms)
SELECT l_orderkey, CAST(meld_initial AS DOUBLE) AS meld_initial,
  CAST(if(meld_initial > 11, meld_initial + 1.32::DOUBLE * lack - 0.033::DOUBLE * meld_initial * lack, meld_initial) AS DOUBLE) AS meld FROM first"""

SQL["props_clamped_window"] = f"""
WITH e AS {E},
d AS (SELECT user_id, min(t) AS lo, min(t) + INTERVAL 1 DAY AS hi FROM e GROUP BY user_id)
SELECT user_id, greatest(min(e.t) - INTERVAL 6 HOUR, lo) AS starttime, least(max(e.t) + INTERVAL 12 HOUR, hi) AS endtime
FROM d JOIN e USING (user_id) WHERE e.event_type = 'click' AND e.t > lo AND e.t <= hi GROUP BY user_id, lo, hi"""

SQL["weekday_quarter_points"] = f"""
WITH points(days, quarters, points) AS (VALUES ([0, 6], [0, 3], 0), ([0, 6], [1, 2], 4), ([1, 2, 3, 4, 5], [0], 1), ([1, 2, 3, 4, 5], [1], 3),
  ([1, 2, 3, 4], [2], 2), ([5], [2], 5))
SELECT user_id, CAST(sum(points) AS BIGINT) AS points, count(*) AS n
FROM {E} e LEFT JOIN points ON list_contains(days, dayofweek(t)) AND list_contains(quarters, hour(t) // 6) GROUP BY user_id"""

SQL["top_three_values"] = f"""
SELECT user_id, event_id, event_type, value, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC NULLS LAST, event_id) AS rank FROM {E} e) WHERE rank <= 3"""
