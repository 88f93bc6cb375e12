"""Operator queries on the supplied tables (P01-P38), registered by name.

Each reusable operator of :mod:`chartwise.operators` is exercised directly on
``events`` (and ``orders`` / ``lineitem`` / ``part`` / ``customer``), so its
work grows with the input.  Event times are truncated to the minute so that
epoch-second frames and interval joins agree exactly with the SQL oracle;
ties at one minute are broken by ``event_id``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import round_numeric
from ..functions.time import days, epoch_seconds, hours, trunc_ntz
from ..operators import matching as M
from ..operators import ordering as O
from ..operators import pivot as P
from ..operators import scores as S
from ..operators import temporal as TJ
from ..operators import windows as W
from ..operators.codes import code_flags, hierarchical_weight, map_labels, match_keywords
from ..operators.units import Unit, harmonise
from ..sources.parquet import read_table

NATIVE: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# FIXED VALUES for the operator demonstrations (not clinical data)
PART_KEYWORDS = ["red", "bolt", "steel"]
SEGMENT_SYNONYMS = [(["AUTOMOBILE", "MACHINERY"], "INDUSTRIAL"), (["HOUSEHOLD", "FURNITURE"], "HOME")]
PART_RULES = {
    "brand_1x": [(1, 7, "in", ["Brand#1"])],
    "type_a_to_m": [(1, 1, "between", ("A", "M"))],
}
QUANTITY = ([("<", 5, 4), ("<", 15, 2), ("<", 35, 0), ("<", 45, 1)], 3)
DISCOUNT_TAX = [(0.03, [(0.04, 0), (None, 2)]), (0.07, [(0.02, 1), (0.06, 3), (None, 5)]), (None, [(0.04, 4), (None, 6)])]
EVENT_UNITS = [Unit(0, 100, factor=100.0, closed="right", codes=("click",)), Unit(100, 200, factor=None, closed="neither", codes=("click",)),
               Unit(200, 400, codes=("click",)), Unit(32, 212, shift=32, divisor=1.8, codes=("view",)), Unit(0, 60, factor=60.0, closed="left", codes=("error",)),
               Unit(60, 3600, closed="left", codes=("error",))]
WEEKDAY_QUARTER = [([1, 7], [0, 3], 0), ([1, 7], [1, 2], 4), ([2, 3, 4, 5, 6], [0], 1), ([2, 3, 4, 5, 6], [1], 3), ([2, 3, 4, 5], [2], 2), ([6], [2], 5),
                   ([2, 3, 4, 5, 6], [3], None)]
PROPS_PATTERN = '"k": 1'


def native(name: str):
    def deco(fn):
        NATIVE[name] = fn
        return fn
    return deco


def events_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select("event_id", "user_id", "event_type", "value", "props",
                    trunc_ntz("MINUTE", F.col("ts")).alias("t"))


@native("daily_event_pivot")
def daily_event_pivot(spark, sf_dir):
    """Events per user x day pivoted by type with clips and a scaled unit."""
    e = events_minute(spark, sf_dir).withColumn("day", trunc_ntz("DAY", F.col("t")))
    specs = {
        "click_max": P.ItemSpec(["click"], value="value", agg="max", lo=0, hi=300),
        "view_avg": P.ItemSpec(["view"], value="value", agg="avg", hi=200, strict_hi=False),
        "purchase_cents": P.ItemSpec(["purchase"], value="value", agg="sum",
                                     transform=lambda v: v * F.lit(100.0)),
        "signup_min": P.ItemSpec(["signup"], value="value", agg="min"),
        "error_max": P.ItemSpec(["error"], value="value", agg="max", lo=10, hi=300, strict_hi=False),
    }
    return P.pivot_items(e, ["user_id", "day"], specs, item_col="event_type")


@native("first_signup_window")
def first_signup_window(spark, sf_dir):
    """Events in [first signup - 6 h, first signup + 1 d] per user."""
    e = events_minute(spark, sf_dir)
    anchor = e.where(F.col("event_type") == "signup").groupBy("user_id").agg(F.min("t").alias("anchor_time"))
    return TJ.agg_in_window(anchor, e, "user_id", "t", F.col("a.anchor_time") - hours(6),
                            F.col("a.anchor_time") + days(1),
                            [F.min("e.value").alias("value_min"), F.max("e.value").alias("value_max"),
                             F.avg("e.value").alias("value_avg"), F.sum("e.value").alias("value_sum")],
                            ["user_id", "anchor_time"])


def _order_intervals(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    start = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval((F.col("o_orderkey") % 30).cast("int"))
    end = start + days(1) + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))
    return o.select("o_orderkey", F.col("o_custkey").alias("user_id"), start.alias("starttime"), end.alias("endtime"))


@native("order_window_events")
def order_window_events(spark, sf_dir):
    """Events of the order's customer inside [start, end] with the three
    closure modes as flags."""
    j = M.contains_join(events_minute(spark, sf_dir), _order_intervals(spark, sf_dir), "user_id", "t", how="inner")
    t, s, en = F.col("p.t"), F.col("i.starttime"), F.col("i.endtime")
    return j.select("i.o_orderkey", "p.event_id", "p.user_id", "p.t",
                    M.between_closed(t, s, en, "left").alias("in_left_closed"),
                    M.between_closed(t, s, en, "right").alias("in_right_closed"),
                    M.between_closed(t, s, en, "neither").alias("in_open"))


@native("asof_view_before_purchase")
def asof_view_before_purchase(spark, sf_dir):
    """The latest view of the same user within 2 h before each purchase."""
    e = events_minute(spark, sf_dir)
    purchases = e.where(F.col("event_type") == "purchase").select("user_id", "event_id", "t")
    views = e.where(F.col("event_type") == "view").select(
        "user_id", F.col("t").alias("view_time"), F.col("event_id").alias("view_id"),
        F.col("value").alias("view_value"))
    return M.asof_within(purchases, views, "user_id", "t", "view_time", 2 * 3600,
                         ["view_id", "view_value"], tiebreak=[F.col("view_id")])


@native("purchase_error_match")
def purchase_error_match(spark, sf_dir):
    """P07 + P26: earliest error in the 72 h before each purchase (errors with an
    even value in cents are date-only: error day in [purchase day - 3, day])."""
    e = events_minute(spark, sf_dir)
    purchases = e.where(F.col("event_type") == "purchase").select("user_id", "event_id", "t")
    errors = e.where(F.col("event_type") == "error").select(
        "user_id", F.col("event_id").alias("error_id"), F.col("t").alias("error_time"),
        (F.round(F.col("value") * 100).cast("long") % 2 == 0).alias("date_only"))
    errors = errors.withColumn("match_time", F.when(F.col("date_only"), trunc_ntz("DAY", F.col("error_time"))).otherwise(F.col("error_time")))
    looks = M.date_or_time("match", F.col("t"), F.col("error_time"), F.col("date_only"), before=72 * 3600, after=0, days_before=3,
                           days_after=0, strict_after=True)
    found = M.first_in_windows(purchases, errors, "user_id", ["event_id"], looks,
                               [("match_time", "asc", None), ("error_id", "asc", None)], ["error_id", "match_time"])
    return found.select("event_id", "user_id", "t", F.col("match_error_id").alias("error_id"), F.col("match_match_time").alias("match_time"))


def _episodes(e):
    per_t = e.groupBy("user_id", "t").agg(F.max("event_type").alias("state"))
    return W.state_episodes(per_t, "user_id", "t", "state", 14)


@native("event_type_episodes")
def event_type_episodes(spark, sf_dir):
    """Episodes of an equal event type with a 14 h gap limit."""
    return _episodes(events_minute(spark, sf_dir))


@native("episode_first_day_flag")
def episode_first_day_flag(spark, sf_dir):
    """Did any episode (P14) start in, end in or span the user's first day."""
    e = events_minute(spark, sf_dir)
    first = e.groupBy("user_id").agg(F.min("t").alias("first_time"))
    return TJ.overlap_flag(first, _episodes(e), "user_id", F.col("a.first_time"),
                           F.col("a.first_time") + days(1), ["user_id"], "touches_first_day")


@native("lookback_min_48h")
def lookback_min_48h(spark, sf_dir):
    """Minimum value of the user's strictly earlier events in the last 48 h."""
    e = events_minute(spark, sf_dir).select("user_id", "event_id", "t", "value")
    return W.lookback(e, "user_id", "t", {"value_min_48h": F.min("value")}, 48 * 3600, False)


@native("trailing_sums")
def trailing_sums(spark, sf_dir):
    """P10: trailing 6 / 12 / 24 h value sums per user (current minute included)."""
    e = events_minute(spark, sf_dir).select("user_id", "event_id", "t", "value")
    for h in (6, 12, 24):
        e = W.lookback(e, "user_id", "t", {f"value_sum_{h}h": F.sum("value")}, h * 3600, True)
    return e


@native("boundary_hour_sums")
def boundary_hour_sums(spark, sf_dir):
    """Sums over earlier-or-equal events at most 5 / 11 hour boundaries back."""
    e = events_minute(spark, sf_dir).select("user_id", "event_id", "t", "value")
    return W.boundary_hour_sums(e, "user_id", "t", ["value"], {"6hr": 5, "12hr": 11})


@native("hourly_spine_minmax")
def hourly_spine_minmax(spark, sf_dir):
    """P17 + P12: hourly spine per user (24 h lead-in) with min / max value per hour."""
    from ..functions.time import boundary_diff
    e = events_minute(spark, sf_dir)
    span = e.groupBy("user_id").agg(F.min("t").alias("t0"), F.max("t").alias("t1"))
    spine = W.hourly_spine(span, "user_id", F.col("t0"), boundary_diff("HOUR", F.col("t1"), F.col("t0")), 24)
    return W.bucket_to_spine(spine, e, "user_id", "t", [F.min("value").alias("value_min"),
                                                          F.max("value").alias("value_max")])


@native("carry_previous_value")
def carry_previous_value(spark, sf_dir):
    """The previous event's value of the same user when less than 6 h older."""
    e = events_minute(spark, sf_dir).select("user_id", "event_id", "t", "value")
    return W.carry_previous(e, "user_id", "t", ["value"], 6 * 3600, ties=["event_id"])


def _type_intervals(e):
    return e.select("user_id", "event_type", F.col("t").alias("starttime"),
                    (F.col("t") + F.make_dt_interval(F.lit(0), F.lit(0), F.floor("value").cast("int")))
                    .alias("endtime"), "value")


@native("event_type_segments")
def event_type_segments(spark, sf_dir):
    """Per user, segments between all interval ends of five event types with
    the value of each type's interval containing the segment."""
    iv = _type_intervals(events_minute(spark, sf_dir))
    frames = {t: iv.where(F.col("event_type") == t) for t in ["click", "error", "purchase", "signup", "view"]}
    return W.segment_intervals(frames, "user_id", "value")


@native("union_event_times")
def union_event_times(spark, sf_dir):
    """Union of click and view times per user with each type's value there."""
    e = events_minute(spark, sf_dir)
    c = e.where(F.col("event_type") == "click").groupBy("user_id", "t").agg(F.max("value").alias("click_value"))
    v = e.where(F.col("event_type") == "view").groupBy("user_id", "t").agg(F.max("value").alias("view_value"))
    tm = W.align_times([c, v], "user_id", "t")
    return tm.join(c, ["user_id", "t"], "left").join(v, ["user_id", "t"], "left")


@native("value_validity")
def value_validity(spark, sf_dir):
    """Signup values as validity intervals [t, next t), the last one ending 2 h
    after the user's last event; a leading gap from the user's first event is
    back-filled with the first value."""
    e = events_minute(spark, sf_dir)
    span = e.groupBy("user_id").agg(F.min("t").alias("t0"), F.max("t").alias("t1"))
    obs = e.where(F.col("event_type") == "signup").select("user_id", F.col("t").alias("starttime"), "value",
                                                          "event_id").join(span, "user_id")
    x = W.to_validity(obs, "user_id", "starttime", ["event_id"], F.col("t1") + hours(2), gap_start=F.col("t0"))
    return x.select("user_id", "starttime", "endtime", "value")


@native("lineitem_ladders")
def lineitem_ladders(spark, sf_dir):
    """Threshold ladders on per-order quantity / price extremes,
    the furthest-from-normal choice, a two-dimensional discount x tax table,
    hierarchical weights, a NULL-as-normal total and its logistic."""
    li = read_table(spark, sf_dir, "lineitem")
    o = li.groupBy("l_orderkey").agg(
        F.min("l_quantity").alias("qty_min"), F.max("l_quantity").alias("qty_max"),
        F.max("l_discount").alias("disc_max"), F.max("l_tax").alias("tax_max"),
        F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("returned"),
        F.max(F.when(F.col("l_linestatus") == "O", 1).otherwise(0)).alias("open_line"))
    c = F.col

    o = o.withColumn("qty_score", S.worst_of(c("qty_min"), c("qty_max"), 25.0, *(S.scale(c(q), *QUANTITY) for q in ("qty_min", "qty_max"))))
    o = o.withColumn("disc_tax_score", S.grid_points(c("disc_max"), c("tax_max"), DISCOUNT_TAX))
    o = o.withColumn("status_weight", hierarchical_weight(c("open_line"), c("returned"), 1, 3))
    o = o.withColumn("total", S.total([c("qty_score"), c("disc_tax_score"), c("status_weight")]))
    return o.withColumn("prob", S.logistic(F.lit(-3.0) + F.lit(0.25) * c("total")))


@native("order_part_flags")
def order_part_flags(spark, sf_dir):
    """P23 + P27: per order, part brand / type rule flags and the customer's
    market segment merged by synonyms."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    dx = li.join(part, "l_partkey", "inner").select(
        F.col("l_orderkey").alias("o_orderkey"), F.lit(1).alias("v"), "p_brand", "p_type")
    brand = dx.select("o_orderkey", F.col("p_brand").alias("code"), "v")
    ptype = dx.select("o_orderkey", F.col("p_type").alias("code"), "v")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    base = orders.join(cust, "o_custkey", "left").select(
        "o_orderkey", map_labels(F.col("c_mktsegment"), SEGMENT_SYNONYMS).alias("segment_group"))
    x = code_flags(base, brand, "o_orderkey", {"brand_1x": PART_RULES["brand_1x"]}, "code", "v")
    return code_flags(x, ptype, "o_orderkey", {"type_a_to_m": PART_RULES["type_a_to_m"]}, "code", "v")


@native("part_name_keywords")
def part_name_keywords(spark, sf_dir):
    """Line items whose part name contains a keyword (distinct names
    classified once, semi-join back)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    part = read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    x = li.join(part, "l_partkey", "inner")
    return match_keywords(x, "p_name", PART_KEYWORDS, case="lower", keys=("p_name",))


@native("props_pattern_window")
def props_pattern_window(spark, sf_dir):
    """Per user, first matching event - 1 h .. last + 4 h, over events in the
    user's first day whose props text contains a pattern."""
    e = events_minute(spark, sf_dir)
    first = e.groupBy("user_id").agg(F.min("t").alias("first_time"))
    return TJ.text_event_window(first, e.withColumn("charttime", F.col("t")), "user_id",
                                F.col("e.props").contains(PROPS_PATTERN), F.col("a.first_time"),
                                F.col("a.first_time") + days(1), 3600, 4 * 3600)


@native("top_event_per_user")
def top_event_per_user(spark, sf_dir):
    """P25: each user's highest-value event (ties: earliest, then lowest id)."""
    e = events_minute(spark, sf_dir).select("user_id", "event_id", "event_type", "value", "t")
    return O.top1_agg(e, ["user_id"], [("value", "desc", None), ("t", "asc", None), ("event_id", "asc", None)])


@native("first_four_event_types")
def first_four_event_types(spark, sf_dir):
    """The first four event types of each user x day as columns."""
    e = events_minute(spark, sf_dir).withColumn("day", trunc_ntz("DAY", F.col("t")))
    return O.pivot_ordinal(e, ["user_id", "day"], [F.col("t"), F.col("event_id")], "event_type", 4, "type_")


def _daily(spark, sf_dir):
    e = events_minute(spark, sf_dir).withColumn("day", trunc_ntz("DAY", F.col("t")))
    return e.groupBy("user_id", "day").agg(
        F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("purchase_total"),
        F.avg(F.when(F.col("event_type") == "click", F.col("value"))).alias("click_pct"),
        F.max(F.when(F.col("event_type") == "view", F.col("value"))).alias("view_max"),
        F.max(F.when(F.col("event_type") == "click", F.col("value"))).alias("click_max"),
        F.max(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("purchase_max"))


@native("daily_ratio_and_dose")
def daily_ratio_and_dose(spark, sf_dir):
    """P31 + P34 + P36: per user x day, an absolute value imputed from a
    percentage of a total when missing, and a weighted NULL-as-0 sum rounded
    as a decimal."""
    d = _daily(spark, sf_dir)
    c = F.col
    imputed = P.impute_from_ratio(c("purchase_total"), c("click_pct") / F.lit(5.0), c("view_max"),
                                  c("purchase_total") > 0)
    dose = S.linear_dose([c("click_max"), c("view_max") / F.lit(10.0), c("purchase_max") * F.lit(2.5) / F.lit(60.0)])
    return d.select("user_id", "day", round_numeric(imputed, 4).alias("view_imputed"),
                    round_numeric(dose, 4).alias("weighted_dose"))


@native("merge_click_view")
def merge_click_view(spark, sf_dir):
    """Full outer merge of click and view values per (user, minute),
    click preferred."""
    e = events_minute(spark, sf_dir)
    c = e.where(F.col("event_type") == "click").groupBy("user_id", "t").agg(F.max("value").alias("value"))
    v = e.where(F.col("event_type") == "view").groupBy("user_id", "t").agg(F.max("value").alias("value"))
    return TJ.merge_sources(c, v, ["user_id", "t"], ["value"])


@native("interval_override")
def interval_override(spark, sf_dir):
    """Error points united with purchase interval starts; a containing
    purchase interval's value overrides the point's."""
    e = events_minute(spark, sf_dir)
    pts = e.where(F.col("event_type") == "error").select("user_id", "t", "value")
    iv = _type_intervals(e.where(F.col("event_type") == "purchase")).select("user_id", "starttime", "endtime", "value")
    return TJ.override_by_interval(pts, iv, "user_id", "t", ["value"])


@native("far_intervals")
def far_intervals(spark, sf_dir):
    """Events inside [start, end) per order, where one order in seven has no known end (the year 2999)."""
    o = read_table(spark, sf_dir, "orders")
    start = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval((F.col("o_orderkey") % 30).cast("int"))
    end = F.when(F.col("o_orderkey") % 7 == 0, F.lit("2999-01-01").cast("timestamp_ntz")).otherwise(
        start + F.make_dt_interval((F.col("o_orderkey") % 40).cast("int")))
    iv = o.select("o_orderkey", F.col("o_custkey").alias("user_id"), start.alias("starttime"), end.alias("endtime"))
    j = M.contains_join(events_minute(spark, sf_dir), iv, "user_id", "t", closed="left", how="inner")
    return j.groupBy(F.col("i.o_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("n_events"), F.min("p.t").alias("first_time"), F.max("p.value").alias("value_max"))


@native("first_matches_open")
def first_matches_open(spark, sf_dir):
    """P07 with open sides and an order that does not begin with time: per purchase the user's first signup until then, the next
    error from then on, and the dearest view within two days on either side."""
    e = events_minute(spark, sf_dir)
    pur = e.where(F.col("event_type") == "purchase").select("user_id", "event_id", "t")
    b = e.select("user_id", F.col("event_id").alias("id"), F.col("t").alias("time"), "event_type", F.col("value").alias("price"))
    at, bt, kind = epoch_seconds(F.col("t")), epoch_seconds(F.col("time")), F.col("event_type")
    near = M.first_in_windows(pur, b, "user_id", ["event_id"], [
        M.Look("signup", at, bt, None, 0, kind == "signup", block=86400), M.Look("error", at, bt, 0, None, kind == "error", block=86400)],
        [("time", "asc", None), ("id", "asc", None)], ["id"])
    return M.first_in_windows(near, b, "user_id", ["event_id"], [M.Look("view", at, bt, 2 * 86400, 2 * 86400, kind == "view")],
                              [("price", "desc", None), ("id", "asc", None)], ["id"])


@native("unit_values")
def unit_values(spark, sf_dir):
    """Event values in one unit by rules on type and range; -1 where the unit is unknown."""
    e = read_table(spark, sf_dir, "events")
    return e.select("event_id", harmonise(F.col("value"), EVENT_UNITS, F.col("event_type"), F.lit(-1.0)).alias("value_std"))


@native("trailing_rows_max")
def trailing_rows_max(spark, sf_dir):
    """P10 over rows: the largest value of a user's last five events (this one included) and of the three before it."""
    e = events_minute(spark, sf_dir).select("user_id", "event_id", "t", "value")
    e = O.ordinal(e, "user_id", M.day_bucket(F.col("t")), [F.col("t"), F.col("event_id")], "n")
    return W.lookback_axis(e, "user_id", F.col("n"), {"max_of_5": (F.max("value"), 4, True), "max_of_3_before": (F.max("value"), 3, False)}, 1000)


@native("order_meld")
def order_meld(spark, sf_dir):
    """P35 on per-order numbers in the place of laboratory values."""
    li = read_table(spark, sf_dir, "lineitem")
    o = li.groupBy("l_orderkey").agg(
        (F.max("l_tax") * F.lit(60.0)).alias("creatinine"), (F.max("l_discount") * F.lit(70.0)).alias("bilirubin"),
        F.max(F.when(F.col("l_quantity") > 20, F.col("l_quantity") / F.lit(16.0))).alias("inr"),
        (F.lit(115.0) + F.min("l_quantity")).alias("sodium"), F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("dialysis"))
    initial, sodium = S.meld_score(*(F.col(c) for c in ("creatinine", "bilirubin", "inr", "sodium", "dialysis")))
    return o.select("l_orderkey", initial.alias("meld_initial"), sodium.alias("meld"))


@native("props_clamped_window")
def props_clamped_window(spark, sf_dir):
    """As ``props_pattern_window`` on any price text, inside (start, end] and clamped to the user's first day."""
    e = events_minute(spark, sf_dir)
    first = e.groupBy("user_id").agg(F.min("t").alias("first_time"))
    return TJ.text_event_window(first, e.withColumn("charttime", F.col("t")), "user_id", F.col("e.event_type") == "click", F.col("a.first_time"),
                                F.col("a.first_time") + days(1), 6 * 3600, 12 * 3600, closed="right", clamp=True)


@native("weekday_quarter_points")
def weekday_quarter_points(spark, sf_dir):
    """P29 on value sets: points of weekday x quarter of the day, summed per user."""
    e = events_minute(spark, sf_dir)
    quarter = F.floor(F.hour("t") / 6).cast("int")
    return e.groupBy("user_id").agg(F.sum(S.cell_points(F.dayofweek("t"), quarter, WEEKDAY_QUARTER, range(1, 8), range(4))).alias("points"),
                                    F.count("*").alias("n"))


@native("top_three_values")
def top_three_values(spark, sf_dir):
    """P25: the three dearest events per user with their rank, in two bounded phases."""
    e = events_minute(spark, sf_dir).select("user_id", "event_id", "event_type", "value")
    return O.top_n(e, ["user_id"], [F.col("value").desc_nulls_last(), F.col("event_id")], 3, "rank")


@native("build_chain")
def build_chain(spark, sf_dir):
    """Build chartevents -> vitalsign -> first_day_vitalsign through the
    registry with the shared node materialised, and return the last node."""
    from ..sources import Sources
    from .registry import build
    out = build(Sources.from_events(spark, sf_dir), ["vitalsign", "first_day_vitalsign"])
    return out["first_day_vitalsign"]

