"""Time-window aggregations, overlap flags and merges.

Anchors meet events by (key, day): every join here carries an equality key, none enumerates pairs beyond the rows a window's
days contain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .matching import between_closed, contains_join, day_bucket


def _cols(xs):
    return [xs] if isinstance(xs, str) else list(xs)


def agg_in_window(anchor: DataFrame, events: DataFrame, on: str | Sequence[str],
                  time_col: str, start: Column, end: Column, aggs: Sequence[Column],
                  group_by: Sequence[str], closed: str = "both",
                  extra_on: Column | None = None) -> DataFrame:
    """LEFT join events whose ``time_col`` lies in [start, end] (anchor columns
    referenced through the ``a`` alias), then aggregate per anchor.

    ``start``/``end`` are expressions over the anchor (e.g.
    ``F.col("a.intime") - hours(6)``); anchors without events are kept with
    NULL aggregates.  The join key is (key, day), so a long series is spread
    over its days, and the aggregate is partial before its shuffle.  An anchor
    has a row without an event for each empty day: ``aggs`` must pass over NULLs.
    """
    a, e = _by_day(anchor, start, end).alias("a"), events.withColumn("_bk", day_bucket(F.col(time_col))).alias("e")
    cond = F.col("a._bk") == F.col("e._bk")
    for k in _cols(on):
        cond = cond & (F.col(f"a.{k}") == F.col(f"e.{k}"))
    cond = cond & between_closed(F.col(f"e.{time_col}"), start, end, closed)
    if extra_on is not None:
        cond = cond & extra_on
    return a.join(e, cond, "left").groupBy(*[F.col(f"a.{g}").alias(g) for g in group_by]).agg(*aggs)


def _by_day(anchor: DataFrame, start: Column, end: Column) -> DataFrame:
    """Anchor rows (``a`` alias) once for each day ``_bk`` that [start, end] touches; once without a day if none."""
    b0, b1 = day_bucket(start), day_bucket(end)
    return anchor.alias("a").select("a.*", F.explode_outer(F.when(b1 >= b0, F.sequence(b0, b1))).alias("_bk"))


def overlap_flag(anchor: DataFrame, intervals: DataFrame, on: str, w_start: Column,
                 w_end: Column, group_by: Sequence[str], name: str,
                 start_col: str = "starttime", end_col: str = "endtime") -> DataFrame:
    """1 if any interval starts in, ends in, or spans [w_start, w_end], else 0.

    The three-way OR equals ``start <= w_end AND end >= w_start`` for intervals
    with start <= end, and for intervals with start > end the branches are
    kept literally.  Anchors meet intervals by (key, day): the days of an interval
    are those between its ends that the key's anchors reach, so a mistyped end
    adds none, and its first and last day where an end is missing or before the start.
    """
    s, e = F.col(f"i.{start_col}"), F.col(f"i.{end_col}")
    hit = ((s >= w_start) & (s <= w_end)) | ((e >= w_start) & (e <= w_end)) | ((s <= w_start) & (e >= w_end))
    days = _by_day(anchor, w_start, w_end)
    reach = days.where(F.col("_bk").isNotNull()).groupBy(F.col(on).alias("_rk")).agg(F.min("_bk").alias("_r0"), F.max("_bk").alias("_r1"))
    b0, b1 = day_bucket(F.col(start_col)), day_bucket(F.col(end_col))
    lo, hi = F.greatest(b0, F.col("_r0")), F.least(b1, F.col("_r1"))
    iv = intervals.join(reach, F.col(on) == F.col("_rk")).select(
        on, start_col, end_col,
        F.explode(F.when(F.col(start_col) <= F.col(end_col), F.when(lo <= hi, F.sequence(lo, hi)))
                  .otherwise(F.array_distinct(F.array_compact(F.array(b0, b1))))).alias("_bk"))
    j = days.alias("a").join(iv.alias("i"), (F.col(f"a.{on}") == F.col(f"i.{on}"))
                             & (F.col("a._bk") == F.col("i._bk")) & hit, "left")
    return j.groupBy(*[F.col(f"a.{g}").alias(g) for g in group_by]).agg(
        F.max(F.when(F.col(f"i.{on}").isNotNull(), 1).otherwise(0)).alias(name))


def merge_sources(a: DataFrame, b: DataFrame, on: Sequence[str], prefer: Sequence[str]) -> DataFrame:
    """FULL OUTER JOIN on ``on`` then COALESCE(a.x, b.x) for ``prefer`` columns."""
    cond = None
    for k in on:
        c = F.col(f"a.{k}") == F.col(f"b.{k}")
        cond = c if cond is None else cond & c
    j = a.alias("a").join(b.alias("b"), cond, "full")
    return j.select(*[F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in on],
                    *[F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in prefer])


def override_by_interval(points: DataFrame, intervals: DataFrame, key: str, time_col: str,
                         values: Sequence[str], start_col: str = "starttime",
                         end_col: str = "endtime") -> DataFrame:
    """Points UNION DISTINCT interval starts; a containing interval's values win."""
    starts = intervals.select(key, F.col(start_col).alias(time_col), *values)
    base = points.select(key, time_col, *values).unionByName(starts).distinct()
    j = contains_join(base, intervals.select(key, start_col, end_col, *values), key, time_col,
                      start_col, end_col, "both", "left")
    return j.select(F.col(f"p.{key}").alias(key), F.col(f"p.{time_col}").alias(time_col),
                    *[F.coalesce(F.col(f"i.{v}"), F.col(f"p.{v}")).alias(v) for v in values])


def text_event_window(anchor: DataFrame, events: DataFrame, key: str, match: Column, lo: Column, hi: Column,
                      before_seconds: int, after_seconds: int, closed: str = "both", clamp: bool = False) -> DataFrame:
    """Per key, [first matching event - before, last matching event + after], over events in [lo, hi] of the anchor
    (``a``/``e`` aliases); with ``clamp`` the result does not leave [lo, hi] of an anchor (one window an anchor then)."""
    e = events.withColumn("_bk", day_bucket(F.col("charttime"))).alias("e")
    t = F.col("e.charttime")
    j = _by_day(anchor, lo, hi).alias("a").join(
        e, (F.col(f"a.{key}") == F.col(f"e.{key}")) & (F.col("a._bk") == F.col("e._bk")) & between_closed(t, lo, hi, closed), "inner")
    bounds = [lo.alias("_lo"), hi.alias("_hi")] if clamp else []
    found = j.where(match).groupBy(F.col(f"a.{key}").alias(key), *bounds).agg(
        F.min(t - F.make_dt_interval(secs=F.lit(before_seconds))).alias("starttime"),
        F.max(t + F.make_dt_interval(secs=F.lit(after_seconds))).alias("endtime"))
    if not clamp:
        return found
    return found.select(key, F.greatest("starttime", "_lo").alias("starttime"), F.least("endtime", "_hi").alias("endtime"))
