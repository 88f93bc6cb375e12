"""Per-entity time-series operators.

A series is never sorted by one task: rows are windowed inside (key, bucket) partitions, and what crosses a
bucket's border comes from halo rows (frames), or from one summary row per key and bucket (neighbours, running
counts).

* P09 / P10 ``lookback``, ``lookback_axis`` - ``rangeBetween`` inside (key, bucket); a bucket also gets the rows of the one
  before it that its frames can reach; the axis may be time, seconds since an event, or a dense ordinal (ROWS frames)
* P12 ``bucket_to_spine`` - equi-join on (id, ceil-hour) instead of a range join
* P13 ``carry_previous``, P14 ``state_episodes``, P16 ``to_validity`` - by ``neighbours`` and ``running_sum``
* P15 ``segment_intervals`` - one pass over the tagged ends of all sources
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import boundary_diff, ceil_hour, epoch_seconds
from . import ordering
from .matching import DAY, day_bucket


def _cols(xs):
    return [xs] if isinstance(xs, str) else list(xs)


def carry_previous(df: DataFrame, key: str, time_col: str, cols: Sequence[str], max_gap_seconds: int,
                   ties: Sequence[str] = (), prefix: str = "prev_") -> DataFrame:
    """Values of the immediately preceding row of the same key (equal times in the order of ``ties``), only if it is
    strictly less than ``max_gap_seconds`` older; NULL keys get no previous."""
    order = [(c, "asc", None) for c in (time_col, *ties)]
    names = [time_col, *[c for c in cols if c != time_col]]
    x = ordering.neighbours(df, key, day_bucket(F.col(time_col)), order, names)
    recent = F.col(key).isNotNull() & (F.col(f"prev_{time_col}")
                                       > F.col(time_col) - F.make_dt_interval(secs=F.lit(max_gap_seconds)))
    return x.select(*df.columns, *[F.when(recent, F.col(f"prev_{c}")).alias(f"{prefix}{c}") for c in cols])


def lookback_axis(df: DataFrame, key: str | Sequence[str], axis: Column,
                  frames: Mapping[str, tuple[Column, int, bool]], least_bucket: int = 0) -> DataFrame:
    """P09/P10 on any integer axis: for each output name an (aggregate, span, include_current) over the rows of the same key
    whose axis value lies in [x - span, x], or [x - span, x - 1] without the current value.

    All frames share one pass.  The axis is cut in buckets of four times the longest span; a row whose position may still be looked back at from the
    next bucket is sent there too, so a long series is split, each frame is whole, and about a
    quarter of the rows travels twice.  Rows without an axis value see one another only.
    """
    keys, longest = _cols(key), max(span for _, span, _ in frames.values())
    width = max(4 * longest, least_bucket, 1)
    x = df.withColumn("_x", axis.cast("long"))
    own = F.floor(F.col("_x") / F.lit(width)).cast("long")
    reaches = F.pmod(F.col("_x"), F.lit(width)) >= width - longest
    x = x.withColumn("_own", own).withColumn("_bk", F.explode(
        F.when(reaches, F.array(own, own + 1)).otherwise(F.array(own))))
    w = Window.partitionBy(*keys, "_bk").orderBy("_x")
    x = x.select("*", *[agg.over(w.rangeBetween(-span, 0 if now else -1)).alias(name) for name, (agg, span, now) in frames.items()])
    return x.where(F.col("_own").eqNullSafe(F.col("_bk"))).drop("_own", "_bk", "_x")


def lookback(df: DataFrame, key: str | Sequence[str], time_col: str,
             aggs: Mapping[str, Column], span_seconds: int, include_current: bool) -> DataFrame:
    """``aggs`` (name -> aggregate) over rows of the same key whose time lies in [t - span, t]
    (``include_current``) or [t - span, t - 1 s] (strictly earlier)."""
    return lookback_axis(df, key, epoch_seconds(F.col(time_col)),
                         {n: (a, span_seconds, include_current) for n, a in aggs.items()}, DAY)


def to_validity(df: DataFrame, key: str, start_col: str, ties: Sequence[str], default_end: Column, end_col: str = "endtime",
                gap_start: Column | None = None, gap_from: Column | None = None) -> DataFrame:
    """Observation -> [start, next start) with ``default_end`` for the last; equal starts in the order of ``ties``.

    With ``gap_start`` the first row of a key whose ``gap_from`` (default: ``gap_start``) precedes its start adds a row
    [gap_start, start) that holds its values."""
    x = ordering.neighbours(df, key, day_bucket(F.col(start_col)), [(c, "asc", None) for c in (start_col, *ties)], [start_col])
    end = F.coalesce(F.col(f"next_{start_col}"), default_end)
    if gap_start is None:
        return x.select(*df.columns, end.alias(end_col))
    gap_from = gap_start if gap_from is None else gap_from
    first = F.col(f"prev_{start_col}").isNull() & (gap_from < F.col(start_col))
    own = F.struct(F.col(start_col).alias("_s"), end.alias("_e"))
    gap = F.struct(gap_start.alias("_s"), F.col(start_col).alias("_e"))
    x = x.withColumn("_v", F.explode(F.when(first, F.array(own, gap)).otherwise(F.array(own))))
    return x.select(*[F.col("_v._s").alias(c) if c == start_col else F.col(c) for c in df.columns], F.col("_v._e").alias(end_col))


def hourly_spine(stays: DataFrame, key: str, start: Column, n_hours: Column,
                 lead_hours: int = 24) -> DataFrame:
    """One row per hour ``hr`` in [-lead_hours, n_hours] with
    ``endtime = ceil_hour(start) + hr hours``; an empty range yields no rows."""
    seq = F.when(n_hours >= -lead_hours, F.sequence(F.lit(-lead_hours).cast("long"), n_hours.cast("long")))
    x = stays.select(key, ceil_hour(start).alias("_base"), F.explode(seq).alias("hr"))
    return x.select(key, "hr", (F.col("_base") + F.make_dt_interval(F.lit(0), F.col("hr").cast("int")))
                    .alias("endtime"))


def align_times(frames: Sequence[DataFrame], key: str, time_col: str) -> DataFrame:
    """UNION DISTINCT of (key, time) from several sources."""
    out = None
    for f in frames:
        x = f.select(key, time_col)
        out = x if out is None else out.union(x)
    return out.distinct()


def bucket_to_spine(spine: DataFrame, events: DataFrame, key: str, time_col: str,
                    aggs: Sequence[Column]) -> DataFrame:
    """Aggregate events in (endtime - 1 h, endtime] per spine row.

    Spine ends are whole hours, so an event belongs to the spine row whose
    endtime is the event's ceil-hour: an equi-join on (key, hour) replaces
    the range join and the spine side of the join is the bucket itself.
    """
    ev = events.withColumn("endtime", ceil_hour(F.col(time_col)))
    agg = ev.groupBy(key, "endtime").agg(*aggs)
    return spine.join(agg, [key, "endtime"], "left")


def boundary_hour_sums(df: DataFrame, key: str, time_col: str, values: Sequence[str],
                       max_hour_diffs: Mapping[str, int]) -> DataFrame:
    """Per row, sums of ``values`` over rows of the same key with t' <= t
    and at most ``d`` hour boundaries between t' and t (one output per suffix).

    Equivalent to the reference's self range-join filtered on
    ``DATETIME_DIFF(t, t', HOUR) <= d`` but linear: the rows of the d previous
    whole hours come from an hourly pre-aggregate with a range frame over the
    hour index, the current hour from a running sum (peers included).  A sum
    is NULL when no non-NULL value contributes, as SQL's SUM.
    """
    hour = F.floor(epoch_seconds(F.col(time_col)) / 3600).cast("long")
    x = df.withColumn("_h", hour)
    w_in = (Window.partitionBy(key, "_h").orderBy(time_col)
            .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    for v in values:
        x = x.withColumn(f"_cs_{v}", F.sum(v).over(w_in)).withColumn(f"_cc_{v}", F.count(v).over(w_in))
    hourly = x.groupBy(key, "_h").agg(*[F.sum(v).alias(f"_hs_{v}") for v in values],
                                      *[F.count(v).alias(f"_hc_{v}") for v in values])
    frames = {}
    for suffix, d in max_hour_diffs.items():
        for v in values:
            frames |= {f"_ps_{v}_{suffix}": (F.sum(f"_hs_{v}"), d, False), f"_pc_{v}_{suffix}": (F.sum(f"_hc_{v}"), d, False)}
    prev = lookback_axis(hourly, key, F.col("_h"), frames, 24).select(key, "_h", *frames)
    x = x.join(prev, [key, "_h"], "left")
    outs = []
    for suffix in max_hour_diffs:
        for v in values:
            total = F.col(f"_cs_{v}") + F.coalesce(F.col(f"_ps_{v}_{suffix}"), F.lit(0))
            cnt = F.col(f"_cc_{v}") + F.coalesce(F.col(f"_pc_{v}_{suffix}"), F.lit(0))
            outs.append(F.when(cnt > 0, total).alias(f"{v}_{suffix}"))
    helper = [c for c in x.columns if c.startswith("_")]
    return x.select(*[c for c in x.columns if c not in helper], *outs)


def segment_intervals(frames: Mapping[str, DataFrame], key: str, value_col: str,
                      start_col: str = "starttime", end_col: str = "endtime") -> DataFrame:
    """Timeline segmentation with per-source values.

    All distinct start / end times of all sources (NULL included, ordered first) become numbered boundaries per key;
    consecutive boundaries form segments [t_k, t_k+1].  The intervals of all sources are one tagged set.  A key's boundaries
    of a day are one sorted array with the number of earlier ones and the day's successor; an interval's two ends look up
    their numbers there (one join), and it gives a row for each segment it contains, and the segments that its ends open.
    One grouping by segment gathers the sources' values; several intervals of one source covering a segment multiply
    its rows, as the reference's containment joins do.  Work is linear in ends and covered segments.
    """
    tagged = reduce(DataFrame.unionByName, [
        f.select(F.col(key).alias("_key"), F.lit(name).alias("_src"), F.col(start_col).alias("_s"), F.col(end_col).alias("_e"),
                 F.col(value_col).alias("_v")) for name, f in frames.items()])
    ends = tagged.select("*", F.explode(F.array(F.struct(F.lit(True).alias("starts"), F.col("_s").alias("t")),
                                                F.struct(F.lit(False).alias("starts"), F.col("_e").alias("t")))).alias("_end"))
    day = day_bucket(F.col("_end.t"))
    days = ends.groupBy(F.col("_key").alias("_dk"), day.alias("_db")).agg(F.array_sort(F.collect_set("_end.t")).alias("_times"))
    by_day = Window.partitionBy("_dk").orderBy(F.col("_db").asc_nulls_first())
    days = days.select("_dk", "_db", "_times", F.lead(F.get("_times", F.lit(0))).over(by_day).alias("_after"), F.coalesce(
        F.sum(F.size("_times")).over(by_day.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    met = ends.withColumn("_b", day).join(days, F.col("_key").eqNullSafe(F.col("_dk")) & F.col("_b").eqNullSafe(F.col("_db")))
    place = F.array_position("_times", F.col("_end.t"))
    # a NULL end is before all others and only opens the segment (NULL, first time), which no interval contains
    number = F.when(F.col("_end.t").isNull(), 0).otherwise(F.col("_before") + place)
    end = F.struct(number.alias("k"), F.col("_end.t").alias("start"),
                   F.when(F.col("_end.t").isNull(), F.col("_after")).otherwise(
                       F.coalesce(F.get("_times", place.cast("int")), "_after")).alias("end"))
    pairs = met.groupBy("_key", "_src", "_s", "_e", "_v").agg(
        F.max(F.when(F.col("_end.starts"), end)).alias("a"), F.max(F.when(~F.col("_end.starts"), end)).alias("z"),
        F.count(F.when(F.col("_end.starts"), 1)).alias("copies"))
    covers = F.col("_key").isNotNull() & F.col("_s").isNotNull() & F.col("_e").isNotNull() & (F.col("a.k") < F.col("z.k"))
    none = F.lit(None)
    opened = [F.struct(F.col(f"{x}.k").cast("long").alias("k"), F.col(f"{x}.start").alias("start"), F.col(f"{x}.end").alias("end"),
                       F.lit(False).alias("held")) for x in ("a", "z")]
    held = F.transform(F.sequence(F.col("a.k"), F.col("z.k") - 1), lambda k: F.struct(
        k.cast("long").alias("k"), none.cast(tagged.schema["_s"].dataType).alias("start"), none.cast(tagged.schema["_s"].dataType).alias("end"),
        F.lit(True).alias("held")))
    rows = pairs.select("_key", "_src", "_v", "copies", F.explode(
        F.concat(F.array(*opened), F.when(covers, held).otherwise(F.slice(F.array(*opened), 1, 0)))).alias("_x"))
    values = F.struct(F.col("_v").alias("v"), F.col("copies").alias("n"))
    seg = rows.groupBy("_key", F.col("_x.k").alias("_k")).agg(
        F.max("_x.start").alias(start_col), F.max("_x.end").alias(end_col),
        *[F.collect_list(F.when(F.col("_x.held") & (F.col("_src") == name), values)).alias(name) for name in frames]).where(
        F.col(end_col).isNotNull())
    for name in frames:
        each = F.flatten(F.transform(name, lambda x: F.array_repeat(x["v"], x["n"].cast("int"))))
        seg = seg.withColumn(name, F.explode_outer(each))
    return seg.select(F.col("_key").alias(key), start_col, end_col, *frames)


def neighbours(df: DataFrame, key: str, time_col: str, cols: Sequence[str],
               bucket_seconds: int = DAY) -> DataFrame:
    """Previous / next row values per key (``prev_<c>`` / ``next_<c>``, time included) in the order of time, bucketed by day
    (:func:`ordering.neighbours`); equal times of a key are open."""
    names = [time_col] + [c for c in cols if c != time_col]
    return ordering.neighbours(df, key, day_bucket(F.col(time_col), bucket_seconds), [(time_col, "asc", None)], names)


def running_sum(df: DataFrame, key: str, time_col: str, value: Column, name: str,
                bucket_seconds: int = DAY) -> DataFrame:
    """Running sum of ``value`` per key in time order (rows at the same time
    included, as SQL's default RANGE frame) without a per-key sort: in-bucket
    running sums plus the total of all earlier buckets of the key."""
    x = df.withColumn("_b", day_bucket(F.col(time_col), bucket_seconds)).withColumn("_v", value)
    w = (Window.partitionBy(key, "_b").orderBy(time_col)
         .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    x = x.withColumn("_in", F.sum("_v").over(w))
    tot = x.groupBy(key, "_b").agg(F.sum("_v").alias("_bt"))
    wb = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(F.col(key).alias("_k"), F.col("_b").alias("_sb"),
                     F.coalesce(F.sum("_bt").over(wb), F.lit(0)).alias("_before"))
    x = x.join(tot, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_b") == F.col("_sb")), "left")
    return x.select(*df.columns, (F.col("_before") + F.col("_in")).alias(name))


def state_episodes(df: DataFrame, key: str, time_col: str, state_col: str, gap_hours: int,
                   out_state: str = "state") -> DataFrame:
    """Sessionise a (key, time, state) series into episodes.

    A new episode starts at the first row, on a change of state, or when >= ``gap_hours`` hour boundaries passed since the
    previous row of the same state; an episode ends at the next row's time unless that is >= gap hours away (then at its own
    last time); episodes with a single time are dropped.  Input rows must be unique per (key, time): then the previous row of
    the same state matters only when it is the previous row, so the rule needs the previous / next row
    (:func:`neighbours`) and a running count of episode starts (:func:`running_sum`), both bucketed by day.
    """
    t = F.col(time_col)
    x = neighbours(df.select(key, time_col, state_col).where(t.isNotNull()), key, time_col, [state_col])
    sp, tp, tn = F.col(f"prev_{state_col}"), F.col(f"prev_{time_col}"), F.col(f"next_{time_col}")
    new = sp.isNull() | (sp != F.col(state_col)) | (boundary_diff("HOUR", t, tp) >= gap_hours)
    x = running_sum(x, key, time_col, F.when(new, 1).otherwise(0), "_seq")
    end = F.when(tn.isNull() | (boundary_diff("HOUR", tn, t) >= gap_hours), t).otherwise(tn)
    ep = x.groupBy(key, "_seq").agg(F.min(time_col).alias("starttime"), F.max(end).alias("endtime"),
                                    F.max(state_col).alias(out_state), F.max(time_col).alias("_last"))
    return ep.where(F.col("starttime") != F.col("_last")).select(key, "starttime", "endtime", out_state)
