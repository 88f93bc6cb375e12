"""Points against intervals, as-of values and first matches in a window.

None of these compares the rows of a key pairwise:

* P05 ``contains_join``  - an interval is a dyadic cover, O(log n) blocks of days; the days on which a key has points are looked
  up by their ancestors, and points meet the intervals that touch their day
* P06 ``asof_within``    - a running ``last`` over the union of both sides inside (key, bucket); a bucket also gets the right rows
  of the one before it
* P07 / P26 ``first_in_windows`` - the least row, by any order, of a sliding window: time is cut in blocks as long as the window, which is then the end
  of one block and the beginning of the next, so two running minima answer it; open sides add one summary row a block
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import epoch_seconds
from .ordering import order_key

DAY = 86400
#: levels of the dyadic cover: blocks of 4^k days, up to 4^10 days (2,870 years)
RADIX, LEVELS = 4, 11


def _cols(xs):
    return [xs] if isinstance(xs, str) else list(xs)


def day_bucket(ts: Column, bucket_seconds: int = DAY) -> Column:
    return F.floor(epoch_seconds(ts) / F.lit(bucket_seconds)).cast("long")


def between_closed(t: Column, start: Column, end: Column, closed: str = "both") -> Column:
    """start <= t <= end with ``closed`` in both/left/right/neither."""
    lo = t >= start if closed in ("both", "left") else t > start
    hi = t <= end if closed in ("both", "right") else t < end
    return lo & hi


def _floor_div(x: Column, n: int) -> Column:
    return F.floor(x / F.lit(float(n))).cast("long")


def _at_level(blocks: Column, level: int) -> Column:
    return F.transform(blocks, lambda b: F.struct(F.lit(level).alias("level"), b.alias("block")))


def dyadic_cover(first: Column, last: Column) -> Column:
    """Blocks (level, block) that are disjoint and together hold the days ``first`` .. ``last``: at each level those before the first
    and after the last block that the next level takes over.  NULL when the range is empty or unknown."""
    parts = []
    for k in range(LEVELS):
        size = RADIX ** k
        lo = -_floor_div(-first, size)                          # the whole blocks of this level: [lo, hi)
        hi = _floor_div(last + 1, size)
        up_lo, up_hi = -_floor_div(-lo, RADIX) * RADIX, _floor_div(hi, RADIX) * RADIX
        none = F.expr("cast(array() as array<bigint>)")

        def run(a, b):
            return F.when(a < b, F.sequence(a, b - 1)).otherwise(none)
        if k == LEVELS - 1:
            blocks = run(lo, hi)
        else:
            blocks = F.when(up_lo < up_hi, F.concat(run(lo, up_lo), run(up_hi, hi))).otherwise(run(lo, hi))
        parts.append(_at_level(blocks, k))
    return F.when(first <= last, F.concat(*parts))


def _blocks(first: Column, last: Column) -> Column:
    """A cover as :func:`dyadic_cover` gives; a few days are their own blocks, which costs a fraction of its arithmetic."""
    few = F.when(first <= last, _at_level(F.sequence(first, last), 0))
    return F.when(last - first < 2 * RADIX, few).otherwise(dyadic_cover(first, last))


def ancestors(day: Column) -> Column:
    """The block of each level that holds a day."""
    return F.array(*[F.struct(F.lit(k).alias("level"), _floor_div(day, RADIX ** k).alias("block")) for k in range(LEVELS)])


def contains_join(points: DataFrame, intervals: DataFrame, on: str | Sequence[str],
                  time_col: str, start_col: str = "starttime", end_col: str = "endtime",
                  closed: str = "both", how: str = "left", short: bool = False,
                  within: tuple[DataFrame, str, str] | None = None, times: DataFrame | None = None) -> DataFrame:
    """Attach the interval(s) containing each point (``p``/``i`` aliases).

    An interval becomes the blocks of its dyadic cover (fewer than 60 for a thousand years), and the
    days on which its key has points find it by their ancestors: an equi-join on (key, level,
    block) of narrow rows, whose result has a row for each interval and each such day it touches.
    Points then join on (key, day) with the exact test, one bucket a point, so no match is met twice and a
    long series is spread over its days.  ``closed`` is both / left / right / neither.

    ``short`` says that intervals are a few days long by their definition (a first day, a stay, a spine that has a row an hour anyway): each
    is then sent to its days as they are, and the points are read once instead of twice.  ``within`` (windows, start, end) says that
    the points come from such windows of their key, one or more: intervals of any length are then sent to those of their days that
    the key's windows reach.  ``times`` has the keys and times of the points, perhaps others too, and is read in their place
    to find their days.  The result is the same.
    """
    keys = _cols(on)
    p = points.withColumn("_bk", day_bucket(F.col(time_col)))
    first, last = day_bucket(F.col(start_col)), day_bucket(F.col(end_col))
    if short:
        touched = intervals.withColumn("_bk", F.explode(F.when(first <= last, F.sequence(first, last))))
    elif within is not None:
        touched = _reached(intervals, keys, first, last, *within)
    else:
        days = p if times is None else times.withColumn("_bk", day_bucket(F.col(time_col)))
        touched = _touched(days, intervals, keys, first, last)
    cond = F.col("p._bk") == F.col("i._bk")
    for k in keys:
        cond = cond & (F.col(f"p.{k}") == F.col(f"i.{k}"))
    cond = cond & between_closed(F.col(f"p.{time_col}"), F.col(f"i.{start_col}"), F.col(f"i.{end_col}"), closed)
    j = p.alias("p").join(touched.alias("i"), cond, how)
    return j.drop(F.col("p._bk")) if how in ("left_semi", "left_anti") else j.drop(F.col("p._bk"), F.col("i._bk"))


def _reached(intervals: DataFrame, keys: list[str], first: Column, last: Column, windows: DataFrame, start_col: str, end_col: str) -> DataFrame:
    """Each interval once for each of its days ``_bk`` between the first and the last day of its key's windows."""
    reach = windows.groupBy(*keys).agg(F.min(day_bucket(F.col(start_col))).alias("_r0"), F.max(day_bucket(F.col(end_col))).alias("_r1"))
    x = intervals.withColumns({"_first": first, "_last": last}).join(reach, keys)
    known = F.col("_first").isNotNull() & F.col("_last").isNotNull() & F.col("_r0").isNotNull() & F.col("_r1").isNotNull()
    lo, hi = F.greatest("_first", "_r0"), F.least("_last", "_r1")       # which pass over NULLs
    return x.select(*intervals.columns, F.explode(F.when(known & (lo <= hi), F.sequence(lo, hi))).alias("_bk"))


def _touched(p: DataFrame, intervals: DataFrame, keys: list[str], first: Column, last: Column) -> DataFrame:
    """Each interval once for each day ``_bk`` from ``first`` to ``last`` on which its key has points."""
    ks = [f"_k{n}" for n in range(len(keys))]
    days = p.select(*[F.col(k).alias(n) for n, k in zip(ks, keys)], F.col("_bk").alias("_day")).where("_day is not null").distinct()
    up = days.select("*", F.explode(ancestors(F.col("_day"))).alias("_b")).select("*", "_b.level", "_b.block").drop("_b")
    cover = intervals.select(F.struct(*intervals.columns).alias("_iv"), *[F.col(k).alias(n) for n, k in zip(ks, keys)],
                             first.alias("_first"), last.alias("_last"))
    cover = cover.select("_iv", *ks, F.explode(_blocks(F.col("_first"), F.col("_last"))).alias("_b")).select("_iv", *ks, "_b.level", "_b.block")
    return up.join(cover, [*ks, "level", "block"]).select("_iv.*", F.col("_day").alias("_bk"))


def asof_within(left: DataFrame, right: DataFrame, on: str | Sequence[str], left_time: str,
                right_time: str, tolerance_seconds: int, values: Sequence[str],
                tiebreak: Sequence[Column] = (), bucket_seconds: int = DAY) -> DataFrame:
    """For each left row, the ``values`` of the latest right row in [t - tol, t] (ties: larger ``tiebreak``), NULL if none.

    Both sides are united by (key, bucket) and ordered by time, right rows first at equal
    times; a running ``last`` carries the latest right row forward.  A bucket is as long as the tolerance at least, so
    the right rows of a bucket are needed there and in the next one only.  Linear in rows, however dense a day is.
    """
    keys = _cols(on)
    width = max(bucket_seconds, tolerance_seconds)
    own = day_bucket(F.col(right_time), width)
    r = right.where(F.col(right_time).isNotNull()).select(
        *keys, F.explode(F.array(own, own + 1)).alias("_bk"), F.col(right_time).alias("_t"), F.lit(0).alias("_side"),
        *[tb.alias(f"_tb{j}") for j, tb in enumerate(tiebreak)],
        F.struct(F.col(right_time).alias("_rt"), *[F.col(v) for v in values]).alias("_r"))
    ties = [f"_tb{j}" for j in range(len(tiebreak))]
    l = left.select(*keys, day_bucket(F.col(left_time), width).alias("_bk"), F.col(left_time).alias("_t"), F.lit(1).alias("_side"),
                    *[F.lit(None).cast(r.schema[c].dataType).alias(c) for c in ties],
                    F.lit(None).cast(r.schema["_r"].dataType).alias("_r"), F.struct(*left.columns).alias("_l"))
    r = r.withColumn("_l", F.lit(None).cast(l.schema["_l"].dataType))
    w = (Window.partitionBy(*keys, "_bk").orderBy("_t", "_side", *[F.col(c).asc_nulls_first() for c in ties])
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    u = l.unionByName(r).withColumn("_last", F.last("_r", ignorenulls=True).over(w)).where("_side = 1")
    ok = F.col("_last._rt") >= F.col("_t") - F.make_dt_interval(secs=F.lit(tolerance_seconds))
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    return u.select("_l.*", *[F.when(ok, F.col(f"_last.{v}")).alias(v) for v in values])


@dataclass(frozen=True)
class Look:
    """One window of :func:`first_in_windows`: rows of ``b`` (``where``) at ``b_at`` from ``a_at - before`` to ``a_at + after``,
    on an integer axis (days, seconds, microseconds); None is an open side.  Several with one ``name`` share a result."""

    name: str
    a_at: Column
    b_at: Column
    before: int | None
    after: int | None
    where: Column | None = None
    block: int = 30

    @property
    def size(self) -> int:
        """Positions of a block: those of the window, so that a window is the end of a block and the beginning of the next."""
        return self.block if self.before is None or self.after is None else self.before + self.after + 1

    @property
    def sides(self) -> list[int]:
        """-1: from the window's beginning to its block's end; 1: from its end's block's beginning to its end."""
        return [s for s, bound in ((-1, self.before), (1, self.after)) if bound is not None]

    @property
    def open(self) -> bool:
        return self.before is None or self.after is None


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-free timestamp: an exact integer axis."""
    return F.unix_micros(ts.cast("timestamp_ltz"))


def date_or_time(name: str, a_time: Column, b_time: Column, date_only: Column, before: int, after: int, days_before: int,
                 days_after: int, strict_before: bool = False, strict_after: bool = False, b_day: Column | None = None) -> list[Look]:
    """Looks for rows whose time may be known to the day only: timed rows in [t - before, t + after] seconds (a ``strict`` end
    left out), date-only ones in [day - days_before, day + days_after].  ``b_day`` is the date where ``b_time`` is NULL."""
    def days(ts):
        return F.unix_date(F.to_date(ts)).cast("long")
    timed = Look(name, micros(a_time), micros(b_time), before * 1_000_000 - strict_before, after * 1_000_000 - strict_after, ~date_only)
    return [timed, Look(name, days(a_time), days(b_time if b_day is None else b_day), days_before, days_after, date_only)]


def first_in_windows(a: DataFrame, b: DataFrame, on: str | Sequence[str], a_id: Sequence[str], looks: Sequence[Look],
                     order: Sequence[tuple], values: Sequence[str]) -> DataFrame:
    """Every row of ``a`` with the ``values`` of the first row of ``b``, by ``order``, in each look's window.

    ``a_id`` identifies a row of ``a``; ``order`` is as for ``top1_agg`` and need not begin with time.  Looks of one name are
    alternatives (timed and date-only rows, say): the first by ``order`` of all of them wins.  Columns are ``<name>_<value>``.
    Both sides are read once; a row of ``b`` is sent to two running minima a look, one of the block's rows up to each
    position and one of those from it, and nothing is compared in pairs.  With an open side the earlier (or later) blocks of
    the key add one row a block.
    """
    keys = _cols(on)
    for look in looks:
        if not look.sides:
            raise ValueError("a window needs a bound")
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()

    def spot(n, side, at, size):
        return F.struct(F.lit(n).alias("look"), F.lit(side).alias("side"), _exact_div(at, size).alias("block"), (at * side).alias("at"))
    b_spots, a_spots = [], []
    for n, look in enumerate(looks):
        for side in look.sides:
            where = look.b_at.isNotNull() if look.where is None else look.b_at.isNotNull() & look.where
            b_spots.append(F.when(where, spot(n, side, look.b_at, look.size)))
            a_spots.append(spot(n, side, look.a_at - look.before if side < 0 else look.a_at + look.after, look.size))
    row = F.struct(order_key(b, order).alias("o"), F.struct(*values).alias("v"))
    rows = b.where(has_key).select(*keys, row.alias("_row"), F.explode(F.array_compact(F.array(*b_spots))).alias("_s")).select(
        *keys, "_s.*", "_row", F.lit(0).alias("_kind"))
    probes = a.select(*keys, F.struct(*a.columns).alias("_a"), F.explode(F.array(*a_spots)).alias("_s")).select(
        *keys, "_s.*", "_a", F.lit(1).alias("_kind"))
    at = [*keys, "look", "side", "block"]
    everything = rows.unionByName(probes, allowMissingColumns=True)
    if any(look.open for look in looks):
        some = F.col("look").isin([n for n, look in enumerate(looks) if look.open])
        blocks = everything.where(some).groupBy(*at).agg(F.min("_row").alias("_least"))
        before = (Window.partitionBy(*keys, "look", "side").orderBy(F.col("block") * F.col("side"))
                  .rowsBetween(Window.unboundedPreceding, -1))
        carried = blocks.select(*at, F.min("_least").over(before).alias("_row"), F.lit(0).alias("_kind")).where("_row is not null")
        everything = everything.unionByName(carried, allowMissingColumns=True)
    running = (Window.partitionBy(*at).orderBy(F.col("at").asc_nulls_first(), "_kind")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    met = everything.withColumn("_best", F.min("_row").over(running)).where("_kind = 1")
    names = list(dict.fromkeys(look.name for look in looks))
    best = met.groupBy(*[F.col(f"_a.{c}").alias(f"_id{n}") for n, c in enumerate(a_id)]).agg(F.first("_a").alias("_a"), *[
        F.min(F.when(F.col("look").isin([n for n, look in enumerate(looks) if look.name == name]), F.col("_best"))).alias(f"_b_{name}")
        for name in names])
    return best.select("_a.*", *[F.col(f"_b_{name}.v.{v}").alias(f"{name}_{v}") for name in names for v in values])


def _exact_div(x: Column, n: int) -> Column:
    """Floor of a long by ``n`` without doubles: microseconds can exceed 53 bits."""
    n = F.lit(n).cast("long")
    return F.call_function("div", x - F.pmod(x, n), n)
