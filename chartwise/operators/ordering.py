"""Orders as one comparable struct, ordinals and neighbours of rows, and the n first rows of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType


def order_key(df: DataFrame, order: Sequence[tuple]) -> Column:
    """A struct whose natural order is ``order``: items ``(column, "asc" | "desc", nulls_last)``; ``nulls_last`` None means Spark's
    default (asc: NULLS FIRST, desc: NULLS LAST).  Descending keys must be numeric, date or timestamp (encoded by negation)."""
    comps = []
    for name, direction, nulls_last in order:
        c = F.col(name)
        if direction == "asc":
            if nulls_last:
                comps.append(c.isNull())
            comps.append(c)
            continue
        dt = df.schema[name].dataType
        if isinstance(dt, NumericType):
            neg = -c
        elif isinstance(dt, (TimestampType, TimestampNTZType)):
            neg = -F.unix_micros(c.cast("timestamp_ltz"))
        elif isinstance(dt, DateType):
            neg = -F.unix_date(c)
        else:
            raise TypeError(f"descending key {name} of type {dt} is not encodable")
        comps += [c.isNull() if (nulls_last is None or nulls_last) else c.isNotNull(), neg]
    return F.struct(*[x.alias(f"_o{i}") for i, x in enumerate(comps)])


def top1_agg(df: DataFrame, by: Sequence[str], order: Sequence[tuple]) -> DataFrame:
    """P25: the first row per ``by`` under ``order`` (see :func:`order_key`), by ``min_by`` with map-side partial
    aggregation: a hot group is reduced in pieces instead of being sorted by one task."""
    rest = [c for c in df.columns if c not in by]
    out = df.groupBy(*by).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), order_key(df, order)).alias("_top"))
    return out.select(*by, *[F.col(f"_top.{c}").alias(c) for c in rest]).select(*df.columns)


def top_n(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, ordinal: str = "_ord", parts: int = 32) -> DataFrame:
    """The ``n`` first rows per ``by`` with their number, in two phases: the n first of each of ``parts`` pieces of a
    group, then the n first of those (``n * parts`` rows at most), so that no group is sorted whole.  ``order`` should be total."""
    piece = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(parts))
    first = Window.partitionBy(*by, "_piece").orderBy(*order)
    some = df.withColumn("_piece", piece).withColumn(ordinal, F.row_number().over(first)).where(F.col(ordinal) <= n).drop("_piece", ordinal)
    return some.withColumn(ordinal, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(ordinal) <= n)


def pivot_ordinal(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, n: int, prefix: str) -> DataFrame:
    """The first ``n`` values per key by ``order`` as columns."""
    return top_n(df, keys, order, n).groupBy(*keys).agg(*[
        F.max(F.when(F.col("_ord") == k, F.col(value))).alias(f"{prefix}{k}") for k in range(1, n + 1)])


def _offsets(df: DataFrame, key: str, bucket: Column, aggs: Sequence[Column]) -> DataFrame:
    """One row per key and bucket: (_k, _sb, aggregates)."""
    return df.withColumn("_b", bucket).groupBy(F.col(key).alias("_k"), F.col("_b").alias("_sb")).agg(*aggs)


def _with_summary(df: DataFrame, key: str, summary: DataFrame) -> DataFrame:
    """NULL keys and buckets are partitions of their own, as in PARTITION BY."""
    return df.join(summary, F.col(key).eqNullSafe(F.col("_k")) & F.col("_b").eqNullSafe(F.col("_sb")), "left")


def ordinal(df: DataFrame, key: str, bucket: Column, order: Sequence[Column], name: str) -> DataFrame:
    """``row_number() over (partition by key order by bucket, order)`` without a sort of a whole key: numbered inside (key,
    bucket), plus the rows of the key's earlier buckets.  ``bucket`` must not decrease along the order."""
    x = df.withColumn("_b", bucket)
    x = x.withColumn("_in", F.row_number().over(Window.partitionBy(key, "_b").orderBy(*order)))
    earlier = Window.partitionBy("_k").orderBy(F.col("_sb").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    count = _offsets(df, key, bucket, [F.count("*").alias("_n")])
    count = count.select("_k", "_sb", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return _with_summary(x, key, count).select(*df.columns, (F.col("_before") + F.col("_in")).cast("long").alias(name))


def neighbours(df: DataFrame, key: str, bucket: Column, order: Sequence[tuple], cols: Sequence[str]) -> DataFrame:
    """Values of the previous and the next row per key (``prev_<c>`` / ``next_<c>``) under ``order`` (as for
    :func:`order_key`; ties beyond it are open) without a sort of a whole key: ``lag`` / ``lead`` inside (key, bucket), and across
    the borders the last / first row of the nearest non-empty bucket, from one summary row per key and bucket.
    ``bucket`` must not decrease along the order; a NULL bucket comes first."""
    by = order_key(df, order)
    x = df.withColumn("_b", bucket).withColumn("_o", by)
    w = Window.partitionBy(key, "_b").orderBy("_o")
    x = x.select("*", F.lag(F.lit(1)).over(w).alias("_has"), F.lead(F.lit(1)).over(w).alias("_more"),
                 *[F.lag(c).over(w).alias(f"_ip_{c}") for c in cols], *[F.lead(c).over(w).alias(f"_in_{c}") for c in cols])
    row = F.struct(*[F.col(c) for c in cols])
    ends = _offsets(df, key, bucket, [F.max_by(row, by).alias("_last"), F.min_by(row, by).alias("_first")])
    wb = Window.partitionBy("_k").orderBy(F.col("_sb").asc_nulls_first())
    ends = ends.select("_k", "_sb", F.lag("_last").over(wb).alias("_pl"), F.lead("_first").over(wb).alias("_nf"))
    x = _with_summary(x, key, ends)
    return x.select(*df.columns,
                    *[F.when(F.col("_has").isNull(), F.col(f"_pl.{c}")).otherwise(F.col(f"_ip_{c}")).alias(f"prev_{c}") for c in cols],
                    *[F.when(F.col("_more").isNull(), F.col(f"_nf.{c}")).otherwise(F.col(f"_in_{c}")).alias(f"next_{c}") for c in cols])
