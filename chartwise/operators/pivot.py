"""EAV pivots.

An EAV event log (entity, time, itemid, value, valuenum) becomes one row per
key with one column per concept item.  The work is one ``groupBy`` with
conditional aggregates: Spark plans it as a partial (map-side) aggregate, one
shuffle on the keys, and a final aggregate, all in whole-stage codegen.  The
``itemid IN (...)`` prefilter reaches the parquet scan as a pushed ``In``
filter when the input is a table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_AGGS: dict[str, Callable[[Column], Column]] = {
    "max": F.max, "min": F.min, "avg": F.avg, "sum": F.sum, "first": F.first,
}


@dataclass(frozen=True)
class ItemSpec:
    """One output column of a pivot.

    ``ids``: itemids merged into the column.  ``value``: source column name or
    a Column expression.  ``lo``/``hi``: plausibility clip (P02) - values
    outside become NULL before aggregation, the row stays.  ``strict_lo`` /
    ``strict_hi`` choose ``>`` / ``<`` (default) versus ``>=`` / ``<=``.
    ``cond``: extra per-row predicate; ``transform``: unit harmonisation (P03)
    applied to the value after the clip test.
    """

    ids: Sequence[int]
    value: str | Column = "valuenum"
    agg: str = "max"
    lo: float | None = None
    hi: float | None = None
    strict_lo: bool = True
    strict_hi: bool = True
    cond: Column | None = None
    transform: Callable[[Column], Column] | None = None
    extra: Sequence[tuple] = field(default_factory=tuple)


def clip(v: Column, lo=None, hi=None, strict_lo=True, strict_hi=True) -> Column:
    """P02 predicate: v within (lo, hi) with chosen strictness; no bound -> TRUE."""
    conds = []
    if lo is not None:
        conds.append(v > F.lit(lo) if strict_lo else v >= F.lit(lo))
    if hi is not None:
        conds.append(v < F.lit(hi) if strict_hi else v <= F.lit(hi))
    out = F.lit(True)
    for c in conds:
        out = out & c
    return out


def item_value(spec: ItemSpec, item_col: str = "itemid") -> Column:
    """CASE WHEN itemid IN ids AND clip AND cond THEN transform(value) END."""
    v = F.col(spec.value) if isinstance(spec.value, str) else spec.value
    cond = F.col(item_col).isin(list(spec.ids)) & clip(v, spec.lo, spec.hi, spec.strict_lo, spec.strict_hi)
    if spec.cond is not None:
        cond = cond & spec.cond
    out = spec.transform(v) if spec.transform is not None else v
    return F.when(cond, out)


def pivot_items(df: DataFrame, keys: Sequence[str], specs: Mapping[str, "ItemSpec | Column"],
                item_col: str = "itemid", extra_aggs: Sequence[Column] = (),
                prefilter: Column | None = None, extra_ids: Sequence[int] = ()) -> DataFrame:
    """Filter to the spec items, then one conditional aggregate per column.

    A spec may also be a ready aggregate Column (for columns that merge items
    with different clips); its items must then be listed in ``extra_ids``.
    """
    ids = sorted({i for s in specs.values() if isinstance(s, ItemSpec) for i in s.ids} | set(extra_ids))
    x = df.where(F.col(item_col).isin(ids))
    if prefilter is not None:
        x = x.where(prefilter)
    aggs = [(_AGGS[s.agg](item_value(s, item_col)) if isinstance(s, ItemSpec) else s).alias(name)
            for name, s in specs.items()]
    return x.groupBy(*keys).agg(*extra_aggs, *aggs)


@dataclass(frozen=True)
class Panel:
    """A pivot's items by name, its row filter, and items that only ready aggregate Columns read (``extra_ids``)."""

    specs: Mapping[str, "ItemSpec | Column"]
    prefilter: Column
    extra_ids: Sequence[int] = ()

    def ids(self) -> list[int]:
        return sorted({i for s in self.specs.values() if isinstance(s, ItemSpec) for i in s.ids} | set(self.extra_ids))


def pivot_panels(df: DataFrame, keys: Sequence[str], panels: Mapping[str, Panel], item_col: str = "itemid",
                 extra_aggs: Sequence[Column] = (), tag: str = "panel") -> DataFrame:
    """P01 for several panels in one scan and one shuffle: what ``pivot_items`` gives for each panel, as rows
    marked by ``tag`` with the columns ``<panel>__<name>`` (null in other panels' rows).

    A row is grouped once for each panel that has its item; ``extra_aggs`` see only that panel's rows.
    """
    own = {name: F.coalesce(F.col(item_col).isin(p.ids()) & p.prefilter, F.lit(False)) for name, p in panels.items()}
    tags = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in own.items()]))
    x = df.where(F.col(item_col).isin(sorted({i for p in panels.values() for i in p.ids()})))
    x = x.select("*", F.explode(tags).alias(tag))
    aggs = []
    for name, p in panels.items():
        for col, s in p.specs.items():
            value = _AGGS[s.agg](item_value(s, item_col)) if isinstance(s, ItemSpec) else s
            # other panels' rows form other groups, whose value is not this panel's
            aggs.append(F.when(F.col(tag) == name, value).alias(f"{name}__{col}"))
    return x.groupBy(*keys, tag).agg(*extra_aggs, *aggs)


def pivot_panels_together(df: DataFrame, keys: Sequence[str], panels: Mapping[str, Panel], ids: Sequence[str],
                          item_col: str = "itemid") -> DataFrame:
    """P01 for several panels in one scan and one row a key: the columns ``<panel>__<name>`` and the greatest of each of ``ids``.

    A key's panels share one aggregate, so its width is paid once a key, not once a panel.  ``ids`` are those of a panel's own rows; where
    panels of a key differ in them, the key has a row for each distinct set, with NULL in the columns of the panels that have another.
    Every spec must be an :class:`ItemSpec` (a ready aggregate cannot be kept to its panel's rows).
    """
    own = {name: F.col(item_col).isin(p.ids()) & p.prefilter for name, p in panels.items()}
    # by the items alone: a key without a row that its panel keeps has no ids and goes with them below, and a filter that repeats the panels'
    # conditions on a derived value makes the scan's generated code too long to be compiled
    x = df.where(F.col(item_col).isin(sorted({i for p in panels.values() for i in p.ids()})))
    aggs = []
    for name, p in panels.items():
        aggs += [F.max(F.when(own[name], F.col(c))).alias(f"_{name}__{c}") for c in ids]
        aggs.append(F.max(F.when(own[name], F.lit(True))).alias(f"_{name}"))
        aggs += [_AGGS[s.agg](F.when(p.prefilter, item_value(s, item_col))).alias(f"{name}__{c}") for c, s in p.specs.items()]
    x = x.groupBy(*keys).agg(*aggs)
    held = {name: F.struct(*[F.col(f"_{name}__{c}").alias(c) for c in ids]) for name in panels}
    x = x.withColumn("_of", F.explode(F.array_distinct(F.array(*[F.when(F.col(f"_{n}"), held[n]) for n in panels])))).where("_of is not null")
    x = x.withColumns({f"_{n}": held[n].eqNullSafe(F.col("_of")) for n in panels})       # compared once a panel, not once a column
    return x.select(*[F.col(f"_of.{c}").alias(c) for c in ids], *keys, *[
        F.when(F.col(f"_{n}"), F.col(f"{n}__{c}")).alias(f"{n}__{c}") for n, p in panels.items() for c in p.specs])


def impute_from_ratio(total: Column, pct: Column, absolute: Column, allowed: Column) -> Column:
    """absolute = pct * total / 100 when absolute is missing and ``allowed``."""
    return F.when(absolute.isNull() & allowed, pct * total / F.lit(100.0)).otherwise(absolute)
