"""All oracle statements by query name, and the double-rounding wrapper."""

from __future__ import annotations

import functools
import os

from . import compose
from . import measurement, firstday, demographics, treatment, scores, kidney, organ, sepsis  # noqa: F401  (register CTEs)
from . import native

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
_PROBE_DIRS = ("/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1")


def all_sql() -> dict[str, str]:
    from chartwise.plans.registry import REGISTRY, _load_all

    _load_all()
    out = {name: compose.concept_sql(name) for name in sorted(REGISTRY) if name in compose.CTE}
    out.update(native.SQL)
    return out


@functools.lru_cache(maxsize=1)
def _probe():
    import duckdb

    con = duckdb.connect()
    for d in _PROBE_DIRS:
        if os.path.exists(f"{d}/events.parquet"):
            for t in TABLES:
                if os.path.exists(f"{d}/{t}.parquet"):
                    con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
            return con
    return None


def _double_columns(sql: str, name: str | None):
    """DOUBLE output columns: from the generated map, else via DESCRIBE."""
    try:
        from .double_columns import DOUBLE_COLUMNS
    except ImportError:
        DOUBLE_COLUMNS = {}
    if name in DOUBLE_COLUMNS:
        return set(DOUBLE_COLUMNS[name]), None
    con = _probe()
    if con is None:
        return None, None
    cols = con.execute(f"DESCRIBE {sql}").fetchall()
    return {c[0] for c in cols if c[1].upper() in ("DOUBLE", "FLOAT", "REAL")}, [c[0] for c in cols]


def rounded(sql: str, digits: int, name: str | None = None) -> str:
    """Wrap ``sql`` so DOUBLE/FLOAT columns are rounded; other columns pass through."""
    doubles, _ = _double_columns(sql, name)
    if doubles is None:
        return sql
    if not doubles:
        return sql
    fine = "CAST(1000000000.0 AS DOUBLE)"
    scale = f"CAST({10.0 ** digits!r} AS DOUBLE)"
    repl = ", ".join(
        f'round((round("{c}" * {fine}) / {fine}) * {scale}) / {scale} AS "{c}"' for c in sorted(doubles))
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS _q"
