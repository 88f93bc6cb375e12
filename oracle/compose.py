"""Assemble a runnable DuckDB statement: adapter CTEs + concept CTEs + final select."""

from __future__ import annotations

from . import adapters

# name -> (dependencies, SQL body); filled by the oracle modules
CTE: dict[str, tuple[tuple[str, ...], str]] = {}


def define(name: str, deps: tuple[str, ...], sql: str) -> None:
    CTE[name] = (tuple(deps), sql)


def _order(targets):
    seen, out = set(), []

    def visit(n):
        if n in seen or n not in CTE:
            return
        seen.add(n)
        for d in CTE[n][0]:
            visit(d)
        out.append(n)

    for t in targets:
        visit(t)
    return out


def statement(final_sql: str, uses: tuple[str, ...]) -> str:
    """WITH <adapters>, <needed concept CTEs> <final_sql>."""
    names = _order(uses)
    parts = [adapters.prefix()]
    for n in names:
        parts.append(f",\n{n} AS ({CTE[n][1]}\n)")
    return "".join(parts) + "\n" + final_sql


def concept_sql(name: str) -> str:
    return statement(f"SELECT * FROM {name}", (name,))
