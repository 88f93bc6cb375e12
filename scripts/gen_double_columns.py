"""Regenerate oracle/double_columns.py: the DOUBLE output columns of each oracle
statement (so oracle_sql() needs no data files to add the rounding wrapper)."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import oracle.catalog as cat  # noqa: E402


def main():
    con = cat._probe()
    out = {}
    for name, sql in sorted(cat.all_sql().items()):
        cols = con.execute(f"DESCRIBE {sql}").fetchall()
        out[name] = [c[0] for c in cols if c[1].upper() in ("DOUBLE", "FLOAT", "REAL")]
    path = os.path.join(os.path.dirname(cat.__file__), "double_columns.py")
    with open(path, "w") as f:
        f.write('"""Generated by scripts/gen_double_columns.py: DOUBLE output columns per oracle."""\n\n')
        f.write("DOUBLE_COLUMNS = {\n")
        for k, v in out.items():
            f.write(f"    {k!r}: {v!r},\n")
        f.write("}\n")
    print(f"{len(out)} statements")


if __name__ == "__main__":
    main()
