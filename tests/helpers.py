import math

import pandas as pd


def canon(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return str(int(v)) if v.is_integer() else repr(v)
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    if hasattr(v, "item"):
        return canon(v.item())
    return str(v)


def table_rows(df: pd.DataFrame):
    cols = sorted(df.columns)
    out = [tuple(canon(x) for x in rec) for rec in df[cols].itertuples(index=False)]
    return cols, sorted(out, key=lambda r: tuple("" if x is None else x for x in r))


def rows(df, cols=None):
    """Collect a Spark DataFrame to a list of tuples (sorted, None-safe)."""
    pdf = df.toPandas()
    cols = cols or list(pdf.columns)
    out = [tuple(canon(x) for x in rec) for rec in pdf[cols].itertuples(index=False)]
    return sorted(out, key=lambda r: tuple("" if x is None else x for x in r))
