"""Order-insensitive frame comparison (column names, dtypes, values)."""

import hashlib

import pandas as pd


def norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:  # DATE arrives as python dates from Spark, datetime64 from DuckDB
        if str(df[c].dtype).startswith("datetime64"):
            df[c] = df[c].dt.date.astype(object)
    return df


def value_hash(df: pd.DataFrame) -> str:
    rows = sorted("|".join("None" if (v is None or (isinstance(v, float) and v != v))
                           else repr(v.item() if hasattr(v, "item") else v) for v in r)
                  for r in df.astype(object).itertuples(index=False))
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()


def _int_with_nulls(a: pd.Series, b: pd.Series) -> bool:
    kinds = {str(a.dtype), str(b.dtype)}
    return "float64" in kinds and any(k.startswith("Int") for k in kinds)


def diff(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame, nullable_ints: bool = False) -> list[str]:
    """Problems found; ``nullable_ints`` accepts an integer column holding NULLs
    that one side converts to float64 and the other to a nullable Int type."""
    s, o = norm(spark_pdf), norm(oracle_pdf)
    if nullable_ints:
        for c in set(s.columns) & set(o.columns):
            if _int_with_nulls(s[c], o[c]):
                s[c], o[c] = s[c].astype("Int64"), o[c].astype("Int64")
    problems = []
    if list(s.columns) != list(o.columns):
        return [f"columns {list(s.columns)} != {list(o.columns)}"]
    if len(s) != len(o):
        problems.append(f"rows {len(s)} != {len(o)}")
    types = {c: (str(s[c].dtype), str(o[c].dtype)) for c in s.columns
             if str(s[c].dtype) != str(o[c].dtype)}
    if types:
        problems.append(f"dtypes {types}")
    if value_hash(s) != value_hash(o):
        problems.append("values differ")
    return problems
