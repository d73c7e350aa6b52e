"""Result comparison used by the oracle tests and scripts/compare_oracle.py.

Order-insensitive: rows are normalised to text (doubles rounded to 9 places,
integral doubles as integers, dates and timestamps as ISO text), sorted and
hashed over columns sorted by name.
"""

from __future__ import annotations

import datetime
import hashlib
import math

import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v) -> str:
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        v = round(v, 9)
        return str(int(v)) if v.is_integer() else repr(v)
    if isinstance(v, (pd.Timestamp, datetime.datetime, datetime.date)):
        return pd.Timestamp(v).isoformat()
    return str(v)


def normalised_rows(df: pd.DataFrame) -> list[str]:
    cols = sorted(df.columns)
    return sorted("|".join(_norm(v) for v in row)
                  for row in df[cols].astype(object).itertuples(index=False))


def table_hash(df: pd.DataFrame) -> str:
    return hashlib.sha256("\n".join(normalised_rows(df)).encode()).hexdigest()[:16]


def duckdb_connection(sf_dir: str):
    import os

    import duckdb

    con = duckdb.connect()
    con.execute("SET timezone='UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def compare(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame) -> dict:
    same_cols = sorted(spark_pdf.columns) == sorted(oracle_pdf.columns)
    result = {"rows": (len(spark_pdf), len(oracle_pdf)), "columns": same_cols}
    if same_cols:
        a, b = normalised_rows(spark_pdf), normalised_rows(oracle_pdf)
        result["hash"] = a == b
        result["only_spark"] = sorted(set(a) - set(b))[:5]
        result["only_oracle"] = sorted(set(b) - set(a))[:5]
    else:
        result["hash"] = False
    result["ok"] = same_cols and result["hash"] and len(spark_pdf) == len(oracle_pdf)
    return result
