"""Local stand-in for the driver's correctness gate: run a Spark query and its
DuckDB SQL on the same parquet tables and compare rows order-insensitively."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

from tessera.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, bool):
        return bool(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, int):
        return int(v)
    return str(v)


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark_df, con, sql: str) -> dict:
    s_pdf = spark_df.toPandas()
    d_pdf = con.execute(sql).df()
    res = {
        "rows_spark": len(s_pdf),
        "rows_oracle": len(d_pdf),
        "cols_spark": sorted(s_pdf.columns),
        "cols_oracle": sorted(d_pdf.columns),
    }
    res["schema_ok"] = res["cols_spark"] == res["cols_oracle"]
    res["rows_ok"] = len(s_pdf) == len(d_pdf)
    if res["schema_ok"] and res["rows_ok"]:
        a, b = _rows(s_pdf), _rows(d_pdf)
        res["values_ok"] = a == b
        if not res["values_ok"]:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            res["first_diff"] = diff
    else:
        res["values_ok"] = False
    res["ok"] = res["schema_ok"] and res["rows_ok"] and res["values_ok"]
    return res
