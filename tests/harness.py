"""Compare a Spark result with its DuckDB oracle, order-insensitively."""

from __future__ import annotations

import datetime
from collections import Counter
import math

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits: int):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, datetime.date):
        return datetime.datetime(v.year, v.month, v.day)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if math.isinf(v):
            return v
        return v if digits >= 17 else round(v, digits)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item"):
        return _norm(v.item(), digits)
    return v


def _rows(df: pd.DataFrame, digits: int) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v, digits) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame, digits: int = 6) -> dict:
    res = {
        "rows_spark": len(spark_pdf), "rows_oracle": len(duck_pdf),
        "cols_match": sorted(spark_pdf.columns) == sorted(duck_pdf.columns),
    }
    res["rows_match"] = res["rows_spark"] == res["rows_oracle"]
    if not (res["cols_match"] and res["rows_match"]):
        res["values_match"] = False
        res["cols_spark"] = sorted(spark_pdf.columns)
        res["cols_oracle"] = sorted(duck_pdf.columns)
        return res
    a, b = Counter(_rows(spark_pdf, digits)), Counter(_rows(duck_pdf, digits))
    res["values_match"] = a == b
    if a != b:
        only_a, only_b = a - b, b - a
        res["n_diff"] = sum(only_a.values())
        res["only_spark"] = list(only_a)[:2]
        res["only_oracle"] = list(only_b)[:2]
    exact_a, exact_b = Counter(_rows(spark_pdf, 17)), Counter(_rows(duck_pdf, 17))
    res["exact_match"] = exact_a == exact_b
    if exact_a != exact_b:
        res["exact_only_spark"] = list(exact_a - exact_b)[:1]
        res["exact_only_oracle"] = list(exact_b - exact_a)[:1]
    return res
