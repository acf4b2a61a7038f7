"""Spark-vs-DuckDB result comparison used by the oracle tests.

Mirrors the driver's check: column names sorted, row order ignored, values
canonicalised (dates as ISO text, floats rounded), multisets compared.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    return str(v)


def canon_rows(names: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return ([names[i] for i in order],
            Counter(tuple(_canon(r[i]) for i in order) for r in rows))


def kind_of_spark(dtype: str) -> str:
    """Type families that must agree: how a value is stored, not how wide."""
    return ("integer" if dtype in ("tinyint", "smallint", "int", "bigint") else
            "real" if dtype in ("float", "double") or dtype.startswith("decimal") else
            "timestamp" if dtype.startswith("timestamp") else dtype)


def kind_of_duck(dtype: str) -> str:
    dtype = dtype.upper()
    return ("integer" if dtype in ("TINYINT", "SMALLINT", "INTEGER", "BIGINT", "HUGEINT", "UBIGINT") else
            "real" if dtype in ("FLOAT", "DOUBLE") or dtype.startswith("DECIMAL") else
            "timestamp" if dtype.startswith("TIMESTAMP") else
            {"VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date"}.get(dtype, dtype.lower()))


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> dict:
    s_names = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    d_names = [d[0] for d in cur.description]
    d_kinds = {d[0]: kind_of_duck(str(d[1])) for d in cur.description}
    s_kinds = {name: kind_of_spark(kind) for name, kind in spark_df.dtypes}
    d_rows = cur.fetchall()
    sn, sc = canon_rows(s_names, s_rows)
    dn, dc = canon_rows(d_names, d_rows)
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "names_match": sn == dn, "types_match": s_kinds == d_kinds, "values_match": sc == dc}
    if sn != dn:
        out["spark_names"], out["oracle_names"] = sn, dn
    elif sc != dc:
        out["only_spark"] = list((sc - dc).elements())[:5]
        out["only_oracle"] = list((dc - sc).elements())[:5]
    if s_kinds != d_kinds:
        out["spark_types"], out["oracle_types"] = s_kinds, d_kinds
    out["ok"] = out["names_match"] and out["types_match"] and out["values_match"]
    return out
