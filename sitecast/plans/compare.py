"""Order-insensitive comparison of a Spark result with DuckDB oracle SQL:
column names, row count and a hash of the values (floats at 6 decimals)."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os

from sitecast.sources.tables import TABLES


def norm(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else f"{round(v, 6):.6f}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


# Spark type -> the DuckDB type of the same column.
DUCK_TYPES = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "DoubleType()": "DOUBLE",
              "FloatType()": "FLOAT", "StringType()": "VARCHAR", "TimestampNTZType()": "TIMESTAMP",
              "BooleanType()": "BOOLEAN", "DateType()": "DATE",
              "ArrayType(TimestampNTZType(), True)": "TIMESTAMP[]", "ArrayType(DoubleType(), True)": "DOUBLE[]",
              "ArrayType(LongType(), True)": "BIGINT[]"}


def compare(df, con, oracle: str) -> dict:
    rows = [tuple(r) for r in df.collect()]
    res = con.sql(oracle)
    ocols, orows = res.columns, res.fetchall()
    h1, l1 = digest(df.columns, rows)
    h2, l2 = digest(ocols, orows)
    stypes = {f.name: DUCK_TYPES.get(str(f.dataType), str(f.dataType)) for f in df.schema.fields}
    otypes = {c: str(t) for c, t in zip(ocols, res.types)}
    out = {"rows": len(rows), "oracle_rows": len(orows),
           "names": sorted(df.columns) == sorted(ocols), "hash": h1 == h2,
           "types": stypes == otypes}
    if not out["types"]:
        out["type_diff"] = {c: (stypes[c], otypes.get(c)) for c in stypes if stypes[c] != otypes.get(c)}
    if not out["hash"]:
        out["diff"] = sorted(set(l1) ^ set(l2))[:4]
    return out
