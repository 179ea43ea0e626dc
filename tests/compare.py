"""Run a catalog query on Spark and its SQL on DuckDB, and compare."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def family(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, (float, decimal.Decimal)):
        return "float"
    return type(value).__name__


def norm(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return f"{round(value, 6) + 0.0:.6f}"
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return str(value)


def type_family(t: str) -> str:
    t = t.lower()
    if t.startswith(("tinyint", "smallint", "int", "bigint", "hugeint", "long")):
        return "hugeint" if t.startswith("hugeint") else "bigint" if t.startswith(("bigint", "long")) else "int"
    if t.startswith(("double", "float")):
        return "double"
    if t.startswith(("varchar", "string")):
        return "string"
    return t


def mismatch(spark_df, con, sql: str) -> str | None:
    """None when equal, else the first difference found."""
    rel = con.sql(sql)
    left, right = sorted(spark_df.columns), sorted(rel.columns)
    if left != right:
        return f"columns {left} vs {right}"
    stypes = {f.name: type_family(f.dataType.simpleString()) for f in spark_df.schema.fields}
    dtypes = {n: type_family(str(t)) for n, t in zip(rel.columns, rel.types)}
    if stypes != dtypes:
        return f"types { {k: (stypes[k], dtypes[k]) for k in stypes if stypes[k] != dtypes[k]} }"
    a = sorted(tuple(norm(v) for v in row) for row in spark_df.select(*left).collect())
    order = [rel.columns.index(c) for c in left]
    b = sorted(tuple(norm(row[i]) for i in order) for row in rel.fetchall())
    if not a:
        return "no rows"
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}; only spark {[x for x in a if x not in set(b)][:3]} only sql {[x for x in b if x not in set(a)][:3]}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ ({left}); first {bad[0]}"
    return None
