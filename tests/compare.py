"""Row-for-row comparison of a Spark result with DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
FAMILY = {
    "bigint": "int64", "BIGINT": "int64", "int": "int32", "INTEGER": "int32", "double": "double", "DOUBLE": "double",
    "string": "string", "VARCHAR": "string", "date": "date", "DATE": "date", "boolean": "bool", "BOOLEAN": "bool",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        if path.exists():
            files = f"{path}/*.parquet" if path.is_dir() else path
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{files}')")
    return con


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (0, "") if math.isnan(value) else (1, repr(value))
    return (1, repr(value))


def mismatch(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when names, types and all rows agree exactly; otherwise what differs."""
    rel = con.sql(sql)
    theirs = dict(zip(rel.columns, map(str, rel.types)))
    ours = dict(result.dtypes)
    if sorted(ours) != sorted(theirs):
        return f"columns {sorted(ours)} != {sorted(theirs)}"
    names = sorted(ours)
    types = [f"{n}: {ours[n]} != {theirs[n]}" for n in names if FAMILY.get(ours[n], ours[n]) != FAMILY.get(theirs[n], theirs[n])]
    if types:
        return "types " + "; ".join(types)
    select = ", ".join(f'"{n}"' for n in names)
    b = sorted(tuple(map(_cell, r)) for r in con.sql(f"SELECT {select} FROM ({sql})").fetchall())
    a = sorted(tuple(map(_cell, r)) for r in result.select(*names).collect())
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    different = [(x, y) for x, y in zip(a, b) if x != y]
    if different:
        return f"{len(different)} of {len(a)} rows differ, e.g. {different[0]}"
    return None
