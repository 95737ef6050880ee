"""Compare a Spark query with its SQL counterpart, value by value."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, Decimal):
        return str(value.normalize())
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return None if value is None else str(value)


_SPARK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when columns, types, row count and all values agree."""
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    theirs = {r[0]: r[1] for r in described}
    ours = {f.name: f.dataType.simpleString() for f in df.schema}
    problems = []
    if sorted(theirs) != sorted(ours):
        return [f"columns {sorted(ours)} against {sorted(theirs)}"]
    for c, kind in ours.items():
        if _SPARK_TYPES.get(kind, kind) != theirs[c]:
            problems.append(f"type of {c}: {kind} against {theirs[c]}")
    names = sorted(ours)
    left = sorted(tuple(_plain(r[c]) or "" for c in names) for r in df.collect())
    order = ", ".join(f'"{c}"' for c in names)
    found = con.execute(f"SELECT {order} FROM ({sql})").fetchall()
    right = sorted(tuple(_plain(v) or "" for v in r) for r in found)
    if len(left) != len(right):
        problems.append(f"{len(left)} rows against {len(right)}")
    if left != right:
        a, b = set(left) - set(right), set(right) - set(left)
        problems.append(f"only spark: {sorted(a)[:2]} only sql: {sorted(b)[:2]} of {names}")
    if not left:
        problems.append("no rows")
    return problems
