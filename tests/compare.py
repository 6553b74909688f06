"""Run a query in both engines and compare names, types and values."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _order(row):
    return tuple((v is None, str(type(v)), "nan" if isinstance(v, float) and math.isnan(v) else v) if not isinstance(v, bool)
                 else (False, "b", int(v)) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return (math.isnan(a) and math.isnan(b)) or a == b or abs(a - b) <= 1e-9 * max(abs(a), abs(b))
    return type(a) is type(b) and a == b


def difference(df, con, sql: str) -> str | None:
    """None if equal, else what differs first."""
    names = sorted(df.columns)
    spark_types = {n: TYPES.get(t, t) for n, t in df.dtypes}
    rows = sorted((tuple(r[n] for n in names) for r in df.collect()), key=_order)
    cursor = con.execute(sql)
    described = {d[0]: str(d[1]) for d in cursor.description}
    if sorted(described) != names:
        return f"columns {names} != {sorted(described)}"
    places = [list(described).index(n) for n in names]
    expected = sorted((tuple(r[p] for p in places) for r in cursor.fetchall()), key=_order)
    if described != spark_types:
        return f"types {spark_types} != {described}"
    if len(rows) != len(expected):
        return f"rows {len(rows)} != {len(expected)}"
    if not rows:
        return "both are empty"
    for got, want in zip(rows, expected):
        if not all(_same(a, b) for a, b in zip(got, want)):
            return f"{names}: {got} != {want}"
    return None
