"""Compare a registered query with its SQL counterpart run by DuckDB on the same files."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def spark_kind(name: str) -> str:
    return {"bigint": "BIGINT", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "int": "INTEGER"}.get(
        name, name.upper()
    )


def differences(df, con, sql: str) -> list[str]:
    """Empty when names, types and rows agree (rows in any order)."""
    columns = sorted(df.columns)
    rel = con.sql(sql)
    problems = []
    if sorted(rel.columns) != columns:
        return [f"columns: spark {columns} / sql {sorted(rel.columns)}"]
    kinds = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for field in df.schema.fields:
        have, want = spark_kind(field.dataType.simpleString()), kinds[field.name]
        if have != want:
            problems.append(f"type of {field.name}: spark {have} / sql {want}")
    got = Counter(tuple(cell(row[c]) for c in columns) for row in df.collect())
    order = [rel.columns.index(c) for c in columns]
    want = Counter(tuple(cell(row[i]) for i in order) for row in rel.fetchall())
    if got != want:
        extra, lacking = got - want, want - got
        problems.append(
            f"rows: spark {sum(got.values())} / sql {sum(want.values())}; columns {columns}; "
            f"only spark {list(extra)[:2]}; only sql {list(lacking)[:2]}"
        )
    return problems
