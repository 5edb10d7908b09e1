"""Run registered queries next to their SQL and compare rows, names and values."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value) if not isinstance(value, bool) else str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql):
    """None when equal, else a description of the first difference."""
    relation = con.sql(sql)
    want_names = list(relation.columns)
    got_names = spark_df.columns
    if sorted(got_names) != sorted(want_names):
        return f"columns {got_names} != {want_names}"
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    same = {
        "bigint": "BIGINT",
        "int": "INTEGER",
        "string": "VARCHAR",
        "double": "DOUBLE",
        "boolean": "BOOLEAN",
        "timestamp_ntz": "TIMESTAMP",
        "date": "DATE",
    }
    for name, kind in spark_df.dtypes:
        if same.get(kind, kind) != kinds[name]:
            return f"type of {name}: {kind} != {kinds[name]}"
    want = rows_of(want_names, relation.fetchall())
    got = rows_of(got_names, [tuple(r) for r in spark_df.collect()])
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"row {a}\n != {b}"
    return None
