"""Compare a registered query with its DuckDB oracle, row by row."""

from __future__ import annotations

import math
import os

import duckdb

DATA = os.environ.get("STRATA_TESTDATA", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str = DATA) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    return value


SPARK_TYPE = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "FLOAT": "float",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=repr)


def differences(query, sql, spark, con, sf_dir: str = DATA) -> list[str]:
    """Human-readable differences; empty when both sides agree."""
    frame = query(spark, sf_dir)
    got_cols, got = _bag(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    want_cols, want = _bag([d[0] for d in cursor.description], cursor.fetchall())
    if got_cols != want_cols:
        return [f"columns {got_cols} != {want_cols}"]
    found = []
    if len(got) != len(want):
        found.append(f"rows {len(got)} != {len(want)}")
    types = dict(frame.dtypes)
    for name, kind in con.execute(f"SELECT column_name, column_type FROM (DESCRIBE {sql})").fetchall():
        if types[name] != SPARK_TYPE.get(kind, kind):
            found.append(f"type of {name}: {types[name]} != {kind}")
    for mine, theirs in zip(got, want):
        if mine != theirs:
            found.append(f"{mine} != {theirs}")
            break
    return found
