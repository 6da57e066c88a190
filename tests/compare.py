"""Compare a Spark result with its SQL run by DuckDB."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.sql(
                f"create view {name} as select * from '{sf_dir}/{name}.parquet'"
            )
    return con


def _plain(value):
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def _kind(value):
    if isinstance(value, Decimal):
        return f"decimal scale {-value.as_tuple().exponent}"
    return type(value).__name__


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in records]
    return [columns[i] for i in order], sorted(plain, key=repr)


def differences(spark_df, con, sql) -> list[str]:
    """What differs in columns, rows, values or value types; empty if nothing."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want_columns, want = rows(names, result.fetchall())
    got_columns, got = rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got_columns != want_columns:
        return [f"columns {got_columns} != {want_columns}"]
    if len(got) != len(want):
        return [f"{len(got)} rows != {len(want)}"]
    found = []
    for a, b in zip(got, want):
        if a != b or [_kind(v) for v in a] != [_kind(v) for v in b]:
            found.append(f"{a} != {b}")
            if len(found) == 3:
                break
    return found
