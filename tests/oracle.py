"""Comparison of a query's rows with those of its SQL."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KIND = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
    "FLOAT": "float", "DATE": "date", "SMALLINT": "smallint", "TINYINT": "tinyint", "BLOB": "binary",
}


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    if isinstance(v, decimal.Decimal):
        return repr(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([plain(r[i]) for i in order] for r in rows)


def difference(spark, folder: str, run, sql: str) -> str:
    """What parts the query from its SQL; empty when nothing does."""
    df = run(spark, folder)
    want = connect(folder).execute(sql)
    kinds = {d[0]: KIND.get(str(d[1]), str(d[1])) for d in want.description}
    want_columns, want_rows = table_of([d[0] for d in want.description], want.fetchall())
    columns, rows = table_of(df.columns, [tuple(r) for r in df.collect()])
    said = []
    if columns != want_columns:
        return f"columns {columns} for {want_columns}"
    off = {c: (k, kinds[c]) for c, k in df.dtypes if k != kinds[c]}
    if off:
        said.append(f"types {off}")
    if len(rows) != len(want_rows):
        said.append(f"{len(rows)} rows for {len(want_rows)}")
    if rows != want_rows:
        mine, theirs = {tuple(r) for r in rows}, {tuple(r) for r in want_rows}
        said.append(f"values: {sorted(mine - theirs)[:3]} for {sorted(theirs - mine)[:3]}")
    return "; ".join(said)
