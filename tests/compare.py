"""Compare a Spark result with DuckDB rows: columns by name, rows in any order."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    if isinstance(value, decimal.Decimal):
        return repr(round(float(value), 6))
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


FAMILY = {"tinyint": "int", "smallint": "int", "integer": "int", "bigint": "int", "hugeint": "int", "int": "int", "string": "text", "varchar": "text", "boolean": "bool", "double": "float", "float": "float"}


def compare(spark_df, con, sql) -> str:
    """'' when equal, else what differs."""
    a_cols, a = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    types = {d[0]: str(d[1]).lower() for d in cur.description}
    b_cols, b = rows_of([d[0] for d in cur.description], cur.fetchall())
    if a_cols != b_cols:
        return f"columns {a_cols} != {b_cols}"
    for f in spark_df.schema:
        x, y = f.dataType.simpleString(), types[f.name]
        if x.split("_")[0] != y and {x, y} not in ({"string", "varchar"}, {"int", "integer"}):
            return f"type of {f.name}: {x} != {y}"
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} of {len(a)} rows differ, first {str(wrong[0])[:600]}" if wrong else ""
