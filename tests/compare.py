"""Run a query and its SQL text on the same tables and compare schema and rows."""

from __future__ import annotations

import glob
import math
import os
import time

import duckdb

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "smallint": "SMALLINT"}


def connect(d: str):
    con = duckdb.connect()
    for f in sorted(glob.glob(f"{d}/*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else v
    return v


def compare(spark, con, d, fn, text):
    """(ok, message, rows, spark seconds, sql seconds)."""
    t = time.time()
    df = fn(spark, d)
    got = df.toArrow()
    t_spark = time.time() - t
    cols = sorted(df.columns)
    rows = list(zip(*[got.column(c).to_pylist() for c in cols])) if cols else []
    if text is None:
        return True, "rows only", len(rows), t_spark, 0.0
    t = time.time()
    rel = con.execute(text)
    names = [x[0] for x in rel.description]
    want_types = {x[0]: str(x[1]) for x in rel.description}
    want = rel.fetchall()
    t_sql = time.time() - t
    if sorted(names) != cols:
        return False, f"columns {cols} != {sorted(names)}", len(rows), t_spark, t_sql
    spark_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    bad = {c: (spark_types[c], want_types[c]) for c in cols if spark_types[c] != want_types[c]}
    if bad:
        return False, f"types {bad}", len(rows), t_spark, t_sql
    order = [names.index(c) for c in cols]
    want = [tuple(_norm(row[i]) for i in order) for row in want]
    rows = [tuple(_norm(v) for v in row) for row in rows]
    key = lambda row: tuple((v is None, str(v)) for v in row)
    if len(rows) != len(want):
        return False, f"{len(rows)} rows, SQL has {len(want)}", len(rows), t_spark, t_sql
    rows.sort(key=key)
    want.sort(key=key)
    diff = [(a, b) for a, b in zip(rows, want) if a != b]
    if diff:
        return False, f"{len(diff)} rows differ: {cols} {diff[:3]}", len(rows), t_spark, t_sql
    return True, "equal", len(rows), t_spark, t_sql
