"""Run a query in Spark and its SQL in DuckDB and compare names, row counts and values."""

from __future__ import annotations

import glob
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if glob.glob(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if value is None:
        return ("", "")
    if isinstance(value, float):
        if math.isnan(value):
            return ("", "nan")
        return ("n", float(f"{value:.10g}") + 0.0)
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, int):
        return ("n", float(value))
    return ("s", str(value))


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        tuple(_cell(row[i]) for i in order) for row in rows
    )


def compare(spark, query, sql, sf_dir):
    """Return an error text, or None when both sides agree."""
    df = query(spark, sf_dir)
    left_names, left = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = connect(sf_dir).execute(sql)
    right_names, right = canonical([d[0] for d in result.description], result.fetchall())
    if left_names != right_names:
        return f"columns {left_names} != {right_names}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(left)} rows differ, first: {wrong[0]}"
    return None
