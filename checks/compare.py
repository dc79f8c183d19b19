"""Run a query on Spark and its oracle on DuckDB over the same parquet files and compare the rows."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

ALL_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in ALL_TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return float(f"{value:.10g}")
    return value


def _rows(rows, order):
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def differences(df, con, sql: str) -> list[str]:
    """Empty when names, row count and values agree."""
    spark_names = df.columns
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(spark_names) != sorted(names):
        return [f"columns: only Spark {sorted(set(spark_names) - set(names))}, "
                f"only oracle {sorted(set(names) - set(spark_names))}"]  # fmt: skip
    common = sorted(names)
    actual = [tuple(r) for r in df.collect()]
    left = _rows(actual, [spark_names.index(n) for n in common])
    right = _rows(expected, [names.index(n) for n in common])
    found = []
    if len(left) != len(right):
        found.append(f"rows: Spark {len(left)}, oracle {len(right)}")
    if left != right:
        for a, b in zip(left, right):
            if a != b:
                cells = [f"{n}: {x!r} / {y!r}" for n, x, y in zip(common, a, b) if x != y]
                found.append("first difference " + "; ".join(cells[:6]))
                break
    return found
