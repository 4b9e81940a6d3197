"""Compare a Spark result with the DuckDB result of its check SQL, value by value."""

import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for table in TABLES:
        if os.path.exists(f"{sf_dir}/{table}.parquet"):
            con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else (value or 0.0)
    return value


def _bag(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides agree, else a short account of the difference."""
    result = con.execute(sql)
    expected_names = [c[0] for c in result.description]
    expected = _bag(expected_names, result.fetchall())
    if sorted(df.columns) != sorted(expected_names):
        return f"columns {sorted(df.columns)} != {sorted(expected_names)}"
    actual = _bag(df.columns, df.collect())
    if actual == expected:
        return None
    extra, missing = list((actual - expected).items())[:2], list((expected - actual).items())[:2]
    return (
        f"rows {sum(actual.values())} vs {sum(expected.values())}, {sum((actual - expected).values())} differ\n"
        f"columns {sorted(df.columns)}\nonly spark {extra}\nonly sql {missing}"
    )
