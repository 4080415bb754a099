"""Run a query and its SQL side by side and compare whole results."""

from __future__ import annotations

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
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    number = float(value)
    return None if math.isnan(number) else float(f"{number:.9g}")


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark_df, con, sql: str) -> str:
    """Empty if both give the same columns and rows, else a short report."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    wanted = rows_of(names, cursor.fetchall())
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if wanted == got:
        return ""
    extra, missing = list((got - wanted).elements()), list((wanted - got).elements())
    return (
        f"{sum(got.values())} rows, expected {sum(wanted.values())}; {len(extra)} extra, {len(missing)} missing\n"
        f"  columns  {sorted(names)}\n  extra    {extra[:2]}\n  missing  {missing[:2]}"
    )
