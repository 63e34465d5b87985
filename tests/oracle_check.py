"""Run one query in Spark and as SQL in DuckDB, and compare the rows."""

import datetime as dt
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck(folder):
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def kind(value):
    return "number" if isinstance(value, int | float) and not isinstance(value, bool) else type(value).__name__


def difference(spark_df, con, sql):
    """None when both give the same rows, else a short description."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    want = [tuple(plain(v) for v in row) for row in result.fetchall()]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns differ: {sorted(set(names) ^ set(spark_df.columns))}"
    got = [tuple(plain(row[n]) for n in names) for row in spark_df.collect()]
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    missing = Counter(want) - Counter(got)
    if missing:
        extra = Counter(got) - Counter(want)
        return f"{sum(missing.values())} rows differ, e.g. {names}: {next(iter(extra))} / {next(iter(missing))}"
    return None
