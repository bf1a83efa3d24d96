"""Compare a Spark result with the answer of the checking SQL."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb
from pyspark.sql import DataFrame

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return db


def _plain(value: object) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return f"{type(value).__name__} {value}"


def _canonical(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(_plain(row[k]) for k in order) for row in rows)


def difference(df: DataFrame, sql: str, db: duckdb.DuckDBPyConnection) -> str | None:
    """None if both give the same rows, else what differs."""
    answer = db.execute(sql)
    names = [d[0] for d in answer.description]
    want = _canonical(names, answer.fetchall())
    got = _canonical(df.columns, [tuple(r) for r in df.collect()])
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    if got == want:
        return None
    extra, lacking = sorted(set(got) - set(want)), sorted(set(want) - set(got))
    return f"{len(got)} rows instead of {len(want)}; e.g. extra {extra[:2]}, lacking {lacking[:2]}"
