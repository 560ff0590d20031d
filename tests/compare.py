"""Comparison of a Spark result with the checking engine's, values and types."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# Names under which both engines know a type.
TYPES = {
    "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _normal(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_normal(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    """What differs between a Spark frame and the SQL's result; empty when nothing does."""
    cursor = con.execute(sql)
    columns = [(d[0], str(d[1])) for d in cursor.description]
    expected = _rows([n for n, _ in columns], cursor.fetchall())
    found = _rows(df.columns, (tuple(r) for r in df.collect()))
    notes = []
    spark_types = sorted(df.dtypes)
    oracle_types = sorted((n, TYPES.get(t, t)) for n, t in columns)
    if spark_types != oracle_types:
        notes.append(f"types {sorted(set(spark_types) ^ set(oracle_types))}")
    if expected != found:
        notes.append(
            f"rows {found.total()} vs {expected.total()}; only here "
            f"{list((found - expected).items())[:2]}; only there {list((expected - found).items())[:2]}"
        )
    return notes
