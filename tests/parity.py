"""Compare a Spark result with a DuckDB result by column name, ignoring row order."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return str(value.normalize()) if value else "0"
    if isinstance(value, float):
        return f"{value:.13g}"
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def kind(type_name: str) -> str:
    """Coarse type name comparable across the two engines."""
    name = type_name.lower()
    for prefix, family in (
        ("decimal", "decimal"), ("hugeint", "hugeint"), ("bigint", "bigint"), ("long", "bigint"),
        ("int", "int"), ("double", "double"), ("bool", "bool"), ("timestamp", "timestamp"),
        ("date", "date"), ("varchar", "string"), ("string", "string"),
    ):
        if name.startswith(prefix):
            return family
    return name


def compare(df, con, sql: str) -> list[str]:
    """Differences found; an empty list means equal."""
    found = []
    cursor = con.execute(sql)
    oracle_columns = [d[0] for d in cursor.description]
    oracle = _rows(oracle_columns, cursor.fetchall())
    types = {
        row[0]: kind(row[1]) for row in con.execute(f"describe {sql}").fetchall()
    }
    if sorted(df.columns) != sorted(oracle_columns):
        return [f"columns {sorted(set(df.columns) ^ set(oracle_columns))}"]
    for name, dtype in df.dtypes:
        if kind(dtype) != types[name]:
            found.append(f"type of {name}: {dtype} against {types[name]}")
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sum(ours.values()) != sum(oracle.values()):
        found.append(f"rows {sum(ours.values())} against {sum(oracle.values())}")
    if ours != oracle:
        only_ours, only_oracle = ours - oracle, oracle - ours
        found.append(
            f"{sum(only_ours.values())} rows differ, e.g. {sorted(map(str, only_ours))[:1]}"
            f" against {sorted(map(str, only_oracle))[:1]}"
        )
    return found
