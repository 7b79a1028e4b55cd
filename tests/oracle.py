"""Comparison of a Spark result with the result of its SQL in DuckDB."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def difference(df, connection, sql: str) -> str | None:
    """Text of the first difference, or None where names, row counts, types and values agree."""
    relation = connection.sql(sql)
    names, expected = relation.columns, relation.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    order = sorted(names)
    types = dict(zip(names, (str(t) for t in relation.types)))
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    same = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}
    for name in order:
        if types[name] in same and same[types[name]] != spark_types[name] or types[name] not in same:
            return f"type of {name}: {spark_types[name]} != {types[name]}"
    mine = sorted((_row(r.asDict(), order) for r in df.collect()), key=_key)
    theirs = sorted((_row(dict(zip(names, r)), order) for r in expected), key=_key)
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(wrong)} of {len(mine)} rows differ, first {wrong[0]}" if wrong else None


def _row(row: dict, order: list[str]) -> tuple:
    return tuple(_value(row[n]) for n in order)


def _value(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    return value


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), "" if v is None else v) for v in row)
