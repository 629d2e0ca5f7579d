"""Compare a registered query with its DuckDB SQL: columns, types, rows, values."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "float": "FLOAT",
}


def connect(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(value):
        if value is None:
            return "null"
        if isinstance(value, float):
            return "nan" if math.isnan(value) else repr(value)
        if isinstance(value, datetime.datetime):
            return value.isoformat()
        return str(value)

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def differences(frame, connection, sql):
    """A list of what differs; empty when the two agree."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    found = []
    if sorted(frame.columns) != sorted(names):
        return [f"columns {sorted(frame.columns)} and {sorted(names)}"]
    for name, kind in frame.dtypes:
        if SAME_TYPE.get(kind) != types[name]:
            found.append(f"type of {name}: {kind} and {types[name]}")
    mine = canonical([tuple(r) for r in frame.collect()], frame.columns)
    theirs = canonical(result.fetchall(), names)
    if len(mine) != len(theirs):
        found.append(f"rows {len(mine)} and {len(theirs)}")
    if mine != theirs:
        wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
        found.append(f"{len(wrong)} rows differ, first {str(wrong[:1])[:400]}")
    return found
