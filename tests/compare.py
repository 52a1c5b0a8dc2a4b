"""Compare a registered query with its oracle, the way a reader would: names, types, rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    """A value both engines agree on: no numeric type differences, doubles to twelve digits."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz",
    "DATE": "date", "BOOLEAN": "boolean",
}


def differences(spark_df, con, sql) -> list[str]:
    found = []
    relation = con.sql(sql)
    expected_columns, expected_types = list(relation.columns), [str(t) for t in relation.types]
    if sorted(spark_df.columns) != sorted(expected_columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(expected_columns)}"]
    types = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    for name, kind in zip(expected_columns, expected_types):
        if KINDS.get(kind, kind) != types[name]:
            found.append(f"type of {name}: {types[name]} != {kind}")
    expected = rows_of(expected_columns, relation.fetchall())
    actual = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if len(actual) != len(expected):
        found.append(f"{len(actual)} rows != {len(expected)}")
    if actual != expected:
        wrong = [(a, e) for a, e in zip(actual, expected) if a != e][:2]
        found.append(f"rows differ, e.g. {str(wrong)[:600]}")
    return found
