"""Result of a Spark query against the same question in SQL."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def sql_connection(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{directory}/{table}.parquet'")
    return con


def _multiset(table, names):
    columns = [table.column(n).to_pylist() for n in names]
    return Counter(zip(*columns)) if columns else Counter()


def differences(df, statement: str, con) -> list[str]:
    ours = df.toArrow()
    theirs = con.execute(statement).to_arrow_table()
    names, expected = sorted(ours.column_names), sorted(theirs.column_names)
    if names != expected:
        return [f"columns {names} against {expected}"]
    faults = []
    for name in names:
        left, right = str(ours.schema.field(name).type), str(theirs.schema.field(name).type)
        if left != right:
            faults.append(f"type of {name}: {left} against {right}")
    if ours.num_rows != theirs.num_rows:
        faults.append(f"rows {ours.num_rows} against {theirs.num_rows}")
    a, b = _multiset(ours, names), _multiset(theirs, names)
    if a != b:
        faults.append(f"only ours {list((a - b).items())[:2]}; only theirs {list((b - a).items())[:2]}")
    return faults
