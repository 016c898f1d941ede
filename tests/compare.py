"""Compare a query's rows with DuckDB's rows for the same tables."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark and DuckDB names of the same type.
TYPE_NAMES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def differences(df, con, sql: str) -> list[str]:
    """What differs between a DataFrame and a query, or an empty list."""
    found = []
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    types = {d[0]: str(d[1]) for d in expected.description}
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for name, kind in df.dtypes:
        if TYPE_NAMES.get(kind) != types[name]:
            found.append(f"{name}: {kind} != {types[name]}")
    order = sorted(names)
    want = Counter(tuple(row[names.index(c)] for c in order) for row in expected.fetchall())
    got = Counter(tuple(row[c] for c in order) for row in df.collect())
    if got != want:
        found.append(f"rows: {sum(got.values())} != {sum(want.values())}")
        found += [f"only spark {r}" for r in list((got - want).elements())[:3]]
        found += [f"only sql {r}" for r in list((want - got).elements())[:3]]
    return found
