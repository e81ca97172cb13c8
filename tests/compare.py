"""Bag comparison of a Spark result with a DuckDB result, types included."""

from __future__ import annotations

import tempfile
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        file = Path(sf_dir) / f"{table}.parquet"
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{file}')")
    return connection


def assert_same_rows(connection, result, sql: str) -> int:
    """Check names, types and the bag of rows; return how many there are."""
    written = f"{tempfile.mkdtemp(prefix='lakestrata-result-')}/rows"
    result.write.parquet(written)
    connection.execute(f"CREATE OR REPLACE VIEW result AS SELECT * FROM read_parquet('{written}/*.parquet')")
    connection.execute(f"CREATE OR REPLACE TEMP TABLE expected AS {sql}")

    def types(name):
        return {row[0]: row[1] for row in connection.execute(f"DESCRIBE {name}").fetchall()}

    assert types("result") == types("expected")
    names = ", ".join(f'"{name}"' for name in sorted(types("expected")))
    for left, right in (("result", "expected"), ("expected", "result")):
        extra = connection.execute(
            f"SELECT {names} FROM {left} EXCEPT ALL SELECT {names} FROM {right} LIMIT 5"
        ).fetchall()
        assert extra == [], f"rows only in {left}"
    return connection.execute("SELECT count(*) FROM result").fetchone()[0]
