"""Compare a Spark result with DuckDB's answer to the query's SQL: columns, types and values, in any order."""

from __future__ import annotations

from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(v)) for v in row)


def assert_same(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> int:
    """Checks the two and returns the number of rows."""
    expected = con.execute(sql)
    types = {d[0]: str(d[1]) for d in expected.description}
    got_types = {f.name: TYPES[f.dataType.simpleString()] for f in result.schema}
    assert got_types == types
    columns = sorted(types)
    order = [list(types).index(c) for c in columns]
    want = sorted((tuple(row[i] for i in order) for row in expected.fetchall()), key=_key)
    got = sorted((tuple(row) for row in result.select(*[f"`{c}`" for c in columns]).collect()), key=_key)
    assert len(got) == len(want)
    assert got == want
    return len(got)
