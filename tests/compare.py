"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if hasattr(value, "asDict"):
        return tuple(_plain(v) for v in value)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    return value


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    data = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(data, key=repr)


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else what differs first."""
    got_columns, got = rows_of(spark_df.columns, spark_df.collect())
    kinds = {r[0]: r[1] for r in con.execute("DESCRIBE " + sql).fetchall()}
    cursor = con.execute(sql)
    want_columns, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}; first {got[:1]} / {want[:1]}"
    for g, w in zip(got, want):
        if g != w:
            return f"{[(c, a, b) for c, a, b in zip(got_columns, g, w) if a != b]} in {g}"
    for field in spark_df.schema:
        if not _same_type(field.dataType.simpleString(), kinds[field.name]):
            return f"type of {field.name}: {field.dataType.simpleString()} != {kinds[field.name]}"
    return None


def _same_type(spark: str, duck: str) -> bool:
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}
    return names.get(spark, spark) == duck
