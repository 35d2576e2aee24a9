"""Comparing a query with its SQL, as row multisets."""

from __future__ import annotations

import datetime
import decimal
import glob
import os
from collections import Counter

import duckdb

TESTDATA = "/root/testdata"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return float(f"{value:.12g}")
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def multiset(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


# Names under which both sides must agree on a column's type.
SPARK_TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def compare(df, sql: str, sf_dir: str) -> int:
    """Assert equal column names, types and rows; returns the number of rows."""
    result = connect(sf_dir).sql(sql)
    expected_types = {c: str(t) for c, t in zip(result.columns, result.types, strict=True)}
    actual_types = {c: SPARK_TYPES.get(t, t) for c, t in df.dtypes}
    assert actual_types == expected_types
    expected = multiset(result.columns, result.fetchall())
    actual = multiset(df.columns, df.collect())
    missing, extra = expected - actual, actual - expected
    assert not missing and not extra, (
        f"{missing.total()} missing, {extra.total()} extra of {expected.total()}:"
        f" {list(missing)[:2]} / {list(extra)[:2]}"
    )
    return expected.total()
