"""Runs a query on Spark and its SQL on DuckDB and compares the results."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pandas as pd
import pyarrow as pa


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _kind(kind: pa.DataType) -> str:
    if pa.types.is_large_string(kind) or pa.types.is_string(kind):
        return "string"
    return str(kind)


def _rows(table: pa.Table) -> list[tuple]:
    table = table.select(sorted(table.column_names))

    def plain(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "null"
        return repr(v + 0.0) if isinstance(v, float) else repr(v)

    columns = [[plain(v) for v in column.to_pylist()] for column in table.columns]
    return sorted(zip(*columns)) if columns else []


def difference(spark_table: pa.Table, sql_table: pa.Table) -> str | None:
    """What differs between two results, or None. Row order does not count."""
    left = {f.name: _kind(f.type) for f in spark_table.schema}
    right = {f.name: _kind(f.type) for f in sql_table.schema}
    if left != right:
        return f"columns differ: spark {sorted(left.items())} sql {sorted(right.items())}"
    if spark_table.num_rows != sql_table.num_rows:
        return f"rows differ: spark {spark_table.num_rows} sql {sql_table.num_rows}"
    pairs = zip(_rows(spark_table), _rows(sql_table))
    bad = [(a, b) for a, b in pairs if a != b]
    return f"{len(bad)} rows differ, first: spark {bad[0][0]} sql {bad[0][1]}" if bad else None


def sql_result(con: duckdb.DuckDBPyConnection, sql: str) -> pa.Table:
    result = con.execute(sql)
    fetch = getattr(result, "to_arrow_table", None) or result.fetch_arrow_table
    return fetch()


def frame(table: pa.Table) -> pd.DataFrame:
    return table.to_pandas()
