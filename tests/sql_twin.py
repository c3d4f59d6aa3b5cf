"""Runs a query on Spark and its SQL on DuckDB over the same tables and compares every row."""

from __future__ import annotations

import os

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as repo


def mismatches(spark: SparkSession, name: str, sf_dir: str) -> tuple[int, int, int]:
    """Row count on Spark, rows only Spark has, rows only the SQL has."""
    sql = repo.oracle_sql()[name]
    result = repo.queries()[name](spark, sf_dir).toArrow()
    con = duckdb.connect()
    for file in os.listdir(sf_dir):
        table, _, kind = file.partition(".")
        if kind == "parquet":
            con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{file}'")
    con.sql(f"CREATE TABLE expected AS {sql}")
    expected_columns = con.table("expected").columns
    assert sorted(result.column_names) == sorted(expected_columns), (
        result.column_names, expected_columns)
    con.register("got", result)
    columns = ", ".join(f'"{c}"' for c in sorted(expected_columns))

    def only(left: str, right: str) -> int:
        query = f"SELECT {columns} FROM {left} EXCEPT ALL SELECT {columns} FROM {right}"
        return con.sql(f"SELECT count(*) FROM ({query})").fetchall()[0][0]

    return result.num_rows, only("got", "expected"), only("expected", "got")
