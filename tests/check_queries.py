"""Compare registered queries with their SQL: `python tests/check_queries.py [sf] [name…]`."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    result = con.execute(sql)
    return [column[0] for column in result.description], result.fetchall()


def by_column_name(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark: SparkSession, sf_dir: str, name: str) -> tuple[bool, int]:
    result = contract.queries()[name](spark, sf_dir)
    rows = [tuple(row) for row in result.collect()]
    columns, expected = oracle_rows(sf_dir, contract.oracle_sql()[name])
    same_columns = sorted(columns) == sorted(result.columns)
    return (
        same_columns and by_column_name(result.columns, rows) == by_column_name(columns, expected),
        len(rows),
    )


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[2:] or list(contract.queries())
    bad = 0
    for name in wanted:
        start = time.time()
        same, n = compare(spark, f"/root/testdata/sf{sf}", name)
        bad += not same
        print(f"{'ok ' if same else 'BAD'} {name} rows={n} {time.time() - start:.2f}s", flush=True)
    print("all equal" if not bad else f"{bad} differ")
