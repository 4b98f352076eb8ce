"""Compare registered queries with their SQL: python -m checks.compare [folder] [key ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.registry import QUERIES


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def oracle_rows(con: duckdb.DuckDBPyConnection, key: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(ORACLE[key])
    names = [f"{column[0]} {TYPES.get(str(column[1]), column[1])}" for column in cursor.description]
    return _canonical(names, cursor.fetchall())


def spark_rows(spark: SparkSession, folder: str, key: str) -> tuple[list[str], list[tuple]]:
    df = QUERIES[key](spark, folder)
    names = [f"{name} {kind}" for name, kind in df.dtypes]
    return _canonical(names, [tuple(row) for row in df.collect()])


def _canonical(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    """Columns by name, rows sorted; type and exact value of every field kept."""
    order = sorted(range(len(names)), key=lambda i: names[i])

    def field(value):
        if isinstance(value, float):
            value += 0.0  # -0.0 and 0.0 are the same number
        return type(value).__name__, repr(value)

    shaped = sorted(tuple(field(row[i]) for i in order) for row in rows)
    return [names[i] for i in order], shaped


def mismatch(expected, actual) -> str | None:
    """The first difference in words, or None."""
    if expected[0] != actual[0]:
        wrong = sorted(set(actual[0]) ^ set(expected[0]))
        return f"columns differ: {wrong}"
    if len(expected[1]) != len(actual[1]):
        return f"{len(actual[1])} rows instead of {len(expected[1])}"
    for want, got in zip(expected[1], actual[1]):
        if want != got:
            fields = [(c, w, g) for c, w, g in zip(expected[0], want, got) if w != g]
            return f"(column, expected, actual): {fields[:4]}"
    return None


def main(folder: str, keys: list[str]) -> int:
    from zonewright.session import build_session

    spark = build_session("local[8]", spark_sql_shuffle_partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(folder)
    failed = 0
    for key in keys or QUERIES:
        started = time.perf_counter()
        actual = spark_rows(spark, folder, key)
        seconds = time.perf_counter() - started
        if key not in ORACLE:
            print(f"{key:28} rows only, {len(actual[1])} rows, {seconds:.2f} s", flush=True)
            continue
        problem = mismatch(oracle_rows(con, key), actual)
        failed += problem is not None
        print(f"{key:28} {problem or 'ok'}, {len(actual[1])} rows, {seconds:.2f} s", flush=True)
    print(f"{failed} of {len(keys or QUERIES)} differ")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]) > 0)
