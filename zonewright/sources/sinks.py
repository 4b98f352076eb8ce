"""Full-refresh sinks and load audits."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{at}")


def replace_table(df: DataFrame, table: str) -> DataFrame:
    """Replace ``table`` with ``df`` and return the table."""
    df.write.format("parquet").mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A typed DataFrame of a few literal rows."""
    return spark.createDataFrame(list(rows), schema)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) for every table, counted where the data is."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
