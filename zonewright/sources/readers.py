"""Raw file readers, all with a declared schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from zonewright.operators import layout
from zonewright.sources import snapshots
from zonewright.sources.json_arrays import FAST, read_json_array


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with one header row, whose names say which column is which.

    Columns may stand in any order; a declared one that is missing, or one that
    is not declared, is an error. All files of a path share one header:
    a file with another one fails while it is read.
    """
    declared = StructType.fromDDL(schema)
    header = spark.read.option("header", True).csv(path).columns
    if sorted(header) != sorted(declared.names):
        raise ValueError(f"{path} has the columns {header}, declared are {declared.names}")
    return (
        spark.read.schema(StructType([declared[name] for name in header]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
        .select(declared.names)
    )


def read_ndjson(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document per line; files split over tasks."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def json_array_to_ndjson(
    spark: SparkSession,
    source: str,
    target: str,
    schema: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    compression: str = "none",
) -> None:
    """Rewrite JSON arrays as NDJSON, enriching the documents on the way."""
    documents = read_json_array(spark, source, schema)
    write_ndjson(documents, target, transform, compression)


def write_ndjson(
    documents: DataFrame,
    target: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    compression: str = "none",
) -> None:
    if transform is not None:
        documents = documents.transform(transform)
    documents.write.mode("overwrite").options(**FAST).option("ignoreNullFields", False).option("compression", compression).json(target)


def read_mart(spark: SparkSession, database: str, name: str, *columns: str) -> DataFrame:
    """A mart of the database's current snapshot, all columns or the named ones."""
    table = snapshots.table(spark, database, name)
    return table.select(*(columns or [c for c in table.columns if c not in layout.COLUMNS]))
