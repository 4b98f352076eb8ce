"""What the text operators share: Arrow batches in, rows out."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


#: Texts are long, so Arrow batches are cut to this many rows where the session has Spark's default.
BATCH_ROWS, SPARK_BATCH_ROWS = 1000, "10000"
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(df: DataFrame) -> None:
    """Bounds the memory that batches of texts take in the JVM and in Python."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH_SETTING, SPARK_BATCH_ROWS) == SPARK_BATCH_ROWS:
        conf.set(_BATCH_SETTING, str(BATCH_ROWS))


def fields(df: DataFrame, *names: str) -> list[T.StructField]:
    return [df.schema[name] for name in names]


def whole_rows(df: DataFrame, text: str = "text") -> DataFrame:
    """``record``, a struct of all columns, beside a copy of the text: what is added can't clash with a column."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("record"), F.col(f"`{text}`").alias("text"))


def map_texts(
    df: DataFrame,
    keep: list[str],
    text: str,
    new: list[T.StructField],
    rows: Callable[[list[bytes | None]], list[tuple]],
    after: Callable[[], None] | None = None,
) -> DataFrame:
    """Columns ``keep`` and, for each row, the columns ``new`` made from its whole text.

    ``rows`` gets the texts of an Arrow batch as bytes (UTF-8), None for null, and
    returns one tuple per text. Other columns are not read, so their names can't clash.
    ``after`` is called when a task has ended, to drop what it has kept: workers live on.
    """
    small_batches(df)
    schema = T.StructType([*fields(df, *keep), *new])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep)).cast(pa.binary()).to_pylist()
            made = list(zip(*rows(texts), strict=True)) if texts else [()] * len(new)
            arrays = [pa.array(x, f.type) for x, f in zip(made, list(arrow)[len(keep) :], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *arrays], schema=arrow)
        if after:
            after()
        pa.default_memory_pool().release_unused()

    column = df[text] if isinstance(df.schema[text].dataType, T.BinaryType) else df[text].cast("string")
    return df.select(*keep, column.alias("__text")).mapInArrow(run, schema)
