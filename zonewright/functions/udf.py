"""The escape hatch for zone indexes that come as a Python library."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def register_cell_function(
    spark: SparkSession, name: str, cell_of: Callable[[float, float, int], str]
):
    """Register ``name(lat, lon, resolution)`` for an index that Spark lacks.

    For a library's own point-to-cell function. NULL in gives NULL out. It runs
    in Python, batch by batch through Arrow; the built-in indexes do not need it.
    """

    @F.pandas_udf("string")
    def cell(lat: pd.Series, lon: pd.Series, resolution: pd.Series) -> pd.Series:
        out = pd.Series(None, index=lat.index, dtype=object)
        there = lat.notna() & lon.notna() & resolution.notna()
        rows = zip(lat[there], lon[there], resolution[there].astype(int))
        out[there] = [cell_of(a, b, n) for a, b, n in rows]
        return out

    spark.udf.register(name, cell)
    return cell
