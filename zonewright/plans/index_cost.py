"""What indexing a delivery costs, per zone scheme."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewright.functions import geo
from zonewright.sources.schemas import CL_BENCHMARKS
from zonewright.sources.sinks import literal_rows

INDEXES = {"H3": geo.hex_cell, "Grid": geo.grid_cell}


def seconds_to_index(points: DataFrame, method: str) -> float:
    """Wall-clock seconds to compute the zone id of every (lat, lon) row."""
    ids = points.select(INDEXES[method](F.col("lat"), F.col("lon")).alias("cell"))
    started = time.perf_counter()
    ids.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def measure(points: DataFrame, repeats: int = 1, n_rows: int | None = None) -> DataFrame:
    """The benchmark table: best of ``repeats`` runs, by default one pass per scheme.

    ``n_rows`` saves the count where it is known.
    """
    n_rows = points.count() if n_rows is None else n_rows
    rows = []
    for method in INDEXES:
        best = min(seconds_to_index(points, method) for _ in range(repeats))
        rows.append((method, n_rows, best, best / n_rows * 1e6 if n_rows else None))
    return literal_rows(points.sparkSession, rows, CL_BENCHMARKS)
