"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR    folder of the test tables, default /root/testdata/sf0.1
BENCH_CPUS      local cores, default all
BENCH_REPEATS   timed runs after one warm-up, default 3; the best one counts
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.registry import QUERIES
from zonewright.plans import index_cost
from zonewright.session import build_session, materialize
from zonewright.sources.testtables import TestTables

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

HEADLINE = [
    "idx_hex",
    "idx_grid",
    "stg_orders",
    "stg_order_items",
    "int_delivery_metrics",
    "mart_kpis",
    "mart_district",
    "mart_h3",
    "mart_grid",
    "mart_spatial_comparison",
    "feed_hotspots",
    "feed_zone_map",
    "route_schedule",
    "src_ndjson_roundtrip",
]

# The index-cost job repeats the points this often, so that the cost per row
# shows over the fixed cost of starting a Spark job.
INDEX_COPIES = 64


def seconds(build, repeats: int = REPEATS) -> float:
    """Best time to build, plan and run a query, all rows computed, none kept."""
    best = float("inf")
    for run in range(repeats + 1):
        started = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        if run:
            best = min(best, time.perf_counter() - started)
    return best


def index_points(spark, copies: int) -> DataFrame:
    points = TestTables(spark, FOLDER).delivery_telemetry().select(
        F.col("spatial_data.destination_lat").alias("lat"),
        F.col("spatial_data.destination_lon").alias("lon"),
        F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy"),
    )
    return materialize(points.repartition(int(CPUS) * 2).drop("copy"), "points")


def main() -> None:
    spark = build_session(
        f"local[{CPUS}]",
        spark_sql_shuffle_partitions=CPUS,
        spark_driver_memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark_ui_showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {key: round(seconds(lambda: QUERIES[key](spark, FOLDER)), 3) for key in HEADLINE}
    points = index_points(spark, INDEX_COPIES)
    index = {
        row["method"]: {"n_rows": row["n_rows"], "us_per_row": round(row["microseconds_per_row"], 4)}
        for row in index_cost.measure(points, REPEATS + 1).collect()
    }
    scale = re.search(r"sf([\d.]+)", FOLDER)
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of best times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
                "index_cost": index,
                "cpus": int(CPUS),
                "repeats": REPEATS,
            }
        )
    )


if __name__ == "__main__":
    main()
