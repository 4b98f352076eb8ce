"""Full refresh of a database: raw tables, then metrics, then marts, each as a snapshot that replaces the last one when it is whole."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewright.operators import layout
from zonewright.operators.spatial import with_cells
from zonewright.plans import comparison, index_cost, marts, metrics, staging
from zonewright.session import scratch_run
from zonewright.sources import snapshots
from zonewright.sources.schemas import missing_tables
from zonewright.sources.sinks import ensure_database

RAW_NAMES = ("raw_customers", "raw_products", "raw_sellers", "raw_orders", "raw_deliveries")


def load(spark: SparkSession, raw: Mapping[str, DataFrame], database: str) -> DataFrame:
    """Replace the raw tables, all together, and return their row counts.

    ``raw_deliveries`` may come without zone ids; they are added on the way in,
    so no later query pays for them. Tables are written as they come, without a
    shuffle: bucketing the facts by order would pay off for repeated joins only,
    and would store all deliveries of one order, or of none, in one bucket.
    """
    ensure_database(spark, database)
    with snapshots.refresh(spark, database, "raw") as snapshot:
        for name in RAW_NAMES:
            df = raw[name]
            if name == "raw_deliveries":
                df = with_cells(df)
            snapshot.write(df, name)
        points = snapshot.table("raw_deliveries").select(
            F.col("spatial_data.destination_lat").alias("lat"),
            F.col("spatial_data.destination_lon").alias("lon"),
        )
        counts = snapshot.counts()
        counted = {row["table_name"]: row["n_rows"] for row in counts.collect()}
        snapshot.write(index_cost.measure(points, n_rows=counted["raw_deliveries"]), "raw_cl_benchmarks")
    return counts


def staging_views(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The staging models over the raw tables, also registered as temp views."""

    # one snapshot for all of them, whatever is published meanwhile
    source = snapshots.current(spark, database).get("raw", database)

    def raw(name: str) -> DataFrame:
        return spark.table(f"`{source}`.`raw_{name}`")

    views = {
        "stg_customers": staging.customers(raw("customers")),
        "stg_products": staging.products(raw("products")),
        "stg_sellers": staging.sellers(raw("sellers")),
        "stg_orders": staging.orders(raw("orders")),
        "stg_order_items": staging.order_items(raw("orders")),
        "stg_deliveries": staging.deliveries(raw("deliveries")),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views


def build(spark: SparkSession, database: str) -> list[str]:
    """Write the metrics and every mart, and make them the current ones together; returns the tables' names.

    The metrics are stored, not a view: all marts read them, and each would
    otherwise repeat the flattening and the join of the two facts. The hexagon mart is
    laid out for lookups. Until all tables are written and add up, readers get the old ones;
    replaced snapshots stay until :func:`snapshots.drop_old` is called.
    """
    missing = missing_tables(spark, database)
    if missing:
        raise ValueError(f"load these tables first: {', '.join(missing)}")
    views = staging_views(spark, database)
    benchmarks = snapshots.table(spark, database, "raw_cl_benchmarks")
    with scratch_run(spark), snapshots.refresh(spark, database, "marts", add_up, layout.COLUMNS) as snapshot:
        base = snapshot.write(metrics.delivery_metrics(views["stg_deliveries"], views["stg_orders"]), "int_delivery_metrics")
        snapshot.write(marts.deliveries(base), "mart_deliveries")
        snapshot.write(marts.kpis(base), "mart_kpis")
        snapshot.write(marts.district(base), "mart_district")
        snapshot.write(layout.laid_out(marts.h3(base)), "mart_h3", ["zone_block"])
        snapshot.write(marts.grid(base), "mart_grid")
        snapshot.write(comparison.spatial_comparison(base, benchmarks), "mart_spatial_comparison")
    return snapshot.tables


def add_up(snapshot: snapshots.Snapshot) -> None:
    """Raises if a mart doesn't stand for all deliveries of the metrics."""
    base = snapshot.table("int_delivery_metrics")
    rows, in_hexagons, in_grid = base.agg(F.count(F.lit(1)), F.count("h3_cell_9"), F.count("grid_cell_id")).first()
    held = {
        "mart_deliveries": (rows, snapshot.table("mart_deliveries").count()),
        **{
            name: (expected, snapshot.table(name).agg(F.coalesce(F.sum("total_deliveries"), F.lit(0))).first()[0])
            for name, expected in (("mart_kpis", rows), ("mart_h3", in_hexagons), ("mart_grid", in_grid))
        },
    }
    wrong = {name: counts for name, counts in held.items() if counts[0] != counts[1]}
    if wrong:
        raise ValueError(f"deliveries expected and found in {snapshot.name}: {wrong}")
