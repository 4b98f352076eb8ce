"""Registered queries: each runs one operator or model over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewright.functions.numeric import pct, round_half_away
from zonewright.operators import cover, quality, spatial, zones
from zonewright.plans import comparison, feeds, index_cost, marts, metrics, refresh, routes, staging
from zonewright.session import materialize, scratch_path, scratch_run
from zonewright.sources import readers, schemas, snapshots
from zonewright.sources.json_arrays import write_json_arrays
from zonewright.sources.sinks import ensure_database, literal_rows, row_counts
from zonewright.sources.testtables import TestTables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# A point in the city whose zone is looked up.
LOOKUP_POINT = (10.7769, 106.7009)


def query(fn: Callable[[TestTables], DataFrame]) -> Callable[[TestTables], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, folder: fn(TestTables(spark, folder))
    return fn


def rounded(df: DataFrame, **places: int) -> DataFrame:
    """Round float results whose last bits depend on the order of summation."""
    return df.withColumns({c: round_half_away(F.col(c), n) for c, n in places.items()})


def orders(t: TestTables) -> DataFrame:
    return staging.orders_with_totals(t.order_headers(staging.flat_totals(t.order_items())))


def deliveries(t: TestTables, stop_numbers: bool = False) -> DataFrame:
    return staging.deliveries(t.raw_deliveries(stop_numbers))


def delivery_metrics(t: TestTables, stop_numbers: bool = False) -> DataFrame:
    return metrics.delivery_metrics(deliveries(t, stop_numbers), orders(t))


# -- sources ------------------------------------------------------------------


@query
def src_dimension_profile(t: TestTables) -> DataFrame:
    """Write each dimension as CSV, columns in another order, read it under its schema, profile it."""
    profiles = []
    for name, key, category, number in (
        ("customers", "customer_id", "segment", None),
        ("products", "product_id", "category", "price_usd"),
        ("sellers", "seller_id", "district", "warehouse_lat"),
    ):
        path = scratch_path(t.spark, name)
        written = getattr(t, name)()
        written.select(*reversed(written.columns)).write.option("header", True).csv(path)
        table = readers.read_csv(t.spark, path, schemas.DIMENSIONS[name])
        total = F.sum(number) if number else F.lit(None).cast("double")
        profiles.append(
            table.agg(
                F.lit(name).alias("table_name"),
                F.count(F.lit(1)).alias("n_rows"),
                F.count_distinct(key).alias("n_ids"),
                F.count_distinct(category).alias("n_categories"),
                round_half_away(total, 2).alias("number_sum"),
            )
        )
    return reduce(DataFrame.unionByName, profiles)


@query
def src_ndjson_roundtrip(t: TestTables) -> DataFrame:
    """Write telemetry as NDJSON, adding zone ids on the way; read and stage it."""
    path = scratch_path(t.spark, "telemetry")
    readers.write_ndjson(t.delivery_telemetry(), path, transform=spatial.with_cells)
    raw = readers.read_ndjson(t.spark, path, schemas.DELIVERIES)
    return staging.deliveries(raw).drop("stop_number")


@query
def row_count_audit(t: TestTables) -> DataFrame:
    return row_counts(
        {
            "raw_customers": t.customers(),
            "raw_products": t.products(),
            "raw_sellers": t.sellers(),
            "raw_orders": t.order_headers(staging.flat_totals(t.order_items())),
            "raw_deliveries": t.raw_deliveries(),
        }
    )


@query
def cl_benchmark(t: TestTables) -> DataFrame:
    points = t.delivery_telemetry().select(
        F.col("spatial_data.destination_lat").alias("lat"),
        F.col("spatial_data.destination_lon").alias("lon"),
    )
    return index_cost.measure(materialize(points, "points")).select(
        "method",
        "n_rows",
        (F.col("total_seconds") > 0).alias("took_time"),
        (
            F.abs(F.col("microseconds_per_row") * F.col("n_rows") / 1e6 - F.col("total_seconds")) < 1e-6
        ).alias("is_consistent"),
    )


# -- staging ------------------------------------------------------------------


@query
def stg_customers(t: TestTables) -> DataFrame:
    return staging.customers(t.customers())


@query
def stg_products(t: TestTables) -> DataFrame:
    return staging.products(t.products())


@query
def stg_sellers(t: TestTables) -> DataFrame:
    return staging.sellers(t.sellers())


@query
def stg_orders(t: TestTables) -> DataFrame:
    return rounded(staging.orders(t.order_documents()), subtotal_usd=2)


@query
def stg_order_items(t: TestTables) -> DataFrame:
    items = staging.order_items(t.order_documents())
    return rounded(items, unit_price_usd=6, line_total_usd=2)


@query
def stg_deliveries(t: TestTables) -> DataFrame:
    return deliveries(t, stop_numbers=True)


# -- metrics ------------------------------------------------------------------


@query
def join_delivery_orders(t: TestTables) -> DataFrame:
    joined = metrics.join_orders(deliveries(t), orders(t))
    return joined.select(
        "order_id", "vehicle_type", "destination_district", "total_freight_usd", "payment_method"
    )


@query
def int_delivery_metrics(t: TestTables) -> DataFrame:
    return rounded(
        delivery_metrics(t, stop_numbers=True), delay_cost_usd=6, margin_gap_usd=6
    )


@query
def route_schedule(t: TestTables) -> DataFrame:
    return routes.schedule(t.route_stops())


# -- marts --------------------------------------------------------------------


@query
def mart_deliveries(t: TestTables) -> DataFrame:
    return rounded(marts.deliveries(delivery_metrics(t)), delay_cost_usd=6, margin_gap_usd=6)


@query
def mart_kpis(t: TestTables) -> DataFrame:
    return marts.kpis(delivery_metrics(t))


@query
def mart_district(t: TestTables) -> DataFrame:
    return marts.district(delivery_metrics(t))


@query
def mart_h3(t: TestTables) -> DataFrame:
    return marts.h3(delivery_metrics(t))


@query
def mart_h3_levels(t: TestTables) -> DataFrame:
    return marts.h3_levels(delivery_metrics(t))


@query
def mart_grid(t: TestTables) -> DataFrame:
    return marts.grid(delivery_metrics(t))


@query
def mart_spatial_comparison(t: TestTables) -> DataFrame:
    base = materialize(delivery_metrics(t).select(*comparison.COLUMNS), "metrics")
    return comparison.spatial_comparison(base)


# Published microseconds per row, for the comparison's last column.
INDEX_COST = [("H3", 100_000, 0.331, 3.31), ("Grid", 100_000, 0.007, 0.07)]


@query
def mart_spatial_comparison_cost(t: TestTables) -> DataFrame:
    """The comparison next to a given table of index costs."""
    base = materialize(delivery_metrics(t).select(*comparison.COLUMNS), "metrics")
    costs = literal_rows(t.spark, INDEX_COST, schemas.CL_BENCHMARKS)
    return comparison.spatial_comparison(base, costs)


# -- stored route ---------------------------------------------------------------

_databases: dict[tuple[str, str], str] = {}


def stored(t: TestTables) -> str:
    """A database loaded and built from files, as a user does it, once per session and folder.

    Orders come as JSON arrays, telemetry as arrays that are rewritten as NDJSON with
    zone ids, dimensions as CSV.
    """
    key = t.spark.sparkContext.applicationId, t.folder
    if key in _databases:
        return _databases[key]
    spark, name = t.spark, f"zones_{uuid.uuid4().hex}"
    location = scratch_path(spark, "database")
    with scratch_run(spark) as folder:
        raw = {}
        for dimension, schema in schemas.DIMENSIONS.items():
            getattr(t, dimension)().write.option("header", True).csv(f"{folder}/{dimension}")
            raw[f"raw_{dimension}"] = readers.read_csv(spark, f"{folder}/{dimension}", schema)
        documents = t.order_documents().drop(*staging.ITEM_TOTALS)
        write_json_arrays(documents, f"{folder}/orders", compression="gzip")
        raw["raw_orders"] = readers.read_json_array(spark, f"{folder}/orders/*", schemas.ORDERS)
        write_json_arrays(t.delivery_telemetry(), f"{folder}/telemetry", compression="gzip")
        readers.json_array_to_ndjson(
            spark, f"{folder}/telemetry/*", f"{folder}/deliveries", schemas.DELIVERY_TELEMETRY, spatial.with_cells, "gzip"
        )
        raw["raw_deliveries"] = readers.read_ndjson(spark, f"{folder}/deliveries", schemas.DELIVERIES)
        ensure_database(spark, name, location)
        refresh.load(spark, raw, name)
    refresh.build(spark, name)
    _databases[key] = name
    return name


@query
def stored_mart_h3(t: TestTables) -> DataFrame:
    return readers.read_mart(t.spark, stored(t), "mart_h3")


@query
def stored_mart_kpis(t: TestTables) -> DataFrame:
    return readers.read_mart(t.spark, stored(t), "mart_kpis")


@query
def stored_zone_lookup(t: TestTables) -> DataFrame:
    """The zone of a point, from the one folder of the stored mart that holds it."""
    return feeds.stored_zone_lookup(snapshots.table(t.spark, stored(t), "mart_h3"), *LOOKUP_POINT)


@query
def stored_tables(t: TestTables) -> DataFrame:
    """The tables of the stored route with their rows, and the declared ones that are missing."""
    database = stored(t)
    names = sorted(table.name for table in t.spark.catalog.listTables(database) if not table.isTemporary)
    missing = {f"missing {name}": t.spark.range(1) for name in schemas.missing_tables(t.spark, database)}
    return row_counts({name: t.spark.table(f"{database}.{name}") for name in names} | missing)


@query
def stored_order_items(t: TestTables) -> DataFrame:
    """The item view over the stored order documents."""
    items = refresh.staging_views(t.spark, stored(t))["stg_order_items"]
    return rounded(items, unit_price_usd=6, line_total_usd=2)


# -- aggregates ---------------------------------------------------------------


@query
def agg_filtered_pct(t: TestTables) -> DataFrame:
    failed = F.col("delivery_status") == "failed"
    counts = zones.filtered_share(deliveries(t), "h3_cell_9", failed, "failed")
    return counts.withColumn("failure_rate_pct", pct(F.col("failed"), F.col("deliveries")))


@query
def agg_distinct_drivers(t: TestTables) -> DataFrame:
    return zones.distinct_per_zone(deliveries(t), "grid_cell_id", "driver_id")


@query
def agg_mode_zone(t: TestTables) -> DataFrame:
    return zones.mode_per_zone(deliveries(t), "h3_cell_9", "traffic_zone")


@query
def cell_stats(t: TestTables) -> DataFrame:
    stats = comparison.cell_stats(delivery_metrics(t)).filter("cell IS NOT NULL")
    return rounded(
        stats.drop("centroid_lat", "centroid_lon"), avg_delay=4, stddev_delay=4, cell_margin_gap=2
    )


@query
def fleet_totals(t: TestTables) -> DataFrame:
    return rounded(comparison.fleet_totals(delivery_metrics(t)), total_margin_gap=2)


# -- spatial ------------------------------------------------------------------


@query
def idx_grid(t: TestTables) -> DataFrame:
    return deliveries(t).select("order_id", "destination_lat", "destination_lon", "grid_cell_id")


@query
def idx_hex(t: TestTables) -> DataFrame:
    return deliveries(t).select("order_id", "destination_lat", "destination_lon", "h3_cell_9")


@query
def hex_centroids(t: TestTables) -> DataFrame:
    centroids = zones.zone_centroids(
        deliveries(t), "h3_cell_9", "destination_lat", "destination_lon"
    )
    return rounded(centroids, centroid_lat=6, centroid_lon=6)


@query
def grid_centroids(t: TestTables) -> DataFrame:
    return rounded(comparison.grid_centroids(deliveries(t)), centroid_lat=6, centroid_lon=6)


@query
def mdqe_hex(t: TestTables) -> DataFrame:
    points = deliveries(t)
    centroids = materialize(
        zones.zone_centroids(points, "h3_cell_9", "destination_lat", "destination_lon"),
        "centroids",
    )
    mean = comparison.hex_distances(points, centroids).agg(F.avg("hex_km").alias("mdqe_km"))
    return rounded(mean, mdqe_km=4)


@query
def mdqe_grid(t: TestTables) -> DataFrame:
    return rounded(comparison.mean_grid_distance(deliveries(t)), mdqe_km=4)


@query
def sdc_measured(t: TestTables) -> DataFrame:
    cells = comparison.by_method(deliveries(t)).filter("cell IS NOT NULL").distinct()
    spread = spatial.distance_spread(spatial.neighbour_distances(cells))
    return rounded(spread, mean_distance_km=4, sdc_km=4)


@query
def hex_lattice(t: TestTables) -> DataFrame:
    """All hexagons in the box around the deliveries."""
    box = spatial.bounds(deliveries(t), "destination_lat", "destination_lon")
    return rounded(spatial.hex_lattice(box), centre_lat=6, centre_lon=6)


def district_areas(t: TestTables) -> DataFrame:
    """An outline per district around its deliveries inside the city box: notched from the north, with a hole in the south."""
    south, west, north, east = spatial.CITY_BOX
    inside = F.col("destination_lat").between(south, north) & F.col("destination_lon").between(west, east)
    box = delivery_metrics(t).where(inside & F.col("destination_district").isNotNull())
    box = box.groupBy("destination_district").agg(
        F.min("destination_lat").alias("s"),
        F.min("destination_lon").alias("w"),
        F.max("destination_lat").alias("n"),
        F.max("destination_lon").alias("e"),
    )
    # (ring, place, lat and lon as shares of the box's height and width)
    outline = [(0, 0, 0.0, 0.0), (0, 1, 0.0, 1.0), (0, 2, 1.0, 1.0), (0, 3, 0.5, 0.5), (0, 4, 1.0, 0.0)]
    hole = [(1, 0, 0.125, 0.5), (1, 1, 0.25, 0.625), (1, 2, 0.375, 0.5), (1, 3, 0.25, 0.375)]
    vertices = F.array(
        *[
            F.struct(
                F.lit(ring).alias("ring"),
                F.lit(place).alias("place"),
                (F.col("s") + (F.col("n") - F.col("s")) * up).alias("lat"),
                (F.col("w") + (F.col("e") - F.col("w")) * right).alias("lon"),
            )
            for ring, place, up, right in outline + hole
        ]
    )
    return box.select(F.col("destination_district").alias("polygon"), F.explode(vertices).alias("v")).select("polygon", "v.*")


@query
def hex_cover(t: TestTables) -> DataFrame:
    """The hexagons of each district's area."""
    covered = cover.hex_cover(district_areas(t)).withColumnRenamed("polygon", "district")
    return rounded(covered, centre_lat=6, centre_lon=6)


# -- feeds --------------------------------------------------------------------


def map_inputs(t: TestTables) -> tuple[DataFrame, DataFrame]:
    return spatial.hex_lattice(spatial.city_box(t.spark)), feeds.h3_zones(mart_h3(t))


def zone_map(t: TestTables) -> DataFrame:
    return feeds.zone_map(*map_inputs(t))


@query
def feed_kpi_cards(t: TestTables) -> DataFrame:
    return feeds.kpi_cards(mart_kpis(t))


@query
def feed_district(t: TestTables) -> DataFrame:
    return feeds.district(mart_district(t))


@query
def feed_district_by_gap(t: TestTables) -> DataFrame:
    return feeds.district(mart_district(t), by="margin_gap_usd")


@query
def feed_h3_zones(t: TestTables) -> DataFrame:
    return feeds.h3_zones(mart_h3(t))


@query
def feed_hotspots(t: TestTables) -> DataFrame:
    return feeds.hotspots(mart_h3(t))


@query
def feed_hotspot_table(t: TestTables) -> DataFrame:
    return feeds.hotspot_table(feeds.hotspots(mart_h3(t)))


@query
def feed_recommendation(t: TestTables) -> DataFrame:
    return feeds.recommendation(feeds.hotspots(mart_h3(t)))


@query
def feed_zone_map(t: TestTables) -> DataFrame:
    return zone_map(t)


@query
def feed_zone_kpis(t: TestTables) -> DataFrame:
    return feeds.zone_kpis(zone_map(t))


@query
def feed_zone_lookup(t: TestTables) -> DataFrame:
    return feeds.zone_lookup(*map_inputs(t), *LOOKUP_POINT)


# -- quality ------------------------------------------------------------------


def ids_with_null(t: TestTables) -> DataFrame:
    """Customer ids and one NULL id, the sample model of the column tests."""
    ids = t["customer"].select(F.col("c_custkey").alias("id"))
    null_id = t.spark.range(1).select(F.lit(None).cast("bigint").alias("id"))
    return ids.unionByName(null_id)


@query
def example_null_id(t: TestTables) -> DataFrame:
    return ids_with_null(t)


@query
def example_first_id(t: TestTables) -> DataFrame:
    return ids_with_null(t).where("id = 1")


CHECKED_COLUMNS = [
    ("orders", "o_orderkey"),
    ("customer", "c_custkey"),
    ("lineitem", "l_orderkey"),
    ("events", "user_id"),
]


@query
def dq_unique(t: TestTables) -> DataFrame:
    tests = [quality.unique(t[name], name, column) for name, column in CHECKED_COLUMNS]
    tests.append(quality.unique(ids_with_null(t), "ids_with_null", "id"))
    return reduce(DataFrame.unionByName, tests)


@query
def dq_not_null(t: TestTables) -> DataFrame:
    tests = [quality.not_null(t[name], name, column) for name, column in CHECKED_COLUMNS]
    tests.append(quality.not_null(ids_with_null(t), "ids_with_null", "id"))
    return reduce(DataFrame.unionByName, tests)


@query
def dq_route_sequence(t: TestTables) -> DataFrame:
    """Faults in the stop numbers, arrivals and dispatches that telemetry carries, per route."""
    carried = materialize(t.carried_telemetry(), "carried")
    continuity = quality.route_continuity(carried)
    return quality.route_sequence(carried).join(continuity, "route_id")


@query
def dq_payment_reconciles(t: TestTables) -> DataFrame:
    return quality.payment_reconciliation(orders(t))
