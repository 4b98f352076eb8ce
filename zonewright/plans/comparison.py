"""Hexagons against the grid: which zones surface delay and loss better.

Two passes over the deliveries: one aggregates both zone schemes at once, the
second measures each delivery's distance to its zone's centroid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewright.functions import geo
from zonewright.functions.numeric import money, pct, ratio, round_half_away
from zonewright.functions.rules import DELAY_THRESHOLD, is_delayed
from zonewright.session import materialize

# Method key -> label and neighbour-distance spread in km.
METHODS = {
    "H3": ("H3 (res=9, ~0.1 km²)", 0.000),
    "Grid": ("Grid (0.01°, ~1.1 km²)", 0.228),
}

# What the comparison reads of the metrics.
COLUMNS = (
    "h3_cell_9",
    "grid_cell_id",
    "destination_lat",
    "destination_lon",
    "delay_minutes",
    "margin_gap_usd",
)


def by_method(df: DataFrame, *columns: str) -> DataFrame:
    """Each row twice, as (method, cell, columns): once per zone scheme."""
    return df.select(
        *columns, F.col("h3_cell_9").alias("H3"), F.col("grid_cell_id").alias("Grid")
    ).unpivot(list(columns), list(METHODS), "method", "cell")


def fleet_totals(metrics: DataFrame) -> DataFrame:
    """One row: deliveries, delayed deliveries, margin gap."""
    return metrics.agg(
        F.count(F.lit(1)).alias("total_deliveries"),
        F.count_if(is_delayed()).alias("total_delayed"),
        F.sum(money(F.col("margin_gap_usd"))).alias("total_margin_gap"),
    )


def cell_stats(metrics: DataFrame) -> DataFrame:
    """Per (method, cell): size, delay mean and spread, gap, hotspot, centroid.

    Deliveries without a zone form a group with a NULL cell. It is no zone, but
    the fleet totals are the sums over all groups of a method. Rows are combined
    per pair of zones first, so that only pairs are doubled. Delays are integers, so their
    sums and squares are exact.
    """
    delay = F.col("delay_minutes").cast("decimal(20,0)")
    pairs = metrics.groupBy("h3_cell_9", "grid_cell_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("delay_minutes").alias("timed"),
        F.sum("delay_minutes").alias("delay_sum"),
        F.sum((delay * delay).cast("decimal(28,0)")).alias("square_sum"),
        F.sum(money(F.col("margin_gap_usd"))).alias("gap"),
        F.count_if(is_delayed()).alias("delayed"),
        F.count("destination_lat").alias("placed"),
        F.sum("destination_lat").alias("lat"),
        F.sum("destination_lon").alias("lon"),
    )
    sums = ["n", "timed", "delay_sum", "square_sum", "gap", "delayed", "placed", "lat", "lon"]
    cells = by_method(pairs, *sums).groupBy("method", "cell").agg(*[F.sum(c).alias(c) for c in sums])
    mean = ratio(F.col("delay_sum"), F.col("timed"))
    squares = F.col("square_sum").cast("double") - F.col("delay_sum").cast("double") * mean
    return cells.select(
        "method",
        "cell",
        F.col("n").alias("deliveries"),
        mean.alias("avg_delay"),
        F.sqrt(ratio(F.greatest(squares, F.lit(0.0)), F.nullif(F.col("timed") - 1, F.lit(0)))).alias("stddev_delay"),
        F.col("gap").alias("cell_margin_gap"),
        F.col("delayed").alias("delayed_count"),
        (mean > DELAY_THRESHOLD).alias("is_hotspot"),
        ratio(F.col("lat"), F.col("placed")).alias("centroid_lat"),
        ratio(F.col("lon"), F.col("placed")).alias("centroid_lon"),
    )


def _to_grid_centre() -> Column:
    """The grid centroid is a function of the point, so it needs no join."""
    lat, lon = F.col("destination_lat"), F.col("destination_lon")
    distance = geo.haversine_km(lat, lon, geo.grid_centre(lat), geo.grid_centre(lon))
    return F.when(F.col("grid_cell_id").isNotNull(), distance)


def hex_distances(points: DataFrame, centroids: DataFrame) -> DataFrame:
    """Points with ``hex_km``, the distance to the mean point of their hexagon.

    ``centroids`` (h3_cell_9, centroid_lat, centroid_lon) should be a stored
    table: the planner then broadcasts it only if its size allows, and else
    shuffles both sides, where AQE splits crowded zones.
    """
    distance = geo.haversine_km(
        F.col("destination_lat"),
        F.col("destination_lon"),
        F.col("centroid_lat"),
        F.col("centroid_lon"),
    )
    return points.join(centroids, "h3_cell_9", "left").withColumn("hex_km", distance)


def mean_distances(points: DataFrame, centroids: DataFrame) -> DataFrame:
    """(method, mdqe_km): mean distance from delivery to zone centroid."""
    both = hex_distances(points, centroids).agg(
        F.avg("hex_km").alias("H3"), F.avg(_to_grid_centre()).alias("Grid")
    )
    return both.unpivot([], list(METHODS), "method", "mdqe_km")


def grid_centroids(points: DataFrame) -> DataFrame:
    """(grid_cell_id, centroid): the midpoint of every grid cell with deliveries."""
    return (
        points.filter(F.col("grid_cell_id").isNotNull())
        .select(
            "grid_cell_id",
            geo.grid_centre(F.col("destination_lat")).alias("centroid_lat"),
            geo.grid_centre(F.col("destination_lon")).alias("centroid_lon"),
        )
        .distinct()
    )


def mean_grid_distance(points: DataFrame) -> DataFrame:
    return points.agg(F.avg(_to_grid_centre()).alias("mdqe_km"))


def _summary(stats: DataFrame) -> DataFrame:
    """Cells to one row per method. Sums over hotspots are NULL if there is none."""
    is_cell = F.col("cell").isNotNull()
    hot = is_cell & F.col("is_hotspot")

    def over_hotspots(column: str) -> Column:
        return F.sum(F.when(hot, F.col(column)))

    return stats.groupBy("method").agg(
        F.count_if(is_cell).alias("total_cells"),
        F.count_if(hot).alias("hotspot_cells"),
        pct(over_hotspots("delayed_count"), F.sum("delayed_count")).alias(
            "hotspot_capture_rate_pct"
        ),
        pct(over_hotspots("delayed_count"), over_hotspots("deliveries")).alias(
            "hotspot_precision_pct"
        ),
        round_half_away(over_hotspots("cell_margin_gap"), 2).alias("margin_gap_in_hotspots_usd"),
        pct(over_hotspots("cell_margin_gap"), F.sum("cell_margin_gap")).alias(
            "margin_gap_capture_pct"
        ),
        round_half_away(F.avg(F.when(is_cell, F.col("stddev_delay"))), 2).alias(
            "avg_within_cell_delay_stddev"
        ),
    )


def spatial_comparison(metrics: DataFrame, index_cost: DataFrame | None = None) -> DataFrame:
    """Two rows, one per zone scheme.

    ``metrics`` is read twice, so it should be a stored table. ``index_cost``
    is the benchmark table (method, ..., microseconds_per_row), if there is one.
    The per-cell statistics are stored on the way: the second pass and the
    summary share them, and the join sees their size.
    """
    stats = materialize(cell_stats(metrics.select(*COLUMNS)), "cell_stats")
    centroids = stats.filter("method = 'H3' AND cell IS NOT NULL").select(
        F.col("cell").alias("h3_cell_9"), "centroid_lat", "centroid_lon"
    )
    rows = _summary(stats).join(mean_distances(metrics.select(*COLUMNS), centroids), "method")
    if index_cost is None:
        rows = rows.withColumn("microseconds_per_row", F.lit(None).cast("double"))
    else:
        rows = rows.join(index_cost.select("method", "microseconds_per_row"), "method", "left")

    def of_method(position: int) -> Column:
        h3, grid = METHODS["H3"][position], METHODS["Grid"][position]
        return F.when(F.col("method") == "H3", F.lit(h3)).otherwise(F.lit(grid))

    return rows.select(
        of_method(0).alias("method"),
        "total_cells",
        "hotspot_cells",
        "hotspot_capture_rate_pct",
        "hotspot_precision_pct",
        "margin_gap_in_hotspots_usd",
        "margin_gap_capture_pct",
        "avg_within_cell_delay_stddev",
        round_half_away(F.col("mdqe_km"), 4).alias("mdqe_km"),
        of_method(1).alias("sdc_km"),
        round_half_away(F.col("microseconds_per_row"), 4).alias("cl_us_per_row"),
    )
