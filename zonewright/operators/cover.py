"""Covering of polygons with hexagons: a scanline over the rows of the lattice."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zonewright.functions import geo


def ring_edges(rings: DataFrame) -> DataFrame:
    """(polygon, lat1, lon1, lat2, lon2) of every side, the closing one included.

    ``rings`` has a row per vertex: polygon, ring, place (its order in the ring), lat, lon. Vertices
    without coordinates are left out, a closing vertex may be repeated. Sides
    run from the smaller end to the larger one, so two polygons that share a
    side have exactly the same one.
    """
    ring = Window.partitionBy("polygon", "ring").orderBy("place")
    end = F.struct("lat", "lon")
    # from the ring's first vertex on, whatever its place
    first = F.first(end).over(ring.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sides = rings.where("lat IS NOT NULL AND lon IS NOT NULL").select(
        "polygon", end.alias("a"), F.coalesce(F.lead(end).over(ring), first).alias("b")
    )
    low, high = F.least("a", "b"), F.greatest("a", "b")
    return sides.select(
        "polygon",
        low["lat"].alias("lat1"),
        low["lon"].alias("lon1"),
        high["lat"].alias("lat2"),
        high["lon"].alias("lon2"),
    )


def hex_cover(rings: DataFrame, reference_lat: float = geo.REFERENCE_LAT) -> DataFrame:
    """Every hexagon whose centre lies in a polygon: polygon, ``h3_cell_9``, q, r and centre.

    Takes vertices as :func:`ring_edges` does. A polygon has any number of rings, and a point is
    inside if a line from it crosses their sides an odd number of times: holes, islands in them and
    concave rings need no marking. Polygons may overlap; where two share a side,
    a centre on it belongs to one of them. A polygon without area has no cells.

    Each side meets the lattice rows between its ends once. In a row the
    crossings, in order, open and close the runs of columns that are inside. So
    the work follows the polygons' outlines and the output their areas; no box around them is
    filled. Rows expand in parallel, a crowded one is sorted, not collected.
    """
    tasks = int(rings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row_height = 1.5 * geo.HEX_SIDE_KM
    column_width = math.sqrt(3.0) * geo.HEX_SIDE_KM
    q, r = F.col("q"), F.col("r")

    # the lattice's own axes: rows at whole v, centres of row r at u = q + r / 2
    def v(lat: str) -> Column:
        return F.col(lat) * geo.KM_PER_DEG_LAT / row_height

    def u(lon: str) -> Column:
        return F.col(lon) * geo.km_per_degree_lon(reference_lat) / column_width

    sides = ring_edges(rings).select(
        "polygon", u("lon1").alias("u1"), v("lat1").alias("v1"), u("lon2").alias("u2"), v("lat2").alias("v2")
    )
    # a row at an end is met by the side above it only, so a vertex counts once
    first_row, last_row = F.ceil("v1"), F.ceil("v2") - 1
    met = sides.where(first_row <= last_row).withColumn("r", F.explode(F.sequence(first_row, last_row)))
    slope = (F.col("u2") - F.col("u1")) / (F.col("v2") - F.col("v1"))
    crossings = met.select("polygon", "r", (F.col("u1") + (r - F.col("v1")) * slope).alias("u")).repartition(
        tasks, "polygon", "r"
    )
    in_row = Window.partitionBy("polygon", "r").orderBy("u")
    runs = crossings.select(
        "polygon", "r", "u", F.lead("u").over(in_row).alias("until"), F.row_number().over(in_row).alias("nth")
    ).where("nth % 2 = 1")
    first_column, last_column = F.ceil(F.col("u") - r / 2.0), F.ceil(F.col("until") - r / 2.0) - 1
    cells = runs.where(first_column <= last_column).select(
        "polygon", "r", F.explode(F.sequence(first_column, last_column)).alias("q")
    )
    centre_lat, centre_lon = geo.hex_centre(q, r, reference_lat)
    return cells.select(
        "polygon",
        geo.hex_id(q, r).alias("h3_cell_9"),
        "q",
        "r",
        centre_lat.alias("centre_lat"),
        centre_lon.alias("centre_lon"),
    )


def box_rings(boxes: DataFrame) -> DataFrame:
    """The outlines of boxes (polygon, south, west, north, east) as vertices."""
    corners = [("south", "west"), ("south", "east"), ("north", "east"), ("north", "west")]
    vertices = F.array(*[F.struct(F.col(lat).alias("lat"), F.col(lon).alias("lon")) for lat, lon in corners])
    return boxes.select("polygon", F.lit(0).alias("ring"), F.posexplode(vertices).alias("place", "vertex")).select(
        "polygon", "ring", "place", "vertex.lat", "vertex.lon"
    )
