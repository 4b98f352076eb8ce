"""Zone index enrichment, cell lattices and neighbour distances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewright.functions import geo
from zonewright.functions.geo import haversine_km

# The city box, south-west and north-east corner.
CITY_BOX = (10.63, 106.56, 10.91, 106.81)


def with_cells(
    documents: DataFrame,
    lat: str = "spatial_data.destination_lat",
    lon: str = "spatial_data.destination_lon",
    reference_lat: float = geo.REFERENCE_LAT,
) -> DataFrame:
    """Add ``h3_cell_9`` and ``grid_cell_id``; a zone id already there is kept, row by row.

    Free of state, so it runs inside the scan. The column may be missing, or be
    declared and hold ids for some rows only.
    """
    point = F.col(lat), F.col(lon)
    indexes = {"h3_cell_9": geo.hex_cell(*point, reference_lat), "grid_cell_id": geo.grid_cell(*point)}
    for name, computed in indexes.items():
        known = [F.col(name)] if name in documents.columns else []
        documents = documents.withColumn(name, F.coalesce(*known, computed))
    return documents


def bounds(points: DataFrame, lat: str, lon: str) -> DataFrame:
    """One row: the box around all points."""
    return points.agg(
        F.min(lat).alias("south"),
        F.min(lon).alias("west"),
        F.max(lat).alias("north"),
        F.max(lon).alias("east"),
    )


def city_box(spark) -> DataFrame:
    south, west, north, east = (F.lit(v) for v in CITY_BOX)
    return spark.range(1).select(
        south.alias("south"), west.alias("west"), north.alias("north"), east.alias("east")
    )


def hex_lattice(box: DataFrame, reference_lat: float = geo.REFERENCE_LAT) -> DataFrame:
    """Every hexagon whose centre lies in the box: (h3_cell_9, q, r, centre).

    Lattice rows are spread over the cluster before each expands to its cells,
    so a large box is not one task's work. The number of tasks is given, as the
    rows are too few for AQE to see a reason for more than one.
    """
    tasks = int(box.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    km_per_degree = geo.km_per_degree_lon(reference_lat)
    south, west, north, east = (F.col(c) for c in ("south", "west", "north", "east"))
    q, r = F.col("q"), F.col("r")

    def row_of(lat: Column) -> Column:
        return lat * geo.KM_PER_DEG_LAT / (1.5 * geo.HEX_SIDE_KM)

    # x = S * sqrt(3) * (q + r / 2), solved for q; one cell of slack on each side
    def column_of(lon: Column) -> Column:
        return lon * km_per_degree * geo.SQRT3_OVER_3 / geo.HEX_SIDE_KM - r / 2.0

    rows = box.withColumn(
        "r", F.explode(F.sequence(F.floor(row_of(south)) - 1, F.ceil(row_of(north)) + 1))
    ).repartition(tasks, "r")
    cells = rows.withColumn(
        "q", F.explode(F.sequence(F.floor(column_of(west)) - 1, F.ceil(column_of(east)) + 1))
    )
    centre_lat, centre_lon = geo.hex_centre(q, r, reference_lat)
    return (
        cells.withColumn("centre_lat", centre_lat)
        .withColumn("centre_lon", centre_lon)
        .filter(F.col("centre_lat").between(south, north))
        .filter(F.col("centre_lon").between(west, east))
        .select(geo.hex_id(q, r).alias("h3_cell_9"), "q", "r", "centre_lat", "centre_lon")
    )


def cell_at(spark, lat: float, lon: float, reference_lat: float = geo.REFERENCE_LAT) -> DataFrame:
    """The row that :func:`hex_lattice` of the city box has for a point's hexagon; none if its centre is outside."""
    south, west, north, east = CITY_BOX
    q, r = geo.hex_axial(F.lit(lat), F.lit(lon), reference_lat)
    # the row's number, zero, makes the id a column: a join on a constant would be a nested loop
    q = q + F.col("id")
    centre_lat, centre_lon = geo.hex_centre(q, r, reference_lat)
    cell = spark.range(1).select(
        geo.hex_id(q, r).alias("h3_cell_9"), q.alias("q"), r.alias("r"), centre_lat.alias("centre_lat"), centre_lon.alias("centre_lon")
    )
    return cell.filter(F.col("centre_lat").between(south, north) & F.col("centre_lon").between(west, east))


def neighbour_distances(cells: DataFrame) -> DataFrame:
    """(method, distance_km) from each (method, cell) to each of its neighbours.

    Hexagons have 6 neighbours, grid cells 8. A narrow step: neighbours follow
    from the id, whether or not they hold data.
    """
    first, second = (geo.lattice_step(F.col("cell"), i) for i in (1, 2))

    def offsets(steps: list[tuple[int, int]]) -> Column:
        return F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in steps])

    def hex_point(a: Column, b: Column) -> tuple[Column, Column]:
        return geo.hex_centre(first + a, second + b)

    def grid_point(a: Column, b: Column) -> tuple[Column, Column]:
        half = geo.GRID_SIZE_DEG / 2
        return (
            (first + a) * geo.GRID_SIZE_DEG + half,
            (second + b) * geo.GRID_SIZE_DEG + half,
        )

    is_hex = F.col("method") == "H3"
    here = F.lit(0), F.lit(0)
    there = F.col("step.a"), F.col("step.b")

    def distance(point) -> Column:
        return haversine_km(*point(*here), *point(*there))

    return cells.withColumn(
        "step",
        F.explode(F.when(is_hex, offsets(geo.HEX_NEIGHBOURS)).otherwise(offsets(geo.GRID_NEIGHBOURS))),
    ).select(
        "method", F.when(is_hex, distance(hex_point)).otherwise(distance(grid_point)).alias("distance_km")
    )


def distance_spread(distances: DataFrame) -> DataFrame:
    """Per method: neighbours seen, mean distance and its population spread."""
    return distances.groupBy("method").agg(
        F.count(F.lit(1)).alias("neighbour_pairs"),
        F.avg("distance_km").alias("mean_distance_km"),
        F.stddev_pop("distance_km").alias("sdc_km"),
    )
