"""Zone ids, zone centres and distances as pure column expressions.

Nothing here leaves whole-stage code generation, so indexing a delivery costs
arithmetic only and runs inside the scan stage.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0

GRID_SIZE_DEG = 0.01

# Planar hexagon lattice: pointy-top, equal size, area 0.1053 km2. It is true to scale at
# its reference latitude and a degree or two around it; another city takes its own.
REFERENCE_LAT = 10.77

# Km per degree at 10.77 degrees north, side in km, sqrt(3) / 3.
KM_PER_DEG_LON = 109.23625344213714
KM_PER_DEG_LAT = 111.19492664455873
HEX_SIDE_KM = 0.20132061220131367
SQRT3_OVER_3 = 0.5773502691896257

# Neighbour offsets in lattice steps.
HEX_NEIGHBOURS = [(1, 0), (-1, 0), (0, 1), (0, -1), (1, -1), (-1, 1)]
GRID_NEIGHBOURS = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a, b) != (0, 0)]


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km on a sphere of radius 6371 km."""
    half_dlat = F.radians((lat2 - lat1) / 2.0)
    half_dlon = F.radians((lon2 - lon1) / 2.0)
    a = F.pow(F.sin(half_dlat), 2.0) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_dlon), 2.0
    )
    return 2.0 * EARTH_RADIUS_KM * F.asin(F.sqrt(a))


def km_per_degree_lon(reference_lat: float) -> float:
    if reference_lat == REFERENCE_LAT:
        return KM_PER_DEG_LON
    return KM_PER_DEG_LAT * math.cos(math.radians(reference_lat))


def _cell_id(first: Column, second: Column) -> Column:
    # concat is NULL if either part is, so a point without coordinates has no cell
    return F.concat(first.cast("string"), F.lit("_"), second.cast("string"))


# -- rectangular grid ---------------------------------------------------------


def grid_cell(lat: Column, lon: Column) -> Column:
    """``floor(lat / 0.01)_floor(lon / 0.01)``."""
    return _cell_id(F.floor(lat / GRID_SIZE_DEG), F.floor(lon / GRID_SIZE_DEG))


def grid_centre(coordinate: Column) -> Column:
    """Centre, along one axis, of the grid cell that holds ``coordinate``."""
    return F.floor(coordinate / GRID_SIZE_DEG) * GRID_SIZE_DEG + GRID_SIZE_DEG / 2


# Ids of both schemes here: two integers.
LATTICE_ID = r"^-?\d+_-?\d+$"


def lattice_step(cell: Column, position: int) -> Column:
    """One of the two integers in a cell id; NULL if the id is malformed."""
    return F.split_part(cell, F.lit("_"), F.lit(position)).try_cast("int")


# -- planar hexagons ----------------------------------------------------------


def hex_axial(
    lat: Column, lon: Column, reference_lat: float = REFERENCE_LAT
) -> tuple[Column, Column]:
    """Axial lattice coordinates (q, r) of the hexagon that holds a point.

    Each cube coordinate is rounded on its own; the one that moved furthest is
    then recomputed from the other two, so the three still sum to zero.
    """
    x = lon * km_per_degree_lon(reference_lat)
    y = lat * KM_PER_DEG_LAT
    q = (SQRT3_OVER_3 * x - y / 3.0) / HEX_SIDE_KM
    r = (2.0 * y / 3.0) / HEX_SIDE_KM
    s = -q - r
    q0, r0, s0 = (F.floor(v + 0.5) for v in (q, r, s))
    dq, dr, ds = F.abs(q0 - q), F.abs(r0 - r), F.abs(s0 - s)
    fix_q = (dq > dr) & (dq > ds)
    fix_r = ~fix_q & (dr > ds)
    return (
        F.when(fix_q, -r0 - s0).otherwise(q0),
        F.when(fix_r, -q0 - s0).otherwise(r0),
    )


def hex_cell(lat: Column, lon: Column, reference_lat: float = REFERENCE_LAT) -> Column:
    """``q_r`` id of the hexagon that holds a point."""
    return _cell_id(*hex_axial(lat, lon, reference_lat))


def hex_id(q: Column, r: Column) -> Column:
    return _cell_id(q, r)


def hex_centre(
    q: Column, r: Column, reference_lat: float = REFERENCE_LAT
) -> tuple[Column, Column]:
    """(lat, lon) of a hexagon's centre."""
    x = HEX_SIDE_KM * math.sqrt(3.0) * (q + r / 2.0)
    y = HEX_SIDE_KM * 1.5 * r
    return y / KM_PER_DEG_LAT, x / km_per_degree_lon(reference_lat)


# -- coarser hexagons -----------------------------------------------------------
#
# The centres of a seventh of the cells are themselves a hexagon lattice, turned
# by 19 degrees and wider by the square root of 7: its axes are the steps (2, 1)
# and (-1, 3). Each coarse cell is one of them with its six neighbours.

CHILDREN = 7


def _nearest_seventh(x: Column) -> Column:
    """x / 7 rounded to the nearest integer; seven is odd, so nothing lies half way."""
    shifted = x + CHILDREN // 2
    return ((shifted - F.pmod(shifted, F.lit(CHILDREN))) / CHILDREN).cast("bigint")


def hex_parent(q: Column, r: Column) -> tuple[Column, Column]:
    """Coordinates, in the coarser lattice, of the cell whose centre is nearest."""
    return _nearest_seventh(3 * q + r), _nearest_seventh(2 * r - q)


def hex_middle_child(q: Column, r: Column) -> tuple[Column, Column]:
    """The finer cell that has the same centre."""
    return 2 * q - r, q + 3 * r
