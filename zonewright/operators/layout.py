"""Zone tables laid out for lookups: neighbouring zones share files, and a lookup reads one of them.

Zones are stored by the place of their cell on a Z-order curve over the lattice. A
square block of the lattice is one partition folder, within which rows are sorted, so
folders are skipped by their name and row groups by their statistics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewright.functions import geo

#: A block is this many bits wide and high: 64 by 64 cells, about 430 km2 of the finest hexagons.
BLOCK_BITS = 6

#: Folders for zones whose ids are of another scheme.
FOREIGN_BLOCKS = 64

COLUMNS = ("zone_key", "zone_block")

# Shifts and masks that move the bits of a 32-bit number apart.
SPREAD = [(16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)]

# Lattice coordinates are shifted to be positive.
MIDDLE = 1 << 30


def _spread(x: Column) -> Column:
    for shift, mask in SPREAD:
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def curve_key(q: Column, r: Column) -> Column:
    """Place on the Z-order curve, a BIGINT; NULL if a coordinate is."""
    x, y = (_spread((c + MIDDLE).cast("bigint")) for c in (q, r))
    return x.bitwiseOR(F.shiftleft(y, 1))


def zone_key(cell: Column) -> Column:
    """Curve place of a cell id; NULL for an id of another scheme."""
    own = cell.rlike(geo.LATTICE_ID)
    return F.when(own, curve_key(*(geo.lattice_step(cell, i) for i in (1, 2))))


def zone_block(cell: Column) -> Column:
    """Folder of a cell id: its block on the curve, or a negative number by a hash for other schemes."""
    foreign = -1 - F.crc32(cell.cast("binary")) % FOREIGN_BLOCKS
    return F.coalesce(F.shiftright(zone_key(cell), 2 * BLOCK_BITS), foreign)


def laid_out(zones: DataFrame, cell: str = "h3_cell_9") -> DataFrame:
    """Adds ``zone_key`` and ``zone_block``, and deals and sorts the rows by them; write it with ``partitionBy("zone_block")``.

    A block holds 4096 zones at most, so no task gets more than its blocks' zones.
    """
    keyed = zones.withColumns({"zone_key": zone_key(F.col(cell)), "zone_block": zone_block(F.col(cell))})
    return keyed.repartition("zone_block").sortWithinPartitions("zone_block", "zone_key")


def lookup(zones: DataFrame, cell: Column, column: str = "h3_cell_9") -> DataFrame:
    """The row of one cell in a laid-out table; ``cell`` is made of literals, so that the plan knows the folder.

    The conditions on key and block follow from the id, and let folders and row groups be skipped.
    """
    found = zones.where((F.col("zone_block") == zone_block(cell)) & (F.col(column) == cell))
    return found.where(F.col("zone_key").eqNullSafe(zone_key(cell))).drop(*COLUMNS)
