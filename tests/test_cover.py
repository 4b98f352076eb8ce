"""Polygon covers, coarser levels and lookups against brute force."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.test_zones import frame, metric
from zonewright.functions import geo
from zonewright.operators import cover, layout, spatial
from zonewright.plans import marts

RINGS = "polygon string, ring int, place int, lat double, lon double"


def vertices(shapes):
    """(polygon, ring, place, lat, lon) of polygons given as lists of rings."""
    return [(name, i, j, *p) for name, rings in shapes.items() for i, ring in enumerate(rings) for j, p in enumerate(ring)]


def centre(q, r):
    x = geo.HEX_SIDE_KM * math.sqrt(3.0) * (q + r / 2.0)
    return 1.5 * geo.HEX_SIDE_KM * r / geo.KM_PER_DEG_LAT, x / geo.KM_PER_DEG_LON


def inside(rings, lat, lon):
    odd = False
    for ring in rings:
        for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (a > lat) != (c > lat) and lon < b + (lat - a) / (c - a) * (d - b):
                odd = not odd
    return odd


def brute(shapes, south=10.6, north=10.8, west=106.6, east=106.8):
    rows = range(math.floor(south * geo.KM_PER_DEG_LAT / (1.5 * geo.HEX_SIDE_KM)), math.ceil(north * geo.KM_PER_DEG_LAT / (1.5 * geo.HEX_SIDE_KM)) + 1)
    width = math.sqrt(3.0) * geo.HEX_SIDE_KM
    found = set()
    for r in rows:
        first, last = (math.floor(lon * geo.KM_PER_DEG_LON / width - r / 2.0) for lon in (west, east))
        for q in range(first, last + 2):
            lat, lon = centre(q, r)
            found |= {(name, q, r) for name, rings in shapes.items() if inside(rings, lat, lon)}
    return found


def covered(spark, shapes):
    cells = cover.hex_cover(spark.createDataFrame(vertices(shapes), RINGS)).collect()
    got = [(c.polygon, c.q, c.r) for c in cells]
    assert len(got) == len(set(got))
    return set(got)


STAR = [(10.7 + 0.06 * (1 if i % 2 else 0.4) * math.cos(i * math.pi / 7), 106.7 + 0.08 * (1 if i % 2 else 0.3) * math.sin(i * math.pi / 7)) for i in range(14)]

SHAPES = {
    "star": [STAR],
    "holes": [
        [(10.61, 106.61), (10.61, 106.79), (10.79, 106.79), (10.79, 106.61)],
        [(10.65, 106.65), (10.75, 106.65), (10.75, 106.75), (10.65, 106.75)],
        [(10.68, 106.68), (10.68, 106.72), (10.72, 106.72), (10.72, 106.68)],  # an island in the hole
    ],
    "crossing itself": [[(10.62, 106.62), (10.78, 106.78), (10.78, 106.62), (10.62, 106.78)]],
    "closed": [[(10.63, 106.63), (10.63, 106.64), (10.65, 106.64), (10.65, 106.63), (10.63, 106.63)]],
    "sliver": [[(10.7, 106.61), (10.7001, 106.79), (10.70005, 106.7)]],
    "line": [[(10.62, 106.62), (10.7, 106.7)]],
    "point": [[(10.7, 106.7)]],
}


def test_covers_equal_a_test_of_every_centre(spark):
    assert covered(spark, SHAPES) == brute(SHAPES)
    assert {name for name, _, _ in covered(spark, SHAPES)} >= {"star", "holes", "crossing itself", "closed"}


def test_many_sides_in_one_row(spark):
    rng = random.Random(5)
    comb = [(10.7 + rng.choice([0.0, 0.01]) + rng.random() / 1000, 106.61 + i * 0.0002) for i in range(800)]
    shapes = {"comb": [[*comb, (10.62, 106.7)]]}
    assert covered(spark, shapes) == brute(shapes)


def test_neighbours_share_no_cell_and_leave_none_out(spark):
    middle = (10.7013, 106.7029)
    corners = [(10.61, 106.61), (10.61, 106.79), (10.79, 106.79), (10.79, 106.61)]
    parts = {f"part {i}": [[a, b, middle]] for i, (a, b) in enumerate(zip(corners, corners[1:] + corners[:1], strict=True))}
    cells = [(q, r) for _, q, r in covered(spark, parts)]
    whole = {(q, r) for _, q, r in covered(spark, {"whole": [corners]})}
    assert len(cells) == len(set(cells)) and set(cells) == whole


def test_missing_vertices_and_no_polygons(spark):
    square = SHAPES["closed"][0][:4]
    rows = vertices({"a": [square]}) + [("a", 0, 9, None, 106.7), ("b", 0, 0, None, None), (None, 0, 0, 10.0, 106.0)]
    cells = cover.hex_cover(spark.createDataFrame(rows, RINGS)).collect()
    assert {(c.polygon, c.q, c.r) for c in cells} == brute({"a": [square]})
    assert cover.hex_cover(spark.createDataFrame([], RINGS)).collect() == []


def test_a_box_is_covered_as_the_lattice_fills_it(spark):
    south, west, north, east = spatial.CITY_BOX
    boxes = spark.createDataFrame([("city", south, west, north, east)], "polygon string, south double, west double, north double, east double")
    cells = cover.hex_cover(cover.box_rings(boxes)).drop("polygon")
    lattice = spatial.hex_lattice(spatial.city_box(spark))
    assert sorted(map(tuple, cells.collect())) == sorted(map(tuple, lattice.select(cells.columns).collect()))


# -- levels -----------------------------------------------------------------------


def test_parents_are_the_nearest_coarse_centres(spark):
    cells = [(q, r) for q in range(-12, 13) for r in range(-12, 13)]
    df = spark.createDataFrame(cells, "q bigint, r bigint")
    i, j = geo.hex_parent(F.col("q"), F.col("r"))
    back_q, back_r = geo.hex_middle_child(F.col("i"), F.col("j"))
    rows = df.select("q", "r", i.alias("i"), j.alias("j")).withColumns({"mq": back_q, "mr": back_r}).collect()
    children = defaultdict(list)
    for row in rows:
        distance = max(abs(row.q - row.mq), abs(row.r - row.mr), abs(row.q + row.r - row.mq - row.mr))
        assert distance <= 1
        children[row.i, row.j].append((row.q, row.r))
    assert max(map(len, children.values())) == 7 and len(children[0, 0]) == 7


def test_levels_add_up(spark):
    rng = random.Random(8)
    cells = [f"{rng.randint(-30, 30)}_{rng.randint(-30, 30)}" for _ in range(300)] + ["89abc", None]
    rows = [metric(rng.choice(cells) if i % 3 else "7_7", rng.randint(-5, 60), driver_id=f"D{rng.randint(1, 9)}") for i in range(4000)]
    df = frame(spark, rows)
    levels = marts.h3_levels(df, levels=4).collect()
    in_zone = [r for r in rows if r["h3_cell_9"]]
    for level in range(4):
        some = [r for r in levels if r.level == level]
        assert sum(r.total_deliveries for r in some) == len(in_zone)
        assert sum(r.finest_cells for r in some) == len({r["h3_cell_9"] for r in in_zone})
        assert {r.cell for r in some if r.centre_lat is None} == {"89abc"}
    finest = marts.h3(df).withColumnRenamed("h3_cell_9", "cell")
    level_0 = marts.h3_levels(df).where("level = 0").select(finest.columns)
    assert sorted(map(repr, level_0.collect())) == sorted(map(repr, finest.collect()))


def test_a_coarse_zone_counts_its_drivers_once(spark):
    rows = [metric("0_0", 10, driver_id="A"), metric("1_0", 20, driver_id="A"), metric("0_1", 30, driver_id="B"), metric("3_0", 40, driver_id="A")]
    zones = {r.cell: r for r in marts.h3_levels(frame(spark, rows)).where("level = 1").collect()}
    assert zones["0_0"].unique_drivers == 2 and zones["0_0"].total_deliveries == 3 and zones["0_0"].avg_delay_minutes == 20
    assert len(zones) == 2


# -- layout -----------------------------------------------------------------------


def interleave(q, r):
    bits = lambda x: bin(x + (1 << 30))[2:].zfill(32)
    return int("".join(b + a for a, b in zip(bits(q), bits(r), strict=True)), 2)


def test_curve_key_interleaves_bits(spark):
    rng = random.Random(1)
    points = [(0, 0), (-1, 5), (-(1 << 29), (1 << 29)), *((rng.randint(-10**6, 10**6), rng.randint(-10**6, 10**6)) for _ in range(50))]
    df = spark.createDataFrame([(f"{q}_{r}",) for q, r in points], "cell string")
    got = {r.cell: r.key for r in df.select("cell", layout.zone_key(F.col("cell")).alias("key")).collect()}
    assert got == {f"{q}_{r}": interleave(q, r) for q, r in points}


def files_read(df):
    """Files that the scans of a plan opened; the frame must not have run before, as files are chosen once."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if name.startswith("Scan parquet") or name.startswith("FileScan"):
            found.append(node.metrics().apply("numFiles").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return sum(found)


@pytest.fixture(scope="module")
def stored_zones(spark, tmp_path_factory):
    rng = random.Random(2)
    cells = {f"{35_000 + rng.randint(0, 600)}_{-(20_000 + rng.randint(0, 600))}" for _ in range(3000)} | {f"8965b{i:04x}" for i in range(500)}
    zones = spark.createDataFrame([(c, len(c), i) for i, c in enumerate(sorted(cells))], "h3_cell_9 string, n int, i int")
    path = str(tmp_path_factory.mktemp("zones") / "z")
    layout.laid_out(zones).write.partitionBy("zone_block").parquet(path)
    return spark.read.parquet(path), sorted(cells)


def test_a_lookup_reads_one_file(spark, stored_zones):
    table, cells = stored_zones
    assert len(table.inputFiles()) > 50
    for cell in (cells[0], cells[1500], cells[-1]):
        found = layout.lookup(table, F.lit(cell))
        assert files_read(found) == 1
        assert [r.h3_cell_9 for r in found.collect()] == [cell] and found.columns == ["h3_cell_9", "n", "i"]
    assert layout.lookup(table, F.lit("1_1")).collect() == [] == layout.lookup(table, F.lit("89ffff")).collect()


def test_neighbours_share_files(stored_zones):
    table, _ = stored_zones
    blocks = table.where("zone_block >= 0").groupBy("zone_block").agg(
        F.max(geo.lattice_step(F.col("h3_cell_9"), 1)) - F.min(geo.lattice_step(F.col("h3_cell_9"), 1)),
        F.max(geo.lattice_step(F.col("h3_cell_9"), 2)) - F.min(geo.lattice_step(F.col("h3_cell_9"), 2)),
    )
    assert all(r[1] < 64 and r[2] < 64 for r in blocks.collect())


def test_the_stored_lookup_reads_one_file_of_the_mart(spark, conf):
    conf(spark__sql__adaptive__enabled="false")  # else a side that turns out empty leaves the plan, and its scan's figures with it
    from checks.registry import QUERIES, stored
    from checks.registry import TestTables as Tables
    from zonewright.sources import snapshots

    mart = snapshots.table(spark, stored(Tables(spark, SMALL)), "mart_h3")
    assert len(mart.inputFiles()) > 1
    found = QUERIES["stored_zone_lookup"](spark, SMALL)
    assert files_read(found) == 1
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, QUERIES["feed_zone_lookup"](spark, SMALL).collect()))
