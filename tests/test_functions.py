import math
import random

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from zonewright.functions import geo, labels
from zonewright.functions.numeric import pct, ratio, round_half_away
from zonewright.functions.temporal import minutes_crossed, naive
from zonewright.functions.udf import register_cell_function


def evaluate(spark, schema, rows, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


# -- rounding -----------------------------------------------------------------


@pytest.mark.parametrize(
    "value, places, expected",
    [(1.005, 2, 1.0), (10.45, 1, 10.5), (10.449999999, 1, 10.4), (-0.125, 2, -0.13), (2.5, 0, 3.0), (-2.5, 0, -3.0)],
)
def test_rounding_ties(spark, value, places, expected):
    [(got,)] = evaluate(spark, "x double", [(value,)], round_half_away(F.col("x"), places))
    assert got == expected


def test_rounding_equals_sql_rounding(spark):
    rng = random.Random(1)
    values = [rng.uniform(-1e6, 1e6) for _ in range(5000)]
    values += [rng.randrange(-10**7, 10**7) / 1000 for _ in range(5000)]
    values += [rng.uniform(-1, 1) * 10 ** rng.randrange(8, 18) for _ in range(2000)]
    con = duckdb.connect()
    for places in (0, 1, 2, 4):
        rows = [(v,) for v in values]
        got = evaluate(spark, "x double", rows, round_half_away(F.col("x"), places))
        want = con.execute(
            f"SELECT round(x, {places}) FROM (SELECT unnest(?::DOUBLE[]) AS x)", [values]
        ).fetchall()
        assert got == want


def test_rounding_of_fleet_sized_sums_does_not_saturate(spark):
    [(got,)] = evaluate(spark, "x double", [(4.2e15,)], round_half_away(F.col("x"), 2))
    assert got == pytest.approx(4.2e15, rel=1e-15)


def test_rounding_and_ratio_of_null_and_zero(spark):
    x = F.col("x")
    row = evaluate(
        spark, "x double", [(None,)], round_half_away(x, 1), ratio(x, F.lit(0)), pct(x, F.lit(2))
    )
    assert row == [(None, None, None)]
    assert evaluate(spark, "x bigint", [(5,)], ratio(x, F.lit(0)), pct(x, F.lit(8))) == [
        (None, 62.5)
    ]


# -- time ---------------------------------------------------------------------


@pytest.mark.parametrize(
    "start, end, minutes",
    [
        ("2024-01-01T00:00:59", "2024-01-01T00:01:00", 1),
        ("2024-01-01T00:00:00", "2024-01-01T00:00:59", 0),
        ("2024-01-01T10:00:00", "2024-01-01T09:58:30", -2),
        ("2023-12-31T23:59:59.999999", "2024-01-01T00:00:00", 1),
        ("2024-02-28T00:00:00", "2024-03-01T00:00:00", 2880),
        (None, "2024-01-01T00:00:00", None),
    ],
)
def test_minutes_crossed(spark, start, end, minutes):
    crossed = minutes_crossed(naive(F.col("a")), naive(F.col("b")))
    assert evaluate(spark, "a string, b string", [(start, end)], crossed) == [(minutes,)]


def test_minutes_crossed_ignores_the_session_zone(spark, conf):
    conf(spark__sql__session__timeZone="America/New_York")
    rows = [("2024-03-10T01:59:00", "2024-03-10T03:01:00")]  # clocks go forward in between
    crossed = minutes_crossed(naive(F.col("a")), naive(F.col("b")))
    assert evaluate(spark, "a string, b string", rows, crossed) == [(62,)]


seconds_of_century = st.integers(0, 3_000_000_000)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(seconds_of_century, seconds_of_century), min_size=50, max_size=50))
def test_minutes_crossed_is_a_difference_of_floors(spark, pairs):
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    moved = [F.timestamp_add("SECOND", F.col(c), epoch) for c in "ab"]
    got = evaluate(spark, "a bigint, b bigint", pairs, minutes_crossed(*moved))
    assert got == [(b // 60 - a // 60,) for a, b in pairs]


# -- geometry -----------------------------------------------------------------


def test_grid_cell_floors_and_passes_null(spark):
    rows = [(10.776, 106.7), (-0.005, -10.01), (None, 1.0), (1.0, None)]
    got = evaluate(spark, "a double, b double", rows, geo.grid_cell(F.col("a"), F.col("b")))
    assert got == [("1077_10670",), ("-1_-1001",), (None,), (None,)]


def test_hexagon_is_the_one_with_the_nearest_centre(spark):
    rng = random.Random(2)
    points = [(rng.uniform(10.6, 10.95), rng.uniform(106.5, 106.85)) for _ in range(400)]
    points += [(-lat, -lon) for lat, lon in points[:100]]
    a, b = F.col("a"), F.col("b")
    got = evaluate(spark, "a double, b double", points, *geo.hex_axial(a, b), geo.hex_cell(a, b))

    def centre_km(q, r):
        return (
            geo.HEX_SIDE_KM * math.sqrt(3) * (q + r / 2),
            geo.HEX_SIDE_KM * 1.5 * r,
        )

    for (lat, lon), (q, r, cell) in zip(points, got):
        x, y = lon * geo.KM_PER_DEG_LON, lat * geo.KM_PER_DEG_LAT
        candidates = [(q + i, r + j) for i in range(-2, 3) for j in range(-2, 3)]
        nearest = min(candidates, key=lambda c: math.dist((x, y), centre_km(*c)))
        assert (q, r) == nearest
        assert cell == f"{q}_{r}"


def test_hexagon_centre_is_inside_its_hexagon(spark):
    a, b = F.col("a"), F.col("b")
    centre = geo.hex_centre(a, b)
    rows = [(31400, 3950), (-7, 12), (0, 0)]
    got = evaluate(spark, "a bigint, b bigint", rows, geo.hex_cell(*centre))
    assert got == [(f"{q}_{r}",) for q, r in rows]


def test_haversine(spark):
    rows = [(10.0, 106.0, 11.0, 106.0), (10.0, 106.0, 10.0, 106.0), (0.0, 0.0, 0.0, 180.0)]
    distance = geo.haversine_km(*[F.col(c) for c in "abcd"])
    got = evaluate(spark, "a double, b double, c double, d double", rows, distance)
    assert [d for (d,) in got] == pytest.approx([111.1949, 0.0, 6371 * math.pi], abs=1e-4)


def test_foreign_cell_function(spark):
    cell = register_cell_function(spark, "my_cell", lambda lat, lon, res: f"{res}:{lat + lon:.1f}")
    rows = [(1.0, 2.0), (None, 2.0)]
    a, b = F.col("a"), F.col("b")
    got = evaluate(
        spark, "a double, b double", rows, cell(a, b, F.lit(9)), F.expr("my_cell(a, b, 9)")
    )
    assert got == [("9:3.0", "9:3.0"), (None, None)]


# -- labels -------------------------------------------------------------------


def test_severity_ramp(spark):
    rows = [(0.0, True), (17.5, True), (35.0, True), (90.0, True), (-2.0, True), (0.0, False)]
    colour = labels.severity_colour(F.col("x"), F.col("has_data"))
    got = evaluate(spark, "x double, has_data boolean", rows, *colour.values())
    assert got == [
        (16, 185, 129, 80),
        (234, 179, 8, 135),
        (239, 68, 68, 190),
        (239, 68, 68, 190),
        (-8, 185, 142, 73),
        (180, 200, 220, 18),
    ]


def test_gap_labels(spark):
    rows = [(1234.4,), (-1234567.0,), (0.0,), (0.4,)]
    x = F.col("x")
    got = evaluate(spark, "x double", rows, labels.gap_label(x), labels.gap_class(x))
    assert got == [
        ("+$1,234 loss", "Loss"),
        ("-$1,234,567 ok", "Profit"),
        ("—", "Profit"),
        ("—", "Loss"),
    ]


def test_zone_labels(spark):
    rows = [("31444_4012", "Thủ Đức"), ("31444_4012", "Hóc Môn"), ("31444_4012", None)]
    cell, district = F.col("cell"), F.col("d")
    got = evaluate(
        spark,
        "cell string, d string",
        rows,
        labels.zone_label(cell, district),
        labels.short_cell(F.concat(cell, cell)),
    )
    assert got == [
        ("TĐ·4012", "31444_401231…"),
        ("Hóc·4012", "31444_401231…"),
        ("—·4012", "31444_401231…"),
    ]
