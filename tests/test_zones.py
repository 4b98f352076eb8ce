"""Zone aggregates, running totals and the comparison against brute force."""

import random
import statistics
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from checks.registry import QUERIES, TestTables, delivery_metrics
from tests.conftest import MEDIUM, SMALL
from zonewright.functions import geo
from zonewright.operators import spatial, zones
from zonewright.operators.prefix import running_totals
from zonewright.plans import comparison, marts

METRICS = """
    h3_cell_9 string, grid_cell_id string, driver_id string, traffic_zone string,
    destination_district string, delivery_status string, has_hem_access boolean,
    delay_minutes bigint, delay_cost_usd double, margin_gap_usd double,
    destination_lat double, destination_lon double
"""


def metric(cell, delay, **changes):
    row = {
        "h3_cell_9": cell,
        "grid_cell_id": "1077_10670",
        "driver_id": "DRV_001",
        "traffic_zone": "low",
        "destination_district": "Quận 1",
        "delivery_status": "delivered",
        "has_hem_access": False,
        "delay_minutes": delay,
        "delay_cost_usd": delay / 20 if delay is not None else None,
        "margin_gap_usd": delay / 20 - 1.0 if delay is not None else None,
        "destination_lat": 10.775,
        "destination_lon": 106.705,
    }
    return row | changes


def frame(spark, rows):
    return spark.createDataFrame(rows, METRICS)


@pytest.fixture(scope="module")
def skewed():
    """One zone, driver and district hold over a third of the rows; NULLs all over."""
    rng = random.Random(3)

    def draw(values, hot):
        return hot if rng.random() < 0.4 else rng.choice(values)

    drivers = [f"DRV_{i:03d}" for i in range(30)] + [None]
    rows = []
    for _ in range(6000):
        cell = draw([f"{i}_{i}" for i in range(40)] + [None], "7_7")
        rows.append(
            metric(
                cell,
                rng.randrange(-2, 60) if rng.random() < 0.95 else None,
                driver_id=draw(drivers, "DRV_001"),
                traffic_zone=rng.choice(["low", "medium", "high", None]),
                destination_district=draw(["Quận 1", "Quận 3", "Gò Vấp", None], "Quận 5"),
                delivery_status=rng.choice(["delivered", "failed", None]),
                has_hem_access=rng.choice([True, False, None]),
            )
        )
    return rows


def mode(values):
    counts = Counter(v for v in values if v is not None)
    return min(counts, key=lambda v: (-counts[v], v.encode())) if counts else None


def test_zone_mart_against_brute_force(spark, skewed):
    groups = defaultdict(list)
    for row in skewed:
        if row["h3_cell_9"] is not None:
            groups[row["h3_cell_9"]].append(row)
    got = {r["h3_cell_9"]: r for r in marts.h3(frame(spark, skewed)).collect()}
    assert set(got) == set(groups)
    for cell, rows in groups.items():
        delays = [r["delay_minutes"] for r in rows if r["delay_minutes"] is not None]
        result = got[cell]
        assert result["total_deliveries"] == len(rows)
        assert result["avg_delay_minutes"] == pytest.approx(statistics.mean(delays), abs=0.051)
        assert result["is_hotspot"] == (sum(delays) > 15 * len(delays))
        assert result["unique_drivers"] == len({r["driver_id"] for r in rows} - {None})
        assert result["dominant_traffic_zone"] == mode(r["traffic_zone"] for r in rows)
        assert result["dominant_district"] == mode(r["destination_district"] for r in rows)
        failed = sum(r["delivery_status"] == "failed" for r in rows)
        assert result["failure_rate_pct"] == pytest.approx(100 * failed / len(rows), abs=0.051)
        hem = sum(r["has_hem_access"] is True for r in rows)
        assert result["hem_access_pct"] == pytest.approx(100 * hem / len(rows), abs=0.051)
        gap = sum(r["margin_gap_usd"] for r in rows if r["margin_gap_usd"] is not None)
        assert result["total_margin_gap_usd"] == pytest.approx(gap, abs=0.0051)


def test_single_aggregates_agree_with_the_mart(spark, skewed):
    df = frame(spark, skewed)
    mart = {r["h3_cell_9"]: r for r in marts.h3(df).collect()}
    drivers = {r[0]: r[1] for r in zones.distinct_per_zone(df, "h3_cell_9", "driver_id").collect()}
    modes = {r[0]: r[1] for r in zones.mode_per_zone(df, "h3_cell_9", "traffic_zone").collect()}
    assert drivers == {c: r["unique_drivers"] for c, r in mart.items()}
    assert modes == {c: r["dominant_traffic_zone"] for c, r in mart.items()}


def test_mode_ties_and_missing_values(spark):
    rows = [metric("a", 1, traffic_zone=z) for z in ("low", "high", "low", "high", "medium")]
    rows += [metric("b", 1, traffic_zone=None, driver_id=None)] * 2
    got = {r["h3_cell_9"]: r for r in marts.h3(frame(spark, rows)).collect()}
    assert got["a"]["dominant_traffic_zone"] == "high"
    assert got["b"]["dominant_traffic_zone"] is None
    assert got["b"]["unique_drivers"] == 0


def test_threshold_is_strict(spark):
    rows = [metric("a", 15), metric("b", 10), metric("b", 20), metric("c", 15), metric("c", 16)]
    df = frame(spark, rows)
    hot = {r["h3_cell_9"]: r["is_hotspot"] for r in marts.h3(df).collect()}
    assert hot == {"a": False, "b": False, "c": True}
    assert comparison.fleet_totals(df).first()["total_delayed"] == 2


def test_grid_centre_of_any_sign(spark):
    rows = [metric("a", 1, grid_cell_id=g) for g in ("1077_10670", "-1_-1001", None)]
    got = {r["grid_cell_id"]: r for r in marts.grid(frame(spark, rows)).collect()}
    assert (got["1077_10670"]["cell_lat_center"], got["1077_10670"]["cell_lon_center"]) == (
        10.775,
        106.705,
    )
    assert (got["-1_-1001"]["cell_lat_center"], got["-1_-1001"]["cell_lon_center"]) == (
        -0.005,
        -10.005,
    )
    assert len(got) == 2


def test_kpis(spark, skewed):
    row = marts.kpis(frame(spark, skewed)).first()
    late = [r for r in skewed if r["delay_minutes"] is not None and r["delay_minutes"] > 15]
    assert row["total_deliveries"] == len(skewed)
    assert row["at_risk_cost_usd"] == pytest.approx(sum(r["delay_cost_usd"] for r in late), abs=0.51)
    assert row["unique_h3_cells"] == len({r["h3_cell_9"] for r in skewed} - {None})
    assert row["unique_grid_cells"] == 1


def test_kpis_of_no_deliveries(spark):
    row = marts.kpis(frame(spark, [])).first()
    assert row["total_deliveries"] == 0 and row["unique_h3_cells"] == 0
    assert row["avg_delay_minutes"] is None and row["pct_severely_delayed"] is None


# -- comparison ---------------------------------------------------------------


def compare(spark, rows, **kwargs):
    result = comparison.spatial_comparison(frame(spark, rows), **kwargs).collect()
    return {r["method"].split()[0]: r for r in result}


def test_comparison_without_hotspots(spark):
    h3 = compare(spark, [metric("a", 1), metric("a", 16), metric("b", 2)])["H3"]
    assert h3["hotspot_cells"] == 0 and h3["total_cells"] == 2
    assert h3["hotspot_capture_rate_pct"] is None
    assert h3["hotspot_precision_pct"] is None
    assert h3["margin_gap_in_hotspots_usd"] is None
    assert h3["margin_gap_capture_pct"] is None
    assert h3["avg_within_cell_delay_stddev"] == pytest.approx(10.61)  # one-row zone skipped


def test_comparison_without_delays(spark):
    h3 = compare(spark, [metric("a", 1), metric("b", 2)])["H3"]
    assert h3["hotspot_capture_rate_pct"] is None
    assert h3["avg_within_cell_delay_stddev"] is None


def test_rows_without_a_zone_count_in_the_totals_only(spark):
    rows = [metric("a", 30), metric(None, 40), metric(None, 50), metric("b", 0)]
    both = compare(spark, rows)
    assert both["H3"]["total_cells"] == 2
    assert both["H3"]["hotspot_capture_rate_pct"] == 33.3
    assert both["Grid"]["total_cells"] == 1
    assert both["Grid"]["hotspot_capture_rate_pct"] == 100.0


def test_comparison_reports_index_cost(spark):
    cost = spark.createDataFrame(
        [("H3", 3.31456), ("Grid", 0.07)], "method string, microseconds_per_row double"
    )
    both = compare(spark, [metric("a", 30)], index_cost=cost)
    assert (both["H3"]["cl_us_per_row"], both["Grid"]["cl_us_per_row"]) == (3.3146, 0.07)
    assert (both["H3"]["sdc_km"], both["Grid"]["sdc_km"]) == (0.0, 0.228)


ANCHORS = {
    SMALL: {
        "H3": (1128, 283, 94.4, 79.8, -2666.53, 24.5, 9.36, 0.0286),
        "Grid": (338, 85, 72.1, 48.7, -3720.10, 34.1, 10.88, 0.4162),
    },
    MEDIUM: {
        "H3": (3523, 1073, 76.5, 58.7, -35376.20, 33.1, 10.71, 0.0980),
        "Grid": (389, 118, 66.6, 48.1, -39383.53, 36.9, 12.93, 0.4221),
    },
}


@pytest.mark.parametrize("folder", ANCHORS)
def test_comparison_anchors(spark, folder):
    got = {r["method"].split()[0]: tuple(r)[1:9] for r in
           QUERIES["mart_spatial_comparison"](spark, folder).collect()}
    assert got == ANCHORS[folder]


def test_invariants(spark):
    metrics_ = delivery_metrics(TestTables(spark, SMALL))
    n = metrics_.count()
    stats = comparison.cell_stats(metrics_).filter("cell IS NOT NULL")
    sizes = dict(stats.groupBy("method").agg(F.sum("deliveries")).collect())
    assert sizes == {"H3": n, "Grid": n}
    assert stats.filter("is_hotspot AND avg_delay <= 15").count() == 0
    lattice = spatial.hex_lattice(spatial.city_box(spark))
    inside = marts.h3(metrics_).join(lattice, "h3_cell_9", "left_anti").count()
    assert inside == 0  # every zone with data lies on the map
    assert lattice.count() == 8085


def test_measured_neighbour_spread(spark):
    got = {r["method"]: r for r in QUERIES["sdc_measured"](spark, SMALL).collect()}
    assert got["H3"]["sdc_km"] == 0.0
    assert got["H3"]["mean_distance_km"] == pytest.approx(0.3487, abs=1e-4)
    assert got["Grid"]["sdc_km"] == pytest.approx(0.228, abs=1e-3)


# -- running totals -----------------------------------------------------------


def test_running_totals_in_ranges_equal_plain_windows(spark):
    rng = random.Random(4)
    keys = rng.sample(range(100_000), 5000)
    groups = [f"g{i}" for i in range(20)] + ["", None]
    values = [None, None, None, *range(9)]
    rows = [("hot" if rng.random() < 0.4 else rng.choice(groups), k - 20_000, rng.choice(values))
            for k in keys]
    df = spark.createDataFrame(rows, "g string, k bigint, v bigint")
    want = set()
    for group in {g for g, _, _ in rows}:
        members = sorted((k, v) for g, k, v in rows if g == group)
        total = None
        for n, (k, v) in enumerate(members, 1):
            total = total if v is None else (total or 0) + v
            want.add((group, k, v, n, total, members[-1][0]))
    for parts in (1, 4, 500):
        got = running_totals(
            df, "g", "k", "n", sums={"so_far": "v"}, group_max={"top": "k"}, parts=parts
        ).collect()
        assert {tuple(r) for r in got} == want and len(got) == len(rows)


def test_sparse_keys_of_a_hot_group_fill_ranges_evenly(spark):
    df = spark.range(20_000).selectExpr("if(id % 3 > 0, 'hot', string(id)) g", "xxhash64(id) k", "1L v")
    ranked = running_totals(df, "g", "k", "n", sums={"so_far": "v"}, parts=16)
    assert ranked.where("n <> so_far").count() == 0
    top = ranked.groupBy("g").agg(F.max("n").alias("n"), F.count("*").alias("rows"))
    assert top.where("n <> rows").count() == 0


def test_rows_without_a_key_come_first_and_spread(spark):
    df = spark.range(1000).selectExpr("'one' g", "if(id < 900, null, id) k", "1L v")
    got = running_totals(df, "g", "k", "n", sums={"so_far": "v"}, parts=8).collect()
    assert sorted(r.n for r in got) == list(range(1, 1001)) and all(r.n == r.so_far for r in got)
    assert {r.n for r in got if r.k is None} == set(range(1, 901))


# -- reference latitude -------------------------------------------------------


def test_hexagons_are_true_to_scale_at_their_reference_latitude(spark):
    box = spark.sql("SELECT 50.0D AS south, 8.0D AS west, 50.02D AS north, 8.03D AS east")
    cells = spatial.hex_lattice(box, reference_lat=50.0)
    indexed = cells.withColumn("again", geo.hex_cell(F.col("centre_lat"), F.col("centre_lon"), 50.0))
    assert cells.count() > 20 and indexed.where("again <> h3_cell_9").count() == 0
    here, there = cells.alias("a"), cells.alias("b")
    near = here.join(there, F.expr("(b.q - a.q, b.r - a.r) IN ((1, 0), (0, 1), (1, -1))"))
    km = geo.haversine_km(*(F.col(c) for c in ("a.centre_lat", "a.centre_lon", "b.centre_lat", "b.centre_lon")))
    low, high = near.agg(F.min(km), F.max(km)).first()
    assert high - low < 0.001
