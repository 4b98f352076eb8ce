"""Marts over the delivery metrics. Lazy; the refresh job writes them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewright.functions import geo
from zonewright.functions.numeric import money, pct, ratio, round_half_away
from zonewright.functions.rules import DELAY_THRESHOLD, is_delayed
from zonewright.operators.zones import MEASURES, merge_state, zone_profile, zone_state


def deliveries(metrics: DataFrame) -> DataFrame:
    """Point-level mart for maps."""
    return metrics.select(
        "order_id",
        "destination_lat",
        "destination_lon",
        "destination_district",
        "h3_cell_9",
        "grid_cell_id",
        "delay_minutes",
        "delay_cost_usd",
        "margin_gap_usd",
        "delivery_status",
        "vehicle_type",
        "traffic_zone",
        "has_hem_access",
        "distance_from_prev_km",
    )


def _sum_when(condition: Column, value: str) -> Column:
    return F.sum(F.when(condition, money(F.col(value))).otherwise(0))


def kpis(metrics: DataFrame) -> DataFrame:
    """One fleet-wide row. Cost and gap cover delayed deliveries only.

    Rows are combined per pair of zones first. The two exact distinct counts
    then run over zone pairs; over rows they would triple the data.
    """
    pairs = metrics.groupBy("h3_cell_9", "grid_cell_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("delay_minutes").alias("timed"),
        F.sum("delay_minutes").alias("delay_sum"),
        F.count_if(is_delayed()).alias("delayed"),
        _sum_when(is_delayed(), "delay_cost_usd").alias("cost"),
        _sum_when(is_delayed(), "margin_gap_usd").alias("gap"),
    )
    n = F.coalesce(F.sum("n"), F.lit(0))
    return pairs.agg(
        n.alias("total_deliveries"),
        round_half_away(ratio(F.sum("delay_sum"), F.sum("timed")), 1).alias("avg_delay_minutes"),
        pct(F.sum("delayed"), n).alias("pct_severely_delayed"),
        round_half_away(F.sum("cost"), 0).alias("at_risk_cost_usd"),
        round_half_away(F.sum("gap"), 0).alias("total_margin_gap_usd"),
        F.count_distinct("h3_cell_9").alias("unique_h3_cells"),
        F.count_distinct("grid_cell_id").alias("unique_grid_cells"),
    )


def district(metrics: DataFrame) -> DataFrame:
    """Per district. The gap covers delayed deliveries only, the cost all of them."""
    n = F.count(F.lit(1))
    return (
        metrics.filter(F.col("destination_district").isNotNull())
        .groupBy("destination_district")
        .agg(
            n.alias("total_deliveries"),
            round_half_away(F.avg("delay_minutes"), 1).alias("avg_delay_minutes"),
            pct(F.count_if(is_delayed()), n).alias("pct_delayed"),
            pct(F.count_if(F.col("delivery_status") == "failed"), n).alias("failure_rate_pct"),
            round_half_away(F.sum(money(F.col("delay_cost_usd"))), 2).alias("total_delay_cost_usd"),
            round_half_away(_sum_when(is_delayed(), "margin_gap_usd"), 0).alias("margin_gap_usd"),
        )
    )


H3_MODES = ["traffic_zone", "destination_district"]


def _with_mean(profile: DataFrame) -> DataFrame:
    return profile.withColumn("mean_delay", ratio(F.col("delay_sum"), F.col("timed")))


def _zones(metrics: DataFrame, zone: str, modes: list[str]) -> DataFrame:
    return _with_mean(zone_profile(metrics, zone, "driver_id", modes))


def _zone_columns() -> list[Column]:
    """What both zone marts show, over a zone profile with ``mean_delay``."""
    deliveries_, mean_delay = F.col("deliveries"), F.col("mean_delay")
    return [
        deliveries_.alias("total_deliveries"),
        round_half_away(mean_delay, 1).alias("avg_delay_minutes"),
        round_half_away(F.col("cost_sum"), 2).alias("total_delay_cost_usd"),
        round_half_away(F.col("gap_sum"), 2).alias("total_margin_gap_usd"),
        round_half_away(ratio(F.col("gap_sum"), F.col("gap_rows")), 2).alias("avg_margin_gap_usd"),
        pct(F.col("failed"), deliveries_).alias("failure_rate_pct"),
        pct(F.col("hem_access"), deliveries_).alias("hem_access_pct"),
        F.col("n_driver_id").alias("unique_drivers"),
        (mean_delay > DELAY_THRESHOLD).alias("is_hotspot"),
        F.col("mode_traffic_zone").alias("dominant_traffic_zone"),
    ]


def h3(metrics: DataFrame) -> DataFrame:
    """Per hexagon. Sums cover all deliveries of the zone, late or not."""
    zones = _zones(metrics, "h3_cell_9", H3_MODES)
    return zones.select(
        "h3_cell_9",
        *_zone_columns(),
        F.col("mode_destination_district").alias("dominant_district"),
    )


def h3_levels(metrics: DataFrame, levels: int = 3, reference_lat: float = geo.REFERENCE_LAT) -> DataFrame:
    """The hexagon mart on several levels at once: level 0 is :func:`h3`, a cell of each next one holds seven.

    Deliveries are combined once, per finest cell; only that state is taken to every
    level and merged there, distinct drivers and modes included, so all levels add up to
    the same totals. ``cell`` is an id within its level, ``finest_cells`` the number of cells with deliveries that
    it holds. A zone whose id is of another scheme has no parent: it stays itself on every level, without a centre.
    """
    facets = ["driver_id", *H3_MODES]
    state = zone_state(metrics, "h3_cell_9", facets)
    q, r = (geo.lattice_step(F.col("h3_cell_9"), i).cast("bigint") for i in (1, 2))
    own = F.col("h3_cell_9").rlike(geo.LATTICE_ID)
    state = state.withColumns({"q0": F.when(own, q), "r0": F.when(own, r)})
    for level in range(1, levels):
        parent_q, parent_r = geo.hex_parent(F.col(f"q{level - 1}"), F.col(f"r{level - 1}"))
        state = state.withColumns({f"q{level}": parent_q, f"r{level}": parent_r})

    def at(level: int) -> Column:
        cell = F.coalesce(geo.hex_id(F.col(f"q{level}"), F.col(f"r{level}")), F.col("h3_cell_9"))
        return F.struct(F.lit(level).alias("level"), cell.alias("cell"))

    state = state.withColumn("at", F.explode(F.array(*map(at, range(levels)))))
    state = state.select("at.level", "at.cell", "h3_cell_9", *facets, "deliveries", *MEASURES)
    merged = _with_mean(merge_state(state, ["level", "cell"], ["driver_id", "h3_cell_9"], H3_MODES))
    centre_lat, centre_lon = _level_centre(levels, reference_lat)
    return merged.select(
        "level",
        "cell",
        F.col("n_h3_cell_9").alias("finest_cells"),
        round_half_away(centre_lat, 6).alias("centre_lat"),
        round_half_away(centre_lon, 6).alias("centre_lon"),
        *_zone_columns(),
        F.col("mode_destination_district").alias("dominant_district"),
    )


def _level_centre(levels: int, reference_lat: float) -> tuple[Column, Column]:
    """Centre of ``cell`` on its ``level``: that of the finest cell in its middle."""
    own = F.col("cell").rlike(geo.LATTICE_ID)
    q, r = (F.when(own, geo.lattice_step(F.col("cell"), i).cast("bigint")) for i in (1, 2))
    centres = []
    for level in range(levels):
        centres.append((F.col("level") == level, geo.hex_centre(q, r, reference_lat)))
        q, r = geo.hex_middle_child(q, r)

    def pick(axis: int) -> Column:
        return F.coalesce(*[F.when(here, centre[axis]) for here, centre in centres])

    return pick(0), pick(1)


def grid(metrics: DataFrame) -> DataFrame:
    """Per grid cell, with the centre parsed back from the cell id."""
    zones = _zones(metrics, "grid_cell_id", ["traffic_zone"])

    def centre(position: int) -> Column:
        step = geo.lattice_step(F.col("grid_cell_id"), position)
        return round_half_away(step * geo.GRID_SIZE_DEG + geo.GRID_SIZE_DEG / 2, 4)

    return zones.select(
        "grid_cell_id",
        centre(1).alias("cell_lat_center"),
        centre(2).alias("cell_lon_center"),
        *_zone_columns(),
    )
