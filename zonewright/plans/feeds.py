"""Ready-to-serve frames for rankings, maps and pricing advice.

All stay DataFrames; a client collects the small result at the edge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewright.functions import geo, labels
from zonewright.functions.numeric import money_total, ratio, round_half_away
from zonewright.functions.rules import DELAY_THRESHOLD
from zonewright.operators import layout, spatial

# Length of the hotspot list, and the delay from which a zone counts as severe.
TOP_HOTSPOTS = 50
SEVERE_MINUTES = 60

# Column headings of the hotspot table.
HOTSPOT_HEADINGS = {
    "h3_cell_9": "H3 Cell",
    "district": "District",
    "total_deliveries": "Deliveries",
    "avg_delay_minutes": "Avg Delay (min)",
    "total_margin_gap_usd": "Margin Gap ($)",
    "failure_rate_pct": "Failure Rate (%)",
    "dominant_traffic_zone": "Traffic Zone",
    "hem_access_pct": "% Hem Access",
}


def kpi_cards(kpis: DataFrame) -> DataFrame:
    """The KPI row as shown: whole dollars, and whether each card alarms."""
    return kpis.select(
        "total_deliveries",
        "avg_delay_minutes",
        "pct_severely_delayed",
        (F.col("pct_severely_delayed") > 50).alias("mostly_late"),
        F.col("at_risk_cost_usd").cast("bigint").alias("at_risk_cost_usd"),
        F.col("total_margin_gap_usd").cast("bigint").alias("total_margin_gap_usd"),
        labels.gap_class(F.col("total_margin_gap_usd")).alias("gap_class"),
    )


def district(mart_district: DataFrame, by: str = "avg_delay_minutes") -> DataFrame:
    """Districts, highest first by a measure, each classed as loss or profit."""
    return mart_district.withColumn(
        "gap_class", labels.gap_class(F.col("margin_gap_usd"))
    ).orderBy(F.desc(by), "destination_district")


def h3_zones(mart_h3: DataFrame) -> DataFrame:
    return mart_h3.select(
        "h3_cell_9",
        "avg_delay_minutes",
        "total_deliveries",
        "total_margin_gap_usd",
        "is_hotspot",
        "dominant_district",
        "failure_rate_pct",
    )


def hotspots(mart_h3: DataFrame) -> DataFrame:
    """The hotspots with the longest mean delay; equal delays rank by zone id."""
    return (
        mart_h3.filter("is_hotspot")
        .select(
            "h3_cell_9",
            F.col("dominant_district").alias("district"),
            "total_deliveries",
            "avg_delay_minutes",
            "total_margin_gap_usd",
            "failure_rate_pct",
            "dominant_traffic_zone",
            "hem_access_pct",
        )
        .orderBy(F.desc("avg_delay_minutes"), "h3_cell_9")
        .limit(TOP_HOTSPOTS)
        .withColumn("is_severe", F.col("avg_delay_minutes") > SEVERE_MINUTES)
        .withColumn("zone_label", labels.zone_label(F.col("h3_cell_9"), F.col("district")))
    )


def hotspot_table(hotspot_list: DataFrame) -> DataFrame:
    """The hotspot list under its presentation headings."""
    return hotspot_list.select(*HOTSPOT_HEADINGS).withColumnsRenamed(HOTSPOT_HEADINGS)


def recommendation(hotspot_list: DataFrame) -> DataFrame:
    """One row of pricing advice from the hotspot list.

    ``recovery_usd`` is the size of the combined gap whatever its sign;
    ``total_margin_gap_usd`` keeps the sign.
    """
    cell = F.col("h3_cell_9")
    worst_first = F.struct(-F.col("avg_delay_minutes"), cell)
    gap = F.col("total_margin_gap_usd")
    return hotspot_list.agg(
        F.count(F.lit(1)).alias("n_zones"),
        F.coalesce(round_half_away(F.sum(money_total(gap)), 2), F.lit(0.0)).alias("total_margin_gap_usd"),
        F.min_by(cell, worst_first).alias("worst_cell"),
        F.min_by("district", worst_first).alias("worst_district"),
    ).select(
        "n_zones",
        "total_margin_gap_usd",
        F.abs("total_margin_gap_usd").alias("recovery_usd"),
        F.coalesce(labels.short_cell(F.col("worst_cell")), F.lit(labels.NO_VALUE)).alias(
            "worst_cell_label"
        ),
        F.coalesce("worst_district", F.lit(labels.NO_VALUE)).alias("worst_district"),
    )


def zone_map(lattice: DataFrame, zones: DataFrame) -> DataFrame:
    """Every lattice cell with its zone's figures, or blanks where it has none.

    Zones of this package's own ids are drawn inside the box only. A zone whose id came
    with the data, from another scheme, has a row as well, without a centre.
    """
    foreign = ~F.col("h3_cell_9").rlike(geo.LATTICE_ID)
    has_data = F.col("total_deliveries").isNotNull()
    merged = (
        lattice.join(zones, "h3_cell_9", "full")
        .where(F.col("centre_lat").isNotNull() | foreign)
        .withColumn("has_data", has_data)
        .withColumns(
            {
                "avg_delay_minutes": F.coalesce("avg_delay_minutes", F.lit(0.0)),
                "total_deliveries": F.coalesce("total_deliveries", F.lit(0).cast("bigint")),
                "total_margin_gap_usd": F.coalesce("total_margin_gap_usd", F.lit(0.0)),
                "is_hotspot": F.coalesce("is_hotspot", F.lit(False)),
                "dominant_district": F.coalesce("dominant_district", F.lit(labels.NO_VALUE)),
                "failure_rate_pct": F.coalesce("failure_rate_pct", F.lit(0.0)),
                "center_lat": round_half_away(F.col("centre_lat"), 5),
                "center_lng": round_half_away(F.col("centre_lon"), 5),
            }
        )
    )
    delay, gap, hot = (
        F.col(c) for c in ("avg_delay_minutes", "total_margin_gap_usd", "is_hotspot")
    )
    shown = F.col("has_data") & (F.col("total_deliveries") > 0)
    colour = labels.severity_colour(delay, shown)
    return merged.select(
        "h3_cell_9",
        "avg_delay_minutes",
        "total_deliveries",
        "total_margin_gap_usd",
        "is_hotspot",
        "dominant_district",
        "failure_rate_pct",
        "has_data",
        "center_lat",
        "center_lng",
        F.when(
            F.col("center_lat").isNotNull(), F.format_string("%.5f, %.5f", "center_lat", "center_lng")
        ).alias("maps_coords"),
        *[value.alias(name) for name, value in colour.items()],
        labels.delay_label(delay).alias("delay_label"),
        labels.gap_label(gap).alias("gap_label"),
        labels.status(hot).alias("status"),
        labels.status_colour(hot).alias("status_color"),
    )


def zone_kpis(zone_map_feed: DataFrame) -> DataFrame:
    """One row over the map: hotspots, their gap, mean of their rounded delays."""
    hot = F.col("is_hotspot")
    delays = F.when(hot & F.col("has_data"), F.col("avg_delay_minutes"))
    return zone_map_feed.agg(
        F.count_if(hot).alias("n_hotspots"),
        F.coalesce(
            round_half_away(F.sum(F.when(hot, money_total(F.col("total_margin_gap_usd")))), 2), F.lit(0.0)
        ).alias("hotspot_gap_usd"),
        F.coalesce(round_half_away(ratio(F.sum(money_total(delays)), F.count(delays)), 4), F.lit(0.0)).alias("hotspot_delay_minutes"),
    )


def zone_lookup(
    lattice: DataFrame,
    zones: DataFrame,
    lat: float,
    lon: float,
    reference_lat: float = geo.REFERENCE_LAT,
) -> DataFrame:
    """The map row of the zone that holds a point; both sides are cut to it before they meet."""
    picked = F.col("h3_cell_9") == geo.hex_cell(F.lit(lat), F.lit(lon), reference_lat)
    return _zone_panel(zone_map(lattice.filter(picked), zones.filter(picked)))


def stored_zone_lookup(
    mart: DataFrame, lat: float, lon: float, reference_lat: float = geo.REFERENCE_LAT
) -> DataFrame:
    """As :func:`zone_lookup` on the city's map, from a mart that is laid out for it: one folder of it is read."""
    cell = geo.hex_cell(F.lit(lat), F.lit(lon), reference_lat)
    lattice = spatial.cell_at(mart.sparkSession, lat, lon, reference_lat)
    return _zone_panel(zone_map(lattice, h3_zones(layout.lookup(mart, cell))))


def _zone_panel(zone_map_feed: DataFrame) -> DataFrame:
    """What is shown of a selected zone."""
    return zone_map_feed.select(
        "h3_cell_9",
        "dominant_district",
        "avg_delay_minutes",
        "total_margin_gap_usd",
        "total_deliveries",
        "failure_rate_pct",
        "status",
        (F.col("avg_delay_minutes") > DELAY_THRESHOLD).alias("is_slow"),
        labels.gap_class(F.col("total_margin_gap_usd")).alias("gap_class"),
        (F.col("failure_rate_pct") > 10).alias("fails_often"),
    )
