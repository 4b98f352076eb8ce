"""Aggregation of deliveries into zones.

All of it merges map-side first and shuffles group keys with fixed-width
buffers only, so a zone that holds a third of all rows costs its reducer no
more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewright.functions.numeric import MONEY

# Additive measures of a zone: partial sums of any grouping can be added up.
MEASURES = {
    "timed": "count(delay_minutes)",
    "delay_sum": "sum(delay_minutes)",
    "cost_sum": f"sum(CAST(delay_cost_usd AS {MONEY}))",
    "gap_sum": f"sum(CAST(margin_gap_usd AS {MONEY}))",
    "gap_rows": "count(margin_gap_usd)",
    "failed": "count_if(delivery_status = 'failed')",
    "hem_access": "count_if(has_hem_access)",
}


def in_zone(zone: str) -> Column:
    """Rows of a group that have a zone: zero for the group of those without.

    Dropping that group afterwards (``HAVING``) rather than filtering rows up
    front keeps the zone id, an expression if the raw table does not store it,
    from being computed twice.
    """
    return F.count(zone)


def zone_profile(metrics: DataFrame, zone: str, distinct: str, modes: Sequence[str]) -> DataFrame:
    """Per zone: the measures, distinct values of one column, modes of others.

    Gives ``zone``, ``deliveries``, MEASURES, ``n_<distinct>`` and ``mode_<column>`` for each of
    ``modes``. NULLs count neither as distinct values nor as a mode; a tie for
    the mode goes to the smallest value.

    Spark's ``count_distinct`` next to ``mode`` carries a map per group through
    four aggregation steps and falls back to sorting all rows. Here rows are
    first combined per (zone, value, value, ...), then one grouping-sets pass
    over that much smaller profile yields the totals and each column's counts.
    """
    return merge_state(zone_state(metrics, zone, [distinct, *modes]), [zone], [distinct], modes)


def zone_state(metrics: DataFrame, zone: str, facets: Sequence[str]) -> DataFrame:
    """``deliveries`` and MEASURES per zone and combination of the facets' values.

    States of zones add up: what :func:`merge_state` makes of them is exact for any union of zones.
    """
    measured = {"deliveries": f"count({zone})", **MEASURES}
    return (
        metrics.groupBy(zone, *facets)
        .agg(*[F.expr(f"{value} AS {name}") for name, value in measured.items()])
        .filter("deliveries > 0")
    )


def merge_state(state: DataFrame, zone: Sequence[str], distinct: Sequence[str], modes: Sequence[str]) -> DataFrame:
    """Totals, distinct counts and modes of zones, which the columns ``zone`` identify, from their states."""
    facets, measured = [*distinct, *modes], ["deliveries", *MEASURES]
    key = [F.col(z) for z in zone]
    counted = state.groupingSets(
        [key, *[[*key, F.col(facet)] for facet in facets]], *zone, *facets
    ).agg(
        *[F.expr(f"sum({name}) AS {name}") for name in measured],
        *[F.expr(f"grouping({facet}) = 0 AS by_{facet}") for facet in facets],
    )

    whole_zone = " AND ".join(f"NOT by_{facet}" for facet in facets)
    rank = "CASE WHEN by_{0} AND {0} IS NOT NULL THEN struct(-deliveries, {0}) END"
    return counted.groupBy(*zone).agg(
        *[F.expr(f"max({name}) FILTER (WHERE {whole_zone}) AS {name}") for name in measured],
        *[F.expr(f"count({name}) FILTER (WHERE by_{name}) AS n_{name}") for name in distinct],
        *[F.expr(f"min_by({mode}, {rank.format(mode)}) AS mode_{mode}") for mode in modes],
    )


def distinct_per_zone(df: DataFrame, zone: str, column: str) -> DataFrame:
    """(zone, n): exact distinct non-NULL values, deduplicated before counting."""
    pairs = df.groupBy(zone, column).agg(in_zone(zone).alias("rows")).filter("rows > 0")
    return pairs.groupBy(zone).agg(F.count(column).alias(f"n_{column}"))


def mode_per_zone(df: DataFrame, zone: str, column: str) -> DataFrame:
    """(zone, mode): most frequent non-NULL value, ties to the smallest."""
    counts = df.groupBy(zone, column).agg(in_zone(zone).alias("rows")).filter("rows > 0")
    rank = F.when(F.col(column).isNotNull(), F.struct(-F.col("rows"), F.col(column)))
    return counts.groupBy(zone).agg(F.min_by(column, rank).alias(f"mode_{column}"))


def filtered_share(df: DataFrame, zone: str, condition: Column, name: str) -> DataFrame:
    """(zone, deliveries, matching rows): the inputs of a percentage."""
    return (
        df.groupBy(zone)
        .agg(in_zone(zone).alias("deliveries"), F.count_if(condition).alias(name))
        .filter("deliveries > 0")
    )


def zone_centroids(points: DataFrame, zone: str, lat: str, lon: str) -> DataFrame:
    """(zone, centroid_lat, centroid_lon): mean position of a zone's deliveries."""
    return (
        points.groupBy(zone)
        .agg(
            in_zone(zone).alias("rows"),
            F.avg(lat).alias("centroid_lat"),
            F.avg(lon).alias("centroid_lon"),
        )
        .filter("rows > 0")
        .drop("rows")
    )
