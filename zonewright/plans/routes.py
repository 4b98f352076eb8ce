"""Planned arrival times along a route."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewright.functions.temporal import plus_seconds
from zonewright.operators.prefix import running_totals

# Hours from the last order of a route to its dispatch.
DISPATCH_HOURS = 2


def schedule(stops: DataFrame) -> DataFrame:
    """Stop number, dispatch time and ETA of each stop.

    ``stops`` is (route_id, stop_key, ordered_at, leg_minutes). A route is
    dispatched two hours after its last order; each stop is reached after the
    legs up to and including its own.
    """
    ranked = running_totals(
        stops,
        group="route_id",
        order="stop_key",
        rank="stop_number",
        sums={"minutes_so_far": "leg_minutes"},
        group_max={"last_ordered_at": "ordered_at"},
    )
    dispatched = plus_seconds(F.col("last_ordered_at"), F.lit(DISPATCH_HOURS * 3600))
    return ranked.select(
        "route_id",
        F.col("stop_key").alias("order_id"),
        "stop_number",
        dispatched.alias("dispatched_at"),
        plus_seconds(dispatched, F.col("minutes_so_far") * 60).alias("estimated_arrival_at"),
    )
