"""The delivery metric model: delay, delay cost and margin gap per delivery."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewright.functions.rules import OTHER_HOURLY, VAN_HOURLY
from zonewright.functions.temporal import minutes_crossed

ORDER_COLUMNS = ("order_id", "destination_district", "total_freight_usd", "payment_method")


def join_orders(deliveries: DataFrame, orders: DataFrame) -> DataFrame:
    """Deliveries with what the metrics need of their order.

    The one join between the two facts. Every delivery is kept, so AQE may
    split a crowded key (one order, or none at all) on the delivery side.
    """
    return deliveries.join(orders.select(*ORDER_COLUMNS), "order_id", "left")


def delivery_metrics(deliveries: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per delivery. A positive ``margin_gap_usd`` is a loss."""
    delay = F.col("delay_minutes")
    hourly = F.when(F.col("vehicle_type") == "van", VAN_HOURLY).otherwise(OTHER_HOURLY)
    return (
        join_orders(deliveries, orders)
        .withColumn(
            "delay_minutes",
            minutes_crossed(F.col("estimated_arrival_at"), F.col("actual_arrival_at")),
        )
        .withColumn("delay_cost_usd", delay / 60.0 * hourly)
        .withColumn(
            "margin_gap_usd",
            F.col("delay_cost_usd") - F.coalesce(F.col("total_freight_usd"), F.lit(0.0)),
        )
        .select(
            "order_id",
            "route_id",
            "driver_id",
            "vehicle_type",
            "stop_number",
            "destination_lat",
            "destination_lon",
            "h3_cell_9",
            "grid_cell_id",
            "delivery_status",
            "traffic_zone",
            "has_hem_access",
            "distance_from_prev_km",
            "destination_district",
            "total_freight_usd",
            "payment_method",
            "delay_minutes",
            "delay_cost_usd",
            "margin_gap_usd",
            "estimated_arrival_at",
            "actual_arrival_at",
        )
    )
