"""Staging models: flat views of the raw tables. All lazy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def customers(raw: DataFrame) -> DataFrame:
    return raw.select("customer_id", "customer_name", "phone", "segment", "district")


def products(raw: DataFrame) -> DataFrame:
    return raw.select("product_id", "product_name", "category", "price_usd", "weight_g")


def sellers(raw: DataFrame) -> DataFrame:
    return raw.select("seller_id", "seller_name", "district", "warehouse_lat", "warehouse_lon")


# -- orders -------------------------------------------------------------------

ITEM_TOTALS = ("item_count", "subtotal_usd", "total_freight_usd")


ORDER_COLUMNS = (
    "order_id",
    "customer_id",
    "order_status",
    "CAST(order_timestamp AS TIMESTAMP_NTZ) AS order_timestamp",
    "payment.method AS payment_method",
    "payment.installments AS payment_installments",
    "payment.amount_usd AS payment_amount_usd",
    "shipping_snapshot.destination_district AS destination_district",
    "shipping_snapshot.destination_lat AS destination_lat",
    "shipping_snapshot.destination_lon AS destination_lon",
    "shipping_snapshot.address_text AS address_text",
)


def _array_sum(values: Column) -> Column:
    """Sum of an array inside its row; NULL if it has no non-NULL value."""
    present = F.array_compact(values)
    total = F.aggregate(present, F.lit(0.0), lambda sum_, value: sum_ + value.cast("double"))
    return F.when(F.size(present) > 0, total)


def item_totals(items: Column) -> list[Column]:
    """Item count, goods value and freight of an order's item array.

    Fields are taken from the array as a whole (an array per field), so that a
    scan reads only those in use; a lambda over structs would read all.
    """
    values = F.zip_with(items["quantity"], items["unit_price_usd"], lambda n, price: n * price)
    return [
        F.when(items.isNotNull(), F.size(items)).cast("bigint").alias("item_count"),
        _array_sum(values).alias("subtotal_usd"),
        _array_sum(items["freight_value_usd"]).alias("total_freight_usd"),
    ]


def orders(raw: DataFrame) -> DataFrame:
    """One row per order document; the array is totalled inside its row."""
    return raw.select(*map(F.expr, ORDER_COLUMNS), *item_totals(F.col("line_items")))


def orders_with_totals(headers: DataFrame) -> DataFrame:
    """As :func:`orders`, for documents whose item totals come ready-made."""
    return headers.selectExpr(*ORDER_COLUMNS, *ITEM_TOTALS)


def flat_totals(items: DataFrame) -> DataFrame:
    """Totals per order where items are stored one row each."""
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.sum(F.col("quantity") * F.col("unit_price_usd")).alias("subtotal_usd"),
        F.sum("freight_value_usd").alias("total_freight_usd"),
    )


def order_items(raw: DataFrame) -> DataFrame:
    """One row per line item; orders with an empty or NULL array have none."""
    return raw.select("order_id", "order_timestamp", F.explode("line_items").alias("item")).selectExpr(
        "order_id",
        "CAST(order_timestamp AS TIMESTAMP_NTZ) AS order_timestamp",
        "item.product_id",
        "item.seller_id",
        "item.quantity",
        "item.unit_price_usd",
        "item.freight_value_usd",
        "item.quantity * item.unit_price_usd AS line_total_usd",
    )


# -- deliveries ---------------------------------------------------------------


def deliveries(raw: DataFrame) -> DataFrame:
    """One row per delivery stop, nested documents flattened."""
    return raw.selectExpr(
        "order_id",
        "route_id",
        "driver_id",
        "stop_number",
        "vehicle_type",
        "spatial_data.destination_lat AS destination_lat",
        "spatial_data.destination_lon AS destination_lon",
        "spatial_data.distance_from_prev_km AS distance_from_prev_km",
        "h3_cell_9",
        "grid_cell_id",
        "CAST(telemetry.dispatched_at AS TIMESTAMP_NTZ) AS dispatched_at",
        "CAST(telemetry.estimated_arrival_at AS TIMESTAMP_NTZ) AS estimated_arrival_at",
        "CAST(telemetry.actual_arrival_at AS TIMESTAMP_NTZ) AS actual_arrival_at",
        "telemetry.status AS delivery_status",
        "complexity_factors.traffic_zone AS traffic_zone",
        "complexity_factors.has_hem_access AS has_hem_access",
        "complexity_factors.weather_condition AS weather_condition",
    )
