"""Declared schemas of the raw tables, in DDL.

Readers never infer: inference costs a pass over the data, and the inferred
types differ by format (UUID-shaped ids, integer against float weights: both
are read as double).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

CUSTOMERS = "customer_id string, customer_name string, phone string, segment string, district string"
PRODUCTS = "product_id string, product_name string, category string, price_usd double, weight_g double"
SELLERS = (
    "seller_id string, seller_name string, district string, "
    "warehouse_lat double, warehouse_lon double"
)

ORDERS = """
    order_id string,
    customer_id string,
    order_status string,
    order_timestamp string,
    payment struct<method: string, installments: bigint, amount_usd: double>,
    line_items array<struct<
        product_id: string, seller_id: string, quantity: bigint,
        unit_price_usd: double, freight_value_usd: double>>,
    shipping_snapshot struct<
        recipient_name: string, destination_district: string,
        destination_lat: double, destination_lon: double, address_text: string>
"""

DELIVERY_TELEMETRY = """
    order_id string,
    route_id string,
    driver_id string,
    stop_number bigint,
    vehicle_type string,
    spatial_data struct<
        destination_lat: double, destination_lon: double, distance_from_prev_km: double>,
    telemetry struct<
        dispatched_at: string, estimated_arrival_at: string,
        actual_arrival_at: string, status: string>,
    complexity_factors struct<
        traffic_zone: string, has_hem_access: boolean, weather_condition: string>
"""

# Telemetry after the loader has added both zone ids.
DELIVERIES = DELIVERY_TELEMETRY + ", h3_cell_9 string, grid_cell_id string"

CL_BENCHMARKS = "method string, n_rows bigint, total_seconds double, microseconds_per_row double"

DIMENSIONS = {"customers": CUSTOMERS, "products": PRODUCTS, "sellers": SELLERS}

# Raw tables with their descriptions; the loader creates them under these names.
RAW_TABLES = {
    "raw_customers": (CUSTOMERS, "Customer dimension"),
    "raw_products": (PRODUCTS, "Product dimension"),
    "raw_sellers": (SELLERS, "Seller dimension with warehouse location"),
    "raw_orders": (ORDERS, "Order documents, nested payment, items and shipping"),
    "raw_deliveries": (DELIVERIES, "Delivery telemetry documents with zone ids"),
    "raw_cl_benchmarks": (CL_BENCHMARKS, "Index cost per method"),
}


def missing_tables(spark: SparkSession, database: str) -> list[str]:
    """Declared raw tables that the catalog does not hold."""
    return [name for name in RAW_TABLES if not spark.catalog.tableExists(f"{database}.{name}")]
