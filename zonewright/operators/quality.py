"""Column tests. Each returns one row; ``failures`` of zero is a pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewright.functions.numeric import round_half_away
from zonewright.operators.prefix import with_previous


def _result(test: str, name: str, column: str, failures) -> list:
    return [
        F.lit(test).alias("test"),
        F.lit(name).alias("table_name"),
        F.lit(column).alias("column_name"),
        failures.alias("failures"),
    ]


def unique(df: DataFrame, name: str, column: str) -> DataFrame:
    """Non-NULL values that occur more than once."""
    repeated = (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    return repeated.agg(F.count(F.lit(1)).alias("n")).select(
        *_result("unique", name, column, F.col("n"))
    )


def not_null(df: DataFrame, name: str, column: str) -> DataFrame:
    """Rows whose value is NULL."""
    return df.agg(F.count_if(F.col(column).isNull()).alias("n")).select(
        *_result("not_null", name, column, F.col("n"))
    )


def route_sequence(deliveries: DataFrame) -> DataFrame:
    """Per route: stops, stop numbers that are missing or doubled, planned arrivals before dispatch.

    Numbers should run from 1 without a gap. They are deduplicated before they are
    counted, so a crowded route is no single task's work.
    """
    early = F.count_if(F.col("estimated_arrival_at") < F.col("dispatched_at"))
    numbers = deliveries.groupBy("route_id", "stop_number").agg(F.count(F.lit(1)).alias("n"), early.alias("early"))
    return numbers.groupBy("route_id").agg(
        F.sum("n").alias("stops"),
        F.greatest(F.max("stop_number") - F.count("stop_number"), F.lit(0)).alias("missing_numbers"),
        F.sum(F.when(F.col("stop_number").isNotNull(), F.col("n") - 1).otherwise(0)).alias("doubled_numbers"),
        F.sum(F.when(F.col("stop_number").isNull(), F.col("n")).otherwise(0)).alias("without_number"),
        F.sum("early").alias("early_arrivals"),
    )


def route_continuity(deliveries: DataFrame) -> DataFrame:
    """Per route: runs of consecutive stop numbers, stops planned before the one they follow, dispatches before the last order.

    One run is a route without gaps, one that starts late included. Takes ``order_id`` and ``ordered_at`` besides what
    telemetry has. Stops are compared in the order of their numbers, those of one number by order id;
    stops without a number are in no run. A route may hold any share of the rows: see :func:`with_previous`.
    """
    stops = with_previous(deliveries, "route_id", "stop_number", "order_id", ["stop_number", "estimated_arrival_at"])
    number, before = F.col("stop_number"), F.col("previous.stop_number")
    backward = before.isNotNull() & (F.col("estimated_arrival_at") < F.col("previous.estimated_arrival_at"))
    runs = stops.groupBy("route_id").agg(
        F.count_if(number.isNotNull() & (before.isNull() | (number - before > 1))).alias("islands"),
        F.count_if(backward).alias("backward_arrivals"),
    )
    # dispatch times are few per route; they meet its last order after they are counted
    dispatches = deliveries.groupBy("route_id", "dispatched_at").agg(F.count(F.lit(1)).alias("n"), F.max("ordered_at").alias("last"))
    last = dispatches.groupBy("route_id").agg(F.max("last").alias("last_order"))
    late = dispatches.join(last.withColumnRenamed("route_id", "route"), F.col("route_id").eqNullSafe(F.col("route")))
    early = late.groupBy("route_id").agg(F.sum(F.when(F.col("dispatched_at") < F.col("last_order"), F.col("n")).otherwise(0)).alias("early_dispatches"))
    early = early.withColumnRenamed("route_id", "route")
    return runs.join(early, F.col("route_id").eqNullSafe(F.col("route"))).drop("route")


def payment_reconciliation(orders: DataFrame) -> DataFrame:
    """One row: orders whose payment is, and is not, goods plus freight.

    Takes staged orders; an order without items has nothing to compare with.
    """
    paid = F.col("payment_amount_usd")
    due = round_half_away(F.col("subtotal_usd") + F.col("total_freight_usd"), 2)
    return orders.agg(
        F.count(F.lit(1)).alias("orders"),
        F.count(due).alias("orders_with_items"),
        F.count_if(paid == due).alias("reconciled"),
        F.count_if(due.isNotNull() & ~paid.eqNullSafe(due)).alias("failures"),
    )
