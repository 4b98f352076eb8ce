"""Delivery documents derived from the order tables used for testing.

One delivery per row of ``orders``. Every value is an integer formula over the
row's key, written once here and once in the SQL the results are checked
against, so a result can be compared bit for bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewright.functions.numeric import round_half_away
from zonewright.operators.prefix import running_totals
from zonewright.operators.spatial import with_cells
from zonewright.plans import routes
from zonewright.plans.staging import item_totals

# District name, centre in millionths of a degree, complex or not.
DISTRICTS = [
    ("Quận 1", 10776900, 106700900, False),
    ("Quận 3", 10780100, 106682100, True),
    ("Quận 4", 10757200, 106704300, False),
    ("Quận 5", 10755300, 106663900, True),
    ("Quận 7", 10729400, 106717200, False),
    ("Quận 10", 10773300, 106666800, True),
    ("Bình Thạnh", 10812400, 106712000, False),
    ("Gò Vấp", 10838800, 106665400, True),
    ("Tân Bình", 10803100, 106652400, False),
    ("Thủ Đức", 10854400, 106753800, False),
    ("Bình Chánh", 10688300, 106614200, False),
]

PAYMENT_METHODS = ["credit_card", "cod", "momo", "zalopay"]
INSTALLMENTS = [1, 1, 1, 3, 6]
DRIVERS = 50

# A route is a driver's month; by day almost every route would have one stop.
DRIVER_ID = f"concat('DRV_', lpad(string({{key}} % {DRIVERS} + 1), 3, '0'))"
ROUTE_ID = (
    "concat('RT_', date_format(trunc(o_orderdate, 'month'), 'yyyyMMdd'), '_', "
    + DRIVER_ID
    + ")"
)

# Every fiftieth order is paid a cent too much, so that there is something to find.
OVERPAID = "if(k % 50 = 7, 0.01D, 0.0D)"


class TestTables:
    """The test tables of one scale-factor folder."""

    __test__ = False

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    # -- dimensions -----------------------------------------------------------

    def customers(self) -> DataFrame:
        return self["customer"].selectExpr(
            "string(c_custkey) AS customer_id",
            "c_name AS customer_name",
            "lpad(string(c_custkey), 10, '0') AS phone",
            "c_mktsegment AS segment",
            f"{_district('name', 'c_nationkey')} AS district",
        )

    def products(self) -> DataFrame:
        return self["part"].selectExpr(
            "string(p_partkey) AS product_id",
            "p_name AS product_name",
            "p_type AS category",
            "p_retailprice AS price_usd",
            "double(100 + (p_partkey * 37) % 4901) AS weight_g",
        )

    def sellers(self) -> DataFrame:
        shift = "(s_suppkey * 7919) % 6001 - 3000"
        return self["supplier"].selectExpr(
            "string(s_suppkey) AS seller_id",
            "s_name AS seller_name",
            f"{_district('name', 's_nationkey')} AS district",
            f"double({_district('lat6', 's_nationkey')} + {shift}) / 1000000D AS warehouse_lat",
            f"double({_district('lon6', 's_nationkey')} + {shift}) / 1000000D AS warehouse_lon",
        )

    # -- facts ----------------------------------------------------------------

    def _located_orders(self) -> DataFrame:
        """Orders with the two pseudo-random draws and the destination point."""
        orders, customer = self["orders"], self["customer"]
        return orders.join(
            customer, orders["o_custkey"] == customer["c_custkey"]
        ).selectExpr(
            "o_orderkey AS k",
            "o_custkey",
            "o_orderstatus",
            "o_orderdate",
            "(o_orderkey * 16807 + 7) % 997 AS h",
            "(o_orderkey * 48271 + 11) % 1009 AS u",
            f"{_district('name', 'c_nationkey')} AS district",
            f"{_district('complex', 'c_nationkey')} AS is_complex",
            f"{_district('lat6', 'c_nationkey')} + (o_orderkey * 7919) % 80001 - 40000 AS lat6",
            f"{_district('lon6', 'c_nationkey')} + (o_orderkey * 104729) % 80001 - 40000 AS lon6",
        )

    def delivery_telemetry(self, stop_numbers: bool = False) -> DataFrame:
        """Telemetry documents without zone ids.

        A stop number is a row's rank within its route. Only the queries that
        show it pay for the ranking; for the others it is NULL.
        """
        noise = "((lat6 div 10000) * 31 + (lon6 div 10000) * 17) % 256"
        orders = self._located_orders().selectExpr(
            "*",
            f"if(is_complex, u < 353 + 2 * ({noise}), u * 256 < ({noise}) * 222) AS late",
            "timestampadd(SECOND, 7200 + (h % 360) * 60 + k % 60, o_orderdate) AS estimated",
            f"{DRIVER_ID.format(key='k')} AS driver_id",
            f"{ROUTE_ID.format(key='k')} AS route_id",
        )
        if stop_numbers:
            orders = running_totals(orders, group="route_id", order="k", rank="stop_number")
        else:
            orders = orders.withColumn("stop_number", F.lit(None).cast("bigint"))
        delay = "if(late, 15 + h % 46, h % 11 - 2)"
        return orders.selectExpr(
            "k AS order_id",
            "route_id",
            "driver_id",
            "stop_number",
            f"if((k % {DRIVERS}) % 2 = 0, 'van', 'motorbike') AS vehicle_type",
            """named_struct(
                'destination_lat', double(lat6) / 1000000D,
                'destination_lon', double(lon6) / 1000000D,
                'distance_from_prev_km', double(30 + h % 371) / 100D) AS spatial_data""",
            f"""named_struct(
                'dispatched_at', timestampadd(SECOND, 7200, o_orderdate),
                'estimated_arrival_at', estimated,
                'actual_arrival_at', timestampadd(SECOND, ({delay}) * 60 + k % 7, estimated),
                'status', if(late AND h % 100 < 12, 'failed', 'delivered')) AS telemetry""",
            """named_struct(
                'traffic_zone', CASE WHEN late THEN 'high' WHEN h % 2 = 0 THEN 'low'
                                     ELSE 'medium' END,
                'has_hem_access', late OR h % 5 = 0,
                'weather_condition', if(h % 3 = 2, 'rainy', 'clear')) AS complexity_factors""",
        )

    def raw_deliveries(self, stop_numbers: bool = False) -> DataFrame:
        """Telemetry documents with both zone ids."""
        return with_cells(self.delivery_telemetry(stop_numbers))

    def order_items(self) -> DataFrame:
        """Line items, one row each."""
        return self["lineitem"].selectExpr(
            "l_orderkey AS order_id",
            "l_partkey AS product_id",
            "l_suppkey AS seller_id",
            "bigint(l_quantity) AS quantity",
            "try_divide(l_extendedprice, l_quantity) AS unit_price_usd",
            "0.5D + 0.25D * ((l_partkey + l_linenumber) % 13) AS freight_value_usd",
        )

    def order_documents(self) -> DataFrame:
        """Order documents, one per order, with their items nested.

        A document is one row, so an order's items are in one place by the data
        model itself; orders without items have no array.
        """
        item = F.struct(
            "product_id", "seller_id", "quantity", "unit_price_usd", "freight_value_usd"
        )
        nested = self.order_items().groupBy("order_id").agg(F.collect_list(item).alias("line_items"))
        count, *sums = item_totals(F.col("line_items"))
        return self.order_headers(nested.select("order_id", "line_items", count, *sums), "line_items")

    def order_headers(self, totals: DataFrame, *extra: str) -> DataFrame:
        """Order documents without their items, next to the items' totals.

        ``totals`` is one row per order that has items; the amount paid follows
        from it. ``extra`` names more of its columns to keep.
        """
        orders = self._located_orders()
        joined = orders.join(totals, orders["k"] == totals["order_id"], "left")
        due = F.col("subtotal_usd") + F.col("total_freight_usd")
        paid = round_half_away(due + F.expr(OVERPAID), 2)
        return joined.withColumn("paid", paid).selectExpr(
            "k AS order_id",
            "o_custkey AS customer_id",
            """CASE WHEN k % 20 = 0 THEN 'cancelled'
                    WHEN o_orderstatus = 'F' THEN 'delivered'
                    WHEN o_orderstatus = 'O' THEN 'shipped'
                    WHEN o_orderstatus = 'P' THEN 'processing' END AS order_status""",
            "o_orderdate AS order_timestamp",
            f"""named_struct(
                'method', {_pick(PAYMENT_METHODS, 'k')},
                'installments', bigint({_pick(INSTALLMENTS, 'k')}),
                'amount_usd', paid) AS payment""",
            """named_struct(
                'recipient_name', concat('Customer ', o_custkey),
                'destination_district', district,
                'destination_lat', double(lat6) / 1000000D,
                'destination_lon', double(lon6) / 1000000D,
                'address_text', concat('No. ', k, ', ', district)) AS shipping_snapshot""",
            "item_count",
            "subtotal_usd",
            "total_freight_usd",
            *extra,
        )

    def route_stops(self) -> DataFrame:
        """(route_id, stop_key, ordered_at, leg_minutes) of every delivery."""
        orders, customer = self["orders"], self["customer"]
        placed = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
        return placed.selectExpr(
            f"{ROUTE_ID.format(key='o_orderkey')} AS route_id",
            "o_orderkey AS stop_key",
            "o_orderdate AS ordered_at",
            "((30 + ((o_orderkey * 16807 + 7) % 997) % 371) * 8) div 100 + 2 AS leg_minutes",
        )

    def carried_telemetry(self) -> DataFrame:
        """Routes as telemetry carries them, with faults planted by formulas of the key.

        Stop numbers that are null or one too high, dispatches three days early, arrivals before
        the dispatch or before the stop in front.
        """
        planned = routes.schedule(self.route_stops())
        ordered = self["orders"].select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("ordered_at"))
        return planned.join(ordered, F.col("order_id") == F.col("k")).selectExpr(
            "order_id",
            "route_id",
            "ordered_at",
            "CASE WHEN k % 97 = 5 THEN NULL WHEN k % 89 = 3 THEN stop_number + 1 ELSE stop_number END AS stop_number",
            "timestampadd(DAY, if(k % 101 = 9, -3, 0), dispatched_at) AS dispatched_at",
            """timestampadd(MINUTE, CASE WHEN k % 83 = 7 THEN -40 * 1440 WHEN k % 79 = 11 THEN -45 ELSE 0 END,
                estimated_arrival_at) AS estimated_arrival_at""",
        )


def _pick(values: list, key: str) -> str:
    """SQL for the value at ``key`` modulo the length of the list."""
    literals = ", ".join(repr(v).lower() if isinstance(v, bool) else repr(v) for v in values)
    return f"element_at(array({literals}), int({key} % {len(values)}) + 1)"


def _district(attribute: str, nation_key: str) -> str:
    column = ("name", "lat6", "lon6", "complex").index(attribute)
    return _pick([row[column] for row in DISTRICTS], nation_key)
