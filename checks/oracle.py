"""SQL that must give the same rows as the registered queries.

Written independently of the Spark plans: indicator columns on single
deliveries, window functions over zones, ranks for modes, distances by chord.
``r(x, n)`` stands for the rounding both sides use.
"""

from __future__ import annotations

import re


def _sql(text: str) -> str:
    """Expand ``r(expression, places)`` to rounding as DOUBLE."""
    pattern = re.compile(r"\br\(")
    while match := pattern.search(text):
        start, depth, commas = match.end(), 1, []
        for i in range(start, len(text)):
            depth += {"(": 1, ")": -1}.get(text[i], 0)
            if text[i] == "," and depth == 1:
                commas.append(i)
            if depth == 0:
                end = i
                break
        expression, places = text[start : commas[-1]], text[commas[-1] + 1 : end].strip()
        text = (
            f"{text[: match.start()]}round(({expression})::double, {places})"
            f"{text[end + 1 :]}"
        )
    return text


# District index, name, centre in millionths of a degree, complex.
DISTRICTS = """
districts(d, district, lat0, lon0, complex) AS (VALUES
    (0, 'Quận 1', 10776900, 106700900, false),
    (1, 'Quận 3', 10780100, 106682100, true),
    (2, 'Quận 4', 10757200, 106704300, false),
    (3, 'Quận 5', 10755300, 106663900, true),
    (4, 'Quận 7', 10729400, 106717200, false),
    (5, 'Quận 10', 10773300, 106666800, true),
    (6, 'Bình Thạnh', 10812400, 106712000, false),
    (7, 'Gò Vấp', 10838800, 106665400, true),
    (8, 'Tân Bình', 10803100, 106652400, false),
    (9, 'Thủ Đức', 10854400, 106753800, false),
    (10, 'Bình Chánh', 10688300, 106614200, false))
"""

_HEX = """
hexed AS (
    SELECT *, (0.5773502691896257 * (lon * 109.23625344213714)
               - (lat * 111.19492664455873) / 3.0::double) / 0.20132061220131367 AS fq,
           (2.0::double * (lat * 111.19492664455873) / 3.0::double) / 0.20132061220131367 AS fr
    FROM located),
cubed AS (
    SELECT *, -fq - fr AS fs, floor(fq + 0.5) AS rq, floor(fr + 0.5) AS rr,
           floor(-fq - fr + 0.5) AS rs
    FROM hexed),
celled AS (
    SELECT *,
        CASE WHEN abs(rq - fq) > abs(rr - fr) AND abs(rq - fq) > abs(rs - fs)
             THEN (-rr - rs)::bigint || '_' || rr::bigint
             WHEN abs(rr - fr) > abs(rs - fs)
             THEN rq::bigint || '_' || (-rq - rs)::bigint
             ELSE rq::bigint || '_' || rr::bigint END AS h3_cell_9,
        floor(lat / 0.01::double)::bigint || '_' || floor(lon / 0.01::double)::bigint
            AS grid_cell_id
    FROM cubed)
"""

BASE = (
    DISTRICTS
    + """,
seeded AS (
    SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_orderdate,
           (o_orderkey * 16807 + 7) % 997 AS h, (o_orderkey * 48271 + 11) % 1009 AS u,
           district, complex,
           lat0 + (o_orderkey * 7919) % 80001 - 40000 AS lat6,
           lon0 + (o_orderkey * 104729) % 80001 - 40000 AS lon6
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN districts ON d = c_nationkey % 11),
noisy AS (SELECT *, ((lat6 // 10000) * 31 + (lon6 // 10000) * 17) % 256 AS noise FROM seeded),
lated AS (
    SELECT *, CASE WHEN complex THEN u < 353 + 2 * noise ELSE u * 256 < noise * 222 END AS late
    FROM noisy),
timed AS (
    SELECT *, CASE WHEN late THEN 15 + h % 46 ELSE h % 11 - 2 END AS planned_delay,
           o_orderdate + to_seconds(7200 + (h % 360) * 60 + k % 60) AS estimated_arrival_at
    FROM lated),
located AS (
    SELECT *, lat6::double / 1000000.0::double AS lat, lon6::double / 1000000.0::double AS lon,
           estimated_arrival_at + to_seconds(planned_delay * 60 + k % 7) AS actual_arrival_at,
           'DRV_' || lpad((k % 50 + 1)::varchar, 3, '0') AS driver_id
    FROM timed),
"""
    + _HEX
    + """,
deliveries AS (
    SELECT k AS order_id,
           'RT_' || strftime(date_trunc('month', o_orderdate), '%Y%m%d') || '_' || driver_id
               AS route_id,
           driver_id,
           CASE WHEN (k % 50) % 2 = 0 THEN 'van' ELSE 'motorbike' END AS vehicle_type,
           lat AS destination_lat, lon AS destination_lon,
           (30 + h % 371)::double / 100.0::double AS distance_from_prev_km,
           h3_cell_9, grid_cell_id,
           o_orderdate + to_seconds(7200) AS dispatched_at,
           estimated_arrival_at, actual_arrival_at,
           CASE WHEN late AND h % 100 < 12 THEN 'failed' ELSE 'delivered' END AS delivery_status,
           CASE WHEN late THEN 'high' WHEN h % 2 = 0 THEN 'low' ELSE 'medium' END AS traffic_zone,
           late OR h % 5 = 0 AS has_hem_access,
           CASE WHEN h % 3 = 2 THEN 'rainy' ELSE 'clear' END AS weather_condition
    FROM celled),
items AS (
    SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS seller_id,
           l_quantity::bigint AS quantity, l_extendedprice / l_quantity AS unit_price_usd,
           0.5::double + 0.25::double * ((l_partkey + l_linenumber) % 13) AS freight_value_usd
    FROM lineitem),
baskets AS (
    SELECT order_id, count(*) AS item_count, sum(quantity * unit_price_usd) AS subtotal_usd,
           sum(freight_value_usd) AS total_freight_usd
    FROM items GROUP BY order_id),
staged_orders AS (
    SELECT k AS order_id, o_custkey AS customer_id,
           CASE WHEN k % 20 = 0 THEN 'cancelled'
                WHEN o_orderstatus = 'F' THEN 'delivered'
                WHEN o_orderstatus = 'O' THEN 'shipped'
                WHEN o_orderstatus = 'P' THEN 'processing' END AS order_status,
           o_orderdate AS order_timestamp,
           ['credit_card', 'cod', 'momo', 'zalopay'][(k % 4 + 1)::int] AS payment_method,
           [1, 1, 1, 3, 6][(k % 5 + 1)::int]::bigint AS payment_installments,
           district AS destination_district,
           lat6::double / 1000000.0::double AS destination_lat,
           lon6::double / 1000000.0::double AS destination_lon,
           'No. ' || k || ', ' || district AS address_text,
           item_count, subtotal_usd, total_freight_usd
    FROM seeded LEFT JOIN baskets ON order_id = k),
metrics AS (
    SELECT d.*, o.destination_district, o.total_freight_usd, o.payment_method,
           (epoch_us(date_trunc('minute', d.actual_arrival_at))
            - epoch_us(date_trunc('minute', d.estimated_arrival_at))) // 60000000
               AS delay_minutes,
           delay_minutes * if(d.vehicle_type = 'van', 5, 3) / 60.0::double AS delay_cost_usd,
           delay_cost_usd - ifnull(o.total_freight_usd, 0) AS margin_gap_usd,
           (delay_minutes > 15)::int AS late,
           (d.delivery_status = 'failed')::int AS failed,
           d.has_hem_access::int AS hem
    FROM deliveries d LEFT JOIN staged_orders o USING (order_id))
"""
)

# Both zone schemes in one relation: every delivery once per scheme.
ZONED = """
zoned AS (
    SELECT 'H3' AS method, h3_cell_9 AS cell, * FROM metrics WHERE h3_cell_9 IS NOT NULL
    UNION ALL
    SELECT 'Grid', grid_cell_id, * FROM metrics WHERE grid_cell_id IS NOT NULL)
"""


def _mode(name: str, column: str) -> str:
    """Most frequent value of a column per zone, found by rank."""
    return f"""
{name} AS (
    SELECT method, cell, {column} AS {name}
    FROM zoned WHERE {column} IS NOT NULL GROUP BY method, cell, {column}
    QUALIFY row_number() OVER (PARTITION BY method, cell ORDER BY count(*) DESC, {column}) = 1)
"""


ZONES = (
    ZONED
    + ","
    + _mode("dominant_traffic_zone", "traffic_zone")
    + ","
    + _mode("dominant_district", "destination_district")
    + """,
zone_totals AS (
    SELECT method, cell, count(*) AS total_deliveries, r(avg(delay_minutes), 1) AS avg_delay_minutes,
           r(sum(delay_cost_usd::decimal(18,9)), 2) AS total_delay_cost_usd,
           r(sum(margin_gap_usd::decimal(18,9)), 2) AS total_margin_gap_usd,
           r(sum(margin_gap_usd::decimal(18,9))::double / count(margin_gap_usd), 2)
               AS avg_margin_gap_usd,
           r(100::double * sum(failed) / count(*), 1) AS failure_rate_pct,
           r(100::double * sum(hem) / count(*), 1) AS hem_access_pct,
           len(list_distinct(list(driver_id)))::bigint AS unique_drivers,
           sum(delay_minutes - 15) > 0 AS is_hotspot,
           min(floor(destination_lat / 0.01::double)) * 0.01::double AS south,
           min(floor(destination_lon / 0.01::double)) * 0.01::double AS west
    FROM zoned GROUP BY method, cell)
"""
)

MART_H3 = f"""
{ZONES},
mart_h3 AS (
    SELECT cell AS h3_cell_9, * EXCLUDE (method, cell, south, west)
    FROM zone_totals
    LEFT JOIN dominant_traffic_zone USING (method, cell)
    LEFT JOIN dominant_district USING (method, cell)
    WHERE method = 'H3')
"""

MART_KPIS = """
mart_kpis AS (
    SELECT count(*) AS total_deliveries, r(avg(delay_minutes), 1) AS avg_delay_minutes,
           r(100::double * sum(late) / count(*), 1) AS pct_severely_delayed,
           r(sum(if(late = 1, delay_cost_usd::decimal(18,9), 0)), 0) AS at_risk_cost_usd,
           r(sum(if(late = 1, margin_gap_usd::decimal(18,9), 0)), 0) AS total_margin_gap_usd,
           (SELECT count(*) FROM (SELECT DISTINCT h3_cell_9 FROM metrics)) AS unique_h3_cells,
           (SELECT count(*) FROM (SELECT DISTINCT grid_cell_id FROM metrics))
               AS unique_grid_cells
    FROM metrics)
"""

MART_DISTRICT = """
mart_district AS (
    SELECT destination_district, count(*) AS total_deliveries,
           r(avg(delay_minutes), 1) AS avg_delay_minutes,
           r(100::double * sum(late) / count(*), 1) AS pct_delayed,
           r(100::double * sum(failed) / count(*), 1) AS failure_rate_pct,
           r(sum(delay_cost_usd::decimal(18,9)), 2) AS total_delay_cost_usd,
           r(sum(if(late = 1, margin_gap_usd::decimal(18,9), 0)), 0) AS margin_gap_usd
    FROM metrics GROUP BY destination_district HAVING destination_district IS NOT NULL)
"""


def _chord_km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Great-circle distance from the straight line between two points on the unit sphere."""

    def axes(lat: str, lon: str) -> list[str]:
        lat, lon = f"radians({lat})", f"radians({lon})"
        return [f"cos({lat}) * cos({lon})", f"cos({lat}) * sin({lon})", f"sin({lat})"]

    squares = [f"pow({a} - {b}, 2)" for a, b in zip(axes(lat1, lon1), axes(lat2, lon2))]
    return f"12742 * asin(sqrt({' + '.join(squares)}) / 2)"


# Every delivery next to the figures of its zone.
_POINT = _chord_km("destination_lat", "destination_lon", "zone_lat", "zone_lon")
PLACED = f"""
{ZONED},
in_zone AS (
    SELECT method, cell, destination_lat, destination_lon, late, delay_minutes, margin_gap_usd,
           count(*) OVER zone AS n,
           avg(delay_minutes) OVER zone AS zone_delay,
           stddev_samp(delay_minutes) OVER zone AS zone_spread,
           if(method = 'H3', avg(destination_lat) OVER zone,
              floor(destination_lat / 0.01::double) * 0.01::double + 0.005::double) AS zone_lat,
           if(method = 'H3', avg(destination_lon) OVER zone,
              floor(destination_lon / 0.01::double) * 0.01::double + 0.005::double) AS zone_lon,
           row_number() OVER (PARTITION BY method, cell ORDER BY order_id) = 1 AS is_first
    FROM zoned WINDOW zone AS (PARTITION BY method, cell)),
placed AS (SELECT *, zone_delay > 15 AS hot, {_POINT} AS km FROM in_zone)
"""

COMPARISON = """
SELECT if(method = 'H3', 'H3 (res=9, ~0.1 km²)', 'Grid (0.01°, ~1.1 km²)') AS method,
       count(*) FILTER (WHERE is_first) AS total_cells,
       count(*) FILTER (WHERE is_first AND hot) AS hotspot_cells,
       r(100::double * sum(if(hot, late, NULL)) / max(fleet_late), 1) AS hotspot_capture_rate_pct,
       r(100::double * sum(if(hot, late, NULL)) / count(if(hot, late, NULL)), 1)
           AS hotspot_precision_pct,
       r(sum(if(hot, margin_gap_usd::decimal(18,9), NULL)), 2) AS margin_gap_in_hotspots_usd,
       r(100::double * sum(if(hot, margin_gap_usd::decimal(18,9), NULL))::double / max(fleet_gap), 1)
           AS margin_gap_capture_pct,
       r(avg(if(is_first, zone_spread, NULL)), 2) AS avg_within_cell_delay_stddev,
       r(avg(km), 4) AS mdqe_km,
       if(method = 'H3', 0, 0.228)::double AS sdc_km,
       NULL::double AS cl_us_per_row
FROM placed, (SELECT sum(late) AS fleet_late, sum(margin_gap_usd::decimal(18,9))::double AS fleet_gap
              FROM metrics)
GROUP BY placed.method
"""

# Cells of the lattice between bounds(south, west, north, east).
LATTICE = """
steps AS (
    SELECT q, r0 AS lr, 0.20132061220131367 * sqrt(3.0) * (q + r0 / 2.0::double)
                            / 109.23625344213714 AS centre_lon,
           0.20132061220131367 * 1.5 * r0 / 111.19492664455873 AS centre_lat
    FROM (SELECT unnest(range(floor(south * 111.19492664455873 / 0.30198091830197051)::bigint - 2,
                              ceil(north * 111.19492664455873 / 0.30198091830197051)::bigint + 3)) AS r0
          FROM bounds),
         (SELECT unnest(range(
              floor(west * 313.2692 - north * 184.1092)::bigint - 50,
              ceil(east * 313.2692 - south * 184.1092)::bigint + 50)) AS q
          FROM bounds)),
lattice AS (
    SELECT q || '_' || lr AS h3_cell_9, q::bigint AS q, lr::bigint AS r_step,
           centre_lat, centre_lon
    FROM steps, bounds
    WHERE centre_lat BETWEEN south AND north AND centre_lon BETWEEN west AND east)
"""

CITY = """
bounds AS (SELECT 10.63::double AS south, 106.56::double AS west, 10.91::double AS north, 106.81::double AS east)
"""

ZONE_MAP = f"""{CITY}, {LATTICE},
merged AS (
    SELECT lattice.h3_cell_9, coalesce(avg_delay_minutes, 0) AS avg_delay_minutes,
           coalesce(total_deliveries, 0) AS total_deliveries,
           coalesce(total_margin_gap_usd, 0) AS total_margin_gap_usd,
           coalesce(is_hotspot, false) AS is_hotspot,
           coalesce(dominant_district, '—') AS dominant_district,
           coalesce(failure_rate_pct, 0) AS failure_rate_pct,
           total_deliveries IS NOT NULL AS has_data,
           r(centre_lat, 5) AS center_lat, r(centre_lon, 5) AS center_lng,
           least(coalesce(avg_delay_minutes, 0) / 35.0::double, 1.0::double) AS t,
           r(coalesce(total_margin_gap_usd, 0), 0)::bigint AS dollars
    FROM lattice LEFT JOIN mart_h3 USING (h3_cell_9)),
zone_map AS (
    SELECT h3_cell_9, avg_delay_minutes, total_deliveries, total_margin_gap_usd, is_hotspot,
           dominant_district, failure_rate_pct, has_data, center_lat, center_lng,
           printf('%.5f, %.5f', center_lat, center_lng) AS maps_coords,
           CASE WHEN NOT has_data THEN 180
                WHEN t < 0.5 THEN trunc(16 + 218 * (t * 2.0::double))::int
                ELSE trunc(234 + 5 * ((t - 0.5::double) * 2.0::double))::int END AS fill_r,
           CASE WHEN NOT has_data THEN 200
                WHEN t < 0.5 THEN trunc(185 - 6 * (t * 2.0::double))::int
                ELSE trunc(179 - 111 * ((t - 0.5::double) * 2.0::double))::int END AS fill_g,
           CASE WHEN NOT has_data THEN 220
                WHEN t < 0.5 THEN trunc(129 - 121 * (t * 2.0::double))::int
                ELSE trunc(8 + 60 * ((t - 0.5::double) * 2.0::double))::int END AS fill_b,
           CASE WHEN NOT has_data THEN 18 ELSE trunc(80 + 110 * t)::int END AS fill_a,
           printf('%.1f min avg', avg_delay_minutes) AS delay_label,
           CASE WHEN dollars > 0 THEN '+$' || format('{{:,}}', dollars) || ' loss'
                WHEN dollars < 0 THEN '-$' || format('{{:,}}', abs(dollars)) || ' ok'
                ELSE '—' END AS gap_label,
           CASE WHEN is_hotspot THEN 'HIGH RISK' ELSE 'Normal' END AS status,
           CASE WHEN is_hotspot THEN '#ef4444' ELSE '#10b981' END AS status_color
    FROM merged)
"""

HOTSPOTS = """
hotspots AS (
    SELECT h3_cell_9, dominant_district AS district, total_deliveries, avg_delay_minutes,
           total_margin_gap_usd, failure_rate_pct, dominant_traffic_zone, hem_access_pct
    FROM mart_h3 WHERE is_hotspot = true
    ORDER BY avg_delay_minutes DESC, h3_cell_9 LIMIT 50)
"""

# The zone of the looked-up point, found as the lattice cell with the nearest centre.
LOOKUP = """
picked AS (
    SELECT arg_min(h3_cell_9, pow((centre_lat - 10.7769) * 111.19492664455873, 2)
                   + pow((centre_lon - 106.7009) * 109.23625344213714, 2)) AS h3_cell_9
    FROM lattice)
"""


def _with(*ctes: str, select: str) -> str:
    return _sql(f"WITH {', '.join(ctes)} {select}")


def _dq(test: str, check: str) -> str:
    tables = [
        ("orders", "orders", "o_orderkey"),
        ("customer", "customer", "c_custkey"),
        ("lineitem", "lineitem", "l_orderkey"),
        ("events", "events", "user_id"),
        ("ids_with_null", "(SELECT c_custkey AS id FROM customer UNION ALL SELECT NULL)", "id"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{test}' AS test, '{name}' AS table_name, '{column}' AS column_name,"
        f" ({check.format(source=source, column=column)}) AS failures"
        for name, source, column in tables
    )


ORDER_COLUMNS = """
    order_id, customer_id, order_status, order_timestamp, payment_method, payment_installments,
    r(subtotal_usd + total_freight_usd + if(order_id % 50 = 7, 0.01::double, 0), 2)
        AS payment_amount_usd, destination_district,
    destination_lat, destination_lon, address_text, item_count,
    r(subtotal_usd, 2) AS subtotal_usd, total_freight_usd
"""

DELIVERY_COLUMNS = """
    route_id, driver_id, vehicle_type, destination_lat, destination_lon,
    distance_from_prev_km, h3_cell_9, grid_cell_id, dispatched_at, estimated_arrival_at,
    actual_arrival_at, delivery_status, traffic_zone, has_hem_access, weather_condition
"""

STOP_NUMBER = "row_number() OVER (PARTITION BY route_id ORDER BY order_id) AS stop_number"

ZONE_LOOKUP = _with(
    BASE,
    MART_H3,
    ZONE_MAP,
    LOOKUP,
    select="""
    SELECT h3_cell_9, dominant_district, avg_delay_minutes, total_margin_gap_usd,
           total_deliveries, failure_rate_pct, status, avg_delay_minutes > 15 AS is_slow,
           CASE WHEN total_margin_gap_usd > 0 THEN 'Loss' ELSE 'Profit' END AS gap_class,
           failure_rate_pct > 10 AS fails_often
    FROM zone_map JOIN picked USING (h3_cell_9)
    """,
)

ORACLE: dict[str, str] = {
    "src_dimension_profile": _with(
        DISTRICTS,
        select="""
        SELECT 'customers' AS table_name, count(*) AS n_rows, count(DISTINCT c_custkey) AS n_ids,
               count(DISTINCT c_mktsegment) AS n_categories, NULL::double AS number_sum
        FROM customer
        UNION ALL
        SELECT 'products', count(*), count(DISTINCT p_partkey), count(DISTINCT p_type),
               r(sum(p_retailprice), 2) FROM part
        UNION ALL
        SELECT 'sellers', count(*), count(DISTINCT s_suppkey), count(DISTINCT district),
               r(sum((lat0 + (s_suppkey * 7919) % 6001 - 3000)::double / 1000000.0::double), 2)
        FROM supplier JOIN districts ON d = s_nationkey % 11
        """,
    ),
    "src_ndjson_roundtrip": _with(
        BASE, select=f"SELECT order_id::varchar AS order_id, {DELIVERY_COLUMNS} FROM deliveries"
    ),
    "row_count_audit": _with(
        BASE,
        select="""
        SELECT 'raw_customers' AS table_name, count(*) AS n_rows FROM customer
        UNION ALL SELECT 'raw_products', count(*) FROM part
        UNION ALL SELECT 'raw_sellers', count(*) FROM supplier
        UNION ALL SELECT 'raw_orders', count(*) FROM staged_orders
        UNION ALL SELECT 'raw_deliveries', count(*) FROM deliveries
        """,
    ),
    "cl_benchmark": """
        SELECT method, count(*) AS n_rows, true AS took_time, true AS is_consistent
        FROM orders JOIN customer ON o_custkey = c_custkey, (VALUES ('H3'), ('Grid')) methods(method)
        GROUP BY method
    """,
    "stg_customers": _with(
        DISTRICTS,
        select="""
        SELECT c_custkey::varchar AS customer_id, c_name AS customer_name,
               lpad(c_custkey::varchar, 10, '0') AS phone, c_mktsegment AS segment, district
        FROM customer JOIN districts ON d = c_nationkey % 11
        """,
    ),
    "stg_products": """
        SELECT p_partkey::varchar AS product_id, p_name AS product_name, p_type AS category,
               p_retailprice AS price_usd, (100 + (p_partkey * 37) % 4901)::double AS weight_g
        FROM part
    """,
    "stg_sellers": _with(
        DISTRICTS,
        select="""
        SELECT s_suppkey::varchar AS seller_id, s_name AS seller_name, district,
               (lat0 + (s_suppkey * 7919) % 6001 - 3000)::double / 1000000.0::double
                   AS warehouse_lat,
               (lon0 + (s_suppkey * 7919) % 6001 - 3000)::double / 1000000.0::double
                   AS warehouse_lon
        FROM supplier JOIN districts ON d = s_nationkey % 11
        """,
    ),
    "stg_orders": _with(BASE, select=f"SELECT {ORDER_COLUMNS} FROM staged_orders"),
    "stg_order_items": _with(
        BASE,
        select="""
        SELECT order_id, o_orderdate AS order_timestamp, product_id, seller_id, quantity,
               r(unit_price_usd, 6) AS unit_price_usd, freight_value_usd,
               r(quantity * unit_price_usd, 2) AS line_total_usd
        FROM items JOIN orders ON o_orderkey = order_id
        """,
    ),
    "stg_deliveries": _with(
        BASE, select=f"SELECT order_id, {STOP_NUMBER}, {DELIVERY_COLUMNS} FROM deliveries"
    ),
    "join_delivery_orders": _with(
        BASE,
        select="""
        SELECT d.order_id, d.vehicle_type, o.destination_district, o.total_freight_usd,
               o.payment_method
        FROM deliveries d LEFT JOIN staged_orders o ON d.order_id = o.order_id
        """,
    ),
    "int_delivery_metrics": _with(
        BASE,
        select=f"""
        SELECT order_id, route_id, driver_id, vehicle_type, {STOP_NUMBER}, destination_lat,
               destination_lon, h3_cell_9, grid_cell_id, delivery_status, traffic_zone,
               has_hem_access, distance_from_prev_km, destination_district, total_freight_usd,
               payment_method, delay_minutes, r(delay_cost_usd, 6) AS delay_cost_usd,
               r(margin_gap_usd, 6) AS margin_gap_usd, estimated_arrival_at, actual_arrival_at
        FROM metrics
        """,
    ),
    "route_schedule": _with(
        BASE,
        """
        legs AS (
            SELECT 'RT_' || strftime(date_trunc('month', o_orderdate), '%Y%m%d') || '_' || driver_id
                       AS route_id, k, o_orderdate, ((30 + h % 371) * 8) // 100 + 2 AS minutes
            FROM located),
        reached AS (
            SELECT route_id, k,
                   row_number() OVER (PARTITION BY route_id ORDER BY k) AS stop_number,
                   max(o_orderdate) OVER (PARTITION BY route_id) + INTERVAL 2 HOUR
                       AS dispatched_at,
                   sum(minutes) OVER (PARTITION BY route_id ORDER BY k)::bigint AS so_far
            FROM legs)
        """,
        select="""
        SELECT route_id, k AS order_id, stop_number, dispatched_at,
               dispatched_at + to_minutes(so_far) AS estimated_arrival_at
        FROM reached
        """,
    ),
    "mart_deliveries": _with(
        BASE,
        select="""
        SELECT order_id, destination_lat, destination_lon, destination_district, h3_cell_9,
               grid_cell_id, delay_minutes, r(delay_cost_usd, 6) AS delay_cost_usd,
               r(margin_gap_usd, 6) AS margin_gap_usd, delivery_status, vehicle_type,
               traffic_zone, has_hem_access, distance_from_prev_km
        FROM metrics
        """,
    ),
    "mart_kpis": _with(BASE, MART_KPIS, select="SELECT * FROM mart_kpis"),
    "mart_district": _with(BASE, MART_DISTRICT, select="SELECT * FROM mart_district"),
    "mart_h3": _with(BASE, MART_H3, select="SELECT * FROM mart_h3"),
    # The parent is the coarse centre among a cell and its six neighbours.
    "mart_h3_levels": _with(
        BASE,
        """
        placed AS (
            SELECT *, split_part(h3_cell_9, '_', 1)::bigint AS q0, split_part(h3_cell_9, '_', 2)::bigint AS r0 FROM metrics),
        around(a, b) AS (VALUES (0, 0), (1, 0), (-1, 0), (0, 1), (0, -1), (1, -1), (-1, 1)),
        first_level AS (
            SELECT p.*, (3 * (q0 + a) + r0 + b) // 7 AS q1, (2 * (r0 + b) - q0 - a) // 7 AS r1
            FROM placed p JOIN around ON (3 * (q0 + a) + r0 + b) % 7 = 0),
        second_level AS (
            SELECT p.*, (3 * (q1 + a) + r1 + b) // 7 AS q2, (2 * (r1 + b) - q1 - a) // 7 AS r2
            FROM first_level p JOIN around ON (3 * (q1 + a) + r1 + b) % 7 = 0),
        leveled AS (
            SELECT 0 AS level, q0 || '_' || r0 AS cell, q0 AS mq, r0 AS mr, * FROM second_level
            UNION ALL
            SELECT 1, q1 || '_' || r1, 2 * q1 - r1, q1 + 3 * r1, * FROM second_level
            UNION ALL
            SELECT 2, q2 || '_' || r2, 2 * (2 * q2 - r2) - (q2 + 3 * r2), (2 * q2 - r2) + 3 * (q2 + 3 * r2), * FROM second_level),
        modes AS (
            SELECT level, cell,
                   (SELECT x FROM (SELECT unnest(list(traffic_zone)) AS x) WHERE x IS NOT NULL
                    GROUP BY x ORDER BY count(*) DESC, x LIMIT 1) AS dominant_traffic_zone,
                   (SELECT x FROM (SELECT unnest(list(destination_district)) AS x) WHERE x IS NOT NULL
                    GROUP BY x ORDER BY count(*) DESC, x LIMIT 1) AS dominant_district
            FROM leveled GROUP BY level, cell)
        """,
        select="""
        SELECT level, cell, count(DISTINCT h3_cell_9) AS finest_cells,
               r(any_value(0.20132061220131367 * 1.5 * mr / 111.19492664455873), 6) AS centre_lat,
               r(any_value(0.20132061220131367 * sqrt(3.0) * (mq + mr / 2.0::double) / 109.23625344213714), 6) AS centre_lon,
               count(*) AS total_deliveries, r(avg(delay_minutes), 1) AS avg_delay_minutes,
               r(sum(delay_cost_usd::decimal(18,9)), 2) AS total_delay_cost_usd,
               r(sum(margin_gap_usd::decimal(18,9)), 2) AS total_margin_gap_usd,
               r(sum(margin_gap_usd::decimal(18,9))::double / count(margin_gap_usd), 2) AS avg_margin_gap_usd,
               r(100::double * sum(failed) / count(*), 1) AS failure_rate_pct,
               r(100::double * sum(hem) / count(*), 1) AS hem_access_pct,
               count(DISTINCT driver_id) AS unique_drivers, sum(delay_minutes - 15) > 0 AS is_hotspot,
               any_value(dominant_traffic_zone) AS dominant_traffic_zone, any_value(dominant_district) AS dominant_district
        FROM leveled JOIN modes USING (level, cell) GROUP BY level, cell
        """,
    ),
    "mart_grid": _with(
        BASE,
        ZONES,
        select="""
        SELECT cell AS grid_cell_id, r(south + 0.005, 4) AS cell_lat_center,
               r(west + 0.005, 4) AS cell_lon_center, * EXCLUDE (method, cell, south, west)
        FROM zone_totals LEFT JOIN dominant_traffic_zone USING (method, cell)
        WHERE method = 'Grid'
        """,
    ),
    "mart_spatial_comparison": _with(BASE, PLACED, select=COMPARISON),
    "mart_spatial_comparison_cost": _with(
        BASE,
        PLACED,
        select=COMPARISON.replace(
            "NULL::double AS cl_us_per_row", "if(method = 'H3', 3.31, 0.07)::double AS cl_us_per_row"
        ),
    ),
    "stored_mart_h3": _with(BASE, MART_H3, select="SELECT * FROM mart_h3"),
    "stored_mart_kpis": _with(BASE, MART_KPIS, select="SELECT * FROM mart_kpis"),
    "stored_tables": _with(
        BASE,
        ZONES,
        select="""
        SELECT 'raw_customers' AS table_name, count(*) AS n_rows FROM customer
        UNION ALL SELECT 'raw_products', count(*) FROM part
        UNION ALL SELECT 'raw_sellers', count(*) FROM supplier
        UNION ALL SELECT 'raw_orders', count(*) FROM staged_orders
        UNION ALL SELECT 'raw_deliveries', count(*) FROM deliveries
        UNION ALL SELECT 'raw_cl_benchmarks', 2
        UNION ALL SELECT 'int_delivery_metrics', count(*) FROM metrics
        UNION ALL SELECT 'mart_deliveries', count(*) FROM metrics
        UNION ALL SELECT 'mart_kpis', 1
        UNION ALL SELECT 'mart_district', count(DISTINCT destination_district) FROM metrics
        UNION ALL SELECT 'mart_h3', count(*) FROM zone_totals WHERE method = 'H3'
        UNION ALL SELECT 'mart_grid', count(*) FROM zone_totals WHERE method = 'Grid'
        UNION ALL SELECT 'mart_spatial_comparison', 2
        """,
    ),
    "stored_order_items": _with(
        BASE,
        select="""
        SELECT order_id::varchar AS order_id, o_orderdate AS order_timestamp,
               product_id::varchar AS product_id, seller_id::varchar AS seller_id, quantity,
               r(unit_price_usd, 6) AS unit_price_usd, freight_value_usd,
               r(quantity * unit_price_usd, 2) AS line_total_usd
        FROM items JOIN orders ON o_orderkey = order_id
        """,
    ),
    "agg_filtered_pct": _with(
        BASE,
        select="""
        SELECT h3_cell_9, count(*) AS deliveries, sum(failed)::bigint AS failed,
               r(100::double * sum(failed) / count(*), 1) AS failure_rate_pct
        FROM metrics GROUP BY h3_cell_9 HAVING h3_cell_9 IS NOT NULL
        """,
    ),
    "agg_distinct_drivers": _with(
        BASE,
        select="""
        SELECT grid_cell_id, count(*) AS n_driver_id
        FROM (SELECT DISTINCT grid_cell_id, driver_id FROM deliveries)
        WHERE grid_cell_id IS NOT NULL GROUP BY grid_cell_id
        """,
    ),
    "agg_mode_zone": _with(
        BASE,
        ZONED,
        _mode("mode_traffic_zone", "traffic_zone"),
        select="""
        SELECT cell AS h3_cell_9, mode_traffic_zone FROM mode_traffic_zone WHERE method = 'H3'
        """,
    ),
    "cell_stats": _with(
        BASE,
        PLACED,
        select="""
        SELECT method, cell, n AS deliveries, r(zone_delay, 4) AS avg_delay,
               r(zone_spread, 4) AS stddev_delay, r(gap, 2) AS cell_margin_gap,
               late_rows AS delayed_count, hot AS is_hotspot
        FROM (SELECT *, sum(margin_gap_usd::decimal(18,9)) OVER (PARTITION BY method, cell) AS gap,
                     (sum(late) OVER (PARTITION BY method, cell))::bigint AS late_rows
              FROM placed)
        WHERE is_first
        """,
    ),
    "fleet_totals": _with(
        BASE,
        select="""
        SELECT count(*) AS total_deliveries, sum(late)::bigint AS total_delayed,
               r(sum(margin_gap_usd::decimal(18,9)), 2) AS total_margin_gap
        FROM metrics
        """,
    ),
    "idx_grid": _with(
        BASE,
        select="SELECT order_id, destination_lat, destination_lon, grid_cell_id FROM deliveries",
    ),
    "idx_hex": _with(
        BASE,
        select="SELECT order_id, destination_lat, destination_lon, h3_cell_9 FROM deliveries",
    ),
    "hex_centroids": _with(
        BASE,
        PLACED,
        select="""
        SELECT cell AS h3_cell_9, r(zone_lat, 6) AS centroid_lat, r(zone_lon, 6) AS centroid_lon
        FROM placed WHERE is_first AND method = 'H3'
        """,
    ),
    "grid_centroids": _with(
        BASE,
        PLACED,
        select="""
        SELECT cell AS grid_cell_id, r(zone_lat, 6) AS centroid_lat, r(zone_lon, 6) AS centroid_lon
        FROM placed WHERE is_first AND method = 'Grid'
        """,
    ),
    "mdqe_hex": _with(
        BASE, PLACED, select="SELECT r(avg(km), 4) AS mdqe_km FROM placed WHERE method = 'H3'"
    ),
    "mdqe_grid": _with(
        BASE, PLACED, select="SELECT r(avg(km), 4) AS mdqe_km FROM placed WHERE method = 'Grid'"
    ),
    "sdc_measured": _with(
        BASE,
        """
        hexes AS (
            SELECT DISTINCT split_part(h3_cell_9, '_', 1)::int AS a,
                   split_part(h3_cell_9, '_', 2)::int AS b FROM deliveries),
        grids AS (
            SELECT DISTINCT split_part(grid_cell_id, '_', 1)::int AS a,
                   split_part(grid_cell_id, '_', 2)::int AS b FROM deliveries),
        hex_steps(x, y) AS (VALUES (1, 0), (-1, 0), (0, 1), (0, -1), (1, -1), (-1, 1)),
        grid_steps(x, y) AS (VALUES (1, 0), (-1, 0), (0, 1), (0, -1),
                                    (1, 1), (1, -1), (-1, 1), (-1, -1)),
        pairs AS (
            SELECT 'H3' AS method,
                   0.20132061220131367 * 1.5 * b / 111.19492664455873 AS lat1,
                   0.20132061220131367 * sqrt(3.0) * (a + b / 2.0::double)
                       / 109.23625344213714 AS lon1,
                   0.20132061220131367 * 1.5 * (b + y) / 111.19492664455873 AS lat2,
                   0.20132061220131367 * sqrt(3.0) * (a + x + (b + y) / 2.0::double)
                       / 109.23625344213714 AS lon2
            FROM hexes, hex_steps
            UNION ALL
            SELECT 'Grid', a * 0.01::double + 0.005::double, b * 0.01::double + 0.005::double,
                   (a + x) * 0.01::double + 0.005::double, (b + y) * 0.01::double + 0.005::double
            FROM grids, grid_steps)
        """,
        select=f"""
        SELECT method, count(*) AS neighbour_pairs, r(avg(km), 4) AS mean_distance_km,
               r(stddev_pop(km), 4) AS sdc_km
        FROM (SELECT method, {_chord_km('lat1', 'lon1', 'lat2', 'lon2')} AS km FROM pairs)
        GROUP BY method
        """,
    ),
    # A cell is inside if an odd number of sides lies east of its centre.
    "hex_cover": _with(
        BASE,
        CITY,
        LATTICE,
        """
        boxes AS (
            SELECT destination_district AS district, min(destination_lat) AS s, min(destination_lon) AS w,
                   max(destination_lat) AS n, max(destination_lon) AS e
            FROM metrics
            WHERE destination_district IS NOT NULL AND destination_lat BETWEEN 10.63::double AND 10.91::double
                AND destination_lon BETWEEN 106.56::double AND 106.81::double
            GROUP BY destination_district),
        sides AS (
            SELECT district, s + (n - s) * up1 AS lat1, w + (e - w) * right1 AS lon1,
                   s + (n - s) * up2 AS lat2, w + (e - w) * right2 AS lon2
            FROM boxes, (VALUES
                (0.0, 0.0, 0.0, 1.0), (0.0, 1.0, 1.0, 1.0), (1.0, 1.0, 0.5, 0.5), (0.5, 0.5, 1.0, 0.0), (1.0, 0.0, 0.0, 0.0),
                (0.125, 0.5, 0.25, 0.625), (0.25, 0.625, 0.375, 0.5), (0.375, 0.5, 0.25, 0.375), (0.25, 0.375, 0.125, 0.5)
            ) shape(up1, right1, up2, right2))
        """,
        select="""
        SELECT district, h3_cell_9, q, r_step AS r, r(centre_lat, 6) AS centre_lat, r(centre_lon, 6) AS centre_lon
        FROM lattice, sides
        WHERE (lat1 > centre_lat) <> (lat2 > centre_lat)
            AND centre_lon < lon1 + (centre_lat - lat1) / (lat2 - lat1) * (lon2 - lon1)
        GROUP BY ALL HAVING count(*) % 2 = 1
        """,
    ),
    "hex_lattice": _with(
        BASE,
        """
        bounds AS (
            SELECT min(destination_lat) AS south, min(destination_lon) AS west,
                   max(destination_lat) AS north, max(destination_lon) AS east
            FROM deliveries)
        """,
        LATTICE,
        select="""
        SELECT h3_cell_9, q, r_step AS r, r(centre_lat, 6) AS centre_lat,
               r(centre_lon, 6) AS centre_lon
        FROM lattice
        """,
    ),
    "feed_kpi_cards": _with(
        BASE,
        MART_KPIS,
        select="""
        SELECT total_deliveries, avg_delay_minutes, pct_severely_delayed,
               pct_severely_delayed > 50 AS mostly_late,
               at_risk_cost_usd::bigint AS at_risk_cost_usd,
               total_margin_gap_usd::bigint AS total_margin_gap_usd,
               CASE WHEN total_margin_gap_usd > 0 THEN 'Loss' ELSE 'Profit' END AS gap_class
        FROM mart_kpis
        """,
    ),
    "feed_district": _with(
        BASE,
        MART_DISTRICT,
        select="""
        SELECT *, CASE WHEN margin_gap_usd > 0 THEN 'Loss' ELSE 'Profit' END AS gap_class
        FROM mart_district ORDER BY avg_delay_minutes DESC, destination_district
        """,
    ),
    "feed_district_by_gap": _with(
        BASE,
        MART_DISTRICT,
        select="""
        SELECT *, CASE WHEN margin_gap_usd > 0 THEN 'Loss' ELSE 'Profit' END AS gap_class
        FROM mart_district ORDER BY margin_gap_usd DESC, destination_district
        """,
    ),
    "feed_h3_zones": _with(
        BASE,
        MART_H3,
        select="""
        SELECT h3_cell_9, avg_delay_minutes, total_deliveries, total_margin_gap_usd, is_hotspot,
               dominant_district, failure_rate_pct FROM mart_h3
        """,
    ),
    "feed_hotspots": _with(
        BASE,
        MART_H3,
        HOTSPOTS,
        """
        short(district, abbr) AS (VALUES
            ('Quận 1', 'Q1'), ('Quận 3', 'Q3'), ('Quận 4', 'Q4'), ('Quận 5', 'Q5'),
            ('Quận 7', 'Q7'), ('Quận 10', 'Q10'), ('Bình Thạnh', 'BTh'), ('Gò Vấp', 'GV'),
            ('Tân Bình', 'TB'), ('Thủ Đức', 'TĐ'), ('Bình Chánh', 'BC'))
        """,
        select="""
        SELECT hotspots.*, avg_delay_minutes > 60 AS is_severe,
               abbr || '·' || right(h3_cell_9, 4) AS zone_label
        FROM hotspots JOIN short USING (district)
        """,
    ),
    "feed_hotspot_table": _with(
        BASE,
        MART_H3,
        HOTSPOTS,
        select="""
        SELECT h3_cell_9 AS "H3 Cell", district AS "District", total_deliveries AS "Deliveries",
               avg_delay_minutes AS "Avg Delay (min)", total_margin_gap_usd AS "Margin Gap ($)",
               failure_rate_pct AS "Failure Rate (%)", dominant_traffic_zone AS "Traffic Zone",
               hem_access_pct AS "% Hem Access"
        FROM hotspots
        """,
    ),
    "feed_recommendation": _with(
        BASE,
        MART_H3,
        HOTSPOTS,
        """
        worst AS (
            SELECT * FROM hotspots ORDER BY avg_delay_minutes DESC, h3_cell_9 LIMIT 1)
        """,
        select="""
        SELECT count(*) AS n_zones,
               coalesce(r(sum(total_margin_gap_usd::decimal(18,9)), 2), 0) AS total_margin_gap_usd,
               abs(coalesce(r(sum(total_margin_gap_usd::decimal(18,9)), 2), 0)) AS recovery_usd,
               coalesce((SELECT left(h3_cell_9, 12) || '…' FROM worst), '—') AS worst_cell_label,
               coalesce((SELECT district FROM worst), '—') AS worst_district
        FROM hotspots
        """,
    ),
    "feed_zone_map": _with(BASE, MART_H3, ZONE_MAP, select="SELECT * FROM zone_map"),
    "feed_zone_kpis": _with(
        BASE,
        MART_H3,
        ZONE_MAP,
        select="""
        SELECT count(*) FILTER (WHERE is_hotspot) AS n_hotspots,
               coalesce(r(sum(total_margin_gap_usd::decimal(18,9)) FILTER (WHERE is_hotspot), 2), 0)
                   AS hotspot_gap_usd,
               coalesce(r(sum(avg_delay_minutes::decimal(18,9)) FILTER (WHERE is_hotspot AND has_data)::double
                          / count(*) FILTER (WHERE is_hotspot AND has_data), 4), 0)
                   AS hotspot_delay_minutes
        FROM zone_map
        """,
    ),
    "feed_zone_lookup": ZONE_LOOKUP,
    "stored_zone_lookup": ZONE_LOOKUP,
    "example_first_id": "SELECT c_custkey AS id FROM customer WHERE c_custkey = 1",
    "example_null_id": "SELECT c_custkey AS id FROM customer UNION ALL SELECT NULL",
    "dq_unique": _dq(
        "unique",
        "SELECT count(*) FROM (SELECT {column} FROM {source} WHERE {column} IS NOT NULL"
        " GROUP BY {column} HAVING count(*) > 1)",
    ),
    "dq_not_null": _dq("not_null", "SELECT count(*) FROM {source} WHERE {column} IS NULL"),
    # Carried numbers and arrivals with the same faults planted, looked at with plain windows over routes.
    "dq_route_sequence": _with(
        BASE,
        f"""
        numbered AS (
            SELECT route_id, k, o_orderdate, (30 + h % 371) * 8 // 100 + 2 AS minutes,
                   row_number() OVER (PARTITION BY route_id ORDER BY k) AS place,
                   max(o_orderdate) OVER (PARTITION BY route_id) + INTERVAL 2 HOUR AS planned_dispatch
            FROM (SELECT *, 'RT_' || strftime(date_trunc('month', o_orderdate), '%Y%m%d') || '_' || driver_id AS route_id FROM located)),
        carried AS (
            SELECT route_id, k, o_orderdate,
                   CASE WHEN k % 97 = 5 THEN NULL WHEN k % 89 = 3 THEN place + 1 ELSE place END AS stop_number,
                   planned_dispatch - if(k % 101 = 9, INTERVAL 3 DAY, INTERVAL 0 DAY) AS dispatched_at,
                   planned_dispatch + to_minutes(sum(minutes) OVER (PARTITION BY route_id ORDER BY k)::bigint)
                       - CASE WHEN k % 83 = 7 THEN INTERVAL 40 DAY WHEN k % 79 = 11 THEN INTERVAL 45 MINUTE
                              ELSE INTERVAL 0 DAY END AS estimated_arrival_at
            FROM numbered),
        looked AS (
            SELECT *, lag(stop_number) OVER stops AS number_before, lag(estimated_arrival_at) OVER stops AS arrival_before,
                   max(o_orderdate) OVER (PARTITION BY route_id) AS last_order
            FROM carried WINDOW stops AS (PARTITION BY route_id ORDER BY stop_number NULLS FIRST, k))
        """,
        select="""
        SELECT route_id, count(*) AS stops,
               coalesce(max(stop_number) - count(DISTINCT stop_number), 0) AS missing_numbers,
               (count(stop_number) - count(DISTINCT stop_number))::bigint AS doubled_numbers,
               count(*) FILTER (WHERE stop_number IS NULL) AS without_number,
               count(*) FILTER (WHERE estimated_arrival_at < dispatched_at) AS early_arrivals,
               count(*) FILTER (WHERE stop_number IS NOT NULL AND (number_before IS NULL OR stop_number - number_before > 1)) AS islands,
               count(*) FILTER (WHERE stop_number IS NOT NULL AND number_before IS NOT NULL AND estimated_arrival_at < arrival_before)
                   AS backward_arrivals,
               count(*) FILTER (WHERE dispatched_at < last_order) AS early_dispatches
        FROM looked GROUP BY route_id
        """,
    ),
    "dq_payment_reconciles": _with(
        BASE,
        f"checked AS (SELECT {ORDER_COLUMNS} FROM staged_orders)",
        "due AS (SELECT payment_amount_usd AS paid, r(subtotal_usd + total_freight_usd, 2) AS due"
        " FROM staged_orders JOIN (SELECT order_id, payment_amount_usd FROM checked)"
        " USING (order_id))",
        select="""
        SELECT count(*) AS orders, count(due) AS orders_with_items,
               count(*) FILTER (WHERE paid = due) AS reconciled,
               count(*) FILTER (WHERE due IS NOT NULL AND paid IS DISTINCT FROM due) AS failures
        FROM due
        """,
    ),
}
