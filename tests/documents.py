"""A few nested documents with the edge cases the models must handle."""

ITEM = {
    "product_id": "p1",
    "seller_id": "s1",
    "quantity": 2,
    "unit_price_usd": 10.0,
    "freight_value_usd": 1.5,
}


def order(order_id, line_items, district="Quận 1", status="delivered"):
    items = line_items or []
    paid = sum((i["quantity"] * i["unit_price_usd"] + i["freight_value_usd"] for i in items), 0.0)
    return {
        "order_id": order_id,
        "customer_id": "c1",
        "order_status": status,
        "order_timestamp": "2024-05-01T08:30:00.123456",
        "payment": {"method": "momo", "installments": 3, "amount_usd": round(paid, 2)},
        "line_items": line_items,
        "shipping_snapshot": {
            "recipient_name": "Lan",
            "destination_district": district,
            "destination_lat": 10.7769,
            "destination_lon": 106.7009,
            "address_text": "12 Lê Lợi",
        },
    }


def delivery(order_id, estimated, actual, vehicle="van", lat=10.7769, lon=106.7009, **changes):
    document = {
        "order_id": order_id,
        "route_id": "RT_20240501_DRV_001",
        "driver_id": "DRV_001",
        "stop_number": 1,
        "vehicle_type": vehicle,
        "spatial_data": {
            "destination_lat": lat,
            "destination_lon": lon,
            "distance_from_prev_km": 1.25,
        },
        "telemetry": {
            "dispatched_at": "2024-05-01T10:00:00",
            "estimated_arrival_at": estimated,
            "actual_arrival_at": actual,
            "status": "delivered",
        },
        "complexity_factors": {
            "traffic_zone": "low",
            "has_hem_access": False,
            "weather_condition": "clear",
        },
    }
    return document | changes


ORDERS = [
    order("o1", [ITEM, ITEM | {"product_id": "p2", "quantity": 1, "unit_price_usd": 5.25}]),
    order("o2", [], district="Quận 3"),
    order("o3", None, district="Quận 3", status="cancelled"),
]

DELIVERIES = [
    delivery("o1", "2024-05-01T10:00:59", "2024-05-01T10:01:00"),
    delivery("o2", "2024-05-01T11:00:00", "2024-05-01T10:40:00", vehicle="motorbike"),
    delivery("o3", "2024-05-01T12:00:00", "2024-05-01T13:00:00", vehicle=None),
    delivery("lost", "2024-05-01T12:00:00", "2024-05-01T12:15:00"),
    delivery(None, "2024-05-01T12:00:00", "2024-05-01T12:30:00", lat=None),
]
