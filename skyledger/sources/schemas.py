"""Raw feeds: names, delivered columns and the types they are read with.

Counts are read as doubles, since files written from frames with gaps hold ``45.0``; staging makes them ints.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import types as T

S, D, B, DATE, TS = T.StringType(), T.DoubleType(), T.BooleanType(), T.DateType(), T.TimestampNTZType()

RAW_COLUMNS: dict[str, dict[str, T.DataType]] = {
    "airports": {
        "airport_code": S,
        "airport_name": S,
        "city": S,
        "country": S,
        "timezone": S,
        "latitude": D,
        "longitude": D,
    },
    "routes": {
        "route_id": S,
        "origin_airport_code": S,
        "destination_airport_code": S,
        "route_type": S,
        "distance_km": D,
        "block_time_min": D,
    },
    "customers": {
        "customer_id": S,
        "first_name": S,
        "last_name": S,
        "gender": S,
        "birth_date": DATE,
        "country": S,
        "city": S,
        "segment": S,
        "loyalty_tier": S,
        "signup_date": DATE,
        "preferred_channel": S,
        "preferred_cabin": S,
        "loyalty_member": B,
        "age": D,
    },
    "flights": {
        "flight_id": S,
        "flight_number": S,
        "route_id": S,
        "flight_date": DATE,
        "scheduled_departure": TS,
        "scheduled_arrival": TS,
        "actual_departure": TS,
        "actual_arrival": TS,
        "aircraft_type": S,
        "seat_capacity": D,
        "flight_status": S,
        "delay_minutes": D,
        "is_delayed": B,
        "is_cancelled": B,
        "route_type": S,
        "distance_km": D,
        "pax_boarded": D,
        "load_factor": D,
        "total_revenue_usd": D,
        "op_cost_usd": D,
        "fuel_cost_usd": D,
    },
    "bookings": {
        "booking_id": S,
        "flight_id": S,
        "customer_id": S,
        "booking_date": DATE,
        "booking_channel": S,
        "fare_class": S,
        "fare_family": S,
        "ticket_price_usd": D,
        "ancillary_revenue_usd": D,
        "bags_count": D,
        "seat_selection_flag": B,
        "booking_status": S,
    },
    "customer_reviews": {
        "review_id": S,
        "booking_id": S,
        "customer_id": S,
        "flight_id": S,
        "review_date": DATE,
        "rating": D,
        "review_text": S,
        "sentiment_score": D,
        "sentiment_label": S,
        "cabin": S,
    },
    "support_tickets": {
        "ticket_id": S,
        "customer_id": S,
        "flight_id": S,
        "category": S,
        "ticket_text": S,
        "sentiment_score": D,
        "sentiment_label": S,
        "severity": S,
        "status": S,
        "created_at": DATE,
        "resolution_days": D,
    },
    "loyalty_activity": {
        "loyalty_id": S,
        "customer_id": S,
        "booking_id": S,
        "transaction_date": DATE,
        "miles_earned": D,
        "miles_redeemed": D,
        "activity_type": S,
    },
}

RAW_TABLES = tuple(RAW_COLUMNS)


def read_schema(table: str, header: list[str], as_text: Collection[str] = ()) -> T.StructType:
    """Schema for a file with this header: declared types by column name, text for others and where asked for."""
    declared = {n: t for n, t in RAW_COLUMNS.get(table, {}).items() if n not in as_text}
    return T.StructType([T.StructField(name, declared.get(name, S)) for name in header])
