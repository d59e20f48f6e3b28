"""Small raw feeds holding the edge rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

from skyledger.sources.schemas import RAW_COLUMNS

D = dt.date
AS_OF = "2024-12-31"


def feed(spark, table, rows):
    """A raw feed from partial rows; columns not given are NULL."""
    columns = RAW_COLUMNS[table]
    schema = T.StructType([T.StructField(c, t) for c, t in columns.items()])
    return spark.createDataFrame([tuple(row.get(c) for c in columns) for row in rows], schema)


ROUTES = [
    {"route_id": "R1", "origin_airport_code": "ABJ", "destination_airport_code": "CDG", "route_type": "International",
     "distance_km": 4880.0, "block_time_min": 390.0},
    {"route_id": "R2", "origin_airport_code": "ABJ", "destination_airport_code": None, "route_type": "Domestic",
     "distance_km": 499.0, "block_time_min": 50.0},
    {"route_id": "R3", "origin_airport_code": "ABJ", "destination_airport_code": "DKR", "route_type": None,
     "distance_km": 500.0, "block_time_min": 130.0},
    {"route_id": "R4", "origin_airport_code": "ABJ", "destination_airport_code": "LOS", "route_type": "longhaul",
     "distance_km": 2000.0, "block_time_min": 95.0},
    {"route_id": None, "origin_airport_code": "ABJ"},
]


def _flight(key, route, delay=0.0, delayed=False, cancelled=False, pax=100.0, load=0.8):
    return {
        "flight_id": key, "route_id": route, "flight_date": D(2024, 5, 17), "seat_capacity": 120.0,
        "delay_minutes": delay, "is_delayed": delayed, "is_cancelled": cancelled, "pax_boarded": pax,
        "load_factor": load, "total_revenue_usd": 1000.0, "op_cost_usd": 650.0, "route_type": "Regional",
        "aircraft_type": "A320",
    }


FLIGHTS = [
    _flight("F1", "R1", 20.0, delayed=True),
    _flight("F2", "R1", None, cancelled=True),
    _flight("F3", "R1", 180.0, delayed=None, cancelled=None),
    _flight("F4", "R2", 14.0, pax=0.0, load=0.75),
    _flight("F5", "R3", 60.0, delayed=True),
    _flight("F6", "R9"),
    _flight("F7", None),
    _flight(None, "R1"),
]


def _booking(key, customer, flight, price, extra=0.0, day=D(2024, 6, 1), fare_class="Economy", status="Confirmed"):
    return {
        "booking_id": key, "customer_id": customer, "flight_id": flight, "ticket_price_usd": price,
        "ancillary_revenue_usd": extra, "booking_date": day, "fare_class": fare_class, "booking_status": status,
        "fare_family": "Flex", "bags_count": 1.0,
    }


BOOKINGS = [
    _booking("B1", "C1", "F1", 100.0, 10.0, fare_class="Business"),
    _booking("B2", "C1", "F1", 50.5, 0.0, day=D(2024, 3, 30)),
    _booking("B2", "C1", "F2", 50.5, 5.0, day=D(2024, 3, 31), status="Cancelled"),
    _booking("B3", "C2", "F9", 80.0, 8.0, day=D(2023, 1, 1)),
    _booking("B4", "C2", None, 20.0, 2.0, day=D(2023, 1, 2)),
    _booking("B5", "C3", "F4", 0.0, 7.0),
    _booking("B6", None, "F5", 30.0, 3.0, status=None),
    _booking(None, "C1", "F1", 999.0, 9.0),
]

CUSTOMERS = [
    {"customer_id": "C1", "first_name": "Awa", "last_name": "Koné", "segment": "Business", "loyalty_tier": "Gold",
     "loyalty_member": True, "age": 17.0, "country": "Ghana"},
    {"customer_id": "C2", "first_name": None, "last_name": "Diallo", "segment": "Budget", "loyalty_member": False,
     "age": 25.0, "country": "Benin"},
    {"customer_id": "C3", "first_name": "Jo", "last_name": "Sow", "segment": "Budget", "loyalty_tier": "Silver",
     "loyalty_member": True, "age": 55.0, "country": "Benin"},
    {"customer_id": "C4", "first_name": "Al", "last_name": "Ba", "segment": "Premium", "loyalty_member": None,
     "age": None, "country": "Senegal"},
    {"customer_id": None, "first_name": "No", "last_name": "Key"},
]

REVIEWS = [
    {"review_id": "V1", "customer_id": "C1", "flight_id": "F1", "rating": 2.0, "sentiment_score": -0.15},
    {"review_id": "V2", "customer_id": "C1", "flight_id": "F1", "rating": 1.0, "sentiment_score": 0.5},
    {"review_id": "V3", "customer_id": "C2", "flight_id": "F4", "rating": 3.0, "sentiment_score": None},
    {"review_id": "V4", "customer_id": "C2", "flight_id": "F1", "rating": 5.0, "sentiment_score": 1.0},
    {"review_id": "V5", "customer_id": "C3", "flight_id": "F4", "rating": None, "sentiment_score": 0.1},
    {"review_id": None, "customer_id": "C1", "flight_id": "F1", "rating": 5.0, "sentiment_score": 1.0},
]

TICKETS = [
    {"ticket_id": "T1", "customer_id": "C1", "flight_id": "F1", "category": "delay", "status": "open"},
    {"ticket_id": "T2", "customer_id": "C1", "flight_id": "F1", "category": "baggage", "status": "in_progress"},
    {"ticket_id": "T3", "customer_id": "C2", "flight_id": "F1", "category": "refund", "status": "open"},
    {"ticket_id": "T4", "customer_id": "C2", "flight_id": "F5", "category": "service", "status": None},
    {"ticket_id": "T5", "customer_id": "C2", "flight_id": "F404", "category": "service", "status": "closed"},
]

LOYALTY = [
    {"loyalty_id": "L1", "customer_id": "C1", "booking_id": "B1", "miles_earned": 500.0, "miles_redeemed": 0.0},
    {"loyalty_id": "L2", "customer_id": "C1", "booking_id": "B2", "miles_earned": 250.0, "miles_redeemed": 125.0},
    {"loyalty_id": "L3", "customer_id": "C3", "booking_id": "B5", "miles_earned": 10.0, "miles_redeemed": None},
]

AIRPORTS = [
    {"airport_code": "ABJ", "airport_name": "Hub Airport", "latitude": 5.26, "longitude": -3.93},
    {"airport_code": "CDG", "airport_name": "Far Airport", "latitude": 49.0, "longitude": 2.55},
    {"airport_code": None},
]

RAW = {
    "airports": AIRPORTS,
    "routes": ROUTES,
    "customers": CUSTOMERS,
    "flights": FLIGHTS,
    "bookings": BOOKINGS,
    "customer_reviews": REVIEWS,
    "support_tickets": TICKETS,
    "loyalty_activity": LOYALTY,
}


def raw_feeds(spark):
    return {name: feed(spark, name, rows) for name, rows in RAW.items()}
