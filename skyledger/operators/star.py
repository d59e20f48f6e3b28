"""Star schema: three dimensions and two facts.

No broadcast hints: Spark broadcasts a dimension when its estimated or measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise runs a sort-merge join, where AQE splits hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.rules import band_below, flag, stamped


def dim_airports(airports: DataFrame, hub: str = V.HUB_AIRPORT, run_ts=None) -> DataFrame:
    """Airports straight from the raw feed, with the hub marked."""
    return stamped(
        airports.select(
            F.col("airport_code").alias("airport_id"),
            "airport_name",
            "city",
            "country",
            "timezone",
            F.col("latitude").cast("double").alias("latitude"),
            F.col("longitude").cast("double").alias("longitude"),
            flag(F.col("airport_code") == hub).alias("is_hub"),
        ),
        run_ts,
    )


def dim_customers(customers: DataFrame, run_ts=None) -> DataFrame:
    """Customer labels from staged customers."""
    return stamped(
        customers.select(
            "customer_id",
            "first_name",
            "last_name",
            "gender",
            "age",
            "age_group",
            "country",
            "city",
            "segment",
            "loyalty_member",
            "loyalty_tier",
            F.coalesce("loyalty_tier", F.lit(V.NO_TIER)).alias("loyalty_tier_clean"),
            "preferred_cabin",
            "preferred_channel",
            "birth_date",
            "signup_date",
        ),
        run_ts,
    )


def dim_routes(routes: DataFrame, run_ts=None) -> DataFrame:
    """Route labels and distance category from staged routes."""
    return stamped(
        routes.select(
            "*",
            F.concat("origin", F.lit(V.ROUTE_ARROW), "destination").alias("route_label"),
            band_below(F.col("distance_km"), V.DISTANCE_BANDS, V.DISTANCE_REST).alias("distance_category"),
        ),
        run_ts,
    )


def fact_bookings(bookings: DataFrame, flights: DataFrame, run_ts=None) -> DataFrame:
    """One row per staged booking with the attributes of its flight, NULL where the flight is unknown."""
    flight_attributes = flights.select(
        "flight_id", "route_id", "flight_date", "flight_year", "flight_month_num", "route_type", "aircraft_type"
    )
    return stamped(
        bookings.join(flight_attributes, "flight_id", "left").select(
            "booking_id",
            "customer_id",
            "flight_id",
            "route_id",
            F.col("fare_family").alias("fare_family_id"),
            "booking_date",
            "flight_date",
            "flight_year",
            "flight_month_num",
            "fare_paid_usd",
            "ancillary_revenue_usd",
            (F.col("fare_paid_usd") + F.col("ancillary_revenue_usd")).alias("total_revenue_usd"),
            "cabin",
            "channel",
            "fare_class",
            "fare_family",
            "bags_count",
            "seat_selected",
            "booking_status",
            "is_cancelled",
            "route_type",
            "aircraft_type",
        ),
        run_ts,
    )


def fact_flights(flights: DataFrame, routes: DataFrame, run_ts=None) -> DataFrame:
    """One row per staged flight with its route's end points, NULL where the route is unknown."""
    ends = routes.select("route_id", "origin", "destination", "is_strategic")
    return stamped(
        flights.join(ends, "route_id", "left").select(
            "flight_id",
            "route_id",
            "flight_date",
            "flight_year",
            "flight_month_num",
            "scheduled_departure",
            "scheduled_arrival",
            "actual_departure",
            "actual_arrival",
            "aircraft_type",
            "seat_capacity",
            "pax_boarded",
            "load_factor",
            "delay_minutes",
            "total_revenue_usd",
            "op_cost_usd",
            "fuel_cost_usd",
            "gross_margin_usd",
            "flight_status",
            "is_delayed",
            "is_cancelled",
            "delay_category",
            "route_type",
            "distance_km",
            "origin",
            "destination",
            "is_strategic",
        ),
        run_ts,
    )
