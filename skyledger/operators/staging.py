"""Typed cleaning of the raw feeds: one narrow, shuffle-free projection per feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.numeric import to_int
from ..functions.rules import band_below, band_from, flag, nps_group


def _number(name: str):
    return F.col(name).cast("double")


def _date(name: str):
    return F.col(name).cast("date").alias(name)


def _int(name: str):
    return to_int(F.col(name)).alias(name)


def stg_bookings(bookings: DataFrame) -> DataFrame:
    """Bookings with typed money, dates and flags, the cabin and whether the booking was cancelled."""
    return bookings.filter(F.col("booking_id").isNotNull()).select(
        "booking_id",
        "flight_id",
        "customer_id",
        _date("booking_date"),
        F.col("booking_channel").alias("channel"),
        "fare_class",
        "fare_family",
        _number("ticket_price_usd").alias("fare_paid_usd"),
        _number("ancillary_revenue_usd").alias("ancillary_revenue_usd"),
        _int("bags_count"),
        F.col("seat_selection_flag").cast("boolean").alias("seat_selected"),
        "booking_status",
        F.when(F.col("fare_class") == V.BUSINESS_FARE_CLASS, "business").otherwise("economy").alias("cabin"),
        flag(F.col("booking_status") == V.CANCELLED_STATUS).alias("is_cancelled"),
    )


def stg_customers(customers: DataFrame) -> DataFrame:
    """Customers with typed dates and flags and an age group; the group looks at the age as delivered."""
    return customers.filter(F.col("customer_id").isNotNull()).select(
        "customer_id",
        "first_name",
        "last_name",
        "gender",
        _date("birth_date"),
        "country",
        "city",
        "segment",
        "loyalty_tier",
        F.col("loyalty_member").cast("boolean").alias("loyalty_member"),
        _date("signup_date"),
        "preferred_channel",
        "preferred_cabin",
        _int("age"),
        band_below(_number("age"), V.AGE_BANDS, V.AGE_REST).alias("age_group"),
    )


def stg_flights(flights: DataFrame) -> DataFrame:
    """Flights with typed counts and money, a delay category, the margin, month and year."""
    revenue, cost = _number("total_revenue_usd"), _number("op_cost_usd")
    departed_on = F.col("flight_date").cast("date")
    return flights.filter(F.col("flight_id").isNotNull()).select(
        "flight_id",
        "flight_number",
        "route_id",
        departed_on.alias("flight_date"),
        "scheduled_departure",
        "scheduled_arrival",
        "actual_departure",
        "actual_arrival",
        "aircraft_type",
        _int("seat_capacity"),
        "flight_status",
        _int("delay_minutes"),
        F.col("is_delayed").cast("boolean").alias("is_delayed"),
        F.col("is_cancelled").cast("boolean").alias("is_cancelled"),
        "route_type",
        _int("distance_km"),
        _int("pax_boarded"),
        _number("load_factor").alias("load_factor"),
        revenue.alias("total_revenue_usd"),
        cost.alias("op_cost_usd"),
        _number("fuel_cost_usd").alias("fuel_cost_usd"),
        band_from(_number("delay_minutes"), V.DELAY_BANDS, V.DELAY_REST).alias("delay_category"),
        (revenue - cost).alias("gross_margin_usd"),
        F.month(departed_on).alias("flight_month_num"),
        F.year(departed_on).alias("flight_year"),
    )


def stg_loyalty(loyalty: DataFrame) -> DataFrame:
    """Loyalty movements with typed miles and their net."""
    return loyalty.filter(F.col("loyalty_id").isNotNull()).select(
        "loyalty_id",
        "customer_id",
        "booking_id",
        _date("transaction_date"),
        _int("miles_earned"),
        _int("miles_redeemed"),
        "activity_type",
        (to_int(F.col("miles_earned")) - to_int(F.col("miles_redeemed"))).alias("miles_net"),
    )


def stg_reviews(reviews: DataFrame) -> DataFrame:
    """Reviews with typed rating and sentiment and the NPS group."""
    return reviews.filter(F.col("review_id").isNotNull()).select(
        "review_id",
        "booking_id",
        "customer_id",
        "flight_id",
        _date("review_date"),
        _int("rating"),
        "review_text",
        _number("sentiment_score").alias("sentiment_score"),
        "sentiment_label",
        "cabin",
        nps_group(_number("rating")).alias("nps_category"),
    )


def stg_routes(routes: DataFrame) -> DataFrame:
    """Routes with typed distance and block time and whether the route is strategic."""
    return routes.filter(F.col("route_id").isNotNull()).select(
        "route_id",
        F.col("origin_airport_code").alias("origin"),
        F.col("destination_airport_code").alias("destination"),
        "route_type",
        _int("distance_km"),
        _int("block_time_min"),
        flag(F.col("route_type").isin(V.STRATEGIC_ROUTE_TYPES)).alias("is_strategic"),
    )


def stg_tickets(tickets: DataFrame) -> DataFrame:
    """Support tickets with typed sentiment, date and days, and whether the ticket is open."""
    return tickets.filter(F.col("ticket_id").isNotNull()).select(
        "ticket_id",
        "customer_id",
        "flight_id",
        "category",
        "ticket_text",
        _number("sentiment_score").alias("sentiment_score"),
        "sentiment_label",
        "severity",
        "status",
        _date("created_at"),
        _int("resolution_days"),
        flag(F.col("status").isin(V.OPEN_TICKET_STATUSES)).alias("is_open"),
    )
