"""Per-route metrics: operations, revenue, satisfaction and support tickets.

Bookings, reviews and tickets know their flight, not their route. Each feed is first reduced to one row per
flight, combining on the map side, and only those rows are joined to the flights. A flight holding a large part
of a feed therefore costs one row per task, and the join never moves single bookings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.frames import zero_if_null
from ..functions.numeric import exact_mean, exact_sum, ratio, round_half_away
from ..functions.rules import stamped

OPERATIONS = (
    "total_flights",
    "operated_flights",
    "total_pax",
    "avg_load_factor",
    "avg_delay_min",
    "delay_rate",
    "cancellation_rate",
)
REVENUE = ("total_revenue", "total_ancillary")
SENTIMENT = ("avg_sentiment", "avg_rating", "review_count", "promoters", "detractors")
TICKETS = ("ticket_count", "delay_tickets", "baggage_tickets", "service_tickets")


def _route_measures() -> dict[str, Column]:
    """Every measure of a route, over flights that carry the per-flight columns the measure needs."""
    flown, delayed = ~F.col("is_cancelled"), F.col("is_delayed")
    flights = F.count(F.lit(1))
    return {
        "total_flights": flights,
        "operated_flights": F.count_if(flown),
        "total_pax": F.sum(F.when(flown, F.col("pax_boarded")).otherwise(0)),
        "avg_load_factor": exact_mean(F.when(flown, F.col("load_factor"))),
        "avg_delay_min": F.avg(F.when(delayed, F.col("delay_minutes"))),
        "delay_rate": ratio(F.count_if(delayed), flights),
        "cancellation_rate": ratio(F.count_if("is_cancelled"), flights),
        "total_revenue": exact_sum(F.col("flight_fares")),
        "total_ancillary": exact_sum(F.col("flight_ancillaries")),
        "avg_sentiment": ratio(exact_sum(F.col("sentiment_sum")), F.sum("sentiment_values")),
        "avg_rating": ratio(F.sum("rating_sum"), F.sum("rating_values")),
        "review_count": F.sum("flight_reviews"),
        "promoters": F.sum("flight_promoters"),
        "detractors": F.sum("flight_detractors"),
        "ticket_count": F.sum("flight_tickets"),
        "delay_tickets": F.sum("flight_delay_tickets"),
        "baggage_tickets": F.sum("flight_baggage_tickets"),
        "service_tickets": F.sum("flight_service_tickets"),
    }


def _per_route(flights: DataFrame, measures: tuple[str, ...]) -> DataFrame:
    known = _route_measures()
    return flights.groupBy("route_id").agg(*[known[m].alias(m) for m in measures])


def _bookings_per_flight(bookings: DataFrame) -> DataFrame:
    return bookings.groupBy("flight_id").agg(
        exact_sum(F.col("fare_paid_usd")).alias("flight_fares"),
        exact_sum(F.col("ancillary_revenue_usd")).alias("flight_ancillaries"),
    )


def _reviews_per_flight(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("flight_id").agg(
        exact_sum(F.col("sentiment_score")).alias("sentiment_sum"),
        F.count("sentiment_score").alias("sentiment_values"),
        F.sum("rating").alias("rating_sum"),
        F.count("rating").alias("rating_values"),
        F.count("review_id").alias("flight_reviews"),
        F.count_if(F.col("nps_category") == "promoter").alias("flight_promoters"),
        F.count_if(F.col("nps_category") == "detractor").alias("flight_detractors"),
    )


def _tickets_per_flight(tickets: DataFrame) -> DataFrame:
    category = F.col("category")
    return tickets.groupBy("flight_id").agg(
        F.count("ticket_id").alias("flight_tickets"),
        F.count_if(category == "delay").alias("flight_delay_tickets"),
        F.count_if(category == "baggage").alias("flight_baggage_tickets"),
        F.count_if(category == "service").alias("flight_service_tickets"),
    )


def route_ops(flights: DataFrame) -> DataFrame:
    """Per route: flights, operated flights, passengers, load, delay and cancellation rates."""
    return _per_route(flights, OPERATIONS)


def route_revenue(bookings: DataFrame, flights: DataFrame) -> DataFrame:
    """Per route: fares and ancillaries of the bookings on its flights, cancelled bookings included."""
    legs = flights.select("flight_id", "route_id")
    return _per_route(legs.join(_bookings_per_flight(bookings), "flight_id"), REVENUE)


def route_sentiment(reviews: DataFrame, flights: DataFrame) -> DataFrame:
    """Per route: mean sentiment and rating, review count, promoters and detractors."""
    legs = flights.select("flight_id", "route_id")
    return _per_route(legs.join(_reviews_per_flight(reviews), "flight_id"), SENTIMENT)


def route_tickets(tickets: DataFrame, flights: DataFrame) -> DataFrame:
    """Per route: support tickets in total and for delay, baggage and service."""
    legs = flights.select("flight_id", "route_id")
    return _per_route(legs.join(_tickets_per_flight(tickets), "flight_id"), TICKETS)


def int_route_metrics(
    flights: DataFrame, routes: DataFrame, bookings: DataFrame, reviews: DataFrame, tickets: DataFrame
) -> DataFrame:
    """One row per known route that has flights: revenue, flat-share cost and margin, yield, rates, NPS, tickets.

    The flights are read and shuffled once: the three per-flight reductions are already partitioned by flight,
    so all joins share that partitioning, and one aggregate gives every route measure.
    """
    activity = (
        flights.select(
            "flight_id", "route_id", "is_cancelled", "is_delayed", "pax_boarded", "load_factor", "delay_minutes"
        )
        .join(_bookings_per_flight(bookings), "flight_id", "left")
        .join(_reviews_per_flight(reviews), "flight_id", "left")
        .join(_tickets_per_flight(tickets), "flight_id", "left")
    )
    counted = ["total_revenue", "total_ancillary", "review_count", "promoters", "detractors", *TICKETS]
    per_route = zero_if_null(_per_route(activity, OPERATIONS + REVENUE + SENTIMENT + TICKETS), counted)
    labels = routes.select("route_id", "origin", "destination", "route_type", "distance_km", "is_strategic")
    revenue = F.col("total_revenue")
    margin = revenue * V.ROUTE_MARGIN_SHARE
    voters = F.col("promoters") + F.col("detractors")
    nps = ratio((F.col("promoters") - F.col("detractors")) * 100.0, voters)
    return per_route.join(labels, "route_id").select(
        "route_id",
        "origin",
        "destination",
        "route_type",
        "distance_km",
        "is_strategic",
        "total_flights",
        "operated_flights",
        "total_pax",
        round_half_away(revenue, 2).alias("total_revenue_usd"),
        round_half_away(F.col("total_ancillary"), 2).alias("total_ancillary_usd"),
        round_half_away(revenue * V.ROUTE_COST_SHARE, 2).alias("total_op_cost_usd"),
        round_half_away(margin, 2).alias("gross_margin_usd"),
        round_half_away(F.col("avg_load_factor"), 4).alias("avg_load_factor"),
        round_half_away(F.col("delay_rate"), 4).alias("delay_rate"),
        round_half_away(F.col("cancellation_rate"), 4).alias("cancellation_rate"),
        round_half_away(F.col("avg_delay_min"), 1).alias("avg_delay_minutes"),
        round_half_away(ratio(revenue, F.col("total_pax")), 2).alias("yield_per_pax_usd"),
        round_half_away(ratio(margin, F.col("operated_flights")), 2).alias("margin_per_flight_usd"),
        round_half_away(F.col("avg_sentiment"), 4).alias("avg_sentiment"),
        round_half_away(F.col("avg_rating"), 2).alias("avg_rating"),
        "review_count",
        round_half_away(nps, 1).alias("nps_proxy"),
        *TICKETS,
    )


def mart_route_performance(metrics: DataFrame, run_ts=None) -> DataFrame:
    """Route metrics for reporting; rates become percentages of the already rounded rates."""

    def percent(name: str) -> Column:
        return round_half_away(F.col(name) * 100.0, 1)

    return stamped(
        metrics.select(
            "route_id",
            "origin",
            "destination",
            "route_type",
            "distance_km",
            "is_strategic",
            "total_flights",
            "operated_flights",
            "total_pax",
            "total_revenue_usd",
            "total_op_cost_usd",
            "gross_margin_usd",
            "yield_per_pax_usd",
            "margin_per_flight_usd",
            percent("avg_load_factor").alias("load_factor_pct"),
            percent("delay_rate").alias("delay_rate_pct"),
            percent("cancellation_rate").alias("cancellation_rate_pct"),
            "avg_delay_minutes",
            "avg_sentiment",
            "avg_rating",
            "nps_proxy",
            "review_count",
            *TICKETS,
        ),
        run_ts,
    )
