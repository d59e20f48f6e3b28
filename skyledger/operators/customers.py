"""Per-customer metrics: value, loyalty, service, satisfaction and churn signals.

Every feed is reduced to one row per customer before it meets another one. The reductions combine on the map
side, so a customer holding a large part of a feed costs one row per task, and all of them end up
hash-partitioned by ``customer_id``, so the joins of :func:`int_customer_metrics` add no shuffle besides that
of the customers themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.frames import zero_if_null
from ..functions.numeric import exact_mean, exact_sum, ratio, round_half_away
from ..functions.rules import as_of_date, signal, stamped


def customer_revenue(bookings: DataFrame, as_of=None, apart: bool = False) -> DataFrame:
    """Per customer: distinct bookings and flights, fares, ancillaries, booking dates and recency counts.

    The bookings are read once. Spark lays each row out once for either distinct count and once for the sums, with the
    columns each needs, and combines them by (customer, booking) and (customer, flight) before the shuffle, which
    spreads a hot customer over all tasks. A consumer that uses no distinct count plans none. Where bookings are cheap to
    read, ``apart`` reads them twice: the rows laid out for the distinct counts then carry no sums.
    """
    cut = F.add_months(as_of_date(as_of), -V.CHURN_WINDOW_MONTHS)
    fare, booked_on = F.col("fare_paid_usd"), F.col("booking_date")
    counts = [F.countDistinct("booking_id").alias("total_bookings"), F.countDistinct("flight_id").alias("total_flights")]
    sums = [
        exact_sum(fare).alias("total_fare_revenue"),
        exact_mean(fare).alias("avg_fare_paid"),
        exact_sum(F.col("ancillary_revenue_usd")).alias("total_ancillary_revenue"),
        F.max(booked_on).alias("last_booking_date"),
        F.min(booked_on).alias("first_booking_date"),
        F.count_if(booked_on >= cut).alias("bookings_recent"),
        F.count_if(booked_on < cut).alias("bookings_older"),
        F.count_if(F.col("cabin") == "business").alias("business_flights"),
    ]
    if not apart:
        return bookings.groupBy("customer_id").agg(*counts, *sums)
    summed = bookings.groupBy("customer_id").agg(*sums)
    counted = bookings.groupBy("customer_id").agg(*counts).withColumnRenamed("customer_id", "_customer")
    joined = counted.join(summed, F.col("_customer").eqNullSafe(F.col("customer_id")))
    return joined.select("customer_id", "total_bookings", "total_flights", *summed.columns[1:])


def customer_loyalty(loyalty: DataFrame) -> DataFrame:
    """Per customer: miles earned and redeemed and the number of movements."""
    return loyalty.groupBy("customer_id").agg(
        F.sum("miles_earned").alias("total_miles_earned"),
        F.sum("miles_redeemed").alias("total_miles_redeemed"),
        F.count("loyalty_id").alias("loyalty_transactions"),
    )


def customer_tickets(tickets: DataFrame) -> DataFrame:
    """Per customer: open support tickets."""
    return tickets.groupBy("customer_id").agg(F.count_if("is_open").alias("open_tickets"))


def customer_satisfaction(reviews: DataFrame) -> DataFrame:
    """Per customer: mean rating and mean review sentiment."""
    return reviews.groupBy("customer_id").agg(
        F.avg("rating").alias("avg_rating"),
        exact_mean(F.col("sentiment_score")).alias("avg_review_sentiment"),
    )


def int_customer_metrics(
    customers: DataFrame,
    bookings: DataFrame,
    loyalty: DataFrame,
    tickets: DataFrame,
    reviews: DataFrame,
    as_of=None,
    apart: bool = False,
) -> DataFrame:
    """One row per customer with lifetime value, attach rate, three churn signals, their score and recency.

    Customers without a row in a feed get zeros, but no dates; an unrated customer shows a rating of 0 and still
    does not raise the low-rating signal.
    """
    joined = (
        customers.select(
            "customer_id", "segment", "loyalty_tier", "loyalty_member", "preferred_cabin", "age_group", "country"
        )
        .join(customer_revenue(bookings, as_of, apart), "customer_id", "left")
        .join(customer_loyalty(loyalty), "customer_id", "left")
        .join(customer_tickets(tickets), "customer_id", "left")
        .join(customer_satisfaction(reviews), "customer_id", "left")
        .withColumn("rating_for_churn", F.coalesce("avg_rating", F.lit(float(V.CHURN_RATING_WHEN_UNRATED))))
    )
    joined = zero_if_null(
        joined,
        [
            "total_fare_revenue",
            "total_ancillary_revenue",
            "total_bookings",
            "total_flights",
            "avg_fare_paid",
            "business_flights",
            "bookings_recent",
            "bookings_older",
            "total_miles_earned",
            "total_miles_redeemed",
            "open_tickets",
            "avg_rating",
            "avg_review_sentiment",
        ],
    )
    fare, ancillary = F.col("total_fare_revenue"), F.col("total_ancillary_revenue")
    recent, older = F.col("bookings_recent"), F.col("bookings_older")
    flight_drop = signal((older > 0) & (recent < older * V.CHURN_DROP_RATIO))
    many_tickets = signal(F.col("open_tickets") >= V.CHURN_OPEN_TICKETS)
    low_rating = signal(F.col("rating_for_churn") <= V.CHURN_LOW_RATING)
    return joined.select(
        "customer_id",
        "segment",
        "loyalty_tier",
        "loyalty_member",
        "preferred_cabin",
        "age_group",
        "country",
        (fare + ancillary).alias("ltv_usd"),
        "total_fare_revenue",
        "total_ancillary_revenue",
        "total_bookings",
        "total_flights",
        "avg_fare_paid",
        "business_flights",
        "last_booking_date",
        "first_booking_date",
        "bookings_recent",
        "bookings_older",
        "total_miles_earned",
        "total_miles_redeemed",
        "open_tickets",
        "avg_rating",
        "avg_review_sentiment",
        F.when(fare > 0, round_half_away(ratio(ancillary, fare), 4)).otherwise(0.0).alias("ancillary_attach_rate"),
        flight_drop.alias("churn_signal_flight_drop"),
        many_tickets.alias("churn_signal_open_tickets"),
        low_rating.alias("churn_signal_low_rating"),
        (flight_drop + many_tickets + low_rating).alias("churn_score"),
        F.datediff(as_of_date(as_of), "last_booking_date").alias("days_since_last_booking"),
    )


def mart_customer_segments(metrics: DataFrame, run_ts=None) -> DataFrame:
    """Customer metrics rounded for reporting."""
    rounded = {
        "ltv_usd": ("ltv_usd", 2),
        "total_fare_revenue": ("total_fare_revenue_usd", 2),
        "total_ancillary_revenue": ("total_ancillary_revenue_usd", 2),
        "avg_fare_paid": ("avg_fare_paid_usd", 2),
        "ancillary_attach_rate": ("ancillary_attach_rate", 4),
        "avg_rating": ("avg_rating", 2),
        "avg_review_sentiment": ("avg_review_sentiment", 4),
    }
    columns = [
        "customer_id",
        "segment",
        "loyalty_tier",
        "loyalty_member",
        "preferred_cabin",
        "age_group",
        "country",
        "ltv_usd",
        "total_fare_revenue",
        "total_ancillary_revenue",
        "avg_fare_paid",
        "ancillary_attach_rate",
        "total_bookings",
        "total_flights",
        "business_flights",
        "last_booking_date",
        "first_booking_date",
        "days_since_last_booking",
        "bookings_recent",
        "bookings_older",
        "total_miles_earned",
        "total_miles_redeemed",
        "open_tickets",
        "avg_rating",
        "avg_review_sentiment",
        "churn_signal_flight_drop",
        "churn_signal_open_tickets",
        "churn_signal_low_rating",
        "churn_score",
    ]
    return stamped(
        metrics.select(
            *[
                round_half_away(F.col(c), rounded[c][1]).alias(rounded[c][0]) if c in rounded else F.col(c)
                for c in columns
            ]
        ),
        run_ts,
    )
