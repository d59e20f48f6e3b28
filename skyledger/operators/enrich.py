"""Preparation of raw feeds: columns a feed lacks, loyalty accrual, sentiment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.frames import may_hold, split_join
from ..functions.numeric import exact_mean, ratio, round_half_even
from ..functions.rules import add_missing, as_of_date, sentiment_of

NON_LETTERS = r"[^\p{L}]+"


def _as_column(value: float | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


def enrich_customers(customers: DataFrame, as_of=None) -> DataFrame:
    """Customers with ``segment``, and with cabin, membership and age derived where the feed has no such column.

    ``birth_date`` becomes a date, NULL where it cannot be read.
    """
    df = customers.withColumnRenamed("customer_segment", "segment")
    if "birth_date" in df.columns:
        df = df.withColumn("birth_date", F.col("birth_date").try_cast("date"))
    if "age" not in df.columns and "birth_date" in df.columns:
        age = {"age": (F.datediff(as_of_date(as_of), "birth_date") / 365).cast("int")}
    else:
        age = {}
    cabin = F.when(F.lower("segment").isin(V.BUSINESS_SEGMENTS), "business").otherwise("economy")
    return add_missing(df, preferred_cabin=cabin, loyalty_member=F.col("loyalty_tier").isNotNull(), **age)


def enrich_flights(
    flights: DataFrame,
    routes: DataFrame,
    revenue_factor: float | Column = V.REVENUE_FACTOR,
    cost_factor: float | Column = V.COST_FACTOR,
) -> DataFrame:
    """Flights with their route's distance and type, and with money, load and status columns the feed lacks.

    The route's distance and type win over the flight's own. Estimated fares depend on the route type; the two
    factors vary revenue around the standard fare and cost around revenue, as constants or columns of the flights.
    """
    own = [c for c in ("distance_km", "route_type") if c in flights.columns]
    facts = routes.select(
        F.col("route_id").alias("_route"),
        F.col("distance_km").alias("_distance_km"),
        F.col("route_type").alias("_route_type"),
    )
    df = (
        flights.withColumns({"_revenue_factor": _as_column(revenue_factor), "_cost_factor": _as_column(cost_factor)})
        .join(facts, F.col("route_id") == F.col("_route"), "left")
        .withColumns({c: F.coalesce(f"_{c}", *([c] if c in own else [])) for c in ("distance_km", "route_type")})
    )
    if "total_revenue_usd" not in flights.columns:
        df = _with_estimates(df)
    if "flight_status" in flights.columns and "is_delayed" not in flights.columns:
        status = F.lower("flight_status")
        df = df.withColumns({"is_delayed": status.contains("delay"), "is_cancelled": status.contains("cancel")})
    if "delay_minutes" not in flights.columns:
        df = df.withColumnRenamed("delay_min", "delay_minutes")
    return df.drop("_revenue_factor", "_cost_factor", "_route", "_distance_km", "_route_type")


def _with_estimates(flights: DataFrame) -> DataFrame:
    """Passengers at the assumed load, fares by route type, cost and fuel as shares; halves round to even."""
    seats = F.col("seat_capacity").cast("double")
    fare = F.lit(V.FARE_FOR_OTHER_ROUTES)
    for route_type, usual in V.FARE_BY_ROUTE_TYPE.items():
        fare = F.when(F.col("route_type") == route_type, usual).otherwise(fare)
    pax = (seats * V.ASSUMED_LOAD).cast("int")
    return (
        flights.withColumn("total_revenue_usd", round_half_even(pax * fare * F.col("_revenue_factor"), 2))
        .withColumn("op_cost_usd", round_half_even(F.col("total_revenue_usd") * F.col("_cost_factor"), 2))
        .withColumn("fuel_cost_usd", round_half_even(F.col("op_cost_usd") * V.FUEL_SHARE_OF_COST, 2))
        .withColumn("pax_boarded", pax)
        .withColumn("load_factor", round_half_even(ratio(pax, seats), 4))
    )


def loyalty_accrual(
    customers: DataFrame,
    bookings: DataFrame,
    rate: float | Column = 5,
    redeemed_share: float | Column = 0,
    activity: str | Column = "flight",
) -> DataFrame:
    """One loyalty movement per booking of a member: whole miles from price and rate, whole miles redeemed.

    Rate, share and activity are constants or columns of the bookings. The movement's id is derived from the
    booking, since a running number would need all movements in one global order.
    """
    price = F.col("ticket_price_usd") if "ticket_price_usd" in bookings.columns else F.lit(V.ACCRUAL_DEFAULT_PRICE)
    miles = (price.cast("double") * _as_column(rate)).cast("int")
    earning = bookings.select(
        F.concat(F.lit("LOY"), "booking_id").alias("loyalty_id"),
        "customer_id",
        "booking_id",
        F.date_format(F.col("booking_date").cast("date"), "yyyy-MM-dd").alias("transaction_date"),
        miles.alias("miles_earned"),
        (miles * _as_column(redeemed_share)).cast("int").alias("miles_redeemed"),
        (activity if isinstance(activity, Column) else F.lit(activity)).alias("activity_type"),
    )
    members = customers.filter(F.col("loyalty_member").cast("boolean")).select("customer_id")
    return earning.join(members, "customer_id").select(*earning.columns)


def sentiment_label(df: DataFrame, score: str, label: str = "sentiment_label") -> DataFrame:
    """The frame with each score rounded to four digits and labelled; the label looks at the unrounded score."""
    return df.withColumn(label, sentiment_of(F.col(score))).withColumn(score, round_half_even(F.col(score), 4))


def candidate_words(texts: DataFrame, lexicon: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (key, word) for the words of texts that may be in the lexicon, and one row at least for every text."""
    words = texts.select(key, F.posexplode_outer(F.split(F.lower(text), NON_LETTERS)).alias("at", "word"))
    return words.filter(F.coalesce(F.col("at") == 0, F.lit(True)) | may_hold(lexicon, "word")(F.col("word"))).drop("at")


def lexicon_sentiment(texts: DataFrame, lexicon: DataFrame, key: str, text: str, salts: int = 1) -> DataFrame:
    """Mean polarity and label per text; every occurrence of a lexicon word counts, no hit means 0 and neutral.

    ``lexicon`` holds one row per lower-case ``word`` with its ``polarity``; ``key`` identifies a text, and texts of one
    key are scored as one. Whole texts are split inside the tasks, where each word is held against a table of bits, so
    that besides the lexicon's own words hardly any goes on. A lexicon below Spark's broadcast threshold is broadcast,
    and a text then leaves its task as one row. Otherwise the words that passed are shuffled to the lexicon; AQE splits a
    frequent one, and ``salts`` repeats the lexicon to spread each word from the outset.
    """
    words = candidate_words(texts, lexicon, key, text).withColumn("salt", F.pmod(F.xxhash64(key), F.lit(salts)))
    polarities = lexicon.select("word", F.col("polarity").cast("double").alias("polarity"))
    polarities = polarities.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    scored = split_join(words, polarities, ["word", "salt"], "left")
    mean = F.coalesce(exact_mean(F.col("polarity")), F.lit(0.0))
    return sentiment_label(scored.groupBy(key).agg(mean.alias("sentiment_score")), "sentiment_score")


def score_texts(feed: DataFrame, lexicon: DataFrame, text: str, salts: int = 1) -> DataFrame:
    """A feed of reviews or tickets with the sentiment score and label of each row's text, whatever its keys.

    Rows find their score by the digest of their text, so rows of equal text have equal scores and a row needs no id.
    """
    own = feed.drop("sentiment_score", "sentiment_label").withColumn("_text", F.md5(F.coalesce(text, F.lit(""))))
    scores = lexicon_sentiment(own, lexicon, "_text", text, salts)
    return split_join(own, scores, ["_text"], "left").drop("_text")
