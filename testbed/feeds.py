"""The raw feeds as projections of the generated test tables.

Each feed is one portable SELECT, run by Spark here and by DuckDB inside the check queries, so both sides start
from the same rows. Every feed keeps all rows of its tables. Dates, ages, delays and counts are text, as in a CSV
file, so that staging has work to do. Some keys point nowhere on purpose: route R25, flights X..., and customers
whose number ends in 3 book nothing.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.enrich import NON_LETTERS

AS_OF = "1999-01-01"
HUB = "NATION_0"
RUN_TS = dt.datetime(1999, 1, 2, 3, 4, 5)

FEEDS = {
    "airports": """
        SELECT n_name AS airport_code, n_name || ' International' AS airport_name, n_name AS city,
               'C' || CAST(n_regionkey AS STRING) AS country, 'UTC+' || CAST(n_nationkey % 12 AS STRING) AS timezone,
               CAST(3.5 * n_nationkey - 40 AS STRING) AS latitude, CAST(90 - 7.25 * n_nationkey AS STRING) AS longitude
        FROM {nation}""",
    "routes": """
        SELECT 'R' || CAST(n_nationkey AS STRING) AS route_id, r_name AS origin_airport_code,
               n_name AS destination_airport_code,
               CASE n_nationkey % 3 WHEN 0 THEN 'Domestic' WHEN 1 THEN 'Regional' ELSE 'International' END
                   AS route_type,
               CAST(350 + 200 * n_nationkey AS STRING) AS distance_km,
               CAST(50 + 15 * n_nationkey AS STRING) AS block_time_min
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "customers": """
        SELECT 'C' || CAST(c_custkey AS STRING) AS customer_id, split_part(c_name, '#', 1) AS first_name,
               split_part(c_name, '#', 2) AS last_name,
               CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
               CAST(DATE '1940-01-01' + CAST(c_custkey % 20000 AS INT) AS STRING) AS birth_date,
               'N' || CAST(c_nationkey AS STRING) AS country, 'City ' || CAST(c_custkey % 97 AS STRING) AS city,
               c_mktsegment AS segment,
               CASE WHEN c_acctbal < 2500 THEN NULL WHEN c_acctbal < 5000 THEN 'Explorer'
                    WHEN c_acctbal < 7500 THEN 'Silver' ELSE 'Gold' END AS loyalty_tier,
               CAST(DATE '1990-01-01' + CAST(c_custkey % 3000 AS INT) AS STRING) AS signup_date,
               CASE c_custkey % 4 WHEN 0 THEN 'Web' WHEN 1 THEN 'Travel Agency' WHEN 2 THEN 'Mobile App'
                    ELSE 'Corporate Desk' END AS preferred_channel,
               CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'business' ELSE 'economy' END
                   AS preferred_cabin,
               CASE WHEN c_acctbal < 2500 THEN 'False' ELSE 'True' END AS loyalty_member,
               CASE WHEN c_custkey % 97 = 5 THEN NULL ELSE CAST(17 + c_custkey % 50 AS STRING) END AS age
        FROM {customer}""",
    "flights": """
        SELECT 'F' || CAST(o_orderkey AS STRING) AS flight_id,
               'SK' || CAST(o_orderkey % 900 AS STRING) AS flight_number,
               'R' || CAST(o_custkey % 26 AS STRING) AS route_id, CAST(o_orderdate AS DATE) AS flight_date,
               o_orderdate + INTERVAL '6' HOUR AS scheduled_departure,
               o_orderdate + INTERVAL '8' HOUR AS scheduled_arrival,
               o_orderdate + INTERVAL '7' HOUR AS actual_departure,
               o_orderdate + INTERVAL '9' HOUR AS actual_arrival,
               CASE o_orderkey % 3 WHEN 0 THEN 'A320' WHEN 1 THEN 'A330' ELSE 'DH8' END AS aircraft_type,
               CAST(100 + 50 * (o_orderkey % 5) AS STRING) AS seat_capacity,
               CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Delayed' ELSE 'Cancelled' END
                   AS flight_status,
               CASE o_orderstatus WHEN 'F' THEN '0' WHEN 'O' THEN CAST(15 + o_orderkey % 240 AS STRING) END
                   AS delay_minutes,
               CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_orderstatus = 'O' END AS is_delayed,
               CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_orderstatus = 'P' END AS is_cancelled,
               CASE o_custkey % 26 % 3 WHEN 0 THEN 'Domestic' WHEN 1 THEN 'Regional' ELSE 'International' END
                   AS route_type,
               CAST(350 + 200 * (o_custkey % 26) AS STRING) AS distance_km,
               CAST(CAST(FLOOR(0.78 * (100 + 50 * (o_orderkey % 5))) AS INT) AS STRING) AS pax_boarded,
               CAST(60 + o_orderkey % 40 AS DOUBLE) / 100 AS load_factor, o_totalprice AS total_revenue_usd,
               o_totalprice * CAST(0.65 AS DOUBLE) AS op_cost_usd, o_totalprice * CAST(0.25 AS DOUBLE) AS fuel_cost_usd
        FROM {orders}""",
    "bookings": """
        SELECT concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING),
                         CAST(l_suppkey AS STRING)) AS booking_id,
               CASE WHEN l_linenumber = 7 AND l_returnflag = 'N' THEN 'X' ELSE 'F' END || CAST(l_orderkey AS STRING)
                   AS flight_id,
               'C' || CAST(CASE WHEN o_custkey % 10 = 3 THEN o_custkey - 1 ELSE o_custkey END AS STRING)
                   AS customer_id,
               CAST(CAST(l_shipdate AS DATE) AS STRING) AS booking_date, l_linestatus AS booking_channel,
               CASE WHEN l_linenumber = 1 THEN 'Business' ELSE 'Economy' END AS fare_class,
               l_returnflag AS fare_family, l_extendedprice AS ticket_price_usd,
               l_extendedprice * l_discount AS ancillary_revenue_usd, CAST(l_linenumber AS STRING) AS bags_count,
               CASE WHEN l_linestatus = 'O' THEN 'True' ELSE 'False' END AS seat_selection_flag,
               CASE WHEN l_returnflag = 'R' THEN 'Cancelled' ELSE 'Confirmed' END AS booking_status
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "customer_reviews": """
        SELECT 'REV' || CAST(event_id AS STRING) AS review_id, 'B' || CAST(event_id AS STRING) AS booking_id,
               'C' || CAST(user_id AS STRING) AS customer_id, 'F' || CAST(event_id AS STRING) AS flight_id,
               CAST(CAST(ts AS DATE) AS STRING) AS review_date,
               CASE WHEN event_id % 89 = 0 THEN NULL
                    ELSE CAST(1 + (7 * user_id + event_id % 2) % 5 AS STRING) END AS rating,
               CASE event_id % 4 WHEN 0 THEN '  ' || props || '  '
                    WHEN 1 THEN 'é "' || props || '",' || chr(10) || ' ñ' ELSE props END AS review_text,
               LEAST(CAST(1 AS DOUBLE), GREATEST(CAST(-1 AS DOUBLE), (value - 50) / 50)) AS sentiment_score,
               CASE WHEN (value - 50) / 50 > 0.15 THEN 'positive' WHEN (value - 50) / 50 < -0.15 THEN 'negative'
                    ELSE 'neutral' END AS sentiment_label,
               CASE WHEN event_id % 5 = 0 THEN 'Business' ELSE 'Economy' END AS cabin
        FROM {events} WHERE event_type IN ('view', 'click')""",
    "support_tickets": """
        SELECT 'TKT' || CAST(event_id AS STRING) AS ticket_id, 'C' || CAST(user_id AS STRING) AS customer_id,
               'F' || CAST(event_id AS STRING) AS flight_id,
               CASE event_id % 4 WHEN 0 THEN 'baggage' WHEN 1 THEN 'delay' WHEN 2 THEN 'refund' ELSE 'service' END
                   AS category,
               props AS ticket_text,
               LEAST(CAST(1 AS DOUBLE), GREATEST(CAST(-1 AS DOUBLE), (value - 50) / 50)) AS sentiment_score,
               CASE WHEN (value - 50) / 50 > 0.15 THEN 'positive' WHEN (value - 50) / 50 < -0.15 THEN 'negative'
                    ELSE 'neutral' END AS sentiment_label,
               CASE event_id % 7 WHEN 0 THEN 'critical' WHEN 1 THEN 'high' WHEN 2 THEN 'low' ELSE 'medium' END
                   AS severity,
               CASE event_id % 20 WHEN 0 THEN 'open' WHEN 1 THEN 'in_progress' WHEN 2 THEN 'closed' ELSE 'resolved' END
                   AS status,
               CAST(CAST(ts AS DATE) AS STRING) AS created_at,
               CASE event_id % 3 WHEN 0 THEN '1' WHEN 1 THEN '7' ELSE '30' END AS resolution_days
        FROM {events} WHERE event_type IN ('error', 'signup')""",
    "loyalty_activity": """
        SELECT 'LOY' || CAST(event_id AS STRING) AS loyalty_id, 'C' || CAST(user_id AS STRING) AS customer_id,
               'B' || CAST(event_id AS STRING) AS booking_id, CAST(CAST(ts AS DATE) AS STRING) AS transaction_date,
               CAST(CAST(FLOOR(3 * value) AS BIGINT) AS STRING) AS miles_earned,
               CASE WHEN event_id % 2 = 0 THEN CAST(CAST(FLOOR(FLOOR(3 * value) / 2) AS BIGINT) AS STRING)
                    ELSE '0' END AS miles_redeemed,
               CASE event_id % 3 WHEN 0 THEN 'flight' WHEN 1 THEN 'partner_hotel' ELSE 'bonus_campaign' END
                   AS activity_type
        FROM {events} WHERE event_type = 'purchase'""",
    "basic_customers": """
        SELECT 'C' || CAST(c_custkey AS STRING) AS customer_id, c_name AS name,
               CASE WHEN c_custkey % 61 = 7 THEN 'not known'
                    ELSE CAST(DATE '1950-01-01' + CAST(c_custkey % 17000 AS INT) AS STRING) END AS birth_date,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'Business' WHEN 'MACHINERY' THEN 'PREMIUM'
                    WHEN 'FURNITURE' THEN NULL ELSE 'Standard' END AS customer_segment,
               CASE WHEN c_acctbal < 2500 THEN NULL ELSE 'Silver' END AS loyalty_tier
        FROM {customer}""",
    "basic_flights": """
        SELECT 'F' || CAST(o_orderkey AS STRING) AS flight_id, 'R' || CAST(o_custkey % 26 AS STRING) AS route_id,
               CAST(o_orderdate AS DATE) AS flight_date, CAST(101 + 37 * (o_orderkey % 7) AS INT) AS seat_capacity,
               CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'DELAYED' ELSE 'Cancelled' END
                   AS flight_status,
               CAST(o_orderkey % 240 AS INT) AS delay_min,
               CAST(80 + o_orderkey % 41 AS DOUBLE) / 100 AS market, CAST(55 + o_orderkey % 21 AS DOUBLE) / 100 AS burn
        FROM {orders}""",
    "texts": "SELECT doc_id, text FROM {documents}",
}

RAW_FEEDS = (
    "airports",
    "routes",
    "customers",
    "flights",
    "bookings",
    "customer_reviews",
    "support_tickets",
    "loyalty_activity",
)


def tables_in(sql: str) -> list[str]:
    return re.findall(r"\{(\w+)\}", sql)


class RawFeeds(Mapping):
    """The feeds by name, each planned when first asked for; iteration gives the eight raw feeds."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self.table = cache(lambda name: spark.read.parquet(f"{folder}/{name}.parquet"))

    def __getitem__(self, name: str) -> DataFrame:
        sql = FEEDS[name]
        return self._spark.sql(sql, **{t: self.table(t) for t in tables_in(sql)})

    def __iter__(self):
        return iter(RAW_FEEDS)

    def __len__(self) -> int:
        return len(RAW_FEEDS)


@cache
def open_feeds(spark: SparkSession, folder: str) -> RawFeeds:
    """The feeds of a folder, opened once per session."""
    return RawFeeds(spark, folder)


def lexicon(benchmark: DataFrame) -> DataFrame:
    """The words of the benchmark texts, each with a polarity between -1 and 1 that depends on its length."""
    words = benchmark.select(F.explode(F.split(F.lower("text"), NON_LETTERS)).alias("word"))
    return words.filter("word <> ''").distinct().withColumn("polarity", (F.length("word") % 5 - 2) / 2.0)
