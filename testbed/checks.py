"""SQL that DuckDB runs on the same tables to check every registered query.

``VIEWS`` names each dataset; ``{name}`` refers to another dataset, a feed or a generated table. :func:`check_sql`
assembles one statement with the datasets it needs as common table expressions.
"""

from __future__ import annotations

import re

from skyledger.sources.schemas import RAW_COLUMNS

from .contents import contents_sql
from .feeds import AS_OF, FEEDS, HUB, RAW_FEEDS, RUN_TS

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def whole(x: str) -> str:
    """Numeric text to INTEGER with halves to even."""
    return f"CAST(CAST({x} AS DOUBLE) AS INTEGER)"


def total(x: str, where: str = "") -> str:
    """Sum of doubles, independent of row order: whole multiples of 2^-60, read as the nearest double."""
    scale = f"{1 << 60}.0::DOUBLE"
    return f"(CAST(CAST(SUM(CAST({x} * {scale} AS HUGEINT)){where} AS VARCHAR) AS DOUBLE) / {scale})"


def mean(x: str, where: str = "") -> str:
    return f"({total(x, where)} / COUNT({x}){where})"


TODAY = f"DATE '{AS_OF}'"

VIEWS: dict[str, str] = {
    "lexicon": f"""
        SELECT word, (length(word) % 5 - 2) / 2.0 AS polarity
        FROM (SELECT DISTINCT unnest(string_split_regex(lower(text), '[^\\p{{L}}]+')) AS word FROM {{benchmark}})
        WHERE word <> ''""",
    "stg_bookings": f"""
        SELECT booking_id, flight_id, customer_id, booking_date::DATE AS booking_date, booking_channel AS channel,
               fare_class, fare_family, ticket_price_usd AS fare_paid_usd, ancillary_revenue_usd,
               {whole("bags_count")} AS bags_count, seat_selection_flag::BOOLEAN AS seat_selected, booking_status,
               IF(fare_class IS NOT DISTINCT FROM 'Business', 'business', 'economy') AS cabin,
               booking_status IS NOT DISTINCT FROM 'Cancelled' AS is_cancelled
        FROM {{bookings}} WHERE booking_id IS NOT NULL""",
    "stg_customers": f"""
        SELECT customer_id, first_name, last_name, gender, birth_date::DATE AS birth_date, country, city, segment,
               loyalty_tier, loyalty_member::BOOLEAN AS loyalty_member, signup_date::DATE AS signup_date,
               preferred_channel, preferred_cabin, {whole("age")} AS age,
               CASE WHEN age IS NULL OR age::DOUBLE >= 55 THEN '55+' WHEN age::DOUBLE >= 45 THEN '45-54'
                    WHEN age::DOUBLE >= 35 THEN '35-44' WHEN age::DOUBLE >= 25 THEN '25-34' ELSE '18-24' END
                   AS age_group
        FROM {{customers}} WHERE customer_id IS NOT NULL""",
    "stg_flights": f"""
        SELECT flight_id, flight_number, route_id, flight_date, scheduled_departure, scheduled_arrival,
               actual_departure, actual_arrival, aircraft_type, {whole("seat_capacity")} AS seat_capacity,
               flight_status, {whole("delay_minutes")} AS delay_minutes, is_delayed, is_cancelled, route_type,
               {whole("distance_km")} AS distance_km, {whole("pax_boarded")} AS pax_boarded, load_factor,
               total_revenue_usd, op_cost_usd, fuel_cost_usd,
               IF(COALESCE(delay_minutes::DOUBLE, 0) < 15, 'on_time', IF(delay_minutes::DOUBLE < 60, 'minor',
                  IF(delay_minutes::DOUBLE < 180, 'significant', 'major'))) AS delay_category,
               total_revenue_usd - op_cost_usd AS gross_margin_usd, month(flight_date)::INTEGER AS flight_month_num,
               year(flight_date)::INTEGER AS flight_year
        FROM {{flights}} WHERE flight_id IS NOT NULL""",
    "stg_loyalty": f"""
        SELECT loyalty_id, customer_id, booking_id, transaction_date::DATE AS transaction_date,
               {whole("miles_earned")} AS miles_earned, {whole("miles_redeemed")} AS miles_redeemed, activity_type,
               {whole("miles_earned")} - {whole("miles_redeemed")} AS miles_net
        FROM {{loyalty_activity}} WHERE loyalty_id IS NOT NULL""",
    "stg_reviews": f"""
        SELECT review_id, booking_id, customer_id, flight_id, review_date::DATE AS review_date,
               {whole("rating")} AS rating, review_text, sentiment_score, sentiment_label, cabin,
               CASE WHEN rating::DOUBLE >= 4 THEN 'promoter' WHEN rating::DOUBLE <= 2 THEN 'detractor' ELSE 'passive' END
                   AS nps_category
        FROM {{customer_reviews}} WHERE review_id IS NOT NULL""",
    "stg_routes": f"""
        SELECT route_id, origin_airport_code AS origin, destination_airport_code AS destination, route_type,
               {whole("distance_km")} AS distance_km, {whole("block_time_min")} AS block_time_min,
               list_contains(['International', 'longhaul'], route_type) AS is_strategic
        FROM {{routes}} WHERE route_id IS NOT NULL""",
    "stg_tickets": f"""
        SELECT ticket_id, customer_id, flight_id, category, ticket_text, sentiment_score, sentiment_label, severity,
               status, created_at::DATE AS created_at, {whole("resolution_days")} AS resolution_days,
               list_contains(['open', 'in_progress'], status) AS is_open
        FROM {{support_tickets}} WHERE ticket_id IS NOT NULL""",
    "customer_revenue": f"""
        SELECT customer_id, COUNT(DISTINCT booking_id) AS total_bookings, COUNT(DISTINCT flight_id) AS total_flights,
               {total("fare_paid_usd")} AS total_fare_revenue, {mean("fare_paid_usd")} AS avg_fare_paid,
               {total("ancillary_revenue_usd")} AS total_ancillary_revenue, MAX(booking_date) AS last_booking_date,
               MIN(booking_date) AS first_booking_date,
               COUNT(*) FILTER (booking_date >= DATE '1998-04-01') AS bookings_recent,
               COUNT(*) FILTER (booking_date < DATE '1998-04-01') AS bookings_older,
               COUNT(*) FILTER (cabin = 'business') AS business_flights
        FROM {{stg_bookings}} GROUP BY ALL""",
    "customer_loyalty": """
        SELECT customer_id, SUM(miles_earned)::BIGINT AS total_miles_earned,
               SUM(miles_redeemed)::BIGINT AS total_miles_redeemed, COUNT(loyalty_id) AS loyalty_transactions
        FROM {stg_loyalty} GROUP BY ALL""",
    "customer_tickets": """
        SELECT customer_id, COUNT(*) FILTER (is_open) AS open_tickets FROM {stg_tickets} GROUP BY ALL""",
    "customer_satisfaction": f"""
        SELECT customer_id, AVG(rating) AS avg_rating, {mean("sentiment_score")} AS avg_review_sentiment
        FROM {{stg_reviews}} GROUP BY ALL""",
    "customer_wide": """
        SELECT customer_id, segment, loyalty_tier, loyalty_member, preferred_cabin, age_group, country,
               IFNULL(total_fare_revenue, 0) AS total_fare_revenue,
               IFNULL(total_ancillary_revenue, 0) AS total_ancillary_revenue, IFNULL(total_bookings, 0) AS total_bookings,
               IFNULL(total_flights, 0) AS total_flights, IFNULL(avg_fare_paid, 0) AS avg_fare_paid,
               IFNULL(business_flights, 0) AS business_flights, last_booking_date, first_booking_date,
               IFNULL(bookings_recent, 0) AS bookings_recent, IFNULL(bookings_older, 0) AS bookings_older,
               IFNULL(total_miles_earned, 0) AS total_miles_earned,
               IFNULL(total_miles_redeemed, 0) AS total_miles_redeemed, IFNULL(open_tickets, 0) AS open_tickets,
               avg_rating AS known_rating, IFNULL(avg_review_sentiment, 0) AS avg_review_sentiment
        FROM {stg_customers} LEFT JOIN {customer_revenue} USING (customer_id)
             LEFT JOIN {customer_loyalty} USING (customer_id) LEFT JOIN {customer_tickets} USING (customer_id)
             LEFT JOIN {customer_satisfaction} USING (customer_id)""",
    "customer_signals": """
        SELECT * EXCLUDE (known_rating), IFNULL(known_rating, 0) AS avg_rating,
               total_fare_revenue + total_ancillary_revenue AS ltv_usd,
               CASE WHEN total_fare_revenue > 0 THEN ROUND(total_ancillary_revenue / total_fare_revenue, 4) ELSE 0 END
                   AS ancillary_attach_rate,
               (bookings_older > 0 AND 10 * bookings_recent < 6 * bookings_older)::INTEGER
                   AS churn_signal_flight_drop,
               (open_tickets >= 2)::INTEGER AS churn_signal_open_tickets,
               (IFNULL(known_rating, 5) <= 2)::INTEGER AS churn_signal_low_rating
        FROM {customer_wide}""",
    "int_customer_metrics": f"""
        SELECT *, churn_signal_flight_drop + churn_signal_open_tickets + churn_signal_low_rating AS churn_score,
               ({TODAY} - last_booking_date)::INTEGER AS days_since_last_booking
        FROM {{customer_signals}}""",
    "route_ops": f"""
        SELECT route_id, COUNT(*) AS total_flights, COUNT(*) FILTER (NOT is_cancelled) AS operated_flights,
               SUM(IF(is_cancelled IS FALSE, pax_boarded, 0))::BIGINT AS total_pax,
               {total("load_factor", " FILTER (NOT is_cancelled)")}
                   / COUNT(load_factor) FILTER (NOT is_cancelled) AS avg_load_factor,
               AVG(delay_minutes) FILTER (is_delayed) AS avg_delay_min,
               COUNT(*) FILTER (is_delayed) / COUNT(*) AS delay_rate,
               COUNT(*) FILTER (is_cancelled) / COUNT(*) AS cancellation_rate
        FROM {{stg_flights}} GROUP BY ALL""",
    # money is a double per flight before it is one per route
    "route_revenue": f"""
        SELECT route_id, {total("fares")} AS total_revenue, {total("ancillaries")} AS total_ancillary
        FROM {{stg_flights}} JOIN (SELECT flight_id, {total("fare_paid_usd")} AS fares, {total("ancillary_revenue_usd")} AS ancillaries
                                   FROM {{stg_bookings}} GROUP BY flight_id) USING (flight_id) GROUP BY ALL""",
    "route_sentiment": f"""
        SELECT route_id, {mean("sentiment_score")} AS avg_sentiment, AVG(rating) AS avg_rating,
               COUNT(review_id) AS review_count, COUNT(*) FILTER (nps_category = 'promoter') AS promoters,
               COUNT(*) FILTER (nps_category = 'detractor') AS detractors
        FROM {{stg_flights}} JOIN {{stg_reviews}} USING (flight_id) GROUP BY ALL""",
    "route_tickets": """
        SELECT route_id, COUNT(ticket_id) AS ticket_count, COUNT(*) FILTER (category = 'delay') AS delay_tickets,
               COUNT(*) FILTER (category = 'baggage') AS baggage_tickets,
               COUNT(*) FILTER (category = 'service') AS service_tickets
        FROM {stg_flights} JOIN {stg_tickets} USING (flight_id) GROUP BY ALL""",
    "int_route_metrics": """
        SELECT route_id, origin, destination, route_type, distance_km, is_strategic, total_flights, operated_flights,
               total_pax, ROUND(IFNULL(total_revenue, 0), 2) AS total_revenue_usd, ROUND(IFNULL(total_ancillary, 0), 2)
                   AS total_ancillary_usd,
               ROUND(IFNULL(total_revenue, 0) * 0.62::DOUBLE, 2) AS total_op_cost_usd,
               ROUND(IFNULL(total_revenue, 0) * 0.38::DOUBLE, 2) AS gross_margin_usd, ROUND(avg_load_factor, 4) AS avg_load_factor,
               ROUND(delay_rate, 4) AS delay_rate, ROUND(cancellation_rate, 4) AS cancellation_rate,
               ROUND(avg_delay_min, 1) AS avg_delay_minutes,
               ROUND(IF(total_pax <> 0, IFNULL(total_revenue, 0) / total_pax, NULL), 2) AS yield_per_pax_usd,
               ROUND(IF(operated_flights <> 0, IFNULL(total_revenue, 0) * 0.38::DOUBLE / operated_flights, NULL), 2)
                   AS margin_per_flight_usd,
               ROUND(avg_sentiment, 4) AS avg_sentiment, ROUND(avg_rating, 2) AS avg_rating,
               IFNULL(review_count, 0) AS review_count,
               ROUND(IF(promoters + detractors > 0, 100 * (promoters - detractors) / (promoters + detractors), NULL), 1)
                   AS nps_proxy,
               IFNULL(ticket_count, 0) AS ticket_count, IFNULL(delay_tickets, 0) AS delay_tickets,
               IFNULL(baggage_tickets, 0) AS baggage_tickets, IFNULL(service_tickets, 0) AS service_tickets
        FROM {stg_routes} JOIN {route_ops} USING (route_id)
             LEFT JOIN {route_revenue} USING (route_id)
             LEFT JOIN {route_sentiment} USING (route_id) LEFT JOIN {route_tickets} USING (route_id)""",
    "dim_airports": f"""
        SELECT airport_code AS airport_id, airport_name, city, country, timezone, latitude::DOUBLE AS latitude,
               longitude::DOUBLE AS longitude, airport_code IS NOT DISTINCT FROM '{HUB}' AS is_hub
        FROM {{airports}}""",
    "dim_customers": """
        SELECT customer_id, first_name, last_name, gender, age, age_group, country, city, segment, loyalty_member,
               loyalty_tier, IFNULL(loyalty_tier, 'non_member') AS loyalty_tier_clean, preferred_cabin,
               preferred_channel, birth_date, signup_date
        FROM {stg_customers}""",
    "dim_routes": """
        SELECT *, format('{} → {}', origin, destination) AS route_label,
               IF(distance_km < 500, 'short', IF(distance_km < 2000, 'medium', 'long')) AS distance_category
        FROM {stg_routes}""",
    "fact_bookings": """
        SELECT booking_id, customer_id, flight_id, route_id, fare_family AS fare_family_id, booking_date, flight_date,
               flight_year, flight_month_num, fare_paid_usd, ancillary_revenue_usd,
               fare_paid_usd + ancillary_revenue_usd AS total_revenue_usd, cabin, channel, fare_class, fare_family,
               bags_count, seat_selected, booking_status, b.is_cancelled, route_type, aircraft_type
        FROM {stg_bookings} b LEFT JOIN {stg_flights} f USING (flight_id)""",
    "fact_flights": """
        SELECT flight_id, route_id, flight_date, flight_year, flight_month_num, scheduled_departure, scheduled_arrival,
               actual_departure, actual_arrival, aircraft_type, seat_capacity, pax_boarded, load_factor, delay_minutes,
               total_revenue_usd, op_cost_usd, fuel_cost_usd, gross_margin_usd, flight_status, is_delayed,
               is_cancelled, delay_category, f.route_type, f.distance_km, origin, destination, is_strategic
        FROM {stg_flights} f LEFT JOIN {stg_routes} r USING (route_id)""",
    "mart_customer_segments": """
        SELECT customer_id, segment, loyalty_tier, loyalty_member, preferred_cabin, age_group, country,
               ROUND(ltv_usd, 2) AS ltv_usd, ROUND(total_fare_revenue, 2) AS total_fare_revenue_usd,
               ROUND(total_ancillary_revenue, 2) AS total_ancillary_revenue_usd,
               ROUND(avg_fare_paid, 2) AS avg_fare_paid_usd, ROUND(ancillary_attach_rate, 4) AS ancillary_attach_rate,
               total_bookings, total_flights, business_flights, last_booking_date, first_booking_date,
               days_since_last_booking, bookings_recent, bookings_older, total_miles_earned, total_miles_redeemed,
               open_tickets, ROUND(avg_rating, 2) AS avg_rating,
               ROUND(avg_review_sentiment, 4) AS avg_review_sentiment, churn_signal_flight_drop,
               churn_signal_open_tickets, churn_signal_low_rating, churn_score
        FROM {int_customer_metrics}""",
    "mart_route_performance": """
        SELECT * EXCLUDE (total_ancillary_usd, avg_load_factor, delay_rate, cancellation_rate),
               ROUND(100 * avg_load_factor, 1) AS load_factor_pct, ROUND(100 * delay_rate, 1) AS delay_rate_pct,
               ROUND(100 * cancellation_rate, 1) AS cancellation_rate_pct
        FROM {int_route_metrics}""",
    "routes_ranking": """
        SELECT route_label AS route, d.route_type, ROUND(100 * avg_load_factor, 1) AS load_factor_pct,
               ROUND(total_revenue_usd) AS revenue_usd, ROUND(gross_margin_usd) AS margin_usd,
               ROUND(100 * delay_rate, 1) AS delay_rate_pct, ROUND(nps_proxy, 1) AS nps
        FROM {int_route_metrics} JOIN {dim_routes} d USING (route_id)
        ORDER BY gross_margin_usd DESC NULLS LAST, route_id""",
    "customers_at_risk": """
        SELECT format('{} {}', first_name, last_name) AS client, d.segment, d.country, ROUND(ltv_usd) AS ltv_usd,
               churn_score, open_tickets, ROUND(avg_rating, 1) AS note_moyenne
        FROM {int_customer_metrics} m JOIN {dim_customers} d USING (customer_id)
        WHERE churn_score >= 2 ORDER BY m.ltv_usd DESC NULLS LAST, customer_id LIMIT 20""",
    "upsell_by_segment": f"""
        SELECT segment, COUNT(DISTINCT booking_id) AS total_reservations,
               ROUND({total("fare_paid_usd")}) AS revenue_billets,
               ROUND({total("ancillary_revenue_usd")}) AS revenue_ancillaires,
               ROUND({total("ancillary_revenue_usd")} * 100 / NULLIF({total("fare_paid_usd")}, 0), 2)
                   AS attach_rate_pct
        FROM {{dim_customers}} JOIN {{fact_bookings}} USING (customer_id) GROUP BY ALL
        ORDER BY attach_rate_pct DESC NULLS LAST, segment""",
    "summary_network": f"""
        SELECT ROUND({total("total_revenue_usd")}) AS revenue_total, ROUND({total("gross_margin_usd")}) AS marge_totale,
               ROUND({mean("avg_load_factor")} * 100, 1) AS load_factor_moyen,
               COUNT(*) FILTER (avg_load_factor >= 0.75::DOUBLE) AS routes_performantes
        FROM {{int_route_metrics}}""",
    "summary_customers": f"""
        SELECT COUNT(*) AS total_clients, ROUND({mean("ltv_usd")}) AS ltv_moyenne,
               COUNT(*) FILTER (churn_score >= 2) AS clients_a_risque,
               ROUND(IFNULL({total("ltv_usd", " FILTER (churn_score >= 2)")}, 0)) AS ltv_menacee
        FROM {{int_customer_metrics}}""",
    "summary_ancillary": f"""
        SELECT ROUND({total("ancillary_revenue_usd")}) AS revenue_ancillaire,
               ROUND({total("ancillary_revenue_usd")} * 100 / NULLIF({total("fare_paid_usd")}, 0), 2)
                   AS attach_rate_pct
        FROM {{fact_bookings}}""",
    "executive_summary": """
        SELECT n.*, c.*, a.*,
               format('Rétention — {} clients à risque, {:.1f}$ menacés', clients_a_risque, ltv_menacee)
                   AS priorite_1,
               format('Routes — {} routes performantes à développer', routes_performantes) AS priorite_2,
               format('Upsell — attach rate actuel {}% vs 15-20% benchmark', attach_rate_pct::VARCHAR) AS priorite_3
        FROM {summary_network} n, {summary_customers} c, {summary_ancillary} a""",
    "enrich_customers": f"""
        SELECT customer_id, name, birth_date, segment, loyalty_tier,
               IF(list_contains(['business', 'premium'], lower(segment)), 'business', 'economy') AS preferred_cabin,
               loyalty_tier IS NOT NULL AS loyalty_member, ({TODAY} - birth_date)::INTEGER // 365 AS age
        FROM (SELECT * REPLACE (TRY_CAST(birth_date AS DATE) AS birth_date) RENAME (customer_segment AS segment)
              FROM {{basic_customers}})""",
    "enrich_flights": """
        SELECT * EXCLUDE (delay_min, guess, revenue, cost), delay_min AS delay_minutes, guess AS pax_boarded,
               revenue AS total_revenue_usd, cost AS op_cost_usd,
               CAST(cost * 0.42::DOUBLE * 100 AS BIGINT) / 100.0::DOUBLE AS fuel_cost_usd,
               CAST(guess / seat_capacity * 10000 AS BIGINT) / 10000.0::DOUBLE AS load_factor,
               contains(lower(flight_status), 'delay') AS is_delayed,
               contains(lower(flight_status), 'cancel') AS is_cancelled
        FROM (SELECT *, CAST(revenue * burn * 100 AS BIGINT) / 100.0::DOUBLE AS cost
              FROM (SELECT f.*, distance_km, route_type, CAST(floor(seat_capacity * 0.78::DOUBLE) AS INTEGER) AS guess,
                           CAST(guess * CASE route_type WHEN 'Domestic' THEN 90 WHEN 'Regional' THEN 200
                                WHEN 'International' THEN 600 ELSE 150 END * market * 100 AS BIGINT) / 100.0::DOUBLE
                               AS revenue
                    FROM {basic_flights} f LEFT JOIN {stg_routes} r USING (route_id)))""",
    "loyalty_accrual": """
        SELECT 'LOY' || booking_id AS loyalty_id, customer_id, booking_id, booking_date AS transaction_date,
               miles AS miles_earned,
               CAST(floor(miles * CASE fare_family WHEN 'R' THEN 1 WHEN 'N' THEN 0.5 ELSE 0 END) AS INTEGER)
                   AS miles_redeemed, 'flight' AS activity_type
        FROM (SELECT *, CAST(floor(ticket_price_usd * IF(fare_class = 'Business', 8,
                     IF(booking_channel = 'O', 5, 3))) AS INTEGER) AS miles
              FROM {bookings}) SEMI JOIN (FROM {customers} WHERE loyalty_member = 'True') USING (customer_id)""",
    "sentiment_label": """
        SELECT review_id, CAST(score * 10000 AS BIGINT) / 10000.0::DOUBLE AS score,
               IF(abs(score) <= 0.15::DOUBLE, 'neutral', IF(score > 0, 'positive', 'negative')) AS sentiment_label
        FROM (SELECT review_id, sentiment_score AS score FROM {customer_reviews})""",
    "lexicon_sentiment": f"""
        SELECT doc_id, CAST(score * 10000 AS BIGINT) / 10000.0::DOUBLE AS sentiment_score,
               IF(abs(score) <= 0.15::DOUBLE, 'neutral', IF(score > 0, 'positive', 'negative')) AS sentiment_label
        FROM (SELECT doc_id, IFNULL({mean("polarity")}, 0) AS score
              FROM {{texts}} LEFT JOIN (
                   SELECT doc_id, polarity
                   FROM (SELECT doc_id, unnest(string_split_regex(lower(text), '[^\\p{{L}}]+')) AS word FROM {{texts}})
                        JOIN {{lexicon}} USING (word)) USING (doc_id)
              GROUP BY doc_id)""",
}

# Columns shown as ISO text in the final result.
DATES = {
    "stg_bookings": ["booking_date"],
    "stg_customers": ["birth_date", "signup_date"],
    "stg_flights": ["flight_date"],
    "stg_loyalty": ["transaction_date"],
    "stg_reviews": ["review_date"],
    "stg_tickets": ["created_at"],
    "customer_revenue": ["first_booking_date", "last_booking_date"],
    "int_customer_metrics": ["first_booking_date", "last_booking_date"],
    "mart_customer_segments": ["first_booking_date", "last_booking_date"],
    "dim_customers": ["birth_date", "signup_date"],
    "fact_bookings": ["booking_date", "flight_date"],
    "fact_flights": ["flight_date"],
    "enrich_customers": ["birth_date"],
    "enrich_flights": ["flight_date"],
}

STORED_TABLES = (
    "dim_customers",
    "dim_routes",
    "dim_airports",
    "fact_bookings",
    "fact_flights",
    "mart_customer_segments",
    "mart_route_performance",
    "int_customer_metrics",
    "int_route_metrics",
)
_FEED_WIDTH = dict(zip(RAW_FEEDS, (7, 6, 14, 21, 12, 10, 11, 7)))

# Raw dates are delivered as text and stored as dates and numbers; both sides compare what is stored.
RAW_TYPES = {
    "DOUBLE": ["latitude", "longitude", "distance_km", "block_time_min", "age", "seat_capacity", "delay_minutes", "pax_boarded", "load_factor",
               "total_revenue_usd", "op_cost_usd", "fuel_cost_usd", "ticket_price_usd", "ancillary_revenue_usd", "bags_count", "rating",
               "sentiment_score", "resolution_days", "miles_earned", "miles_redeemed"],
    "DATE": ["birth_date", "signup_date", "flight_date", "booking_date", "review_date", "created_at", "transaction_date"],
    "TIMESTAMP": ["scheduled_departure", "scheduled_arrival", "actual_departure", "actual_arrival"],
    "BOOLEAN": ["loyalty_member", "is_delayed", "is_cancelled", "seat_selection_flag"],
}
_COLUMNS = {t: list(c) for t, c in RAW_COLUMNS.items()}


def stored_feed(table: str) -> str:
    """A feed with the types that its file is read with."""
    cast = {c: kind for kind, names in RAW_TYPES.items() for c in names}
    return "SELECT " + ", ".join(f"CAST({c} AS {cast[c]}) AS {c}" if c in cast else c for c in _COLUMNS[table]) + f" FROM {{{table}}}"


for _feed in RAW_FEEDS:
    VIEWS[f"stored_{_feed}"] = stored_feed(_feed)
VIEWS["ingest_raw"] = " UNION ALL ".join(
    contents_sql(f"stored_{t}").replace(f"'stored_{t}' AS", f"'{t}' AS") for t in RAW_FEEDS
) + " UNION ALL SELECT 'fare_rules', 0, 'absent', 0, '0', '0'"
VIEWS["export_tables"] = " UNION ALL ".join(contents_sql(t) for t in STORED_TABLES) + (
    " UNION ALL SELECT 'dim_fare_families', 0, 'absent', 0, '0', '0'"
)
VIEWS["grouped_summary"] = """
    SELECT revenue_total AS "réseau_revenue_total", marge_totale AS "réseau_marge_totale",
           load_factor_moyen AS "réseau_load_factor_moyen", routes_performantes AS "réseau_routes_performantes",
           total_clients AS clients_total_clients, ltv_moyenne AS clients_ltv_moyenne,
           clients_a_risque AS clients_clients_a_risque, ltv_menacee AS clients_ltv_menacee,
           revenue_ancillaire AS ancillaires_revenue_ancillaire, attach_rate_pct AS ancillaires_attach_rate_pct,
           priorite_1 AS "recommandation_priorité_1", priorite_2 AS "recommandation_priorité_2",
           priorite_3 AS "recommandation_priorité_3"
    FROM {executive_summary}"""
VIEWS["stamped_airports"] = f"SELECT airport_code AS airport_id, '{RUN_TS:%Y-%m-%d %H:%M:%S}' AS loaded_at FROM {{airports}}"
VIEWS["views_in_sql"] = """
    SELECT channel, flight_year, count(*) AS bookings, count(DISTINCT customer_id) AS customers
    FROM {stg_bookings} JOIN {stg_flights} USING (flight_id) GROUP BY ALL"""
VIEWS["report_records"] = "SELECT * FROM {upsell_by_segment}"
VIEWS["customers_today"] = """
    SELECT customer_id, (current_date - last_booking_date)::INTEGER AS days_since_last_booking FROM {int_customer_metrics}"""
VIEWS["table_profile"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, {_FEED_WIDTH[t]}::INTEGER AS column_count FROM {{{t}}}"
    for t in RAW_FEEDS
)


def check_sql(name: str) -> str:
    """One statement computing the dataset from the generated tables."""
    known = {**FEEDS, **VIEWS}
    reference = re.compile(r"\{(" + "|".join([*known, *TABLES]) + r")\}")
    order: list[str] = []

    def need(dataset: str) -> None:
        for other in reference.findall(known[dataset]):
            if other in known and other not in order:
                need(other)
                order.append(other)

    def body(dataset: str) -> str:
        return reference.sub(r"\1", known[dataset])

    need(name)
    ctes = ",\n".join(f"{d} AS ({body(d)})" for d in order)
    result = body(name)
    if name in DATES:
        as_text = ", ".join(f"CAST({d} AS VARCHAR) AS {d}" for d in DATES[name])
        result = f"SELECT * REPLACE ({as_text}) FROM ({result})"
    return (f"WITH {ctes}\n" if ctes else "") + result
