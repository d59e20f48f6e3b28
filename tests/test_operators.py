"""Edge rows, worked out by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import rows as R
from skyledger.functions import fixed_values as V
from skyledger.operators import customers, enrich, routes
from skyledger.plans import serving
from skyledger.plans.warehouse import Warehouse


@pytest.fixture(scope="module")
def wh(spark):
    return Warehouse(R.raw_feeds(spark), R.AS_OF)


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_staging_drops_rows_without_key(wh):
    sizes = {name: wh[name].count() for name in ("stg_bookings", "stg_customers", "stg_flights", "stg_routes")}
    assert sizes == {"stg_bookings": 7, "stg_customers": 4, "stg_flights": 7, "stg_routes": 4}
    assert (wh.stg_reviews.count(), wh.stg_tickets.count(), wh.stg_loyalty.count()) == (5, 5, 3)


def test_staging_labels(wh):
    ages = by(wh.stg_customers, "customer_id")
    assert {k: v["age_group"] for k, v in ages.items()} == {"C1": "18-24", "C2": "25-34", "C3": "55+", "C4": "55+"}
    delays = by(wh.stg_flights, "flight_id")
    assert {k: delays[k]["delay_category"] for k in ("F1", "F2", "F3", "F4", "F5")} == {
        "F1": "minor",
        "F2": "on_time",
        "F3": "major",
        "F4": "on_time",
        "F5": "significant",
    }
    assert (delays["F1"]["gross_margin_usd"], delays["F1"]["flight_year"], delays["F1"]["flight_month_num"]) == (
        350.0,
        2024,
        5,
    )
    assert {r["route_id"]: r["is_strategic"] for r in wh.stg_routes.collect()} == {
        "R1": True,
        "R2": False,
        "R3": False,
        "R4": True,
    }
    assert {r["ticket_id"]: r["is_open"] for r in wh.stg_tickets.collect()}["T4"] is False
    assert {r["loyalty_id"]: r["miles_net"] for r in wh.stg_loyalty.collect()} == {"L1": 500, "L2": 125, "L3": None}
    cancelled = [(r["booking_id"], r["is_cancelled"]) for r in wh.stg_bookings.collect()]
    assert ("B2", True) in cancelled and ("B6", False) in cancelled


def test_customer_revenue_is_the_same_when_counted_apart(wh):
    together, apart = (customers.customer_revenue(wh.stg_bookings, R.AS_OF, apart=a) for a in (False, True))
    assert apart.columns == together.columns
    assert sorted(map(str, apart.collect())) == sorted(map(str, together.collect()))


def test_customer_revenue_counts_distinct_ids_and_keeps_the_unknown_customer(wh):
    got = by(customers.customer_revenue(wh.stg_bookings, R.AS_OF), "customer_id")
    assert set(got) == {"C1", "C2", "C3", None}
    one = got["C1"]
    assert (one["total_bookings"], one["total_flights"]) == (2, 2)
    assert (one["total_fare_revenue"], one["avg_fare_paid"]) == (201.0, 67.0)
    assert (one["bookings_recent"], one["bookings_older"], one["business_flights"]) == (2, 1, 1)
    assert (one["first_booking_date"], one["last_booking_date"]) == (dt.date(2024, 3, 30), dt.date(2024, 6, 1))
    assert (got["C2"]["total_bookings"], got["C2"]["total_flights"]) == (2, 1)
    assert (got[None]["total_bookings"], got[None]["total_flights"]) == (1, 1)


def test_customer_metrics(wh):
    got = by(wh.int_customer_metrics, "customer_id")
    assert len(wh.int_customer_metrics.columns) == 29
    assert set(got) == {"C1", "C2", "C3", "C4"}

    assert got["C1"]["ltv_usd"] == 216.0
    assert got["C1"]["ancillary_attach_rate"] == 0.0746
    assert (got["C1"]["avg_rating"], got["C1"]["avg_review_sentiment"]) == (1.5, 0.175)
    signals = ("churn_signal_flight_drop", "churn_signal_open_tickets", "churn_signal_low_rating", "churn_score")
    assert [got["C1"][s] for s in signals] == [0, 1, 1, 2]
    assert [got["C2"][s] for s in signals] == [1, 0, 0, 1]
    assert got["C1"]["days_since_last_booking"] == 213
    assert (got["C1"]["total_miles_earned"], got["C1"]["total_miles_redeemed"]) == (750, 125)

    assert (got["C3"]["ancillary_attach_rate"], got["C3"]["ltv_usd"]) == (0.0, 7.0)
    assert (got["C3"]["avg_rating"], got["C3"]["churn_signal_low_rating"]) == (0.0, 0)

    nobody = got["C4"]
    assert nobody["last_booking_date"] is None and nobody["days_since_last_booking"] is None
    assert [nobody[c] for c in ("ltv_usd", "total_bookings", "avg_fare_paid", "open_tickets", "avg_rating")] == [0] * 5
    assert [nobody[s] for s in signals] == [0, 0, 0, 0]


def test_churn_drop_is_strict(spark, wh):
    def bookings(recent, older):
        days = [dt.date(2024, 12, 1)] * recent + [dt.date(2020, 1, 1)] * older
        rows = [R._booking(f"B{i}", "C1", "F1", 1.0, day=d) for i, d in enumerate(days)]
        return Warehouse({**R.raw_feeds(spark), "bookings": R.feed(spark, "bookings", rows)}, R.AS_OF)

    for recent, older, expected in ((3, 5, 0), (2, 5, 1), (0, 1, 1), (1, 0, 0), (6, 10, 0), (5, 10, 1)):
        got = by(bookings(recent, older).int_customer_metrics, "customer_id")["C1"]
        assert (recent, older, got["churn_signal_flight_drop"]) == (recent, older, expected)


def test_route_metrics(wh):
    got = by(wh.int_route_metrics, "route_id")
    assert len(wh.int_route_metrics.columns) == 27
    assert set(got) == {"R1", "R2", "R3"}

    one = got["R1"]
    assert (one["total_flights"], one["operated_flights"], one["total_pax"]) == (3, 1, 100)
    assert (one["total_revenue_usd"], one["total_ancillary_usd"]) == (201.0, 15.0)
    assert (one["total_op_cost_usd"], one["gross_margin_usd"]) == (124.62, 76.38)
    assert (one["delay_rate"], one["cancellation_rate"], one["avg_delay_minutes"]) == (0.3333, 0.3333, 20.0)
    assert (one["yield_per_pax_usd"], one["margin_per_flight_usd"]) == (2.01, 76.38)
    assert (one["avg_sentiment"], one["avg_rating"], one["review_count"]) == (0.45, 2.67, 3)
    assert one["nps_proxy"] == -33.3
    assert [one[c] for c in routes.TICKETS] == [3, 1, 1, 0]

    passive = got["R2"]
    assert (passive["nps_proxy"], passive["review_count"], passive["avg_rating"]) == (None, 2, 3.0)
    assert (passive["total_revenue_usd"], passive["yield_per_pax_usd"]) == (0.0, None)

    silent = got["R3"]
    assert (silent["avg_sentiment"], silent["review_count"], silent["nps_proxy"]) == (None, 0, None)
    assert [silent[c] for c in routes.TICKETS] == [1, 0, 0, 1]


def test_route_parts_agree_with_the_whole(wh):
    whole = by(wh.int_route_metrics, "route_id")
    revenue = by(routes.route_revenue(wh.stg_bookings, wh.stg_flights), "route_id")
    mood = by(routes.route_sentiment(wh.stg_reviews, wh.stg_flights), "route_id")
    help_desk = by(routes.route_tickets(wh.stg_tickets, wh.stg_flights), "route_id")
    operations = by(routes.route_ops(wh.stg_flights), "route_id")
    assert set(operations) == {"R1", "R2", "R3", "R9", None}
    assert (set(revenue), set(mood), set(help_desk)) == ({"R1", "R2", "R3"}, {"R1", "R2"}, {"R1", "R3"})
    for route, row in whole.items():
        assert row["total_flights"] == operations[route]["total_flights"]
        assert row["total_revenue_usd"] == round(revenue[route]["total_revenue"], 2)
        assert row["review_count"] == mood.get(route, {"review_count": 0})["review_count"]
        assert row["ticket_count"] == help_desk.get(route, {"ticket_count": 0})["ticket_count"]


def test_repeated_flight_rows_count_their_bookings_each_time(spark, wh):
    twice = R.FLIGHTS + [R._flight("F1", "R1"), R._flight("F1", "R2")]
    got = by(
        Warehouse({**R.raw_feeds(spark), "flights": R.feed(spark, "flights", twice)}, R.AS_OF).int_route_metrics,
        "route_id",
    )
    assert got["R1"]["total_revenue_usd"] == 201.0 + 150.5
    assert got["R2"]["total_revenue_usd"] == 150.5
    assert got["R2"]["review_count"] == 2 + 3


def test_facts_keep_their_grain(wh):
    bookings = wh.fact_bookings.collect()
    assert len(bookings) == wh.stg_bookings.count() == 7
    unknown = [r for r in bookings if r["flight_id"] in ("F9", None)]
    assert [r["route_id"] for r in unknown] == [None, None]
    assert wh.fact_flights.count() == wh.stg_flights.count() == 7
    flights = by(wh.fact_flights, "flight_id")
    assert (flights["F6"]["origin"], flights["F6"]["is_strategic"]) == (None, None)
    assert (flights["F1"]["origin"], flights["F1"]["destination"]) == ("ABJ", "CDG")


def test_dimensions(wh):
    labels = by(wh.dim_routes, "route_id")
    assert {k: (v["route_label"], v["distance_category"]) for k, v in labels.items()} == {
        "R1": ("ABJ → CDG", "long"),
        "R2": (None, "short"),
        "R3": ("ABJ → DKR", "medium"),
        "R4": ("ABJ → LOS", "long"),
    }
    tiers = by(wh.dim_customers, "customer_id")
    assert (tiers["C1"]["loyalty_tier_clean"], tiers["C2"]["loyalty_tier_clean"]) == ("Gold", V.NO_TIER)
    hubs = by(wh.dim_airports, "airport_id")
    assert {k: v["is_hub"] for k, v in hubs.items()} == {"ABJ": True, "CDG": False, None: False}


def test_load_time_is_stamped(spark):
    when = dt.datetime(2024, 12, 31, 6, 0)
    wh = Warehouse(R.raw_feeds(spark), R.AS_OF, run_ts=when)
    for name in ("dim_airports", "dim_customers", "dim_routes", "fact_bookings", "fact_flights"):
        assert wh[name].columns[-1] == "updated_at"
        assert {r["updated_at"] for r in wh[name].collect()} == {when}
    assert wh.mart_customer_segments.columns[-1] == wh.mart_route_performance.columns[-1] == "updated_at"
    assert (len(wh.mart_customer_segments.columns), len(wh.mart_route_performance.columns)) == (30, 27)


def test_invariants(wh):
    score = F.expr("churn_signal_flight_drop + churn_signal_open_tickets + churn_signal_low_rating")
    assert wh.int_customer_metrics.filter(score != F.col("churn_score")).count() == 0
    gap = F.abs(F.col("total_op_cost_usd") + F.col("gross_margin_usd") - F.col("total_revenue_usd"))
    assert wh.int_route_metrics.filter(gap > 0.01).count() == 0


def test_reports(wh):
    reports = serving.reports(wh)
    ranking = [r["route"] for r in reports["routes"].collect()]
    assert ranking == ["ABJ → CDG", "ABJ → DKR", None]
    at_risk = [r.asDict() for r in reports["clients_a_risque"].collect()]
    assert at_risk == [
        {
            "client": "Awa Koné",
            "segment": "Business",
            "country": "Ghana",
            "ltv_usd": 216.0,
            "churn_score": 2,
            "open_tickets": 2,
            "note_moyenne": 1.5,
        }
    ]
    upsell = [tuple(r) for r in reports["upsell"].collect()]
    assert upsell == [("Budget", 3, 100.0, 17.0, 17.0), ("Business", 2, 201.0, 15.0, 7.46)]
    resume = reports["resume"].first().asDict(recursive=True)
    assert list(resume) == ["réseau", "clients", "ancillaires", "recommandation"]
    assert resume["recommandation"] == {
        "priorité_1": "Rétention — 1 clients à risque, 216.0$ menacés",
        "priorité_2": "Routes — 3 routes performantes à développer",
        "priorité_3": "Upsell — attach rate actuel 10.57% vs 15-20% benchmark",
    }
    assert resume["réseau"]["revenue_total"] == 231.0
    assert (resume["clients"]["total_clients"], resume["ancillaires"]["revenue_ancillaire"]) == (4, 35.0)


def test_attach_rate_without_fares(spark, wh):
    free = R.feed(spark, "bookings", [R._booking("B1", "C1", "F1", 0.0, 5.0)])
    only = Warehouse({**R.raw_feeds(spark), "bookings": free}, R.AS_OF)
    assert serving.summary_ancillary(only.fact_bookings).first()["attach_rate_pct"] is None


def test_top_k_breaks_ties_by_customer(frame):
    rows = [(f"C{i:02d}", 100.0 if i < 30 else 500.0, 2, 0, 1.0) for i in range(32)]
    metrics = frame(
        rows, "customer_id string, ltv_usd double, churn_score int, open_tickets long, avg_rating double"
    )
    people = frame(
        [(r[0], r[0], "x", "s", "c") for r in rows],
        "customer_id string, first_name string, last_name string, segment string, country string",
    )
    names = [r["client"][:3] for r in serving.customers_at_risk(metrics.repartition(7), people).collect()]
    assert names == ["C30", "C31"] + [f"C{i:02d}" for i in range(18)]


def test_enrich_customers_fills_only_missing_columns(frame):
    df = frame(
        [
            ("a", "Business", "Gold", "1990-01-01"),
            ("b", "PREMIUM", None, "not a date"),
            ("c", None, None, "2000-12-31"),
        ],
        "customer_id string, customer_segment string, loyalty_tier string, birth_date string",
    )
    got = enrich.enrich_customers(df, "2024-12-31")
    assert got.columns == [
        "customer_id",
        "segment",
        "loyalty_tier",
        "birth_date",
        "preferred_cabin",
        "loyalty_member",
        "age",
    ]
    assert [(r["preferred_cabin"], r["loyalty_member"], r["age"]) for r in got.orderBy("customer_id").collect()] == [
        ("business", True, 35),
        ("business", False, None),
        ("economy", False, 24),
    ]
    complete = got.withColumn("age", F.lit(99)).withColumn("preferred_cabin", F.lit("first"))
    assert enrich.enrich_customers(complete, "2030-01-01").collect() == complete.collect()


def test_enrich_flights_estimates(frame):
    flights = frame(
        [("F1", "R1", 101, "Flight DELAYED", 7), ("F2", "R9", 200, "cancelled", 0), ("F3", "R1", 0, None, 0)],
        "flight_id string, route_id string, seat_capacity int, flight_status string, delay_min int",
    )
    legs = frame([("R1", 350, "Domestic")], "route_id string, distance_km int, route_type string")
    enriched = enrich.enrich_flights(flights, legs)
    assert enriched.columns == [
        "flight_id",
        "route_id",
        "seat_capacity",
        "flight_status",
        "delay_minutes",
        "distance_km",
        "route_type",
        "total_revenue_usd",
        "op_cost_usd",
        "fuel_cost_usd",
        "pax_boarded",
        "load_factor",
        "is_delayed",
        "is_cancelled",
    ]
    got = by(enriched, "flight_id")
    one = got["F1"]
    assert (one["pax_boarded"], one["total_revenue_usd"], one["op_cost_usd"]) == (78, 7020.0, 4563.0)
    assert (one["fuel_cost_usd"], one["load_factor"], one["delay_minutes"]) == (1916.46, 0.7723, 7)
    assert (one["is_delayed"], one["is_cancelled"]) == (True, False)
    assert (got["F2"]["total_revenue_usd"], got["F2"]["route_type"], got["F2"]["is_cancelled"]) == (23400.0, None, True)
    assert (got["F3"]["load_factor"], got["F3"]["is_delayed"]) == (None, None)


def test_enrich_flights_prefers_the_route_and_keeps_given_money(frame):
    flights = frame(
        [("F1", "R1", 1, "x", 5.0, True, 3), ("F2", "R9", 2, "y", 6.0, None, 4)],
        "flight_id string, route_id string, distance_km int, route_type string, total_revenue_usd double, "
        "is_delayed boolean, delay_minutes int",
    )
    legs = frame([("R1", 350, "Domestic")], "route_id string, distance_km int, route_type string")
    got = enrich.enrich_flights(flights, legs)
    assert got.columns == flights.columns
    assert sorted(tuple(r) for r in got.collect()) == [
        ("F1", "R1", 350, "Domestic", 5.0, True, 3),
        ("F2", "R9", 2, "y", 6.0, None, 4),
    ]


def test_loyalty_accrual(frame):
    people = frame([("C1", "True"), ("C2", "False"), ("C3", "True")], "customer_id string, loyalty_member string")
    sales = frame(
        [("B1", "C1", 99.99, "2024-01-02"), ("B2", "C1", None, "2024-01-03"), ("B3", "C2", 10.0, "2024-01-04")],
        "booking_id string, customer_id string, ticket_price_usd double, booking_date string",
    )
    got = sorted(tuple(r) for r in enrich.loyalty_accrual(people, sales, 3, 0.5).collect())
    assert got == [
        ("LOYB1", "C1", "B1", "2024-01-02", 299, 149, "flight"),
        ("LOYB2", "C1", "B2", "2024-01-03", None, None, "flight"),
    ]
    unpriced = enrich.loyalty_accrual(people, sales.drop("ticket_price_usd"), 8)
    assert {r["miles_earned"] for r in unpriced.collect()} == {800}


def test_sentiment_label_looks_at_the_unrounded_score(frame):
    got = enrich.sentiment_label(frame([(0.15001,), (0.15,), (-0.15004,)], "score double"), "score")
    assert [tuple(r) for r in got.collect()] == [(0.15, "positive"), (0.15, "neutral"), (-0.15, "negative")]


def test_lexicon_sentiment(frame):
    texts = frame(
        [(1, "Good, good food... BAD seat"), (2, "nothing here"), (3, ""), (4, None), (5, "bad-bad")],
        "id long, body string",
    )
    words = frame([("good", 0.7), ("bad", -0.7), ("great", 0.8)], "word string, polarity double")
    got = sorted(tuple(r) for r in enrich.lexicon_sentiment(texts, words, "id", "body").collect())
    assert got == [
        (1, 0.2333, "positive"),
        (2, 0.0, "neutral"),
        (3, 0.0, "neutral"),
        (4, 0.0, "neutral"),
        (5, -0.7, "negative"),
    ]
