"""Analytic queries on the finished tables. Every result is small: routes, segments, twenty rows or one row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.numeric import exact_mean, exact_sum, ratio, round_half_away


def _attach_rate_pct():
    """Ancillary revenue per fare revenue in percent, NULL without fares."""
    fares, ancillaries = exact_sum(F.col("fare_paid_usd")), exact_sum(F.col("ancillary_revenue_usd"))
    return round_half_away(ratio(ancillaries * 100.0, fares), 2).alias("attach_rate_pct")


def routes_ranking(route_metrics: DataFrame, dim_routes: DataFrame) -> DataFrame:
    """Routes by gross margin, best first."""
    labels = dim_routes.select(
        "route_id",
        F.concat("origin", F.lit(V.ROUTE_ARROW), "destination").alias("route"),
        F.col("route_type").alias("label_type"),
    )
    return (
        route_metrics.join(labels, "route_id")
        .orderBy(F.desc_nulls_last("gross_margin_usd"), "route_id")
        .select(
            "route",
            F.col("label_type").alias("route_type"),
            round_half_away(F.col("avg_load_factor") * 100.0, 1).alias("load_factor_pct"),
            round_half_away(F.col("total_revenue_usd")).alias("revenue_usd"),
            round_half_away(F.col("gross_margin_usd")).alias("margin_usd"),
            round_half_away(F.col("delay_rate") * 100.0, 1).alias("delay_rate_pct"),
            round_half_away(F.col("nps_proxy"), 1).alias("nps"),
        )
    )


def customers_at_risk(
    customer_metrics: DataFrame, dim_customers: DataFrame, k: int = V.AT_RISK_ROWS, min_score: int = V.AT_RISK_SCORE
) -> DataFrame:
    """The ``k`` most valuable customers with a churn score of ``min_score`` or more; ties go by customer id.

    The first ``k`` are found among the metrics alone, of customers that the dimension has, and only these meet its names.
    """
    who = dim_customers.select(
        "customer_id",
        F.concat("first_name", F.lit(" "), "last_name").alias("client"),
        F.col("segment").alias("client_segment"),
        F.col("country").alias("client_country"),
    )
    order = (F.desc_nulls_last("ltv_usd"), "customer_id")
    first = (
        customer_metrics.filter(F.col("churn_score") >= min_score)
        .select("customer_id", "ltv_usd", "churn_score", "open_tickets", "avg_rating")
        .join(dim_customers.select("customer_id"), "customer_id", "left_semi")
        .orderBy(*order)
        .limit(k)
    )
    return (
        first.join(who, "customer_id")
        .orderBy(*order)
        .limit(k)
        .select(
            "client",
            F.col("client_segment").alias("segment"),
            F.col("client_country").alias("country"),
            round_half_away(F.col("ltv_usd")).alias("ltv_usd"),
            "churn_score",
            "open_tickets",
            round_half_away(F.col("avg_rating"), 1).alias("note_moyenne"),
        )
    )


def upsell_by_segment(fact_bookings: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Bookings, fares, ancillaries and attach rate per customer segment, highest attach rate first.

    One pass over the bookings: they meet their customers' segments and are counted and summed together. The distinct
    count combines rows by (segment, booking) before the shuffle, so a large segment is spread over all tasks.
    """
    segments = dim_customers.select("customer_id", "segment")
    sales = fact_bookings.select("customer_id", "booking_id", "fare_paid_usd", "ancillary_revenue_usd")
    return (
        sales.join(segments, "customer_id")
        .groupBy("segment")
        .agg(
            F.countDistinct("booking_id").alias("total_reservations"),
            round_half_away(exact_sum(F.col("fare_paid_usd"))).alias("revenue_billets"),
            round_half_away(exact_sum(F.col("ancillary_revenue_usd"))).alias("revenue_ancillaires"),
            _attach_rate_pct(),
        )
        .orderBy(F.desc_nulls_last("attach_rate_pct"), "segment")
    )


def summary_network(route_metrics: DataFrame) -> DataFrame:
    """Network totals, mean load factor and the number of routes with a strong load."""
    load = F.col("avg_load_factor")
    return route_metrics.agg(
        round_half_away(exact_sum(F.col("total_revenue_usd"))).alias("revenue_total"),
        round_half_away(exact_sum(F.col("gross_margin_usd"))).alias("marge_totale"),
        round_half_away(exact_mean(load) * 100.0, 1).alias("load_factor_moyen"),
        F.count_if(load >= V.STRONG_LOAD_FACTOR).alias("routes_performantes"),
    )


def summary_customers(customer_metrics: DataFrame) -> DataFrame:
    """Number of customers, mean lifetime value, customers at risk and the value they stand for."""
    value, at_risk = F.col("ltv_usd"), F.col("churn_score") >= V.AT_RISK_SCORE
    return customer_metrics.agg(
        F.count(F.lit(1)).alias("total_clients"),
        round_half_away(exact_mean(value)).alias("ltv_moyenne"),
        F.count_if(at_risk).alias("clients_a_risque"),
        round_half_away(exact_sum(F.when(at_risk, value).otherwise(0.0))).alias("ltv_menacee"),
    )


def summary_ancillary(fact_bookings: DataFrame) -> DataFrame:
    """Ancillary revenue and attach rate over all bookings."""
    return fact_bookings.agg(
        round_half_away(exact_sum(F.col("ancillary_revenue_usd"))).alias("revenue_ancillaire"), _attach_rate_pct()
    )


def executive_summary(network: DataFrame, customers: DataFrame, ancillary: DataFrame) -> DataFrame:
    """The three one-row summaries side by side with three recommendation sentences."""

    def one_row(df: DataFrame):
        return df.select(F.struct("*")).scalar()

    row = network.withColumns({"_clients": one_row(customers), "_extras": one_row(ancillary)})
    return row.select(
        *network.columns,
        *[F.col("_clients")[c].alias(c) for c in customers.columns],
        *[F.col("_extras")[c].alias(c) for c in ancillary.columns],
    ).withColumns(
        {
            "priorite_1": F.format_string(V.ADVICE_RETENTION, "clients_a_risque", "ltv_menacee"),
            "priorite_2": F.format_string(V.ADVICE_ROUTES, "routes_performantes"),
            "priorite_3": F.format_string(V.ADVICE_UPSELL, F.col("attach_rate_pct").cast("string")),
        }
    )


def grouped_summary(summary: DataFrame) -> DataFrame:
    """The executive summary as one row of groups: network, customers, ancillaries and recommendations."""
    groups = {
        "réseau": ["revenue_total", "marge_totale", "load_factor_moyen", "routes_performantes"],
        "clients": ["total_clients", "ltv_moyenne", "clients_a_risque", "ltv_menacee"],
        "ancillaires": ["revenue_ancillaire", "attach_rate_pct"],
    }
    advice = F.struct(*[F.col(f"priorite_{i}").alias(f"priorité_{i}") for i in (1, 2, 3)])
    return summary.select(*[F.struct(*names).alias(g) for g, names in groups.items()], advice.alias("recommandation"))


def reports(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The four reports by name, over stored tables or a lazy warehouse; each is computed when collected."""
    route_metrics, customer_metrics = tables["int_route_metrics"], tables["int_customer_metrics"]
    sales, who = tables["fact_bookings"], tables["dim_customers"]
    return {
        "routes": routes_ranking(route_metrics, tables["dim_routes"]),
        "clients_a_risque": customers_at_risk(customer_metrics, who),
        "upsell": upsell_by_segment(sales, who),
        "resume": grouped_summary(
            executive_summary(
                summary_network(route_metrics), summary_customers(customer_metrics), summary_ancillary(sales)
            )
        ),
    }
