"""The whole warehouse: staging, metrics, star schema and marts in dependency order."""

from __future__ import annotations

import datetime as dt
import posixpath
import uuid
from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..functions import fixed_values as V
from ..operators import customers, routes, staging, star
from ..sources import storage
from ..sources.tables import bind_views, ensure_database, replace_table, write_parquet

STAGING = (
    "stg_bookings",
    "stg_customers",
    "stg_flights",
    "stg_loyalty",
    "stg_reviews",
    "stg_routes",
    "stg_tickets",
)
METRICS = ("int_customer_metrics", "int_route_metrics")
MARTS = (
    "dim_airports",
    "dim_customers",
    "dim_routes",
    "fact_bookings",
    "fact_flights",
    "mart_customer_segments",
    "mart_route_performance",
)


class Warehouse:
    """Every table as a DataFrame over the raw feeds, planned when first asked for and computed when used.

    ``as_of`` is the reporting date (today when not given), ``run_ts`` the load time stamped on the marts.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        as_of: dt.date | str | None = None,
        hub: str = V.HUB_AIRPORT,
        run_ts: dt.datetime | None = None,
    ):
        self.raw, self.as_of, self.hub, self.run_ts = raw, as_of, hub, run_ts
        self.bookings_stored = False

    def __getitem__(self, table: str) -> DataFrame:
        return getattr(self, table)

    @cached_property
    def stg_bookings(self) -> DataFrame:
        return staging.stg_bookings(self.raw["bookings"])

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw["customers"])

    @cached_property
    def stg_flights(self) -> DataFrame:
        return staging.stg_flights(self.raw["flights"])

    @cached_property
    def stg_loyalty(self) -> DataFrame:
        return staging.stg_loyalty(self.raw["loyalty_activity"])

    @cached_property
    def stg_reviews(self) -> DataFrame:
        return staging.stg_reviews(self.raw["customer_reviews"])

    @cached_property
    def stg_routes(self) -> DataFrame:
        return staging.stg_routes(self.raw["routes"])

    @cached_property
    def stg_tickets(self) -> DataFrame:
        return staging.stg_tickets(self.raw["support_tickets"])

    @cached_property
    def int_customer_metrics(self) -> DataFrame:
        return customers.int_customer_metrics(
            self.stg_customers,
            self.stg_bookings,
            self.stg_loyalty,
            self.stg_tickets,
            self.stg_reviews,
            self.as_of,
            self.bookings_stored,
        )

    @cached_property
    def int_route_metrics(self) -> DataFrame:
        return routes.int_route_metrics(
            self.stg_flights, self.stg_routes, self.stg_bookings, self.stg_reviews, self.stg_tickets
        )

    @cached_property
    def dim_airports(self) -> DataFrame:
        return star.dim_airports(self.raw["airports"], self.hub, self.run_ts)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return star.dim_customers(self.stg_customers, self.run_ts)

    @cached_property
    def dim_routes(self) -> DataFrame:
        return star.dim_routes(self.stg_routes, self.run_ts)

    @cached_property
    def fact_bookings(self) -> DataFrame:
        return star.fact_bookings(self.stg_bookings, self.stg_flights, self.run_ts)

    @cached_property
    def fact_flights(self) -> DataFrame:
        return star.fact_flights(self.stg_flights, self.stg_routes, self.run_ts)

    @cached_property
    def mart_customer_segments(self) -> DataFrame:
        return customers.mart_customer_segments(self.int_customer_metrics, self.run_ts)

    @cached_property
    def mart_route_performance(self) -> DataFrame:
        return routes.mart_route_performance(self.int_route_metrics, self.run_ts)

    def store(
        self,
        spark: SparkSession,
        location: str,
        metrics_database: str = "main_intermediate",
        marts_database: str = "main_marts",
        partition_by: Mapping[str, str] | None = None,
    ) -> dict[str, DataFrame]:
        """Bind staging as views, store metrics and marts below ``location`` and return the stored tables.

        The metric tables are stored first and the marts read them from storage, so nothing is computed twice and
        a lost executor never sends a mart back to the raw feeds. Staged bookings are written once for all that read them and
        deleted at the end. ``partition_by`` names a folder column per
        table, such as ``flight_year`` for the facts; that column then comes last.
        """
        layout = partition_by or {}
        bind_views({name: self[name] for name in STAGING})
        # the metrics and the fact read the bookings, however they are made, from one copy that goes with the job
        copy = posixpath.join(location, f"_stg_bookings-{uuid.uuid4().hex}")
        staged = self.stg_bookings
        for name in ("int_customer_metrics", "int_route_metrics", "fact_bookings"):
            self.__dict__.pop(name, None)
        stored = {}
        try:
            self.stg_bookings, self.bookings_stored = write_parquet(staged, copy), True
            for database, names in ((metrics_database, METRICS), (marts_database, MARTS)):
                folder = posixpath.join(location, database)
                ensure_database(spark, database, folder)
                for name in names:
                    stored[name] = replace_table(self[name], database, name, folder, layout.get(name))
                    setattr(self, name, stored[name])
        finally:
            self.stg_bookings, self.bookings_stored = staged, False
            storage.delete(spark, copy)
        return stored
