"""Column rules shared by the operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V


def as_of_date(as_of: dt.date | str | Column | None) -> Column:
    """The reporting date as a column; today when not given."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    return F.lit(str(as_of)).cast("date")


def band_below(x: Column, bands: Sequence[tuple[float, str]], rest: str) -> Column:
    """Label of the first band whose upper bound exceeds ``x``; ``rest`` for larger or NULL values."""
    return _first_match(((x < bound, label) for bound, label in bands), rest)


def band_from(x: Column, bands: Sequence[tuple[float, str]], rest: str) -> Column:
    """Label of the first band whose lower bound ``x`` reaches; ``rest`` for smaller or NULL values."""
    return _first_match(((x >= bound, label) for bound, label in bands), rest)


def _first_match(arms, rest: str) -> Column:
    chain = F
    for condition, label in arms:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(rest))


def flag(condition: Column) -> Column:
    """The condition as a boolean that is false, not NULL, where it cannot be decided."""
    return F.coalesce(condition, F.lit(False))


def signal(condition: Column) -> Column:
    """The condition as 1 or 0."""
    return flag(condition).cast("int")


def nps_group(rating: Column) -> Column:
    return (
        F.when(rating >= V.PROMOTER_MIN_RATING, F.lit("promoter"))
        .when(rating <= V.DETRACTOR_MAX_RATING, F.lit("detractor"))
        .otherwise(F.lit("passive"))
    )


def sentiment_of(score: Column) -> Column:
    """Positive above +0.15, negative below -0.15, neutral on the bounds and between them."""
    return (
        F.when(score > V.POSITIVE_ABOVE, F.lit("positive"))
        .when(score < V.NEGATIVE_BELOW, F.lit("negative"))
        .otherwise(F.lit("neutral"))
    )


def add_missing(df, **columns: Column):
    """Add each column the frame does not have yet; the choice is made on the schema, before any job runs."""
    return df.withColumns({name: c for name, c in columns.items() if name not in df.columns})


def stamped(df, run_ts: dt.datetime | Column | None):
    """Append the load time ``updated_at``."""
    when = F.current_timestamp() if run_ts is None else run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    return df.withColumn("updated_at", when)
