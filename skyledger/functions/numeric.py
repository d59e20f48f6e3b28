"""Number handling that gives one answer whatever the partitioning."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_FINE, _FINEST = float(1 << 30), float(1 << 60)


def round_half_away(x: Column, digits: int = 0) -> Column:
    """Round a double to ``digits`` places, halves away from zero, by scaling the binary value.

    ``F.round(x, n)`` rounds the decimal text of the value instead and differs on ties such as 1.005.
    """
    if digits == 0:
        return F.round(x)
    scale = float(10**digits)
    return F.round(x * scale) / scale


def round_half_even(x: Column, digits: int = 0) -> Column:
    """Round a double to ``digits`` places, halves to even."""
    scale = float(10**digits)
    return F.rint(x * scale) / scale


def to_int(c: Column) -> Column:
    """Cast a number or numeric text to int, rounding half to even; a plain cast would truncate."""
    return F.rint(c.cast("double")).cast("int")


def exact_sum(x: Column) -> Column:
    """Sum of a double column, the same for every row order, task count and retry.

    A double sum changes in its last bits with the order of the rows, which can flip a rounded cent. Here every addend
    is cut, without rounding, into whole units, 2^-30ths and 2^-60ths; the parts are summed as longs, which no order
    changes, and put together as the nearest double. What is finer than that is summed as doubles, and so is what longs
    cannot hold: groups with NaN, an infinity or an addend of 2^53 and more, or whose total passes 9e18 units.
    """
    # NaN is above every number, so this is false for it too
    held = F.when(F.abs(x) < float(1 << 53), x)
    whole = F.rint(held)
    fine = F.rint((held - whole) * _FINE)
    finest = F.rint((held - whole - fine / _FINE) * _FINEST)
    rest = held - whole - fine / _FINE - finest / _FINEST
    units, thirtieths, sixtieths = (F.try_sum(c.cast("long")).cast("decimal(20,0)") for c in (whole, fine, finest))
    parts = units * F.lit(Decimal(1 << 60)) + thirtieths * F.lit(Decimal(1 << 30)) + sixtieths
    plain = F.max(F.abs(x)) >= float(1 << 53)
    return F.when(plain, F.sum(x)).otherwise(F.coalesce(parts.cast("double") / _FINEST + F.sum(rest), F.sum(x)))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient, NULL where the denominator is zero or NULL."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def exact_mean(x: Column) -> Column:
    """Mean on top of :func:`exact_sum`; NULL when no value is present."""
    return ratio(exact_sum(x), F.count(x))
