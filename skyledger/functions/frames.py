"""Joins that stay divisible, and a filter in front of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join in which Spark may split a hot key.

    Spark splits a large partition of a join only if a shuffle made for this join feeds both sides. A side that is
    already dealt by the key, such as the result of an aggregate, would be joined in place, so the key gets a further
    column, its hash, by which neither side is dealt yet. A NULL key matches nothing, as in any join.
    """
    tag = F.xxhash64(*on)
    return left.withColumn("_tag", tag).join(right.withColumn("_tag", tag), [*on, "_tag"], how).drop("_tag")


#: Bits of the table that keys pass before they are shuffled (128 KB): of keys that are not among 100,000 known ones, one in
#: eleven passes.
FILTER_BITS = 1 << 20


def may_hold(known: DataFrame, key: str) -> Callable[[Column], Column]:
    """Whether a value may be among those of column ``key``, by a table of bits that are set at the hashes of the known ones.

    The table is one value of FILTER_BITS, so it can go to every task, however many keys are known.
    """
    place = lambda value: F.pmod(F.xxhash64(value), F.lit(FILTER_BITS))
    bit = lambda at: F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
    entry = lambda at: F.shiftright(at, 6).cast("int")
    marks = known.select(place(F.col(key)).alias("at"))
    marks = marks.groupBy(entry(F.col("at")).alias("entry")).agg(F.bit_or(bit(F.col("at"))).alias("held"))
    every = known.sparkSession.range(FILTER_BITS // 64).select(F.col("id").cast("int").alias("entry"))
    rows = F.array_sort(F.collect_list(F.struct("entry", F.coalesce("held", F.lit(0).cast("long")).alias("held"))))
    table = every.join(marks, "entry", "left").agg(rows.getField("held").alias("table")).scalar()
    return lambda value: F.get(table, entry(place(value))).bitwiseAND(bit(place(value))) != 0


def zero_if_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """The frame with NULL as 0 in some columns; NaN stays, which ``fillna`` would replace too."""
    return df.withColumns({c: F.coalesce(c, F.lit(0).cast(df.schema[c].dataType)) for c in columns})
