"""A stable pseudo-random order inside groups, and running totals along it without one task for a group."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK_BITS = 52
#: Rows that a bucket is meant to hold; the number of buckets follows the number of rows.
BUCKET_ROWS = 256


def rank(salt: str, *keys: Column) -> Column:
    """A number below 2^52 that follows from the keys alone, the same in every run; a null is an empty key."""
    text = F.concat_ws("|", F.lit(salt), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, RANK_BITS // 4), 16, 10).cast("long")


@dataclass
class Buckets:
    """The range of ranks cut into 2^bits buckets, with totals of every group's buckets."""

    bits: int
    totals: DataFrame


def _cut(col: Column, bits: int) -> Column:
    return F.shiftright(col, RANK_BITS - bits)


def bucket_totals(df: DataFrame, rows: int, group: str, order: str, amount: str) -> Buckets:
    """For each (group, bucket) the amount in it (``held``) and in the group's buckets before it (``before``).

    The buckets of a group are summed in two steps, within ranges of buckets and over the ranges, so that no task holds
    more than about the square root of their number.
    """
    bits = max((rows // BUCKET_ROWS).bit_length(), 1)
    half = bits // 2
    held = df.groupBy(group, _cut(F.col(order), bits).alias("bucket")).agg(F.sum(amount).alias("held"))
    held = held.withColumn("range", F.shiftright("bucket", half))
    ranges = held.groupBy(group, "range").agg(F.sum("held").alias("in_range"))
    earlier = Window.partitionBy(group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(F.col(group).alias("_g"), F.col("range").alias("_range"), F.coalesce(F.sum("in_range").over(earlier), F.lit(0)).alias("range_before"))
    inside = Window.partitionBy(group, "range").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("inside", F.coalesce(F.sum("held").over(inside), F.lit(0)))
    joined = held.join(ranges, held[group].eqNullSafe(ranges["_g"]) & (held["range"] == ranges["_range"]))
    return Buckets(bits, joined.select(group, "bucket", "held", (F.col("inside") + F.col("range_before")).alias("before")))


def running(df: DataFrame, buckets: Buckets, group: str, order: str, ties: list[str], amount: str, into: str) -> DataFrame:
    """df with the group's amount before each row, in the order of ``order`` and then ``ties``, as column ``into``.

    Columns of ``buckets.totals`` beyond its own are added too. Rows equal in order and ties are put in any order.
    """
    df = df.withColumn("_bucket", _cut(F.col(order), buckets.bits))
    own = Window.partitionBy(group, "_bucket").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_inside", F.coalesce(F.sum(amount).over(own), F.lit(0)))
    totals = buckets.totals.withColumnsRenamed({group: "_g", "bucket": "_b", "before": "_before"}).drop("held")
    df = df.join(totals, df[group].eqNullSafe(totals["_g"]) & (F.col("_bucket") == F.col("_b")))
    return df.withColumn(into, F.col("_inside") + F.col("_before")).drop("_inside", "_before", "_bucket", "_b", "_g")
