import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from skyledger.functions.numeric import exact_mean, exact_sum, ratio, round_half_away, round_half_even, to_int
from skyledger.functions.rules import as_of_date, band_below, band_from, flag, nps_group, sentiment_of, signal
from skyledger.functions import fixed_values as V


def values(df):
    return [r[0] for r in df.collect()]


def test_round_half_away_scales_the_binary_value(frame):
    df = frame([(1.005,), (2.5,), (-2.5,), (0.125,), (-0.125,), (None,)], "x double")
    assert values(df.select(round_half_away(F.col("x"), 2))) == [1.0, 2.5, -2.5, 0.13, -0.13, None]
    assert values(df.select(round_half_away(F.col("x")))) == [1.0, 3.0, -3.0, 0.0, 0.0, None]


def test_round_half_even(frame):
    df = frame([(0.125,), (0.375,), (-0.125,), (2.345678,)], "x double")
    assert values(df.select(round_half_even(F.col("x"), 2))) == [0.12, 0.38, -0.12, 2.35]


@pytest.mark.parametrize("kind", ["string", "double"])
def test_to_int_rounds_half_to_even(frame, kind):
    raw = [45.0, 44.5, 45.5, -44.5, 17.4]
    df = frame([(str(v) if kind == "string" else v,) for v in raw] + [(None,)], f"x {kind}")
    assert values(df.select(to_int(F.col("x")))) == [45, 44, 46, -44, 17, None]


def test_exact_sum_ignores_row_order_and_partitioning(spark):
    rng = random.Random(7)
    amounts = [round(rng.uniform(-1000, 100000), 4) for _ in range(5000)] + [1e12, 0.0001, -1e12]
    expected = math.fsum(amounts)
    for parts in (1, 3, 16):
        rng.shuffle(amounts)
        df = spark.createDataFrame([(a,) for a in amounts], "x double").repartition(parts)
        assert df.select(exact_sum(F.col("x"))).first()[0] == expected


def test_exact_sum_keeps_small_addends(spark, frame):
    df = frame([(0.123456,), (0.000001,), (None,), (7.25,)], "x double")
    assert df.select(exact_sum(F.col("x"))).first()[0] == 7.373457
    small = spark.range(1_000_000).select(F.lit(4e-7).alias("x"), F.lit(3e-13).alias("y"))
    assert tuple(small.select(exact_sum(F.col("x")), exact_sum(F.col("y"))).first()) == tuple(math.fsum([a] * 1_000_000) for a in (4e-7, 3e-13))


def test_exact_sum_and_mean_without_values(frame):
    df = frame([(None,)], "x double")
    assert tuple(df.select(exact_sum(F.col("x")), exact_mean(F.col("x"))).first()) == (None, None)


@pytest.mark.parametrize("amounts, total", [([9e18, 9e18], 1.8e19), ([8e15] * 3000, 2.4e19), ([math.inf, 1.0], math.inf), ([1e300, 1.0], 1e300)])
def test_exact_sum_beyond_longs_is_a_double_sum(frame, amounts, total):
    assert frame([(a,) for a in amounts], "x double").select(exact_sum(F.col("x"))).first()[0] == total


def test_exact_sum_and_mean_of_nan_are_nan(frame):
    df = frame([(math.nan,), (1.0,), (None,)], "x double")
    assert all(math.isnan(v) for v in df.select(exact_sum(F.col("x")), exact_mean(F.col("x"))).first())


def test_exact_mean_of_a_hot_key_matches_fsum(spark):
    df = spark.range(100_000).select((F.col("id") % 977 / 100.0).alias("x"))
    expected = math.fsum(i % 977 / 100 for i in range(100_000)) / 100_000
    assert df.select(exact_mean(F.col("x"))).first()[0] == pytest.approx(expected, rel=1e-15)


def test_ratio_guards_zero_and_null(frame):
    df = frame([(1, 4), (1, 0), (None, 2), (3, None)], "a int, b int")
    assert values(df.select(ratio(F.col("a"), F.col("b")))) == [0.25, None, None, None]


def test_bands(frame):
    ages = frame([(24.9,), (25.0,), (44.0,), (54.0,), (55.0,), (3.0,), (None,)], "x double")
    assert values(ages.select(band_below(F.col("x"), V.AGE_BANDS, V.AGE_REST))) == [
        "18-24",
        "25-34",
        "35-44",
        "45-54",
        "55+",
        "18-24",
        "55+",
    ]
    delays = frame([(14.0,), (15.0,), (59.0,), (60.0,), (179.0,), (180.0,), (None,)], "x double")
    assert values(delays.select(band_from(F.col("x"), V.DELAY_BANDS, V.DELAY_REST))) == [
        "on_time",
        "minor",
        "minor",
        "significant",
        "significant",
        "major",
        "on_time",
    ]
    km = frame([(499,), (500,), (1999,), (2000,), (None,)], "x int")
    assert values(km.select(band_below(F.col("x"), V.DISTANCE_BANDS, V.DISTANCE_REST))) == [
        "short",
        "medium",
        "medium",
        "long",
        "long",
    ]


def test_flags_are_never_null(frame):
    df = frame([("a",), ("b",), (None,)], "x string")
    assert values(df.select(flag(F.col("x") == "a"))) == [True, False, False]
    assert values(df.select(signal(F.col("x") == "a"))) == [1, 0, 0]


def test_review_and_sentiment_labels(frame):
    ratings = frame([(1,), (2,), (3,), (4,), (5,), (None,)], "x int")
    assert values(ratings.select(nps_group(F.col("x")))) == [
        "detractor",
        "detractor",
        "passive",
        "promoter",
        "promoter",
        "passive",
    ]
    scores = frame([(0.15,), (0.1500001,), (-0.15,), (-0.2,), (0.0,), (None,)], "x double")
    assert values(scores.select(sentiment_of(F.col("x")))) == [
        "neutral",
        "positive",
        "neutral",
        "negative",
        "neutral",
        "neutral",
    ]


def test_as_of_accepts_dates_texts_and_columns(spark):
    one = spark.range(1)
    for given in (dt.date(2024, 11, 30), "2024-11-30", F.lit("2024-11-30")):
        assert one.select(F.add_months(as_of_date(given), -9)).first()[0] == dt.date(2024, 2, 29)
    assert one.select(as_of_date(None) == F.current_date()).first()[0]
