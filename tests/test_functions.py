from __future__ import annotations

import math

import pytest
from conftest import only
from pyspark.sql import functions as F

from clickshop.functions import exact_sum, one_row, ratio, round_half_away, whole_units
from clickshop.functions.numbers import HOUR, MINUTE, SECOND


def result(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("value", "digits", "rounded"),
    [
        (2.5, 0, 3.0),
        (-2.5, 0, -3.0),
        (0.125, 2, 0.13),
        (-0.125, 2, -0.13),
        (1234.5678, 2, 1234.57),
        (0.00004, 4, 0.0),
        (0.0, 2, 0.0),
    ],
)
def test_halves_round_away_from_zero(spark, value, digits, rounded):
    assert result(spark, round_half_away(F.lit(value), digits)) == rounded


def test_negative_values_never_round_to_negative_zero(spark):
    assert math.copysign(1, result(spark, round_half_away(F.lit(-0.001), 2))) == 1


def test_ratio(spark):
    assert result(spark, ratio(F.lit(1), F.lit(3), 4)) == 0.3333
    assert result(spark, ratio(F.lit(1), F.lit(0), 4)) is None
    assert result(spark, ratio(F.lit(1.5), F.lit(0.0), 4)) is None
    assert result(spark, ratio(F.lit(None).cast("bigint"), F.lit(2), 4)) is None


@pytest.mark.parametrize(
    ("micros", "seconds", "units"),
    [
        (3_600_999_999, SECOND, 3_600),
        (119_999_999, MINUTE, 1),
        (-119_999_999, MINUTE, -1),
        (-1, HOUR, 0),
    ],
)
def test_time_differences_truncate_toward_zero(spark, micros, seconds, units):
    start = 1_700_000_000_000_000
    later, earlier = F.lit(start + micros), F.lit(start)
    assert result(spark, whole_units(later, earlier, seconds)) == units


def test_exact_sum_ignores_row_order_and_null(spark):
    amounts = [0.1, 1e12, 0.2, None, -1e12, 0.3]
    for order in (amounts, amounts[::-1], sorted(amounts, key=lambda a: a or 0)):
        df = spark.createDataFrame([(a,) for a in order], "x double").repartition(3)
        assert df.agg(exact_sum(F.col("x")).alias("s")).first().s == 0.6
    nothing = spark.createDataFrame([(None,)], "x double")
    assert nothing.agg(exact_sum(F.col("x")).alias("s")).first().s is None


def test_one_row_joins_rows_side_by_side(spark):
    left = spark.range(3).agg(F.count(F.lit(1)).alias("a"))
    right = spark.range(3).agg(F.max("id").alias("b"), F.max(F.lit(None).cast("date")).alias("c"))
    assert only(one_row(left, right)) == {"a": 3, "b": 2, "c": None}


@pytest.mark.parametrize("value", [1e19, -1e19, 9.3e16, 1e300, math.inf, -math.inf])
def test_numbers_without_fraction_are_not_rounded(spark, value):
    assert result(spark, round_half_away(F.lit(value), 2)) == value


def test_nan_and_null_stay_when_rounded(spark):
    assert math.isnan(result(spark, round_half_away(F.lit(math.nan), 2)))
    assert result(spark, round_half_away(F.lit(None).cast("double"), 2)) is None


@pytest.mark.parametrize(
    ("amounts", "total"),
    [
        ([1.0, math.inf], math.inf),
        ([1.0, -math.inf, None], -math.inf),
        ([1e29, 1.0], 1e29),
        ([1e18, 1e18], 2e18),
        ([9e17] * 12, 1.08e19),
        ([1e-11, 1e-11], 0.0),
        ([1e-10, 0.1, 0.2], 0.3000000001),
        ([None], None),
    ],
)
def test_sums_of_extreme_amounts(spark, amounts, total):
    df = spark.createDataFrame([(a,) for a in amounts], "x double")
    assert df.agg(exact_sum(F.col("x"))).first()[0] == total


def test_a_sum_with_nan_is_nan(spark):
    df = spark.createDataFrame([(1.0,), (math.nan,)], "x double")
    assert math.isnan(df.agg(exact_sum(F.col("x"))).first()[0])
