import math
import random
from datetime import datetime
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillstream.functions import (
    iso_text,
    money_sum,
    order_time_text,
    two_places,
    within_trailing,
    zero_if_missing,
)

few = settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@few
@given(st.lists(st.datetimes(datetime(1900, 1, 1), datetime(2200, 1, 1)), min_size=1, max_size=30))
def test_iso_text_is_pythons(spark, moments):
    rows = spark.createDataFrame([(m.isoformat(),) for m in moments], "text string")
    got = [r[0] for r in rows.select(iso_text(F.to_timestamp("text"))).collect()]
    assert got == [m.isoformat() for m in moments]


def test_time_text_falls_back_to_what_was_sent(spark):
    rows = spark.createDataFrame([("2024-01-01 00:00:00",), ("soon",), (None,)], "text string")
    text = order_time_text(F.try_to_timestamp("text"), F.col("text"))
    assert [r[0] for r in rows.select(text).collect()] == ["2024-01-01T00:00:00", "soon", None]


cents = st.integers(-10**12, 10**12)


@few
@given(st.lists(cents, min_size=1, max_size=60))
@example([1, 6921245604])
@example([-1, -6921245604, 10**14 - 1, 1])
def test_money_sum_is_exact(spark, amounts):
    rows = spark.createDataFrame([(a / 100,) for a in amounts], "x double")
    (got,) = rows.repartition(5).agg(money_sum(F.col("x"))).first()
    assert got == float(Fraction(sum(amounts), 100))


def test_money_sum_of_many_cents_at_once(spark):
    rng = random.Random(11)
    groups = [[rng.randrange(-(10 ** rng.randrange(1, 15)), 10 ** rng.randrange(1, 15)) for _ in range(rng.randrange(1, 30))] for _ in range(2_000)]
    rows = spark.createDataFrame([(g, a / 100) for g, amounts in enumerate(groups) for a in amounts], "g int, x double")
    got = {r[0]: r[1] for r in rows.repartition(5).groupBy("g").agg(money_sum(F.col("x"))).collect()}
    assert all(got[g] == float(Fraction(sum(amounts), 100)) for g, amounts in enumerate(groups))


def test_money_sum_over_many_partitions_of_large_amounts(spark):
    # A sum of doubles, in any order, is off by more than a cent here.
    rows = spark.range(0, 300_000, 1, 32).select((F.col("id") + 1e12 + 0.01).alias("x"))
    (got,) = rows.agg(money_sum(F.col("x"))).first()
    exact = Fraction(300_000 * 299_999, 2) + 300_000 * (10**12 + Fraction(1, 100))
    # 1e12 + .01 itself is only stored to 1e-4.
    assert abs(Fraction(got) - exact) < 50


def test_money_sum_passes_the_range_of_a_long(spark):
    rows = spark.range(0, 100_000, 1, 8).select(F.lit(9e14).alias("x"))
    assert rows.agg(money_sum(F.col("x"))).first()[0] == 9e19


def test_money_sum_of_tiny_amounts(spark):
    rows = spark.range(0, 1000, 1, 7).select(F.lit(0.00004).alias("x"))
    assert rows.agg(money_sum(F.col("x"))).first()[0] == 0.04


@pytest.mark.parametrize(
    "amounts, total",
    [
        ([10.0, 1e15], 1e15 + 10),
        ([1e300, 1.0], 1e300),
        ([10.0, math.inf], math.inf),
        ([None, 2.5], 2.5),
        ([-0.25, -(2.0**42)], -(2.0**42) - 0.25),
    ],
)
def test_money_sum_drops_no_amount(spark, amounts, total):
    rows = spark.createDataFrame([(a,) for a in amounts], "x double")
    assert rows.agg(money_sum(F.col("x"))).first()[0] == total


def test_money_sum_without_amounts(spark):
    rows = spark.createDataFrame([(None,)], "x double")
    assert rows.agg(money_sum(F.col("x"))).first()[0] is None
    assert rows.limit(0).agg(money_sum(F.col("x"))).first()[0] is None
    rows = spark.createDataFrame([(10.0,), (math.nan,)], "x double")
    assert math.isnan(rows.agg(money_sum(F.col("x"))).first()[0])


def test_shown_numbers(spark):
    rows = spark.createDataFrame([(None, None), (3, 1.005), (4, 2.345)], "n long, x double")
    shown = rows.select(zero_if_missing(F.col("n")), two_places(F.col("x"))).collect()
    assert [tuple(r) for r in shown] == [(0, 0.0), (3, 1.01), (4, 2.35)]


@pytest.mark.parametrize(
    "text, inside",
    [
        ("2024-01-01 00:00:00", True),
        ("2023-12-31 23:59:59.999999", False),
        ("2024-01-01 00:01:00", True),
        ("2024-01-01 00:01:00.000001", False),
    ],
)
def test_trailing_minute_includes_both_ends(spark, text, inside):
    moment = F.to_timestamp(F.lit(text))
    as_of = F.to_timestamp(F.lit("2024-01-01 00:01:00"))
    assert spark.range(1).select(within_trailing(moment, as_of)).first()[0] is inside
