"""Rounding on the binary value, against Python's own."""

import math
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegauge.functions.rounding import round_binary


def rounded(spark, numbers, digits=4):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(numbers)], "i int, x double")
    got = df.select("i", round_binary(F.col("x"), digits).alias("r")).orderBy("i")
    return [r["r"] for r in got.collect()]


def test_ties(spark):
    """Numbers whose printed decimal lies halfway; they are stored a little beside it, or on it."""
    dice = random.Random(5)
    numbers = [n / 100000 for n in range(-5000, 5000) if n % 10 == 5]
    numbers += [dice.randrange(10**9) / 10**4 + 0.00005 for _ in range(3000)]
    numbers += [n + 0.03125 for n in range(50)] + [n + 0.5 for n in range(5)]
    expected = [round(x, 4) for x in numbers]
    assert rounded(spark, numbers) == expected
    # The printed decimal alone would give other results.
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    printed = [r[0] for r in df.select(F.round("x", 4)).collect()]
    assert printed != expected


def test_ends_of_the_range(spark):
    numbers = [0.0, 1e-300, -1e-300, 4.5e11 + 0.00004, 450359962737.0496, 1e15 + 0.3, 1.5e300, -1.5e300,
               math.inf, -math.inf, None, 5e-5, 0.00015, 0.00025]
    expected = [None if x is None else round(x, 4) if math.isfinite(x) else x for x in numbers]
    assert rounded(spark, numbers) == expected
    assert math.isnan(rounded(spark, [math.nan])[0])


def test_where_doubles_become_sparse(spark):
    """Around 2 ** 52 and 2 ** 53 scaled units, where halves and then units are no doubles."""
    dice = random.Random(6)
    numbers = []
    for bits in (50, 51, 52, 53, 54):
        numbers += [dice.uniform(0.999, 1.001) * 2.0**bits / 10**4 for _ in range(1500)]
        numbers += [-x for x in numbers[-200:]]
    assert rounded(spark, numbers) == [round(x, 4) for x in numbers]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e13, 1e13), min_size=1, max_size=200), st.integers(0, 6))
def test_any_number(spark, numbers, digits):
    assert rounded(spark, numbers, digits) == [round(x, digits) for x in numbers]
