"""JVM-side fixed-point text equals Python's formatting exactly."""

import math
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from gridcast.functions.display import fixed, py_format

TIES = [0.125, 0.375, 2.675, 6.55, 1.005, 0.5, 1.5, 2.5, 0.05, 0.15, 0.25, 0.35, 1.45, 80.005, 29.995, 1e-9, 0.0, -0.125, -6.55, 123456.785]


def _check(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    out = df.select("x", fixed("x", 1).alias("d1"), fixed("x", 2).alias("d2")).collect()
    for r in out:
        if r.x == 0 and math.copysign(1, r.x) < 0:
            continue  # negative zero: sign dropped
        assert (r.d1, r.d2) == ("%.1f" % r.x, "%.2f" % r.x), r.x


def test_known_ties(spark):
    _check(spark, TIES)


def test_random_two_decimal_values(spark):
    rng = random.Random(5)
    _check(spark, [round(rng.uniform(-1000, 1000), rng.choice([1, 2, 3, 4])) for _ in range(3000)])


@settings(max_examples=30, deadline=None)
@given(st.lists(st.floats(min_value=-1e9, max_value=1e9, allow_nan=False), min_size=1, max_size=50))
def test_property_any_double(spark, values):
    _check(spark, values)


def test_pattern_and_specials(spark):
    df = spark.createDataFrame([(6.55,), (None,), (float("nan"),)], "x double")
    out = [r.t for r in df.select(py_format("€ %.2f", "x").alias("t")).collect()]
    assert out == ["€ 6.55", None, "€ nan"]


def test_very_large_and_negative_zero(spark):
    from gridcast.functions.display import fixed

    values = [1e17, -1e17, 123456789012345680.0, -0.0, 0.0, -0.001, 2.0**53]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").select(fixed("x", 2)).collect()]
    assert got == ["%.2f" % v for v in values]
