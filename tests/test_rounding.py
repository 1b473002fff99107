"""Exact rounding helpers agree with decimal arithmetic, including ties."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from latewatch.functions.rounding import exact_avg, exact_pct


def ref_avg(vals, d):
    vals = [v for v in vals if v is not None]
    if not vals:
        return None
    s = sum(Decimal(str(v)) for v in vals) / len(vals)
    q = s.copy_abs().quantize(Decimal(1).scaleb(-d), rounding=ROUND_HALF_UP)
    return float(-q if s < 0 else q)


def test_tie_rounds_away_from_zero(spark):
    df = spark.createDataFrame([(2.90,), (2.91,)], "x double")   # mean 2.905
    assert df.agg(exact_avg("x", 2).alias("a")).first().a == 2.91
    df = spark.createDataFrame([(-2.90,), (-2.91,)], "x double")
    assert df.agg(exact_avg("x", 2).alias("a")).first().a == -2.91


def test_empty_group_is_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert df.agg(exact_avg("x", 2).alias("a")).first().a is None


def test_pct(spark):
    df = spark.createDataFrame([(True,), (False,), (False,)], "b boolean")
    assert df.agg(exact_pct(F.col("b")).alias("p")).first().p == 33.3
    df = spark.createDataFrame([(True,)] * 1 + [(False,)] * 7, "b boolean")   # 12.5 exactly
    assert df.agg(exact_pct(F.col("b")).alias("p")).first().p == 12.5


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=-100000, max_value=100000), min_size=1, max_size=40))
def test_matches_decimal(spark, cents):
    vals = [c / 100 for c in cents]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert df.agg(exact_avg("x", 2).alias("a")).first().a == ref_avg(vals, 2)
