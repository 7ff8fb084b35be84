"""Exact rounding helpers against Python's Decimal arithmetic."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflife.functions.money import pct, ratio_half_up


def _expected(n: Decimal, d: Decimal, factor: int, scale: int):
    if d == 0:
        return None
    q = (n * factor) / d
    return q.quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(-10**6, 10**6)), min_size=1, max_size=40))
def test_ratio_matches_decimal(spark, pairs):
    import decimal
    decimal.getcontext().prec = 60
    data = [(Decimal(a).scaleb(-4), Decimal(b).scaleb(-2)) for a, b in pairs]
    schema = T.StructType([T.StructField("n", T.DecimalType(18, 4)), T.StructField("d", T.DecimalType(18, 2))])
    df = spark.createDataFrame(data, schema)
    got = [r[0] for r in df.select(pct(F.col("n"), F.col("d"), num_scale=4, den_scale=2)).collect()]
    want = [_expected(n, d, 100, 2) for n, d in data]
    assert got == want


def test_half_cases(spark):
    df = spark.createDataFrame([(1, 8), (3, 8), (-1, 8), (5, 1000), (0, 3), (1, 0)], "n bigint, d bigint")
    got = [r[0] for r in df.select(ratio_half_up(F.col("n"), F.col("d"), num_scale=0, den_scale=0,
                                                 scale=2)).collect()]
    assert got == [Decimal("0.13"), Decimal("0.38"), Decimal("-0.13"), Decimal("0.01"),
                   Decimal("0.00"), None]
