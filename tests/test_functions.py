import math
from fractions import Fraction

import pytest

from revops_spark.functions.exprs import (days_between, is_blank, lookup, month_of, pct,
                                          round_ratio)
from revops_spark.functions.stats import erfc, two_sided_p


def half_up(num, den, scale, factor=1):
    if den == 0:
        return None
    q = Fraction(num * factor, den) * 10 ** scale
    sign = -1 if q < 0 else 1
    return sign * math.floor(abs(q) + Fraction(1, 2)) / 10 ** scale


def test_pct_matches_exact_half_up(spark):
    pairs = [(c, n) for n in range(0, 41) for c in range(-3, n + 1)] + [
        (1, 8), (3, 8), (5, 8), (1, 16), (122, 320), (10**9 + 7, 3 * 10**9), (-1, 8), (1, -8)]
    df = spark.createDataFrame(pairs, "c long, n long")
    got = df.select("c", "n", pct("c", "n").alias("p"), round_ratio("c", "n", 1).alias("r")).collect()
    for row in got:
        assert row.p == half_up(row.c, row.n, 2, 100), row
        assert row.r == half_up(row.c, row.n, 1), row


def test_pct_zero_and_null_denominator(spark):
    df = spark.createDataFrame([(0, 0), (5, None), (None, 3)], "c long, n long")
    assert [r.p for r in df.select(pct("c", "n").alias("p")).collect()] == [None, None, None]


def test_pct_has_no_negative_zero(spark):
    df = spark.createDataFrame([(0, -5)], "c long, n long")
    v = df.select(pct("c", "n").alias("p")).first().p
    assert v == 0.0 and math.copysign(1.0, v) == 1.0


def test_erfc_against_math(spark):
    ys = [i / 100 for i in range(0, 801)] + [0.46875, 4.0, 9.5, 17.3, 26.0, 26.5431]
    df = spark.createDataFrame([(y,) for y in ys], "y double")
    for row in df.select("y", erfc("y").alias("e")).collect():
        want = math.erfc(row.y)
        assert row.e == pytest.approx(want, rel=2e-15, abs=1e-300), row


def test_two_sided_p(spark):
    df = spark.createDataFrame([(0.0,), (1.959963984540054,), (-2.5758293035489,), (None,)], "z double")
    got = [r.p for r in df.select(two_sided_p("z").alias("p")).collect()]
    assert got[0] == pytest.approx(1.0)
    assert got[1] == pytest.approx(0.05, rel=1e-12)
    assert got[2] == pytest.approx(0.01, rel=1e-11)
    assert got[3] is None


def test_dates_and_blanks(spark):
    import datetime as dt
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 31), dt.date(2024, 3, 1), None), (dt.date(2024, 2, 29), dt.date(2024, 2, 29), ""),
         (dt.date(2024, 5, 5), dt.date(2024, 5, 4), "x")], "a date, b date, s string")
    rows = df.select(days_between("a", "b").alias("d"), month_of("a").alias("m"),
                     is_blank("s").alias("blank")).collect()
    assert [r.d for r in rows] == [30, 0, -1]
    assert [r.m for r in rows] == [dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 5, 1)]
    assert [r.blank for r in rows] == [True, True, False]


def test_lookup_unknown_is_null(spark):
    df = spark.createDataFrame([("a",), ("zz",), (None,)], "k string")
    got = [r.v for r in df.select(lookup("k", {"a": "A"}).alias("v")).collect()]
    assert got == ["A", None, None]
    assert [r.v for r in df.select(lookup("k", {}).alias("v")).collect()] == [None] * 3
    quoted = [r.v for r in df.select(lookup("k", {"a": "it's"}).alias("v")).collect()]
    assert quoted == ["it's", None, None]


from hypothesis import given, settings, strategies as st

_pairs = st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(-10**9, 10**9)),
                  min_size=1, max_size=200)


@settings(max_examples=15, deadline=None)
@given(_pairs, st.integers(0, 3))
def test_round_ratio_property(spark, pairs, scale):
    """Exact HALF_UP (away from zero) of num / den at any magnitude and sign."""
    df = spark.createDataFrame(pairs, "c long, n long")
    for row in df.select("c", "n", round_ratio("c", "n", scale).alias("r")).collect():
        want = half_up(row.c, row.n, scale)
        assert row.r == (None if want is None else float(want)), row
