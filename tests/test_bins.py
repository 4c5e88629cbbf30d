"""Edge conventions at and around every boundary."""

import math

from pyspark.sql import functions as F

from creditloom.functions.binning import boundary_score, cut_right, equal_width_bin, lerp, quantile_bin, steps_at_or_below
from creditloom.functions import clean

c = F.col


def _col(spark, values, expr, kind="double"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(expr).collect()]


def test_cut_right_is_right_closed(spark):
    assert _col(spark, [0.0, 0.1, 500.0, 500.1, 900.0, 900.1, None], cut_right(c("x"), (0, 500, 900), [1, 2])) == [None, 1, 1, 2, 2, None, None]
    assert _col(spark, [0.0], cut_right(c("x"), (0, 500, 900), [1, 2], include_lowest=True)) == [1]


def test_grade_boundary_belongs_to_the_worse_side(spark):
    assert _col(spark, [0.0599, 0.06, 0.12, 0.9], steps_at_or_below(c("x"), (0.06, 0.12))) == [0, 1, 2, 2]


def test_equal_width_last_bin_is_closed(spark):
    e = equal_width_bin(c("x"), F.lit(0.0), F.lit(10.0), 10)
    assert _col(spark, [-0.1, 0.0, 1.0, 9.99, 10.0, 10.1], e) == [None, 0, 1, 9, 9, None]


def test_quantile_bin_lowest_included_and_open_ends(spark):
    edges = F.array(*[F.lit(v) for v in (0.0, 1.0, 5.0)])
    assert _col(spark, [-1.0, 0.0, 1.0, 1.1, 5.0, 6.0], quantile_bin(c("x"), edges, 2)) == [None, 0, 0, 1, 1, None]
    assert _col(spark, [-1.0, 6.0, None], quantile_bin(c("x"), edges, 2, open_ends=True)) == [0, 1, None]


def test_boundary_score_both_directions(spark):
    assert _col(spark, [569.0, 570.0, 800.0, None], boundary_score(c("x"), (570, 800), True, 7)) == [3, 2, 1, 7]
    assert _col(spark, [0.0, 1.0, 2.0, None], boundary_score(c("x"), (1, 2), False, 5)) == [1, 2, 3, 5]


def test_lerp(spark):
    got = _col(spark, [-1.0, 0.0, 0.5, 1.0, 2.0, None], lerp(c("x"), (0.0, 1.0), (0.2, 0.6)))
    assert [None if v is None else round(v, 9) for v in got] == [0.2, 0.2, 0.4, 0.6, 0.6, None]


def test_null_nan_and_sentinels(spark):
    vals = ["5", "", " ", "MISSING", "abc", "NaN", None]
    assert _col(spark, vals, clean.number(c("x"), 1.0), "string") == [5.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0]
    assert _col(spark, vals, clean.flag(clean.is_missing(c("x"))), "string") == [0, 1, 1, 1, 0, 1, 1]
    assert _col(spark, [1.0, math.nan, math.inf, None], clean.flag(clean.finite(c("x")))) == [1, 0, 0, 0]
    assert _col(spark, [-1.0, None, 2.0], clean.clip(c("x"), 0, 1)) == [0.0, None, 1.0]
