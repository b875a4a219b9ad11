"""List aggregates (sum/max) and the result checks."""

import pytest

from conftest import raises_spark, rows
from kestrel.operators import checks, lists


def ints(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v int")


@pytest.mark.parametrize("values,total", [([1, 2, 0], 3), ([1, 2, 0, -1], 2), ([3, 3, 3, 3], 12), ([], 0)])
def test_sum(spark, values, total):
    assert rows(lists.sum_or_zero(ints(spark, values))) == [(total,)]


@pytest.mark.parametrize("values,best", [([3, 7, 2], 7), ([3, 7, 2, -7], 7), ([3, 7, 0, 0], 7)])
def test_max(spark, values, best):
    assert rows(lists.strict_max(ints(spark, values))) == [(best,)]


def test_max_of_empty_raises(spark):
    raises_spark(lambda: lists.strict_max(ints(spark, [])).collect(), "max of an empty column")


def test_expect_row_count(spark):
    df = ints(spark, [1, 2, 3])
    assert rows(checks.expect_row_count(df, 3)) == [(3, 3, True)]
    assert rows(checks.expect_row_count(df, 4)) == [(3, 4, False)]
    raises_spark(lambda: checks.expect_row_count(df, 4, strict=True).collect(), "row count differs")


def test_diff_rows_as_sets(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2), ("y", 2)], "term string, n bigint")
    e = spark.createDataFrame([("y", 2), ("z", 0)], "term string, n bigint")
    assert sorted(rows(checks.diff_rows(a, e))) == [("missing", "z", 0), ("unexpected", "x", 1)]
    assert rows(checks.diff_rows(a, a)) == []


def test_order_violations(spark):
    good = spark.createDataFrame([(1, "a", 5), (2, "b", 3), (3, "c", 3)], "rank int, term string, n bigint")
    bad = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (3, "c", 3)], "rank int, term string, n bigint")
    assert rows(checks.order_violations(good)) == [(3, 0, 0, True)]
    assert rows(checks.order_violations(bad)) == [(3, 1, 0, False)]
    assert rows(checks.order_violations(good, expected=bad)) == [(3, 0, 2, False)]
