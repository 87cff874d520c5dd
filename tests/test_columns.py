import datetime
import decimal
import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ledgerlens.functions.columns import (
    clip,
    given_text,
    normalise_status,
    parse_number,
    parse_timestamp,
    round_half_even,
    round_half_up,
)
from ledgerlens.functions.sums import exact_mean, exact_sum, merged_sum, partial_sums, rankable_mean
from ledgerlens.plans.health import risk_category


def one_column(spark, values, kind):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def result(df, column):
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_numbers_from_text_like_pandas(spark):
    texts = ["1", " 2.5 ", "-3", "+4", "1e3", ".5", "5.", "abc", "", "1,000", "12d", "7f", None, "0x10", "1 2", "nan"]
    df = one_column(spark, texts, "string")
    expected = pd.to_numeric(pd.Series(texts), errors="coerce")
    expected[texts.index("0x10")] = np.nan
    assert result(df, parse_number(df, "x")) == [None if pd.isna(v) else v for v in expected]


def test_numbers_without_nan_and_infinity(spark):
    df = one_column(spark, [1.0, float("nan"), float("inf"), None], "double")
    assert result(df, parse_number(df, "x")) == [1.0, None, None, None]


def test_timestamps(spark):
    df = one_column(spark, ["2024-01-02", "2024-01-02 03:04:05", "02/01/2024", "soon", "2024-02-30", None], "string")
    day = datetime.datetime(2024, 1, 2)
    assert result(df, parse_timestamp(df, "x")) == [day, day.replace(hour=3, minute=4, second=5), None, None, None, None]
    assert result(df, parse_timestamp(df, "x", ["dd/MM/yyyy"]))[2] == day


def test_dates_that_are_none(spark):
    df = one_column(spark, ["45292", "2024", "1066-10-14", "9999-01-01", "2024-1-2", "2024-01-02T03:04:05Z"], "string")
    found = result(df, parse_timestamp(df, "x"))
    assert found[:4] == [None] * 4 and found[4] == datetime.datetime(2024, 1, 2) and found[5] is not None


def test_missing_texts(spark):
    df = one_column(spark, ["N/A", "null", "", "NaN", "x", None, "na"], "string")
    assert result(df, given_text(F.col("x"))) == [None, None, None, None, "x", None, "na"]


def test_sums_of_any_finite_value(spark):
    values = [1e300, 1e300, 1e30, 0.1, 0.2, 1e-9, -1e300]
    df = one_column(spark, values, "double")
    total = df.select(exact_sum(F.col("x"))).first()[0]
    assert math.isclose(total, 1e300)
    small = one_column(spark, [0.1] * 10 + [0.0000001] * 3 + [1e-20], "double")
    assert small.select(exact_sum(F.col("x"))).first()[0] == 1.0000003
    assert small.limit(0).select(exact_sum(F.col("x")), exact_mean(F.col("x"))).first() == (None, None)
    assert result(one_column(spark, [1e300, -1e30, 2.345], "double"), round_half_up(F.col("x"), 2)) == [1e300, -1e30, 2.35]


def amounts(n, seed=8):
    """Money, prices with many digits, tiny and absurd values of either sign."""
    rng = np.random.default_rng(seed)
    x = np.concatenate([
        rng.integers(-(10**9), 10**9, n) / 100,
        rng.normal(0, 1e4, n),
        rng.normal(0, 1e-13, n // 4),
        rng.normal(0, 1, n // 4) * 10.0 ** rng.integers(11, 31, n // 4),
        [0.01, 1e30, -0.0, 1e11, -1e11, 99999999999.99, 2.0**53, 1e31, -9e31],
    ])
    rng.shuffle(x)
    return [float(v) for v in x]


def test_sums_do_not_depend_on_the_order_of_rows(spark):
    values = amounts(2000)
    found = set()
    for parts, order in ((1, values), (7, values[::-1]), (13, sorted(values))):
        df = one_column(spark, order, "double").repartition(parts, F.xxhash64("i"))
        two_levels = df.groupBy((F.col("i") % 17).alias("k")).agg(*partial_sums(F.col("x"), "x")).agg(merged_sum("x")).first()[0]
        found |= {df.agg(exact_sum(F.col("x"))).first()[0], two_levels}
    assert len(found) == 1
    assert math.isclose(found.pop(), math.fsum(values), rel_tol=1e-15)


def test_sums_of_decimal_digits(spark):
    """The digits that values print as, and no bits beyond them."""
    for scale, low in ((2, 10), (4, 11), (9, 6)):
        rng = np.random.default_rng(scale)
        values = [float(v) for v in (rng.integers(-(10**low), 10**low, 400) / 10**scale)]
        expected = float(sum(decimal.Decimal(repr(v)) for v in values))
        assert one_column(spark, values, "double").agg(exact_sum(F.col("x"))).first()[0] == expected


def test_small_beside_absurd(spark):
    for values in ([1e30, 0.01, -1e30], [0.01, 1e30, -1e30], [-1e30, 1e30, 0.01]):
        assert one_column(spark, values, "double").coalesce(1).agg(exact_sum(F.col("x"))).first()[0] == 0.01


def test_equal_means_rank_alike(spark):
    rows = [(1, 0.1)] + [(2, v) for v in (0.1, 0.1, 0.1)] + [(3, v) for v in (0.05, 0.15)]
    df = spark.createDataFrame(rows, "k int, x double")
    assert df.groupBy("k").agg(rankable_mean(F.col("x")).alias("m")).select("m").distinct().count() == 1


def test_status(spark):
    df = one_column(spark, ["active", " ACTIVE\t", " paid ", "past due", "", None], "string")
    assert result(df, normalise_status(F.col("x"))) == ["Active", "Active", "Paid", "Past Due", "", "Nan"]


def test_half_even_like_numpy(spark):
    values = [0.125, 0.135, 0.285, 0.575, 2.675, 57.005, 33.335, -0.125, 100.0, None]
    values += list(np.random.default_rng(1).uniform(0, 100, 500).round(3))
    values = [None if v is None else float(v) for v in values]
    expected = [None if v is None else float(np.round(v, 2)) for v in values]
    assert result(one_column(spark, values, "double"), round_half_even(F.col("x"))) == expected


def test_half_up(spark):
    df = one_column(spark, [0.125, 0.285, -0.125, 2.5, 69433.165], "double")
    assert result(df, round_half_up(F.col("x"), 2)) == [0.13, 0.29, -0.13, 2.5, 69433.17]
    assert result(df, round_half_up(F.col("x"), 0)) == [0.0, 0.0, 0.0, 3.0, 69433.0]


def test_clip_keeps_null(spark):
    df = one_column(spark, [-1.0, 0.5, 7.0, None], "double")
    assert result(df, clip(F.col("x"), 0.0, 1.0)) == [0.0, 0.5, 1.0, None]


def test_risk_categories_like_pandas_cut(spark):
    values = [0.0, 40.0, 40.01, 70.0, 70.01, 100.0, 100.01, -0.01, None]
    labels = ["High Risk", "Watchlist", "Healthy"]
    cut = pd.cut(pd.Series(values, dtype=float), bins=[-0.01, 40, 70, 100], labels=labels)
    expected = [None if pd.isna(v) else v for v in cut]
    assert result(one_column(spark, values, "double"), risk_category(F.col("x"))) == expected
