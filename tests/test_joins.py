"""Balanced joins: results, rows per partition and rows repeated."""

import math

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import joins
from ledgerlens.operators.shared import materialize

PARTITIONS = 16


@pytest.fixture(autouse=True)
def many_partitions(spark, monkeypatch):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(PARTITIONS))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(joins, "LEAST_HOT_ROWS", 50)
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.unset("spark.sql.adaptive.enabled")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def side(spark, rows, hot, name):
    """``hot`` rows of key 0, the others a key each; every 50th key is null."""
    key = F.when(F.col("id") < hot, 0).when(F.col("id") % 50 == 49, None).otherwise(F.col("id"))
    return spark.range(rows).select(key.alias("k"), F.col("id").alias(name))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_left, hot_right", [(0, 0), (900, 1), (3, 900), (900, 40), (300, 200)])
def test_rows_and_balance(spark, how, hot_left, hot_right):
    left, right = side(spark, 3000, hot_left, "a"), side(spark, 2000, hot_right, "b")
    joined = joins.spread_join(left, right, ["k"], ["a"], how)
    expected = left.join(right, ["k"], how)
    assert joined.columns == expected.columns
    assert joined.exceptAll(expected).isEmpty() and expected.exceptAll(joined).isEmpty()
    sizes = [n for (n,) in joined.groupBy(F.spark_partition_id()).count().select("count").collect()]
    if how != "left_anti" or not hot_right:
        assert max(sizes) <= 4 * max(sum(sizes) / PARTITIONS, 100)


def test_smaller_side_is_repeated_as_often_as_needed(spark):
    left, right = side(spark, 3000, 900, "a"), side(spark, 2000, 140, "b")
    hot = joins._hot_keys(left, right, ["k"]).collect()
    assert [(r["k"], r["_deal_left"]) for r in hot] == [(0, True)]
    share = left.na.drop().count() / PARTITIONS
    assert hot[0]["_salts"] == max(math.ceil(900 / share), min(PARTITIONS, math.ceil(900 * 140 / share)))
    hot = joins._hot_keys(right, left, ["k"]).collect()
    assert [(r["k"], r["_deal_left"]) for r in hot] == [(0, False)]
    assert joins._hot_keys(side(spark, 100, 0, "a"), side(spark, 100, 0, "b"), ["k"]).isEmpty()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_keys_stay_together_without_hot_keys(spark, how):
    left, right = side(spark, 3000, 0, "a"), side(spark, 2000, 0, "b")
    joined = joins.spread_join(left, right, ["k"], ["a"], how).where(F.col("k").isNotNull())
    counts = joined.groupBy("k").agg(F.count("a").alias("n"))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(k") == plan.count("Exchange") == 2 and "Union" not in plan
    assert counts.agg(F.sum("n")).first()[0] == left.join(right, ["k"], how).where(F.col("k").isNotNull()).count()


@pytest.mark.parametrize("counters", [1, 7, 1 << 14])
def test_keys_are_counted_only_where_a_counter_is_full(spark, monkeypatch, counters):
    monkeypatch.setattr(joins, "COUNTERS", counters)
    written = []

    def noted(df, name):
        written.append(name)
        return materialize(df, name)

    monkeypatch.setattr(joins, "materialize", noted)
    crowded = joins._crowded_keys(side(spark, 3000, 900, "a"), ["k"])
    assert [tuple(r) for r in crowded.keys.select("k", "_n").collect()] == [(0, 900)]
    assert crowded.share == side(spark, 3000, 900, "a").na.drop().count() / PARTITIONS
    written.clear()
    assert joins._crowded_keys(side(spark, 3000, 0, "a"), ["k"]).keys.isEmpty()
    assert written == (["key_counters"] if counters == 1 << 14 else ["key_counters", "crowded_keys"])


def test_two_keys_and_nulls_without_hot_keys(spark):
    left = side(spark, 700, 0, "a").withColumn("m", F.when(F.col("a") % 3 > 0, F.col("k")))
    right = side(spark, 500, 0, "b").withColumn("m", F.when(F.col("b") % 4 > 0, F.col("k")))
    for how in ("left", "left_anti", "left_semi"):
        joined, expected = joins.spread_join(left, right, ["k", "m"], ["a"], how), left.join(right, ["k", "m"], how)
        assert joined.columns == expected.columns
        assert joined.exceptAll(expected).isEmpty() and expected.exceptAll(joined).isEmpty()
