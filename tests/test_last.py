"""The last row of each group against a sort."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import joins
from ledgerlens.operators.last import FAR, last_rows, microseconds, packed_place
from ledgerlens.operators.shared import Measured, measure, text_bytes

SCHEMA = "k string, t timestamp_ntz, a long, b string, v int"


def rows_of_groups(n, seed=4):
    rng = random.Random(seed)
    days = [datetime(2020, 1, 1) + timedelta(seconds=rng.randrange(10**6), microseconds=rng.randrange(3)) for _ in range(5)]
    days += [None, datetime(1678, 1, 1), datetime(2261, 12, 31, 23, 59, 59, 999999), datetime(1969, 12, 31, 23, 59, 59, 999999)]
    return [
        (f"k{rng.randrange(40) if rng.random() < 0.6 else 0}", rng.choice(days), rng.choice([None, -5, 0, 2**62, i]), rng.choice("abc"), i)
        for i in range(n)
    ]


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("order", [("a", "b", "v"), ("b", "a", "v")])
def test_like_a_sort(spark, monkeypatch, broadcast, order):
    if not broadcast:
        monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
        monkeypatch.setattr(joins, "LEAST_HOT_ROWS", 3)
    data = rows_of_groups(500)
    df = spark.createDataFrame(data, SCHEMA)
    place = packed_place(df, F.coalesce(microseconds(F.col("t")), F.lit(FAR)), order)
    groups = df.groupBy("k").agg(F.max(place).alias("_last"), F.count(F.lit(1)).alias("n"))
    groups = measure(groups, "groups", rows=F.count(F.lit(1)), bytes=text_bytes(groups))
    assert isinstance(groups, Measured)
    found = last_rows(df.select("k", *order, F.col("v").alias("value"), place.alias("_place")), groups, "k", "_place", "_last", order)
    at = {"a": 2, "b": 3, "v": 4}

    def key(r):
        return (r[1] is None, r[1] or datetime.min, *[(r[at[c]] is not None, r[at[c]] if r[at[c]] is not None else 0) if c == "a" else r[at[c]] for c in order])

    expected = {}
    for r in data:
        if r[0] not in expected or key(r) > key(expected[r[0]]):
            expected[r[0]] = r
    assert {r["k"]: r["value"] for r in found.collect()} == {k: r[4] for k, r in expected.items()}


def test_microseconds_order_like_time(spark):
    moments = sorted({r[1] for r in rows_of_groups(300) if r[1]})
    df = spark.createDataFrame([(i, m) for i, m in enumerate(moments)], "i int, t timestamp_ntz")
    found = [r[0] for r in df.orderBy("i").select(microseconds(F.col("t"))).collect()]
    assert found == [(m - datetime(1970, 1, 1)) // timedelta(microseconds=1) for m in moments]


def test_no_sort_of_aggregated_rows(spark):
    from ledgerlens.plans import metrics
    from ledgerlens.sources.fixtures import AS_OF, derive_tables
    from ledgerlens.plans.audit import RevenueAudit

    audit = RevenueAudit(derive_tables(spark, "/root/testdata/sf0.001"), AS_OF)
    figures = metrics._subscription_figures(
        audit.written_subscriptions, AS_OF, place=metrics._signup_place(audit.clean_subscriptions, ["source_seq"], audit.corrections)
    )
    for df in (figures, metrics.latest_attributes(audit.clean_subscriptions, AS_OF)):
        plan = df._jdf.queryExecution().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in figures._jdf.queryExecution().toString()
